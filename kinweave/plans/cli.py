"""python -m kinweave.plans.cli COMMAND --data DIR --split S ...: the workflows from the command line.

  profile        [--out FILE]                      Markdown profile of the sources
  block          --out DIR [--cap R]               candidate pairs (Parquet), statistics and recall
  features       --pairs DIR --out DIR             pair features of candidate pairs (Parquet)
  training-data  --out DIR [--cap R]               labelled pairs with features and is_validation (Parquet)
  train-pairs    --pairs DIR --models DIR          pair models from training-data, compared, the best one kept
  threshold-search --mode single --pairs DIR --models DIR --out DIR    class curve of the held-out pairs (CSV), its best row
  threshold-search --mode dual --models DIR --out DIR [--cap R]        dual thresholds over the whole candidate pool (CSV)
  infer          --models DIR --out DIR --singleton T --match T [--cap R]   lists of matches and candidates (TSV)
  train          --models DIR                      target-centric models and settings
  tune-guard     --models DIR                      threshold and lone-match threshold, kept where they are better
  predict        --models DIR --out DIR            lists of matches (TSV)
  validate       --results F --candidates F
"""

from __future__ import annotations

import argparse
from dataclasses import fields

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from kinweave.operators import blocking, features, metrics, models, profile, sampling, validate
from kinweave.operators.prepare import ensure_clean_columns
from kinweave.plans import pipelines
from kinweave.sources import delimited

ENTITY = pipelines.ENTITY
NEEDS = {
    "profile": (), "block": ("out",), "features": ("pairs", "out"), "training-data": ("out",), "train-pairs": ("pairs", "models"), "threshold-search": ("models", "out"),
    "infer": ("models", "out"), "train": ("models",), "tune-guard": ("models",), "predict": ("models", "out"), "validate": ("results", "candidates"),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kinweave")
    sub = p.add_subparsers(dest="command", required=True)
    for name, needed in NEEDS.items():
        c = sub.add_parser(name)
        c.add_argument("--data", required=True)
        c.add_argument("--split", default="train")
        for x in needed:
            c.add_argument(f"--{x}", required=True)
        if name == "profile":
            c.add_argument("--out")
        if name in ("block", "training-data", "threshold-search", "infer"):
            c.add_argument("--cap", type=float, default=blocking.CAP)
        if name == "threshold-search":
            c.add_argument("--mode", choices=("single", "dual"), required=True)
            c.add_argument("--pairs")
        if name == "infer":
            c.add_argument("--singleton", type=float)
            c.add_argument("--match", type=float)
        if name in ("train", "predict"):
            c.add_argument("--k", type=int, default=10)
            c.add_argument("--k-name", type=int, default=10)
            c.add_argument("--name-channel", choices=("char", "skeleton"), default="skeleton")
            c.add_argument("--name-max-df", type=float, default=0.01)
        if name in ("train", "train-pairs"):
            c.add_argument("--rounds", type=int, default=100)
        if name == "predict":
            c.add_argument("--threshold", type=float)
    return p


def _settings(info: dict) -> pipelines.Settings:
    known = {f.name for f in fields(pipelines.Settings)}
    return pipelines.Settings(**{k: v for k, v in info["settings"].items() if k in known})


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("kinweave").getOrCreate()
    t = delimited.load_catalog(spark, a.data, a.split)
    targets = delimited.stack_targets(t["source2"], t["source3"])
    ids = t["source1"].select(F.col("entity_id").alias(ENTITY))
    records = t["source1"].withColumn("source", F.lit("S1")).unionByName(targets)
    return COMMANDS[a.command](spark, a, t, targets, ids, records) or 0


def _profile(spark, a, t, targets, ids, records):
    text = profile.report({k: v for k, v in t.items() if k != "ground_truth"}, a.out)
    if not a.out:
        print(text)


def _block(spark, a, t, targets, ids, records):
    s1, tg = ensure_clean_columns(t["source1"]), ensure_clean_columns(targets)
    blocking.candidate_pairs(s1, tg, blocking.default_rules(a.cap)).write.mode("overwrite").parquet(a.out)
    pairs = spark.read.parquet(a.out)
    blocking.blocking_stats(pairs, s1, tg).show()
    if "ground_truth" in t:
        blocking.blocking_recall(pairs, sampling.explode_truth(t["ground_truth"])).show()


def _features(spark, a, t, targets, ids, records):
    features.pair_features(delimited.read_pairs(spark, a.pairs), ensure_clean_columns(t["source1"]), ensure_clean_columns(targets)).write.mode("overwrite").parquet(a.out)


def _training_data(spark, a, t, targets, ids, records):
    pipelines.training_pairs(t["source1"], targets, t["ground_truth"], blocking.default_rules(a.cap)).write.mode("overwrite").parquet(a.out)


def _train_pairs(spark, a, t, targets, ids, records):
    pairs = spark.read.parquet(a.pairs)
    columns = features.PAIR_FEATURES
    found = models.train_all(pairs.where("not is_validation"), columns, options={n: {"rounds": a.rounds} for n in (*models.BOOSTERS, "logistic_regression")})
    held = pairs.where("is_validation")
    comparison = models.compare(found, held, sampling.explode_truth(t["ground_truth"]), held.select(ENTITY).distinct())
    print("best:", models.save_best(found, comparison, columns, a.models, spark))


def _threshold_search(spark, a, t, targets, ids, records):
    _, score = models.load(spark, f"{a.models}/best")
    if a.mode == "single":
        if not a.pairs:
            raise SystemExit("--mode single needs --pairs")
        curve = metrics.class_curve(score(spark.read.parquet(a.pairs).where("is_validation")), metrics.steps(0.30, 0.99, 140))
        delimited.write_csv(curve.orderBy("t"), f"{a.out}/curve")
        found = {"threshold": metrics.best(curve).first()["t"]}
    else:
        found = pipelines.tune_from_pool(t["source1"], targets, sampling.explode_truth(t["ground_truth"]), score, blocking.default_rules(a.cap))
        delimited.write_csv(spark.createDataFrame([found]), f"{a.out}/dual")
    models.write_info(spark, f"{a.models}/{a.mode}", found)
    print(found)


def _infer(spark, a, t, targets, ids, records):
    told = {mode: models.read_info(spark, f"{a.models}/{mode}") for mode in ("single", "dual")}
    singleton, match = (pipelines.resolve_threshold(given, told["dual"], told["single"], key) for key, given in (("singleton", a.singleton), ("match", a.match)))
    _, score = models.load(spark, f"{a.models}/best")
    results, candidates = pipelines.run_inference(t["source1"], targets, score, singleton, match, blocking.default_rules(a.cap))
    delimited.write_tsv(results, f"{a.out}/matching_results")
    delimited.write_tsv(candidates, f"{a.out}/candidate_pairs")


def _train(spark, a, t, targets, ids, records):
    s = pipelines.Settings(k=a.k, k_name=a.k_name, name_channel=a.name_channel, name_max_df=a.name_max_df)
    tuned, found, figures = pipelines.train_assignment(records, sampling.explode_truth(t["ground_truth"]), s, a.rounds)
    models.save(found, features.FEATURES, a.models, spark, settings=tuned.__dict__, figures=figures)
    print(figures)


def _tune_guard(spark, a, t, targets, ids, records):
    info, score = models.load(spark, a.models)
    s = _settings(info)
    truth, held = sampling.explode_truth(t["ground_truth"]), ids.where(sampling.hashed_share(F.col(ENTITY), s.held_share, s.seed))
    tuned = pipelines.tune_guard(pipelines.best_owners(records, score, s)[0], truth, held, s)
    if tuned is not s:
        models.write_info(spark, f"{a.models}/info", info | {"settings": tuned.__dict__})
    print(tuned)


def _predict(spark, a, t, targets, ids, records):
    info, score = models.load(spark, a.models)
    delimited.write_tsv(pipelines.predict_assignment(records, score, _settings(info), a.threshold), a.out)


def _validate(spark, a, t, targets, ids, records):
    results = delimited.read_tsv(spark, a.results, delimited.TRUTH_COLUMNS)
    candidates = delimited.read_tsv(spark, a.candidates, (ENTITY, "candidate_entity_ids"))
    bad = validate.messages(results, candidates, ids)
    print("\n".join(bad) or "valid")
    return 1 if bad else 0


COMMANDS = {
    "profile": _profile, "block": _block, "features": _features, "training-data": _training_data, "train-pairs": _train_pairs, "threshold-search": _threshold_search,
    "infer": _infer, "train": _train, "tune-guard": _tune_guard, "predict": _predict, "validate": _validate,
}


if __name__ == "__main__":
    raise SystemExit(main())
