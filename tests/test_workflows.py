"""Models, whole workflows, the command line, sources and streams on a small directory of records."""

import pytest
from pyspark.sql import functions as F

from kinweave.operators import blocking, decision, features, metrics, models, prepare, sampling
from kinweave.plans import cli, pipelines
from kinweave.sources import delimited, scratch
from kinweave.streaming import linking

E, O, P = decision.ENTITY, decision.OTHER, decision.PROB
NOUNS = "otter maple granite harbor violet copper falcon meadow timber saffron juniper pebble".split()


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """TSV files of 60 reference rows, their noisy copies in two sources, and the truth."""
    folder = tmp_path_factory.mktemp("data")
    name = lambda i: f"{NOUNS[i % 12]} {NOUNS[i * 5 % 11]} {chr(97 + i % 26)}{i}works"
    rows = {1: [], 2: [], 3: []}
    truth = []
    for i in range(60):
        country = "Peru" if i % 2 else "Togo"
        rows[1].append((f"S1-{i}", f"{name(i)} Ltd", f"{100 + i} Dock Rd", country))
        if i % 3:
            rows[2].append((f"S2-{i}", name(i).upper(), f"{100 + i} dock road", country))
        if i % 4 == 0:
            rows[3].append((f"S3-{i}", f"{name(i)} Inc.", "", country))
        own = [f"S2-{i}"] * bool(i % 3) + [f"S3-{i}"] * (i % 4 == 0)
        truth.append((f"S1-{i}", ",".join(own)))
    for k, own in rows.items():
        (folder / f"train_source{k}.tsv").write_text("\n".join("\t".join(r) for r in [delimited.SOURCE_COLUMNS, *own]) + "\n", encoding="utf-8")
    (folder / "train_ground_truth.tsv").write_text("\n".join("\t".join(r) for r in [delimited.TRUTH_COLUMNS, *truth]) + "\n", encoding="utf-8")
    return folder


def test_catalog_of_files(spark, data):
    t = delimited.load_catalog(spark, str(data), "train")
    assert {k: v.count() for k, v in t.items()} == {"source1": 60, "source2": 40, "source3": 15, "ground_truth": 60}
    assert spark.table("train_source3").where("business_address is null").count() == 15
    with pytest.raises(Exception):
        delimited.load_catalog(spark, str(data), "absent")["source1"].count()


def test_shared_paths_need_a_setting(spark, monkeypatch):
    class Bare:
        master = "spark://elsewhere"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Bare()

    with pytest.raises(ValueError):
        scratch.shared_path(Session(), "x")


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(f"e{i % 40}", f"t{i}", float(i % 10), float(i % 3), int(i % 10 > 5)) for i in range(400)]
    return spark.createDataFrame(rows, f"{E} string, {O} string, a double, b double, label int")


def test_models(spark, labelled, tmp_path):
    cols = ["a", "b"]
    assert models.train_trees(labelled, cols, 0) is None
    found = models.train_all(labelled, cols, options={"gbt": {"rounds": 3, "least_rows": 2, "feature_share": 1.0}, "gbt_deep": {"rounds": 2}, "random_forest": {"trees": 3, "depth": 3}, "logistic_regression": {"rounds": 10}})
    assert {"gbt", "gbt_deep", "random_forest", "logistic_regression"} <= set(found)
    right = models.predict(found["gbt"], labelled).where((F.col(P) >= 0.5).cast("int") == F.col("label")).count()
    assert right == 400
    shares = models.importances(found["gbt"], cols)
    assert shares[0][0] == "a" and abs(sum(x for _, x in shares) - 1) < 1e-9
    truth = labelled.where("label = 1").select(E, O)
    comparison = models.compare(found, labelled, truth, labelled.select(E).distinct())
    rows = {r["model"]: r["macro_f05"] for r in comparison.collect()}
    assert "blend" in rows and rows["gbt"] == 1.0
    best = models.save_best(found, comparison, cols, str(tmp_path), spark)
    assert rows[best] == max(rows.values()) and spark.read.csv(f"{tmp_path}/comparison", header=True).count() == len(rows)
    info, score = models.load(spark, f"{tmp_path}/best")
    assert info["columns"] == cols and info["figures"]["model"] == best
    assert score(labelled).where(F.col(P) >= 0.5).count() == 160
    with pytest.raises(ValueError):
        score(labelled.drop("a"))
    # an ensemble of saved folders
    models.write_info(spark, f"{tmp_path}/info", {"weights": {"gbt": 3.0, "logistic_regression": 1.0, "random_forest": 0.0}, "columns": cols})
    _, both = models.load(spark, str(tmp_path))
    one = {r[O]: r[P] for r in both(labelled).collect()}
    parts = [{r[O]: r[P] for r in models.predict(found[n], labelled).collect()} for n in ("gbt", "logistic_regression")]
    assert all(abs(one[k] - (3 * parts[0][k] + parts[1][k]) / 4) < 1e-9 for k in one)
    with pytest.raises(ValueError):
        models.blend([("x", 1.0)])


def test_pairwise_commands(spark, data, tmp_path, capsys):
    run = lambda *a: cli.main([a[0], "--data", str(data), *map(str, a[1:])], spark)
    assert run("profile") == 0 and "### Sample" in capsys.readouterr().out
    assert run("block", "--out", tmp_path / "pairs", "--cap", 0.5) == 0
    assert run("features", "--pairs", tmp_path / "pairs", "--out", tmp_path / "features") == 0
    assert set(features.PAIR_FEATURES) <= set(spark.read.parquet(str(tmp_path / "features")).columns)
    assert run("training-data", "--out", tmp_path / "training", "--cap", 0.5) == 0
    assert run("train-pairs", "--pairs", tmp_path / "training", "--models", tmp_path / "m", "--rounds", 3) == 0
    assert run("threshold-search", "--mode", "single", "--pairs", tmp_path / "training", "--models", tmp_path / "m", "--out", tmp_path / "found") == 0
    assert spark.read.csv(str(tmp_path / "found/curve"), header=True).count() == 140
    assert run("threshold-search", "--mode", "dual", "--models", tmp_path / "m", "--out", tmp_path / "found", "--cap", 0.5) == 0
    assert run("infer", "--models", tmp_path / "m", "--out", tmp_path / "out", "--cap", 0.5) == 0
    assert run("validate", "--results", tmp_path / "out/matching_results", "--candidates", tmp_path / "out/candidate_pairs") == 0
    got = delimited.read_tsv(spark, str(tmp_path / "out/matching_results"), delimited.TRUTH_COLUMNS)
    truth = delimited.load_catalog(spark, str(data), "train")["ground_truth"]
    assert metrics.score_lists(got, truth, truth.select(E)).first()["macro_f05"] > 0.7


def test_assignment_commands(spark, data, tmp_path):
    run = lambda *a: cli.main([a[0], "--data", str(data), "--models", str(tmp_path / "m"), *map(str, a[1:])], spark)
    assert run("train", "--rounds", 3, "--k", 3, "--k-name", 3, "--name-max-df", 0.9) == 0
    before = models.read_info(spark, str(tmp_path / "m/info"))["settings"]
    assert run("tune-guard") == 0
    after = models.read_info(spark, str(tmp_path / "m/info"))["settings"]
    assert set(before) == set(after)
    assert run("predict", "--out", tmp_path / "out") == 0
    assert delimited.read_tsv(spark, str(tmp_path / "out"), delimited.TRUTH_COLUMNS).count() == 60


def test_guard_changes_only_what_is_better(spark):
    best = spark.createDataFrame([("a", "t1", 0.9), ("b", "t2", 0.55), ("c", "t3", 0.8)], f"{E} string, {O} string, {P} double")
    truth = spark.createDataFrame([("a", "t1"), ("c", "t3")], f"{E} string, {O} string")
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], f"{E} string")
    s = pipelines.Settings(threshold=0.5)
    assert pipelines.tune_guard(best, truth, ids, pipelines.Settings(threshold=0.6)).threshold == 0.6
    tuned = pipelines.tune_guard(best, truth, ids, s)
    assert tuned is not s and metrics.macro_f05(decision.sole_guard(decision.threshold(best, tuned.threshold), tuned.sole_threshold), truth, ids).first()["macro_f05"] == 1.0


def test_stream_links_as_tables_do(spark, data, tmp_path):
    t = delimited.load_catalog(spark, str(data), "train")
    rule = blocking.Rule("number", lambda: blocking.by_number("address_clean"), 1.0)
    want = linking.link_stream(t["source2"], t["source1"], rule)
    t["source2"].write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(t["source2"].schema).parquet(str(tmp_path / "in"))
    q = linking.link_stream(stream, t["source1"], rule).writeStream.format("memory").queryName("linked").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(spark.table("linked")) == rows(want) and want.count() == 40


def test_whole_pool_is_tuned(spark, data):
    t = delimited.load_catalog(spark, str(data), "train")
    s1, tg = prepare.add_clean_columns(t["source1"]), prepare.add_clean_columns(delimited.stack_targets(t["source2"], t["source3"]))
    score = lambda df: df.withColumn(P, F.col("jaccard_token_similarity"))
    found = pipelines.tune_from_pool(s1, tg, sampling.explode_truth(t["ground_truth"]), score, blocking.default_rules(0.5))
    assert set(found) == {"singleton", "match", "macro_f05"} and found["macro_f05"] > 0.8


def test_blends_in_one_pass_are_those_one_by_one(spark):
    rows = [(f"t{i}", f"e{(i * 7 + j) % 9}", (i * 31 + j * 17) % 23 / 23, (i * 13 + j * 29) % 19 / 19) for i in range(40) for j in range(3)]
    scored = spark.createDataFrame(rows, "tgt string, s1 string, p_a double, p_b double")
    truth = spark.createDataFrame([(f"e{i * 7 % 9}", f"t{i}") for i in range(0, 40, 2)], f"{E} string, {O} string")
    ids = spark.createDataFrame([(f"e{i}",) for i in range(8)] + [("none",)], f"{E} string")
    blended = pipelines.blends(scored)
    got = {(r["w"], r["t"]): r["macro_f05"] for r in pipelines.blend_curves(blended, truth, ids).collect()}
    assert len(got) == 5 * 91
    for w in pipelines.WEIGHTS:
        one = decision.assign(pipelines.as_pairs(scored.withColumn(P, F.lit(w) * F.col("p_a") + F.lit(1 - w) * F.col("p_b"))))
        assert sorted(map(tuple, one.select(O, E, P).collect())) == sorted(map(tuple, blended.where(F.col("w") == w).select(O, E, P).collect()))
        assert {r["t"]: r["macro_f05"] for r in metrics.threshold_curve(one, truth, ids).collect()} == {t: x for (v, t), x in got.items() if v == w}
