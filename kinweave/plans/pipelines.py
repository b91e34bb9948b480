"""The whole workflows as lazy plans: pairwise linkage (v1) and target-centric assignment (v2)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators import blocking, decision, features, metrics, models, retrieval, sampling, validate
from kinweave.operators.prepare import ensure_clean_columns, load_split
from kinweave.sources.scratch import settled, together

ENTITY, OTHER, PROB = decision.ENTITY, decision.OTHER, decision.PROB
#: Weights of the first model against the second one that are tried; among equally good ones the first.
WEIGHTS = (1.0, 0.75, 0.5, 0.25, 0.0)
#: Rows of training pairs a partition, whatever the shuffle's number is: each level of a tree is a job over all of them. Up to
#: TRAIN_PARTS partitions have the lower number of rows; beyond that they grow to the higher one, as every task costs its start.
TRAIN_ROWS, TRAIN_PARTS = (20_000, 200_000), 24


@dataclass
class Settings:
    k: int = 10
    k_name: int = 10
    max_df: int = 5000
    name_max_df: float = 0.01
    name_channel: str = "skeleton"
    threshold: float = 0.5
    sole_threshold: float | None = None
    country_thresholds: dict[str, float] = field(default_factory=dict)
    seed: int = 42
    held_share: float = 0.2
    target_share: float = 0.4


def as_pairs(candidates: DataFrame) -> DataFrame:
    return candidates.withColumnsRenamed({"s1": ENTITY, "tgt": OTHER})


def candidate_matrix(records: DataFrame, s: Settings, **kw) -> DataFrame:
    """tgt, s1 and all features of every retrieved pair, written once: training and prediction on the same records share them."""
    s1, targets = load_split(records, **kw)
    candidates = retrieval.retrieve(s1, targets, s.k, s.max_df, s.k_name, s.name_max_df, s.name_channel)
    return settled(features.feature_matrix(candidates, s1, targets), "matrix")


def blends(scored: DataFrame, weights=WEIGHTS) -> DataFrame:
    """Each target's best reference row for every weight w of p_a against p_b, as decision.assign finds it: w, OTHER, ENTITY, PROB."""
    best = lambda w: F.min(F.struct((-(F.lit(w) * F.col("p_a") + F.lit(1 - w) * F.col("p_b"))).alias("p"), F.col("s1").alias("e")))
    each = scored.groupBy("tgt").agg(F.array(*[F.struct(F.lit(float(w)).alias("w"), best(w).alias("b")) for w in weights]).alias("x"))
    return each.select(F.col("tgt").alias(OTHER), F.explode("x").alias("x")).select("x.w", OTHER, F.col("x.b.e").alias(ENTITY), (-F.col("x.b.p")).alias(PROB))


def blend_curves(blended: DataFrame, truth_long: DataFrame, ids: DataFrame, weights=WEIGHTS) -> DataFrame:
    """w, t, macro_f05: metrics.threshold_curve of every weight, all in one pass. An entity counts once a weight, under a name of its own."""
    ws = F.explode(F.array(*[F.lit(float(w)) for w in weights])).alias("w")
    own = lambda df: df.withColumn(ENTITY, F.concat_ws("|", "w", ENTITY))
    return metrics.threshold_curve(own(blended), own(truth_long.select(ENTITY, OTHER, ws)), own(ids.select(ENTITY, ws)), by=["w"])


def train_parts(n: int) -> int:
    few, many = TRAIN_ROWS
    return max(1, -(-n // many), min(TRAIN_PARTS, -(-n // few)))


def train_assignment(records: DataFrame, truth_long: DataFrame, s: Settings, rounds: int = 20, matrix: DataFrame | None = None, found: dict | None = None, **kw) -> tuple[Settings, dict, dict]:
    """Models, tuned settings and figures. Held-out entities tune the blend, the threshold and each country's threshold. matrix:
    candidate_matrix of these records and settings, where it is there already. found: gets as "best" what best_owners returns for
    these records by the tuned blend, so that they needn't be scored again."""
    s1, targets = load_split(records, **kw)
    matrix = candidate_matrix(records, s, **kw) if matrix is None else matrix
    truth_long = settled(truth_long.select(ENTITY, OTHER), "truth")
    labelled = sampling.label_candidates(matrix, sampling.owners(truth_long, s1, targets)[0])
    held_ids = settled(s1.where(sampling.hashed_share(F.col("entity_id"), s.held_share, s.seed)).select(F.col("entity_id").alias(ENTITY), "country"), "held")
    held = sampling.hashed_share(F.col("s1"), s.held_share, s.seed)
    train = labelled.where(~held & sampling.hashed_share(F.col("tgt"), s.target_share, s.seed + 1)).withColumn("stop", sampling.hashed_share(F.concat_ws("|", "tgt", "s1"), 0.2, s.seed + 2))
    train = train.repartition(train_parts(train.count()), "tgt", "s1").sortWithinPartitions("tgt", "s1").persist()
    fit = lambda **kw: models.train_trees(train, features.FEATURES, rounds, held="stop", **kw)
    try:
        a, b = together(train.sparkSession, lambda: fit(seed=s.seed), lambda: fit(depth=8, rate=0.15, seed=s.seed + 1))
    finally:
        train.unpersist()
    scored = settled(models.predict(b, models.predict(a, matrix, "p_a"), "p_b").select("tgt", "s1", "p_a", "p_b"), "scored")
    blended = settled(blends(scored), "blended")
    tune = lambda: blend_curves(blended, truth_long, held_ids).orderBy(F.col("macro_f05").desc(), F.col("w").desc(), "t").select("macro_f05", "w", "t").first()
    (score, w, t), (ceiling,) = together(train.sparkSession, tune, lambda: metrics.retrieval_ceiling(labelled, truth_long, held_ids).select("macro_f05").first())
    best = blended.where(F.col("w") == w).drop("w")
    if found is not None:
        found["best"] = best
    by_country = metrics.threshold_curve(best, truth_long, held_ids, by=["country"])
    rows = by_country.groupBy("country").agg(F.min(F.struct((-F.col("macro_f05")).alias("f"), "t")).alias("b")).select("country", "b.t").collect()
    tuned = Settings(**{**s.__dict__, "threshold": t, "country_thresholds": {r["country"]: r["t"] for r in rows}})
    return tuned, {"a": (a, w), "b": (b, 1 - w)}, {"macro_f05": score, "ceiling": ceiling}


def best_owners(records: DataFrame, score, s: Settings, matrix: DataFrame | None = None, **kw) -> tuple[DataFrame, DataFrame]:
    """Each target's best reference row with its probability, and the reference table."""
    s1, targets = load_split(records, **kw)
    if matrix is None:
        candidates = retrieval.retrieve(s1, targets, s.k, s.max_df, s.k_name, s.name_max_df, s.name_channel)
        matrix = features.feature_matrix(candidates, s1, targets)
    scored = settled(score(matrix).select("tgt", "s1", PROB), "scored")  # tune_guard reads them several times
    return decision.assign(as_pairs(scored)), s1


def predict_assignment(records: DataFrame, score, s: Settings, threshold: float | None = None, matrix: DataFrame | None = None, **kw) -> DataFrame:
    """One row an entity of S1 with its ids. A threshold given here turns off countries' thresholds and the lone-match guard."""
    return owner_lists(*best_owners(records, score, s, matrix, **kw), s, threshold)


def owner_lists(best_pairs: DataFrame, s1: DataFrame, s: Settings, threshold: float | None = None) -> DataFrame:
    if threshold is not None:
        kept = decision.threshold(best_pairs, threshold)
    else:
        kept = decision.sole_guard(decision.country_threshold(best_pairs, s1, s.country_thresholds, s.threshold), s.sole_threshold)
    return decision.group_ids(kept, s1.select(F.col("entity_id").alias(ENTITY)), distinct=False)


def tune_guard(best_pairs: DataFrame, truth_long: DataFrame, held_ids: DataFrame, s: Settings) -> Settings:
    """The best (threshold, lone-match threshold); as it was where nothing is better."""
    base = metrics.threshold_curve(best_pairs, truth_long, held_ids, [s.threshold]).first()["macro_f05"]
    top = metrics.guard_grid(best_pairs, truth_long, held_ids, s.threshold).orderBy(F.col("macro_f05").desc(), "t", F.col("sole").asc_nulls_first()).first()
    if top["macro_f05"] <= base:
        return s
    return Settings(**{**s.__dict__, "threshold": top["t"], "sole_threshold": top["sole"], "country_thresholds": {}})


def training_pairs(s1: DataFrame, targets: DataFrame, truth: DataFrame, rules=None, stratified: bool = True, seed: int = 42, **kw) -> DataFrame:
    """v1: labelled pairs with features and is_validation."""
    s1, targets = ensure_clean_columns(s1, **kw), ensure_clean_columns(targets, **kw)
    labelled = sampling.labeled_pairs(blocking.candidate_pairs(s1, targets, rules), truth, seed=seed)
    ready = features.pair_features(labelled, s1, targets)
    return sampling.stratified_split(ready, s1, seed=seed) if stratified else sampling.split(ready, seed=seed)


def run_inference(s1: DataFrame, targets: DataFrame, score, singleton: float, match: float, rules=None, **kw) -> tuple[DataFrame, DataFrame]:
    """v1: matching results, and the candidates as they were before any threshold."""
    s1, targets = ensure_clean_columns(s1, **kw), ensure_clean_columns(targets, **kw)
    pairs = settled(blocking.candidate_pairs(s1, targets, rules), "pairs")
    candidates = decision.submission(pairs, s1)
    scored = score_pairs(pairs, s1, targets, score)
    results = decision.group_predictions(scored, s1, singleton, match)
    validate.require_valid(results, candidates, s1.select(F.col("entity_id").alias(ENTITY)))
    return results, candidates


def score_pairs(pairs: DataFrame, s1: DataFrame, targets: DataFrame, score, keep=None, **kw) -> DataFrame:
    """Pairs with match_probability; keep: a condition on the scored rows. No pairs give a typed table without rows."""
    s1, targets = ensure_clean_columns(s1, **kw), ensure_clean_columns(targets, **kw)
    scored = score(features.pair_features(pairs, s1, targets)).select(ENTITY, OTHER, PROB)
    return scored if keep is None else scored.where(keep)


def tune_on_entities(scored: DataFrame, truth: DataFrame, ids: DataFrame, singleton: list[float] = metrics.DUAL, match: list[float] = metrics.DUAL) -> dict[str, float]:
    """The dual thresholds that score best over the given entities; among equal ones the lowest."""
    top = metrics.best(metrics.dual_grid(scored, truth, ids, singleton, match), by=("ts", "tm")).first()
    return {"singleton": top["ts"], "match": top["tm"], "macro_f05": top["macro_f05"]}


def tune_from_pool(s1: DataFrame, targets: DataFrame, truth: DataFrame, score, rules=None, **kw) -> dict[str, float]:
    """Clean, block, score and tune over all entities, on the whole candidate pool."""
    s1, targets = ensure_clean_columns(s1, **kw), ensure_clean_columns(targets, **kw)
    scored = score_pairs(blocking.candidate_pairs(s1, targets, rules), s1, targets, score)
    return tune_on_entities(settled(scored, "scored"), truth, s1.select(F.col("entity_id").alias(ENTITY)))


def resolve_threshold(given: float | None, dual: dict | None, single: dict | None, key: str) -> float:
    """The command line's value, else the dual search's, else the single one's; each threshold by itself."""
    for value in (given, (dual or {}).get(key), (single or {}).get("threshold")):
        if value is not None:
            return float(value)
    raise ValueError(f"no value for {key}")
