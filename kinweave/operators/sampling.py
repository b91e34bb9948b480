"""Labels, hard negatives and splits. Shuffles go by text.order_key, so every run and engine samples the same rows."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kinweave.functions.text import order_key

PAIR = ["source1_entity_id", "candidate_entity_id"]
log = logging.getLogger(__name__)


def explode_truth(truth: DataFrame) -> DataFrame:
    """Long form of a table with comma-joined ids; null and empty lists have no rows."""
    ids = F.split(F.coalesce("matched_entity_ids", F.lit("")), ",")
    return truth.select("source1_entity_id", F.explode(ids).alias("candidate_entity_id")).withColumn("candidate_entity_id", F.trim("candidate_entity_id")).where("candidate_entity_id <> ''")


def positive_pairs(truth: DataFrame) -> DataFrame:
    return explode_truth(truth).distinct().select(*PAIR, F.when(F.col("candidate_entity_id").startswith("S2"), "S2").otherwise("S3").alias("source"), F.lit(1).alias("label"))


def attach_labels(features: DataFrame, truth_long: DataFrame) -> DataFrame:
    hit = truth_long.select(*PAIR).distinct().withColumn("__hit", F.lit(1))
    return features.join(hit, PAIR, "left").withColumn("label", F.coalesce("__hit", F.lit(0))).drop("__hit")


def owners(truth_long: DataFrame, s1: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """owner of each target (null: none; the largest id where the truth names several), and true_count of each reference row, which counts unknown targets too."""
    known = truth_long.join(s1.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    one = known.groupBy("candidate_entity_id").agg(F.max("source1_entity_id").alias("owner"))
    owner = targets.select(F.col("entity_id").alias("tgt")).join(one, F.col("tgt") == F.col("candidate_entity_id"), "left").select("tgt", "owner")
    counts = known.groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("n"))
    total = s1.select(F.col("entity_id").alias("s1")).join(counts, F.col("s1") == F.col("source1_entity_id"), "left").select("s1", F.coalesce("n", F.lit(0)).alias("true_count"))
    return owner, total


def label_candidates(candidates: DataFrame, owner: DataFrame) -> DataFrame:
    own = owner.select(F.col("tgt").alias("__t"), F.col("owner").alias("__o"))
    return candidates.join(own, F.col("tgt") == F.col("__t"), "left").withColumn("label", F.coalesce((F.col("s1") == F.col("__o")).cast("int"), F.lit(0))).drop("__t", "__o")


def not_in(pairs: DataFrame, positives: DataFrame) -> DataFrame:
    return pairs.join(positives.select(*PAIR), PAIR, "left_anti")


def hard_negatives(pairs: DataFrame, positives: DataFrame, per_positive: int = 6, seed: int = 42) -> DataFrame:
    """Candidates that are not matches, of each entity at most max(matches, 1) x per_positive."""
    quota = positives.groupBy("source1_entity_id").agg((F.count(F.lit(1)) * per_positive).alias("quota"))
    w = Window.partitionBy("source1_entity_id").orderBy(order_key(seed, *map(F.col, PAIR)), "candidate_entity_id")
    ranked = not_in(pairs.select(*PAIR, "source"), positives).withColumn("r", F.row_number().over(w)).join(quota, "source1_entity_id", "left")
    return ranked.where(F.col("r") <= F.coalesce("quota", F.lit(per_positive))).select(*PAIR, "source", F.lit(0).alias("label"))


def labeled_pairs(pairs: DataFrame, truth: DataFrame, per_positive: int = 6, seed: int = 42) -> DataFrame:
    positives = positive_pairs(truth)
    return positives.unionByName(hard_negatives(pairs, positives, per_positive, seed))


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select("source1_entity_id").distinct()


PARTS = 1 << 16


def first_in_order(ids: DataFrame, column: str, n: int, seed: int) -> DataFrame:
    """The first n distinct ids in the order of their keys. A histogram of the keys finds the part that the cut lies in, and only
    that part is ranked."""
    keyed = ids.select(column, order_key(seed, F.col(column)).alias("key")).withColumn("part", F.floor(F.col("key") / (1 << 32) * PARTS).cast("int"))
    w = Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy("part").agg(F.count(F.lit(1)).alias("c"))  # PARTS rows at most
    before = F.broadcast(counts.select("part", "c", F.coalesce(F.sum("c").over(w), F.lit(0)).alias("before")))
    near = keyed.join(before.where(F.col("before") < n), "part")
    rank = F.row_number().over(Window.partitionBy("part").orderBy("key", column))
    whole = near.where(F.col("before") + F.col("c") <= n).select(column)
    return whole.unionByName(near.where(F.col("before") + F.col("c") > n).withColumn("r", rank).where(F.col("before") + F.col("r") <= n).select(column))


def split(pairs: DataFrame, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """is_validation of every row; by entity, with exactly round(n x fraction) entities held out."""
    ids = _ids(pairs)
    n = round(ids.count() * fraction)
    held = first_in_order(ids, "source1_entity_id", n, seed).withColumn("is_validation", F.lit(True))
    return pairs.join(held, "source1_entity_id", "left").withColumn("is_validation", F.coalesce("is_validation", F.lit(False)))


def strata(pairs: DataFrame, s1: DataFrame) -> DataFrame:
    """source1_entity_id, stratum: by number of matches and country."""
    n = F.sum((F.col("label") == 1).cast("int"))
    kinds = pairs.groupBy("source1_entity_id").agg(F.when(n == 0, "singleton").when(n == 1, "single_match").otherwise("multi_match").alias("kind"))
    country = s1.select(F.col("entity_id").alias("source1_entity_id"), "country")
    return kinds.join(country, "source1_entity_id", "left").select("source1_entity_id", F.concat_ws("|", "kind", F.coalesce(F.nullif("country", F.lit("")), F.lit("UNKNOWN"))).alias("stratum"))


def stratified_split(pairs: DataFrame, s1: DataFrame, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """split() within strata. Strata of one entity are merged; if a stratum of fewer than two remains, the split is plain."""
    own = strata(pairs, s1)
    sizes = own.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    merged = own.join(sizes, "stratum").withColumn("stratum", F.when(F.col("n") == 1, "OTHER").otherwise(F.col("stratum"))).drop("n")
    small = merged.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    if small.where("n < 2").limit(1).count():
        log.warning("a stratum has one entity: the split is not stratified")
        return split(pairs, fraction, seed)
    w = Window.partitionBy("stratum").orderBy(order_key(seed, F.col("source1_entity_id")), "source1_entity_id")
    held = merged.withColumn("r", F.row_number().over(w)).join(small, "stratum").select("source1_entity_id", (F.col("r") <= F.floor(F.col("n") * fraction + 0.5)).alias("is_validation"))
    return pairs.join(held, "source1_entity_id")


def bernoulli(ids: DataFrame, column: str, fraction: float, seed: int) -> DataFrame:
    return ids.where(order_key(seed, F.col(column)) < int(fraction * (1 << 32)))


def hashed_share(c: Column, fraction: float, seed: int) -> Column:
    return order_key(seed, c) < int(fraction * (1 << 32))
