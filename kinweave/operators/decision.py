"""Decision rules: thresholds, best-owner assignment, the lone-match guard, and one list of ids an entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

ENTITY, OTHER, PROB = "source1_entity_id", "candidate_entity_id", "match_probability"


def dual_threshold(scored: DataFrame, singleton: float, match: float) -> DataFrame:
    top = F.max(PROB).over(Window.partitionBy(ENTITY))
    return scored.withColumn("__top", top).where((F.col("__top") >= singleton) & (F.col(PROB) >= match)).drop("__top")


def assign(scored: DataFrame) -> DataFrame:
    """The best entity of each target; ties go to the smaller id."""
    best = F.min(F.struct((-F.col(PROB)).alias("p"), F.col(ENTITY).alias("e")))
    return scored.groupBy(OTHER).agg(best.alias("b")).select(OTHER, F.col("b.e").alias(ENTITY), (-F.col("b.p")).alias(PROB))


def threshold(assigned: DataFrame, at: float | Column) -> DataFrame:
    return assigned.where(F.col(PROB) >= at)


def country_threshold(assigned: DataFrame, s1: DataFrame, by_country: dict[str, float], otherwise: float) -> DataFrame:
    """The threshold of the chosen entity's country. The table of thresholds is a parameter, so its size is the caller's."""
    own = s1.select(F.col("entity_id").alias(ENTITY), "country")
    joined = assigned.join(own, ENTITY, "left")
    if not by_country:
        return threshold(joined, otherwise).drop("country")
    limits = F.create_map(*[F.lit(x) for kv in by_country.items() for x in kv])
    return threshold(joined, F.coalesce(F.try_element_at(limits, F.col("country")), F.lit(otherwise))).drop("country")


def sole_guard(kept: DataFrame, at: float | None) -> DataFrame:
    """Drops the only kept assignment of an entity where its probability is under `at`; None keeps all."""
    if at is None:
        return kept
    n = F.count(F.lit(1)).over(Window.partitionBy(ENTITY))
    return kept.withColumn("__n", n).where((F.col("__n") > 1) | (F.col(PROB) >= at)).drop("__n")


def group_ids(pairs: DataFrame, ids: DataFrame, name: str = "matched_entity_ids", distinct: bool = True) -> DataFrame:
    """One row an entity of ids, its partners' ids sorted and comma-joined, "" where it has none."""
    gather = F.collect_set if distinct else F.collect_list
    lists = pairs.groupBy(ENTITY).agg(F.array_join(F.array_sort(gather(OTHER)), ",").alias(name))
    return ids.select(ENTITY).distinct().join(lists, ENTITY, "left").fillna("", [name])


def submission(pairs: DataFrame, s1: DataFrame) -> DataFrame:
    return group_ids(pairs, s1.select(F.col("entity_id").alias(ENTITY)), "candidate_entity_ids")


def group_predictions(scored: DataFrame, s1: DataFrame, singleton: float, match: float) -> DataFrame:
    return group_ids(dual_threshold(scored, singleton, match), s1.select(F.col("entity_id").alias(ENTITY)))
