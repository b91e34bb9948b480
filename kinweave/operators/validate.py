"""Checks of result lists: coverage, duplicates, order, and matches that are among the candidates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITY = "source1_entity_id"


def _list(c: str) -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), ","), lambda x: x != "")


def checks(results: DataFrame, candidates: DataFrame, ids: DataFrame, column: str = "matched_entity_ids", pool: str = "candidate_entity_ids") -> DataFrame:
    """check, n_bad for each check."""
    got, want = results.select(ENTITY), ids.select(ENTITY).distinct()
    own = results.select(ENTITY, _list(column).alias("a"))
    joined = own.join(candidates.select(ENTITY, _list(pool).alias("b")), ENTITY)
    count = lambda name, df: df.agg(F.count(F.lit(1)).alias("n_bad")).select(F.lit(name).alias("check"), "n_bad")
    found = [
        count("missing_ids", want.join(got, ENTITY, "left_anti")),
        count("extra_ids", got.distinct().join(want, ENTITY, "left_anti")),
        got.groupBy(ENTITY).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n_bad")).select(F.lit("duplicate_rows").alias("check"), "n_bad"),
        count("duplicate_ids_in_row", own.where(F.size("a") != F.size(F.array_distinct("a")))),
        count("unsorted_ids_in_row", own.where(F.col("a") != F.array_sort("a"))),
        count("not_among_candidates", joined.where(F.size(F.array_except("a", "b")) > 0)),
    ]
    return reduce(DataFrame.unionByName, found)


MATTER = ("missing_ids", "extra_ids", "duplicate_rows", "duplicate_ids_in_row", "not_among_candidates")


def require_valid(results: DataFrame, candidates: DataFrame, ids: DataFrame) -> None:
    bad = [f"{r['check']}: {r['n_bad']}" for r in checks(results, candidates, ids).where(F.col("check").isin(*MATTER) & (F.col("n_bad") > 0)).collect()]
    if bad:
        raise ValueError("invalid results: " + "; ".join(bad))


def messages(results: DataFrame, candidates: DataFrame, ids: DataFrame) -> list[str]:
    """All failures; the subset check only where the others pass."""
    found = [(r["check"], r["n_bad"]) for r in checks(results, candidates, ids).collect()]
    bad = [f"{c}: {n}" for c, n in found if n and c != "not_among_candidates"]
    return bad or [f"{c}: {n}" for c, n in found if n]


def raw_file(spark: SparkSession, path: str, header: tuple[str, ...]) -> DataFrame:
    """Tab counts and the first line of one file as it is: check, n_bad; blank lines don't count for tabs."""
    every = spark.read.text(path)
    lines = every.where(F.trim("value") != "")
    tabs = F.length("value") - F.length(F.replace("value", F.lit("\t"), F.lit("")))
    bad = lines.where(tabs != len(header) - 1).agg(F.count(F.lit(1)).alias("n_bad")).select(F.lit("tabs").alias("check"), "n_bad")
    first = every.limit(1).where(F.col("value") == "\t".join(header))
    heads = first.agg((F.lit(1) - F.count(F.lit(1))).alias("n_bad")).select(F.lit("header").alias("check"), "n_bad")
    return bad.unionByName(heads)
