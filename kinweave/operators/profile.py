"""Profiles of tables: sizes, missing values, duplicates, value counts, and a Markdown report of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dataset_summary(tables: dict[str, DataFrame]) -> DataFrame:
    def one(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"), F.lit(",".join(df.columns)).alias("column_names"), F.lit(",".join(k for _, k in df.dtypes)).alias("dtypes"))

    return reduce(DataFrame.unionByName, [one(k, v) for k, v in tables.items()])


def missing_values(df: DataFrame) -> DataFrame:
    """column_name, n_missing, pct_missing in one pass over the rows."""
    counts = df.agg(F.count(F.lit(1)).alias("__n"), *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    long = counts.unpivot("__n", df.columns, "column_name", "n_missing")
    return long.select("column_name", F.coalesce("n_missing", F.lit(0)).alias("n_missing"), F.round(F.coalesce(F.try_divide(F.col("n_missing") * 100.0, "__n"), F.lit(0.0)), 3).alias("pct_missing"))


def duplicates(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each key; nulls are equal."""
    keys = subset or df.columns
    c = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))
    return c.select("n_rows", "n_duplicates", F.round(F.coalesce(F.try_divide(F.col("n_duplicates") * 100.0, "n_rows"), F.lit(0.0)), 3).alias("pct_duplicates"))


def country_distribution(tables: dict[str, DataFrame], top: int = 15) -> DataFrame:
    def one(name: str, df: DataFrame) -> DataFrame:
        c = df.groupBy(F.coalesce("country", F.lit("<missing>")).alias("country")).agg(F.count(F.lit(1)).alias("n"))
        total = df.agg(F.count(F.lit(1)).alias("t"))
        return c.orderBy(F.col("n").desc(), "country").limit(top).crossJoin(F.broadcast(total)).select(F.lit(name).alias("table_name"), "country", "n", F.round(F.col("n") * 100.0 / F.col("t"), 3).alias("pct"))

    return reduce(DataFrame.unionByName, [one(k, v) for k, v in tables.items()])


def sample_records(df: DataFrame, n: int, key: str) -> DataFrame:
    return df.orderBy(key).limit(n)


def _markdown(df: DataFrame) -> str:
    rows = df.collect()
    line = lambda xs: "| " + " | ".join(map(str, xs)) + " |"
    return "\n".join([line(df.columns), line(["---"] * len(df.columns)), *[line(r) for r in rows]])


def report(tables: dict[str, DataFrame], path: str | None = None, n_samples: int = 5) -> str:
    """Markdown; path: a file beside the driver to write it to as well."""
    parts = ["# Data profile", "## Tables", _markdown(dataset_summary(tables))]
    for name, df in tables.items():
        parts += [f"## {name}", "### Missing values", _markdown(missing_values(df)), "### Duplicates", _markdown(duplicates(df))]
        if "country" in df.columns:
            parts += ["### Countries", _markdown(country_distribution({name: df}))]
        parts += ["### Sample", _markdown(sample_records(df, n_samples, df.columns[0]))]
    text = "\n\n".join(parts) + "\n"
    if path:
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
    return text
