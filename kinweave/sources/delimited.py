"""Delimited sources and sinks: all-string schemas, the usual missing-value tokens, no type inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that a reader takes for missing.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
SOURCE_COLUMNS = ("entity_id", "business_name", "business_address", "country")
TRUTH_COLUMNS = ("source1_entity_id", "matched_entity_ids")


def all_strings(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def missing_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NA_TOKENS), c)


def read_tsv(spark: SparkSession, path: str, columns=SOURCE_COLUMNS, limit: int | None = None) -> DataFrame:
    df = spark.read.schema(all_strings(columns)).csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=True, enforceSchema=False)
    df = df.select(*[missing_to_null(F.col(c)).alias(c) for c in columns])
    return df if limit is None else df.limit(limit)


def write_tsv(df: DataFrame, path: str, single: bool = False) -> None:
    (df.coalesce(1) if single else df).write.mode("overwrite").csv(path, sep="\t", header=True, quote='"', escape='"', emptyValue="", nullValue="")


def write_csv(df: DataFrame, path: str) -> None:
    """One file with a header, for small results such as curves."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_catalog(spark: SparkSession, folder: str, split: str) -> dict[str, DataFrame]:
    """The split's tables by name, each also a view; the ground truth only where it is there."""
    out = {f"source{i}": read_tsv(spark, f"{folder}/{split}_source{i}.tsv") for i in (1, 2, 3)}
    truth = f"{folder}/{split}_ground_truth.tsv"
    if exists(spark, truth):
        out["ground_truth"] = read_tsv(spark, truth, TRUTH_COLUMNS)
    for name, df in out.items():
        df.createOrReplaceTempView(f"{split}_{name}")
    return out


def stack_targets(s2: DataFrame, s3: DataFrame) -> DataFrame:
    return s2.withColumn("source", F.lit("S2")).unionByName(s3.withColumn("source", F.lit("S3")))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Candidate pairs, three columns of them; Parquet keeps ids as dictionaries by itself."""
    return spark.read.parquet(path).select("source1_entity_id", "candidate_entity_id", "source")
