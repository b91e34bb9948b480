"""The queries opN_<name>: each applies its operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import counts, idfiles, jaccard, mixing, neighbours, packing, quality, scoring, sharding, warc
from kinweave.llm.common import Scratch, table

SHARDS = 40


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op2_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count(table(spark, sf_dir, "documents"))


def op3_idfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = Scratch(spark, "idfiles")
    idfiles.write(table(spark, sf_dir, "documents"), keep.path("files"))
    return idfiles.described(idfiles.read(spark, keep.path("files")), keep)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(table(spark, sf_dir, "documents"), n_shards=SHARDS)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scoring.score(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", F.round("score", 6).alias("score"), F.round("mean_score", 6).alias("mean_score"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = Scratch(spark, "archive")
    warc.write(table(spark, sf_dir, "pages"), keep.root)
    return warc.records(warc.read(spark, keep.root)).drop("url")


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_jaccard": op1_jaccard, "op2_counts": op2_counts, "op3_idfiles": op3_idfiles, "op4_sharding": op4_sharding, "op5_scoring": op5_scoring, "op6_warc": op6_warc, "op7_neighbours": op7_neighbours, "op8_quality": op8_quality, "op9_packing": op9_packing, "op10_mixing": op10_mixing, "pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {"op1_jaccard": jaccard.SQL, "op5_scoring": scoring.SQL, "op6_warc": warc.SQL, "op7_neighbours": neighbours.SQL}
