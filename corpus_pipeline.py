"""A training corpus from `documents`: good documents, one of each near-duplicate group, mixed to weights, packed.

All stages: a null text is an empty one, which the quality rules reject; a null id stays null and is the smallest id of a group only
where the group has no other; a null source is a source of its own, after the others. Equal rows are rows of their own until
near-duplicates, where one of them stays; of rows that tie on id and text the one with the smallest digest stays. Very long texts are
read whole. An empty table gives no rows at every stage. Further columns of `documents` are kept as they are up to the last stage,
unless their names begin with two underscores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinweave.llm import jaccard, mixing, packing, quality
from kinweave.llm.common import Scratch, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, null and empty texts among them; ties don't matter."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that 5-word shingles link at a similarity of 0.8 stays: the one with the smallest id.

    Documents without words link with nothing and stay."""
    return jaccard.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is there as often as the mix takes it, from 0 to 2 times; without words it goes."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences; an empty text is a piece of one end id."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("source_mix", source_mix), ("packed", packed)]

#: No SQL: trees, entropy balancing and packing can't be expressed; tests/llm hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep.put(stage(spark, docs, sf_dir), name)
    return docs
