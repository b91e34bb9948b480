"""A stream of noisy records, cleaned and joined to a blocked reference table; each record is scored as it arrives.

The reference index is a table at rest, so the join keeps no state and needs no watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions import text
from kinweave.operators.blocking import Rule, index
from kinweave.operators.prepare import ensure_clean_columns


def link_stream(records: DataFrame, reference: DataFrame, rule: Rule, **kw) -> DataFrame:
    """source1_entity_id, candidate_entity_id, match_probability of every pair that shares a key of the rule, once a key. Works on
    streams and tables alike; the rule's cap holds for the reference table alone."""
    ref = ensure_clean_columns(reference, **kw)
    own = index(ref, [rule]).join(ref.select("entity_id", F.col("name_clean").alias("name1")), "entity_id").select("key", F.col("entity_id").alias("source1_entity_id"), "name1")
    coming = ensure_clean_columns(records, **kw).select(F.explode(rule.keys()).alias("key"), F.col("entity_id").alias("candidate_entity_id"), F.col("name_clean").alias("name2"))
    return coming.join(own, "key").select("source1_entity_id", "candidate_entity_id", _score().alias("match_probability"))


def _score() -> Column:
    tokens = lambda c: F.array_distinct(text.tokens(F.col(c)))
    return text.jaccard(tokens("name1"), tokens("name2"))
