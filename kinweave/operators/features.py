"""Pair features: native similarities, one Arrow UDF for the fuzzy ones, and features relative to competing candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kinweave.functions import fuzzy, text
from kinweave.operators import retrieval

# The features and their order.
NATIVE = ("exact_country_match", "first_word_match", "prefix_match", "name_length_diff", "address_length_diff", "numeric_overlap", "jaccard_token_similarity", "name_bigram_jaccard", "name_trigram_dice", "postal_code_match")
STRING = fuzzy.FIELDS[:10] + NATIVE
SKELETON = fuzzy.FIELDS[10:]
RANK = ("rank_within_entity", "is_top1_for_entity", "score_margin_to_next")
PAIR_FEATURES = STRING + RANK
RETRIEVAL = ("cos", "rank", "gap_to_top1", "margin_to_next", "n_cands", "s1_top1_count", "s1_cand_count", "s1_reverse_rank", "s1_best_cos_gap", "cos_name", "name_rank", "name_gap_to_top1", "in_name_retrieval", "in_combined_retrieval", "both_channels_retrieved")
RELATIVE_BASE = ("name_jaro_winkler", "token_sort_ratio", "name_bigram_jaccard", "address_token_similarity", "address_partial_similarity", "address_lcs_ratio", "skel_token_set_ratio")
RELATIVE = tuple(f"{c}_gap_to_best" for c in RELATIVE_BASE)
FEATURES = RETRIEVAL + STRING + SKELETON + RELATIVE


def native(prefix_len: int = 3) -> dict[str, Column]:
    """Over name1, address1, country1 and name2, address2, country2, none of them null."""
    c = F.col
    t1, t2 = text.tokens(c("name1")), text.tokens(c("name2"))
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("int")
    return {
        "exact_country_match": flag((c("country1") != "") & (c("country1") == c("country2"))),
        "first_word_match": flag(F.try_element_at(t1, F.lit(1)) == F.try_element_at(t2, F.lit(1))),
        "prefix_match": flag((c("name1") != "") & (F.substring("name1", 1, prefix_len) == F.substring("name2", 1, prefix_len))),
        "name_length_diff": F.abs(F.length("name1") - F.length("name2")),
        "address_length_diff": F.abs(F.length("address1") - F.length("address2")),
        "numeric_overlap": text.jaccard(text.numbers(c("address1")), text.numbers(c("address2"))),
        "jaccard_token_similarity": text.jaccard(F.array_distinct(t1), F.array_distinct(t2)),
        "name_bigram_jaccard": text.jaccard(text.char_ngrams(c("name1"), 2), text.char_ngrams(c("name2"), 2)),
        "name_trigram_dice": text.dice(text.char_ngrams(c("name1"), 3), text.char_ngrams(c("name2"), 3)),
        "postal_code_match": flag(text.postal_code(c("address1")) == text.postal_code(c("address2"))),
    }


def with_texts(pairs: DataFrame, s1: DataFrame, targets: DataFrame, left: str = "source1_entity_id", right: str = "candidate_entity_id") -> DataFrame:
    """Both sides' texts by id; an unknown id has empty ones."""
    for df in (s1, targets):
        if not {"name_clean", "address_clean"} <= set(df.columns):
            raise ValueError("clean columns are missing")
    own = lambda df, i, key: df.select(F.col("entity_id").alias(key), F.col("name_clean").alias(f"name{i}"), F.col("address_clean").alias(f"address{i}"), F.col("country").alias(f"country{i}"), (F.col("name_skeleton") if "name_skeleton" in df.columns else F.lit("")).alias(f"skeleton{i}"))
    out = pairs.join(own(s1, 1, left), left, "left").join(own(targets, 2, right), right, "left")
    return out.fillna("", [f"{x}{i}" for x in ("name", "address", "country", "skeleton") for i in (1, 2)])


TEXTS = [f"{x}{i}" for x in ("name", "address", "country", "skeleton") for i in (1, 2)]


def add_native(texts: DataFrame, prefix_len: int = 3, leave: tuple[str, ...] = ()) -> DataFrame:
    return texts.withColumns({k: c for k, c in native(prefix_len).items() if k not in leave})


def add_fuzzy(texts: DataFrame, fields: tuple[str, ...] = fuzzy.FIELDS) -> DataFrame:
    scored = texts.withColumn("__f", fuzzy.scores(*map(F.col, ("name1", "name2", "address1", "address2", "skeleton1", "skeleton2")), fields))
    return scored.select(*texts.columns, "__f.*")


def add_entity_rank(df: DataFrame, entity: str = "source1_entity_id", other: str = "candidate_entity_id") -> DataFrame:
    """Rank of each candidate within its entity by the mean of name and address similarity, from 1; the best one's lead."""
    base = (F.col("token_sort_ratio") + F.col("address_token_similarity")) / 2
    w = Window.partitionBy(entity).orderBy(F.col("__b").desc(), other)
    out = df.withColumn("__b", base).withColumn("rank_within_entity", F.row_number().over(w)).withColumn("__n", F.lead("__b").over(w))
    first = F.col("rank_within_entity") == 1
    return out.withColumns({"is_top1_for_entity": first.cast("int"), "score_margin_to_next": F.when(first, F.col("__b") - F.coalesce("__n", F.lit(0.0))).otherwise(0.0)}).drop("__b", "__n")


def pair_features(pairs: DataFrame, s1: DataFrame, targets: DataFrame, prefix_len: int = 3) -> DataFrame:
    texts = with_texts(pairs, s1, targets)
    return add_entity_rank(add_fuzzy(add_native(texts, prefix_len), fuzzy.FIELDS[:10])).drop(*TEXTS)


def add_gaps(df: DataFrame, bases=RELATIVE_BASE, group: str = "tgt") -> DataFrame:
    w = Window.partitionBy(group)
    return df.withColumns({f"{c}_gap_to_best": F.col(c) - F.max(c).over(w) for c in bases})


def feature_matrix(candidates: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """Candidates with all FEATURES, in their order after tgt and s1."""
    texts = with_texts(candidates, s1, targets, "s1", "tgt")
    out = add_gaps(add_fuzzy(add_native(texts, leave=fuzzy.GRAMS), fuzzy.FIELDS + fuzzy.GRAMS))
    return out.select("tgt", "s1", *FEATURES)
