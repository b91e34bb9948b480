"""The registered queries, each beside the SQL that gives its rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions import fuzzy, phonetic, text
from kinweave.operators import blocking, decision, features, metrics, models, profile, retrieval, sampling, validate
from kinweave.operators.prepare import add_clean_columns, add_skeleton
from kinweave.plans import oracle, pipelines
from kinweave.plans.oracle import CAP, NAME_MAX_DF, f05, sql
from kinweave.sources import delimited, fixtures
from kinweave.sources.scratch import settled, shared_path

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
ENTITY, OTHER, PROB = decision.ENTITY, decision.OTHER, decision.PROB


#: What a query's steps share; emptied when the next query starts.
_SHARED: dict[str, DataFrame] = {}


def query(statement: str | None = None):
    def keep(f: Query) -> Query:
        def run(spark: SparkSession, d: str) -> DataFrame:
            _SHARED.clear()
            return f(spark, d)

        _QUERIES[f.__name__] = run
        if statement is not None:
            _SQL[f.__name__] = statement
        return f

    return keep


# what the queries run on


def records(spark, d) -> DataFrame:
    """Cleaned once a query."""
    if "records" not in _SHARED:
        _SHARED["records"] = settled(add_skeleton(add_clean_columns(fixtures.directory(spark, d), ascii_input=True)), "records")
    return _SHARED["records"]


def sides(spark, d) -> tuple[DataFrame, DataFrame]:
    r = records(spark, d)
    return r.where("source = 'S1'"), r.where("source <> 'S1'")


def truth(spark, d) -> DataFrame:
    t = fixtures.directory(spark, d).where("source <> 'S1' and owner_k <> -1")
    return t.select(F.concat(F.lit("S1-"), F.col("owner_k").cast("string")).alias(ENTITY), F.col("entity_id").alias(OTHER), "source")


def truth_lists(spark, d) -> DataFrame:
    ids = fixtures.directory(spark, d).where("source = 'S1'").select(F.col("entity_id").alias(ENTITY))
    return decision.group_ids(truth(spark, d), ids)


def blocked(spark, d) -> DataFrame:
    return blocking.candidate_pairs(*sides(spark, d), blocking.default_rules(CAP))


def texts(spark, d) -> DataFrame:
    return features.with_texts(blocked(spark, d), *sides(spark, d))


def scored(spark, d) -> DataFrame:
    tokens = lambda c: F.array_distinct(text.tokens(F.col(c)))
    s = (text.jaccard(tokens("name1"), tokens("name2")) + text.jaccard(text.numbers(F.col("address1")), text.numbers(F.col("address2")))) / 2
    return texts(spark, d).select(ENTITY, OTHER, F.round(s, 6).alias(PROB))


def assigned(spark, d) -> DataFrame:
    return decision.assign(scored(spark, d))


def ids(spark, d) -> DataFrame:
    return fixtures.directory(spark, d).where("source = 'S1'").select(F.col("entity_id").alias(ENTITY))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return queries()["linkage_f05"](spark, d)


# sources


@query(sql("select entity_id, business_name, business_address, country, source, name_clean, address_clean, name_skeleton from tg", "tg"))
def split_loader(spark, d):
    return sides(spark, d)[1].drop("owner_k")


@query(sql("select entity_id, business_name, business_address, country from d where source = 'S2'", "d"))
def tsv_round_trip(spark, d):
    """Written as TSV to the shared folder and read back with missing-value tokens."""
    own = fixtures.directory(spark, d).where("source = 'S2'").select(*delimited.SOURCE_COLUMNS)
    path = shared_path(spark, "tsv")
    delimited.write_tsv(own, path)
    return delimited.read_tsv(spark, path)


@query(sql("select source1_entity_id, candidate_entity_id, source from pairs", "pairs"))
def pair_scan(spark, d):
    path = shared_path(spark, "pairs")
    blocked(spark, d).write.mode("overwrite").parquet(path)
    return delimited.read_pairs(spark, path)


@query(sql("select source, count(*) as n from pairs group by 1", "pairs"))
def parquet_round_trip(spark, d):
    path = shared_path(spark, "round")
    blocked(spark, d).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).select("source").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


# text


@query(sql(f"select entity_id, lower(business_name) as lowered, {oracle.normalize('business_name')} as plain, {oracle.normalize('business_name', legal=True)} as no_suffix, {oracle.normalize('business_address', streets=True)} as streets from d", "d"))
def normalize_text(spark, d):
    r, name = fixtures.directory(spark, d), F.col("business_name")
    return r.select("entity_id", F.lower(name).alias("lowered"), text.normalize(name).alias("plain"), text.normalize(name, legal=True).alias("no_suffix"), text.normalize(F.col("business_address"), streets=True).alias("streets"))


@query(sql("select entity_id, name_clean, address_clean from c", "c"))
def clean_columns(spark, d):
    return add_clean_columns(fixtures.directory(spark, d)).select("entity_id", "name_clean", "address_clean")


@query(sql("select entity_id, name_skeleton from k", "k"))
def name_skeleton(spark, d):
    return records(spark, d).select("entity_id", "name_skeleton")


@query(sql(f"select entity_id, array_to_string({oracle.words('name_clean')}, '|') as tokens, array_to_string(list_sort({oracle.numbers('address_clean')}), '|') as numbers, array_to_string(list_sort({oracle.ngrams('name_clean', 2)}), '|') as bigrams, {oracle.postal('address_clean')} as postal from c", "c"))
def token_functions(spark, d):
    name, address = F.col("name_clean"), F.col("address_clean")
    return records(spark, d).select("entity_id", F.array_join(text.tokens(name), "|").alias("tokens"), F.array_join(F.array_sort(text.numbers(address)), "|").alias("numbers"), F.array_join(F.array_sort(text.char_ngrams(name, 2)), "|").alias("bigrams"), text.postal_code(address).alias("postal"))


@query(sql(f"select entity_id, {oracle.collapse(oracle.sub(oracle.sub('lower(business_name)', rf'\b({'|'.join(text.LEGAL_SUFFIXES)})\b', ' '), r'[^a-z0-9\s]', ' '))} as cleaned from d", "d"))
def clean_text_variant(spark, d):
    return fixtures.directory(spark, d).select("entity_id", text.clean_text_v0(F.col("business_name")).alias("cleaned"))


@query(sql(f"select entity_id, ascii_name, {oracle.normalize('ascii_name', legal=True)} as name_clean from (select entity_id, {oracle.to_ascii('business_name')} as ascii_name from noisy) x", "noisy"))
def transliterate(spark, d):
    return fixtures.noisy_documents(spark, d).select("entity_id", text.to_ascii(F.col("business_name")).alias("ascii_name"), text.normalize_name(F.col("business_name")).alias("name_clean"))


# blocking


@query(sql("select entity_id, upper(country) || '|' || substr(name_clean, 1, 3) as prefix3, upper(country) || '|' || split_part(name_clean, ' ', 1) as first_word, upper(country) || '|' || regexp_extract(name_clean, '([^ ]*)$', 1) as last_word, upper(country) || '|' || substr(replace(address_clean, ' ', ''), 1, 10) as address10, upper(country) || '|' || array_to_string(list_sort([substr(t, 1, 1) for t in (" + oracle.words("name_clean") + ")[1:5]]), '') as initials from c", "c"))
def blocking_keys(spark, d):
    return records(spark, d).select("entity_id", blocking.name_prefix(3).alias("prefix3"), blocking.first_word().alias("first_word"), blocking.last_word().alias("last_word"), blocking.address_prefix(10).alias("address10"), blocking.initials().alias("initials"))


@query()
def phonetic_keys(spark, d):
    return records(spark, d).select("entity_id", blocking.phonetic_key().alias("phonetic"))


@query(sql("select rule, key, entity_id from idx where source = 'S1' and rule = 'country_name_firstword'", "idx"))
def block_index(spark, d):
    rule = next(r for r in blocking.default_rules(CAP) if r.name == "country_name_firstword")
    return blocking.index(sides(spark, d)[0], [rule])


@query(sql("select rule, key, entity_id from idx where source = 'S2' and rule = 'name_token'", "idx"))
def token_index(spark, d):
    rule = next(r for r in blocking.default_rules(CAP) if r.name == "name_token")
    return blocking.index(records(spark, d).where("source = 'S2'"), [rule])


@query(sql("select rule, key, entity_id from idx where source = 'S1' and rule = 'address_numeric_token'", "idx"))
def numeric_index(spark, d):
    rule = next(r for r in blocking.default_rules(CAP) if r.name == "address_numeric_token")
    return blocking.index(sides(spark, d)[0], [rule])


@query(sql("select distinct entity_id from idx where source = 'S1' and key in ('10007', '10021', '10100')", "idx"))
def index_lookup(spark, d):
    return blocking.candidate_ids(blocking.index(sides(spark, d)[0], blocking.default_rules(CAP)), ["10007", "10021", "10100"])


@query(sql("select source1_entity_id, candidate_entity_id, source, '' as rules_matched from pairs", "pairs"))
def candidate_pairs(spark, d):
    return blocking.candidate_pairs(*sides(spark, d), blocking.default_rules(CAP)).select(ENTITY, OTHER, "source", "rules_matched")


@query(sql("select n_pairs, round(n_pairs::double / n_s1, 6) as avg_per_entity, n_s1 * n_targets as full_pairs, round(1 - n_pairs::double / (n_s1 * n_targets), 9) as reduction_ratio from (select count(*) as n_pairs from pairs) a, (select count(*) as n_s1 from s1) b, (select count(*) as n_targets from tg) c", "pairs", "s1", "tg"))
def blocking_stats(spark, d):
    return blocking.blocking_stats(blocked(spark, d), *sides(spark, d))


@query(sql("select count(*) as n_true, count(p.source) as n_hit, round(count(p.source)::double / count(*), 6) as recall from truth t left join pairs p using (source1_entity_id, candidate_entity_id)", "truth", "pairs"))
def blocking_recall(spark, d):
    return blocking.blocking_recall(blocked(spark, d), truth(spark, d), sample_size=None)


# retrieval


@query(sql("select country, term, entity_id, round(w, 6) as w from w_w where source = 'S1'", "w_w"))
def tfidf_word_weights(spark, d):
    w, _ = retrieval.weights(*sides(spark, d), retrieval.word_terms(F.concat_ws(" ", "name_clean", "address_clean")), 5000)
    return w.withColumn("w", F.round("w", 6))


@query(sql("select country, term, entity_id, round(w, 6) as w from n_w where source <> 'S1'", "n_w"))
def tfidf_char_weights(spark, d):
    _, w = retrieval.weights(*sides(spark, d), retrieval.char_terms(F.col("name_clean"), 3, 5), NAME_MAX_DF, 2)
    return w.withColumn("w", F.round("w", 6))


@query(sql("select tgt, s1, cos from (select *, row_number() over (partition by tgt order by cos desc, s1) as r from w_c) x where r <= 10", "w_c"))
def top_k_join(spark, d):
    return retrieval.top_cosines(*_words(spark, d), 10)


def _words(spark, d):
    return retrieval.weights(*sides(spark, d), retrieval.word_terms(F.concat_ws(" ", "name_clean", "address_clean")), 5000)


def _both(spark, d) -> DataFrame:
    return retrieval.union_channels(*retrieval.channels(*sides(spark, d), 5000, NAME_MAX_DF, "char"), 10, 10)


@query(sql("select * from bth", "bth"))
def channel_union(spark, d):
    return _both(spark, d)


@query(sql("select t.tgt, t.s1, coalesce(n_c.cos, 0.0) as cos from w_top t left join n_c using (tgt, s1)", "w_top", "n_c"))
def pair_cosines(spark, d):
    """The name channel's exact cosine of the word channel's pairs."""
    grams = retrieval.weights(*sides(spark, d), retrieval.char_terms(F.col("name_clean"), 3, 5), NAME_MAX_DF, 2)
    return retrieval.pair_cosines(retrieval.top_cosines(*_words(spark, d), 10), *grams)


_RF = "select tgt, s1, cos, cos_name, in_combined_retrieval, in_name_retrieval, row_number() over (partition by tgt order by cos desc, s1) - 1 as rank, round(max(cos) over (partition by tgt) - cos, 9) as gap_to_top1, round(cos - coalesce(lead(cos) over (partition by tgt order by cos desc, s1), 0.0), 9) as margin_to_next, count(*) over (partition by tgt) as n_cands, row_number() over (partition by tgt order by cos_name desc, s1) - 1 as name_rank, round(max(cos_name) over (partition by tgt) - cos_name, 9) as name_gap_to_top1, in_combined_retrieval * in_name_retrieval as both_channels_retrieved from bth"


@query(sql(f"select *, sum((rank = 0)::int) over (partition by s1) as s1_top1_count, count(*) over (partition by s1) as s1_cand_count, row_number() over (partition by s1 order by cos desc, tgt) - 1 as s1_reverse_rank, round(max(cos) over (partition by s1) - cos, 9) as s1_best_cos_gap from ({_RF}) x", "bth"))
def retrieval_features(spark, d):
    return retrieval.retrieve(*sides(spark, d), 10, 5000, 10, NAME_MAX_DF, "char")


@query(sql("select count(*) as n_owned, round(avg(coalesce(in_combined_retrieval, 0)), 6) as word_recall, round(avg(coalesce(in_name_retrieval, 0)), 6) as name_recall, round(avg(greatest(coalesce(in_combined_retrieval, 0), coalesce(in_name_retrieval, 0))), 6) as union_recall from truth left join bth on tgt = candidate_entity_id and s1 = source1_entity_id", "truth", "bth"))
def owner_recall(spark, d):
    owner, _ = sampling.owners(truth(spark, d), *sides(spark, d))
    return retrieval.owner_recall(_both(spark, d), owner)


# pair features


_N1, _N2 = (f"list_distinct({oracle.words(c)})" for c in ("name1", "name2"))


@query(sql(f"select source1_entity_id, candidate_entity_id, (country1 <> '' and country1 = country2)::int as exact_country_match, coalesce((list_extract({oracle.words('name1')}, 1) = list_extract({oracle.words('name2')}, 1))::int, 0) as first_word_match, (name1 <> '' and substr(name1, 1, 3) = substr(name2, 1, 3))::int as prefix_match, abs(length(name1) - length(name2)) as name_length_diff, abs(length(address1) - length(address2)) as address_length_diff, round({oracle.jaccard(oracle.numbers('address1'), oracle.numbers('address2'))}, 6) as numeric_overlap, round({oracle.jaccard(_N1, _N2)}, 6) as jaccard_token_similarity, round({oracle.jaccard(oracle.ngrams('name1', 2), oracle.ngrams('name2', 2))}, 6) as name_bigram_jaccard, round({oracle.dice(oracle.ngrams('name1', 3), oracle.ngrams('name2', 3))}, 6) as name_trigram_dice, coalesce(({oracle.postal('address1')} = {oracle.postal('address2')})::int, 0) as postal_code_match from texts", "texts"))
def pair_features_native(spark, d):
    out = features.add_native(texts(spark, d))
    rounded = ("numeric_overlap", "jaccard_token_similarity", "name_bigram_jaccard", "name_trigram_dice")
    return out.select(ENTITY, OTHER, *[F.round(c, 6).alias(c) if c in rounded else F.col(c) for c in features.NATIVE])


@query(sql("select source1_entity_id, candidate_entity_id, round(case when name1 = name2 then 1.0 else jaro_winkler_similarity(name1, name2) end * 100, 6) as name_jaro_winkler, round(case when address1 = address2 then 1.0 else jaro_winkler_similarity(address1, address2) end * 100, 6) as address_jaro_winkler from texts", "texts"))
def pair_features_jaro_winkler(spark, d):
    out = features.add_fuzzy(texts(spark, d), ("name_jaro_winkler", "address_jaro_winkler"))
    return out.select(ENTITY, OTHER, F.round("name_jaro_winkler", 6).alias("name_jaro_winkler"), F.round("address_jaro_winkler", 6).alias("address_jaro_winkler"))


@query()
def pair_features_fuzzy(spark, d):
    return features.add_fuzzy(texts(spark, d)).select(ENTITY, OTHER, *fuzzy.FIELDS)


@query()
def pair_features_all(spark, d):
    return features.pair_features(blocked(spark, d), *sides(spark, d))


@query(sql("select source1_entity_id, candidate_entity_id, r as rank_within_entity, (r = 1)::int as is_top1_for_entity, round(case when r = 1 then match_probability - coalesce(n, 0.0) else 0.0 end, 6) as score_margin_to_next from (select *, row_number() over w as r, lead(match_probability) over w as n from scored window w as (partition by source1_entity_id order by match_probability desc, candidate_entity_id)) x", "scored"))
def entity_rank_features(spark, d):
    base = scored(spark, d).select(ENTITY, OTHER, F.col(PROB).alias("token_sort_ratio"), F.col(PROB).alias("address_token_similarity"))
    out = features.add_entity_rank(base)
    return out.select(ENTITY, OTHER, "rank_within_entity", "is_top1_for_entity", F.round("score_margin_to_next", 6).alias("score_margin_to_next"))


@query(sql("select source1_entity_id, candidate_entity_id, round(match_probability - max(match_probability) over (partition by candidate_entity_id), 6) as match_probability_gap_to_best from scored", "scored"))
def gap_features(spark, d):
    out = features.add_gaps(scored(spark, d), (PROB,), OTHER)
    return out.select(ENTITY, OTHER, F.round(f"{PROB}_gap_to_best", 6).alias(f"{PROB}_gap_to_best"))


@query()
def feature_matrix(spark, d):
    s1, tg = sides(spark, d)
    s = pipelines.Settings(name_max_df=NAME_MAX_DF)
    return features.feature_matrix(retrieval.retrieve(s1, tg, s.k, s.max_df, s.k_name, s.name_max_df, s.name_channel), s1, tg)


# labels, samples, splits


@query(sql("select source1_entity_id, candidate_entity_id, source, 1 as label from truth", "truth"))
def positive_pairs(spark, d):
    return sampling.positive_pairs(truth_lists(spark, d))


@query(sql("select s.source1_entity_id, s.candidate_entity_id, s.match_probability, (t.source is not null)::int as label from scored s left join truth t using (source1_entity_id, candidate_entity_id)", "scored", "truth"))
def attach_labels(spark, d):
    return sampling.attach_labels(scored(spark, d), truth(spark, d))


@query(sql("select k.entity_id as tgt, t.source1_entity_id as owner from (select entity_id from d where source <> 'S1') k left join truth t on t.candidate_entity_id = k.entity_id", "d", "truth"))
def owner_index(spark, d):
    return sampling.owners(truth(spark, d), *sides(spark, d))[0]


@query(sql("select source1_entity_id as s1, n_true as true_count from n_true", "n_true"))
def true_counts(spark, d):
    return sampling.owners(truth(spark, d), *sides(spark, d))[1]


@query(sql("select b.tgt, b.s1, (t.source is not null)::int as label from bth b left join truth t on t.candidate_entity_id = b.tgt and t.source1_entity_id = b.s1", "bth", "truth"))
def candidate_labels(spark, d):
    owner, _ = sampling.owners(truth(spark, d), *sides(spark, d))
    return sampling.label_candidates(_both(spark, d), owner).select("tgt", "s1", "label")


@query(sql("select source1_entity_id, candidate_entity_id, source from pairs p where not exists (select 1 from truth t where t.source1_entity_id = p.source1_entity_id and t.candidate_entity_id = p.candidate_entity_id)", "pairs", "truth"))
def not_matches(spark, d):
    return sampling.not_in(blocked(spark, d).select(ENTITY, OTHER, "source"), truth(spark, d))


_KEY = oracle.key_of(42, "source1_entity_id", "candidate_entity_id")
_NEG = f"select source1_entity_id, candidate_entity_id, source, 0 as label from (select p.*, row_number() over (partition by source1_entity_id order by {_KEY}, candidate_entity_id) as r from pairs p where not exists (select 1 from truth t where t.source1_entity_id = p.source1_entity_id and t.candidate_entity_id = p.candidate_entity_id)) x left join (select source1_entity_id, count(*) * 6 as quota from truth group by 1) q using (source1_entity_id) where r <= coalesce(quota, 6)"


@query(sql(_NEG, "pairs", "truth"))
def hard_negatives(spark, d):
    return sampling.hard_negatives(blocked(spark, d), sampling.positive_pairs(truth_lists(spark, d)))


@query(sql(f"select source1_entity_id, candidate_entity_id, source, 1 as label from truth union all {_NEG}", "pairs", "truth"))
def labeled_pairs(spark, d):
    return sampling.labeled_pairs(blocked(spark, d), truth_lists(spark, d))


_ENT = oracle.key_of(42, "source1_entity_id")


@query(sql(f"select t.source1_entity_id, candidate_entity_id, r <= round(n * 0.2) as is_validation from truth t join (select source1_entity_id, row_number() over (order by {_ENT}, source1_entity_id) as r, count(*) over () as n from (select distinct source1_entity_id from truth) x) y using (source1_entity_id)", "truth"))
def entity_split(spark, d):
    return sampling.split(truth(spark, d)).select(ENTITY, OTHER, "is_validation")


_STRATA = "select source1_entity_id, case when n = 0 then 'singleton' when n = 1 then 'single_match' else 'multi_match' end || '|' || country as stratum from (select source1_entity_id, sum(label) as n from lab group by 1) x join s1 on s1.entity_id = source1_entity_id"
_LAB = f"select source1_entity_id, candidate_entity_id, source, 1 as label from truth union all {_NEG}"


def _lab(spark, d) -> DataFrame:
    return sampling.labeled_pairs(blocked(spark, d), truth_lists(spark, d))


@query(sql(_STRATA.replace(" lab ", f" ({_LAB}) l "), "pairs", "truth", "s1"))
def entity_strata(spark, d):
    return sampling.strata(_lab(spark, d), sides(spark, d)[0])


@query(sql(f"select source1_entity_id, r <= floor(n * 0.2 + 0.5) as is_validation from (select source1_entity_id, row_number() over (partition by stratum order by {_ENT}, source1_entity_id) as r, count(*) over (partition by stratum) as n from (select source1_entity_id, case when count(*) over (partition by stratum) = 1 then 'OTHER' else stratum end as stratum from ({_STRATA.replace(' lab ', f' ({_LAB}) l ')}) a) b) c", "pairs", "truth", "s1"))
def stratified_split(spark, d):
    return sampling.stratified_split(_lab(spark, d), sides(spark, d)[0]).select(ENTITY, "is_validation").distinct()


@query(sql(f"select entity_id from (select entity_id from d where source <> 'S1') x where {oracle.key_of(43, 'entity_id')} < {int(0.4 * (1 << 32))}", "d"))
def target_sample(spark, d):
    return sampling.bernoulli(fixtures.directory(spark, d).where("source <> 'S1'").select("entity_id"), "entity_id", 0.4, 43)


# models


def _training(spark, d) -> DataFrame:
    lab = _lab(spark, d)
    return features.add_native(features.with_texts(lab, *sides(spark, d))).select(ENTITY, OTHER, "label", *features.NATIVE)


@query()
def model_boosted_trees(spark, d):
    train = _training(spark, d)
    return models.predict(models.train_trees(train, features.NATIVE, rounds=5, depth=3), train).select(ENTITY, OTHER, "label", PROB)


@query()
def model_logistic(spark, d):
    train = _training(spark, d)
    return models.predict(models.train_logistic(train, features.NATIVE, rounds=20), train).select(ENTITY, OTHER, "label", PROB)


@query()
def model_importances(spark, d):
    model = models.train_forest(_training(spark, d), features.NATIVE, trees=5, depth=4)
    return spark.createDataFrame(models.importances(model, features.NATIVE), "feature string, share double")


@query(sql("select source1_entity_id, candidate_entity_id, round((3 * match_probability + round(match_probability * match_probability, 6)) / 4, 6) as match_probability from scored", "scored"))
def blend(spark, d):
    two = scored(spark, d).select(ENTITY, OTHER, F.col(PROB).alias("a"), F.round(F.col(PROB) * F.col(PROB), 6).alias("b"))
    return two.select(ENTITY, OTHER, F.round(models.blend([("a", 3.0), ("b", 1.0)]), 6).alias(PROB))


@query(sql("select w, source1_entity_id, candidate_entity_id, round(w * match_probability + (1 - w) * round(match_probability * match_probability, 6), 6) as match_probability from best, (select unnest([1.0, 0.75, 0.5, 0.25, 0.0]::double[]) as w) g", "best"))
def blend_sweep(spark, d):
    two = assigned(spark, d).select(ENTITY, OTHER, F.col(PROB).alias("a"), F.round(F.col(PROB) * F.col(PROB), 6).alias("b"))
    return models.sweep(two, "a", "b").select("w", ENTITY, OTHER, F.round(PROB, 6).alias(PROB))


# decisions


@query(sql("select source1_entity_id, candidate_entity_id, match_probability from (select *, max(match_probability) over (partition by source1_entity_id) as top from scored) x where top >= 0.5 and match_probability >= 0.4", "scored"))
def dual_threshold(spark, d):
    return decision.dual_threshold(scored(spark, d), 0.5, 0.4)


@query(sql("select * from best", "best"))
def assign(spark, d):
    return assigned(spark, d)


@query(sql("select * from best where match_probability >= 0.5", "best"))
def threshold(spark, d):
    return decision.threshold(assigned(spark, d), 0.5)


@query(sql("select b.* from best b join s1 on s1.entity_id = source1_entity_id where match_probability >= case country when 'CHINA' then 0.3 when 'FRANCE' then 0.7 else 0.5 end", "best", "s1"))
def country_threshold(spark, d):
    return decision.country_threshold(assigned(spark, d), sides(spark, d)[0], {"CHINA": 0.3, "FRANCE": 0.7}, 0.5)


@query(sql("select candidate_entity_id, source1_entity_id, match_probability from (select *, count(*) over (partition by source1_entity_id) as n from best where match_probability >= 0.4) x where n > 1 or match_probability >= 0.6", "best"))
def sole_guard(spark, d):
    return decision.sole_guard(decision.threshold(assigned(spark, d), 0.4), 0.6)


_LISTS = "select e.entity_id as source1_entity_id, coalesce(string_agg(p.candidate_entity_id, ',' order by p.candidate_entity_id), '') as {n} from (select entity_id from d where source = 'S1') e left join ({p}) p on p.source1_entity_id = e.entity_id group by 1"


@query(sql(_LISTS.format(n="candidate_entity_ids", p="select * from pairs"), "pairs", "d"))
def submission(spark, d):
    return decision.submission(blocked(spark, d), sides(spark, d)[0])


@query(sql(_LISTS.format(n="matched_entity_ids", p="select * from best where match_probability >= 0.5"), "best", "d"))
def grouped_ids(spark, d):
    return decision.group_ids(decision.threshold(assigned(spark, d), 0.5), ids(spark, d), distinct=False)


@query(sql(_LISTS.format(n="matched_entity_ids", p="select * from (select *, max(match_probability) over (partition by source1_entity_id) as top from scored) x where top >= 0.5 and match_probability >= 0.4"), "scored", "d"))
def group_predictions(spark, d):
    return decision.group_predictions(scored(spark, d), sides(spark, d)[0], 0.5, 0.4)


# metrics


_COUNTS = "select n.source1_entity_id, n_true, coalesce(n_pred, 0) as n_pred, coalesce(tp, 0) as tp from n_true n left join (select b.source1_entity_id, count(*) as n_pred, count(t.source) as tp from {p} b left join truth t using (source1_entity_id, candidate_entity_id) group by 1) x using (source1_entity_id)"


@query(sql(f"select source1_entity_id, tp, n_pred, n_true, round({f05()}, 6) as f from ({_COUNTS.format(p='(select * from best where match_probability >= 0.5)')}) y", "best", "truth", "n_true"))
def entity_f05(spark, d):
    c = metrics.entity_counts(decision.threshold(assigned(spark, d), 0.5), truth(spark, d), ids(spark, d))
    return c.select(ENTITY, "tp", "n_pred", "n_true", F.round(metrics.f05(F.col("tp"), F.col("n_pred"), F.col("n_true")), 6).alias("f"))


@query(sql(f"select count(*) as n_entities, round(avg({f05()}), 6) as macro_f05 from ({_COUNTS.format(p='(select * from best where match_probability >= 0.5)')}) y", "best", "truth", "n_true"))
def linkage_f05(spark, d):
    """Block, score, assign, threshold, group into lists and score the lists against the truth."""
    lists = decision.group_ids(decision.threshold(assigned(spark, d), 0.5), ids(spark, d))
    return metrics.score_lists(lists, truth_lists(spark, d), ids(spark, d))


_GRID = "(select round(0.30 + 0.69 * i / 139, 6) as t from range(140) r(i))"
_F = "coalesce(1.25 * {a} / nullif(1.25 * {a} + 0.25 * {c} + {b}, 0), 0.0)"
_CURVE = f"select t, round(({_F.format(a='tp', b='fp', c='fn')} + {_F.format(a='tn', b='fn', c='fp')}) / 2, 6) as macro_f05, round(coalesce(tp::double / nullif(tp + fp, 0), 0.0), 6) as precision, round(coalesce(tp::double / nullif(tp + fn, 0), 0.0), 6) as recall from (select t, sum((label = 1 and p >= t)::int) as tp, sum((label = 0 and p >= t)::int) as fp, sum((label = 1 and p < t)::int) as fn, sum((label = 0 and p < t)::int) as tn from (select match_probability as p, (x.source is not null)::int as label from scored s left join truth x using (source1_entity_id, candidate_entity_id)) l, {_GRID} g group by t) y"


@query(sql(_CURVE, "scored", "truth"))
def class_threshold_curve(spark, d):
    return metrics.class_curve(sampling.attach_labels(scored(spark, d), truth(spark, d)), metrics.steps(0.30, 0.99, 140))


@query(sql(f"select * from ({_CURVE}) z order by macro_f05 desc, t limit 1", "scored", "truth"))
def best_threshold(spark, d):
    return metrics.best(metrics.class_curve(sampling.attach_labels(scored(spark, d), truth(spark, d)), metrics.steps(0.30, 0.99, 140)))


_TS = "(select round(0.05 + 0.01 * i, 2) as t from range(91) r(i))"
_KEPT = "(select t, source1_entity_id, count(*) as n_pred, count(x.source) as tp from (select * from best, {ts} g where match_probability >= t) b left join truth x using (source1_entity_id, candidate_entity_id) group by 1, 2)"


@query(sql(f"select t, round(avg({f05('coalesce(tp, 0)', 'coalesce(n_pred, 0)')}), 6) as macro_f05 from {_TS} g cross join n_true left join {_KEPT.format(ts=_TS)} k using (t, source1_entity_id) group by t", "best", "truth", "n_true"))
def threshold_curve(spark, d):
    return metrics.threshold_curve(assigned(spark, d), truth(spark, d), ids(spark, d))


@query(sql(f"select country, t, round(avg({f05('coalesce(tp, 0)', 'coalesce(n_pred, 0)')}), 6) as macro_f05 from {_TS} g cross join (select n.*, country from n_true n join s1 on entity_id = source1_entity_id) m left join {_KEPT.format(ts=_TS)} k using (t, source1_entity_id) group by 1, 2", "best", "truth", "n_true", "s1"))
def country_threshold_curve(spark, d):
    own = fixtures.directory(spark, d).where("source = 'S1'").select(F.col("entity_id").alias(ENTITY), "country")
    return metrics.threshold_curve(assigned(spark, d), truth(spark, d), own, by=["country"])


@query(sql(f"select count(*) as n_entities, round(avg({f05()}), 6) as macro_f05 from ({_COUNTS.format(p='(select s1 as source1_entity_id, tgt as candidate_entity_id from bth join truth on candidate_entity_id = tgt and source1_entity_id = s1)')}) y", "bth", "truth", "n_true"))
def retrieval_ceiling(spark, d):
    owner, _ = sampling.owners(truth(spark, d), *sides(spark, d))
    return metrics.retrieval_ceiling(sampling.label_candidates(_both(spark, d), owner), truth(spark, d), ids(spark, d))


_DUAL = "(select a.v as ts, b.v as tm from (select round(0.30 + 0.05 * i, 6) as v from range(14) r(i)) a, (select round(0.30 + 0.05 * i, 6) as v from range(14) r(i)) b where b.v >= a.v)"


@query(sql(f"select ts, tm, round(avg({f05('coalesce(tp, 0)', 'coalesce(n_pred, 0)')}), 6) as macro_f05 from {_DUAL} g cross join n_true left join (select ts, tm, source1_entity_id, count(*) as n_pred, count(x.source) as tp from (select * from (select *, max(match_probability) over (partition by source1_entity_id) as top from scored) s, {_DUAL} h where top >= ts and match_probability >= tm) b left join truth x using (source1_entity_id, candidate_entity_id) group by 1, 2, 3) k using (ts, tm, source1_entity_id) group by 1, 2", "scored", "truth", "n_true"))
def dual_threshold_grid(spark, d):
    return metrics.dual_grid(scored(spark, d), truth(spark, d), ids(spark, d))


_GUARD = "(select t, null::double as sole from (select round(0.45 + 0.01 * i, 2) as t from range(36) r(i)) a union all select t, round(t + 0.01 * j, 2) from (select round(0.45 + 0.01 * i, 2) as t from range(36) r(i)) a, range(1, 60) q(j) where j < round((1 - t) * 100))"


@query(sql(f"select t, coalesce(sole, -1.0) as sole, round(avg({f05('coalesce(tp, 0)', 'coalesce(n_pred, 0)')}), 6) as macro_f05 from (select t, sole, n.source1_entity_id, n_true, k.n_pred, k.tp from {_GUARD} g cross join n_true n left join (select t, source1_entity_id, count(*) as n_pred, count(x.source) as tp, max(match_probability) as top from (select * from best, (select distinct t from {_GUARD} z) h where match_probability >= t) b left join truth x using (source1_entity_id, candidate_entity_id) group by 1, 2) k on k.t = g.t and k.source1_entity_id = n.source1_entity_id and (g.sole is null or k.n_pred > 1 or k.top >= g.sole)) y group by 1, 2".replace("select t, sole, n.source1_entity_id", "select g.t, g.sole, n.source1_entity_id"), "best", "truth", "n_true"))
def guard_grid(spark, d):
    """sole is -1 where there is no guard."""
    return metrics.guard_grid(assigned(spark, d), truth(spark, d), ids(spark, d), 0.5).fillna(-1.0, ["sole"])


_LABELLED = "(select match_probability as p, (x.source is not null)::int as label from scored s left join truth x using (source1_entity_id, candidate_entity_id))"


@query(sql(f"select p as threshold, tp, n_pred, round(tp::double / n_pred, 6) as precision, round(coalesce(tp::double / nullif(n_true, 0), 0.0), 6) as recall from (select p, sum(sum(label)) over (order by p desc) as tp, sum(count(*)) over (order by p desc) as n_pred, sum(sum(label)) over () as n_true from {_LABELLED} l group by p) y", "scored", "truth"))
def pr_curve(spark, d):
    return metrics.pr_curve(sampling.attach_labels(scored(spark, d), truth(spark, d)))


@query(sql(f"select round(sum(hits) filter (where p >= 0.5)::double / sum(n) filter (where p >= 0.5), 6) as precision, round(sum(hits) filter (where p >= 0.5)::double / sum(hits), 6) as recall, round(sum(hits * tp::double / k) / sum(hits), 6) as average_precision from (select p, sum(label) as hits, count(*) as n, sum(sum(label)) over (order by p desc) as tp, sum(count(*)) over (order by p desc) as k from {_LABELLED} l group by p) y", "scored", "truth"))
def precision_recall_ap(spark, d):
    return metrics.precision_recall_ap(sampling.attach_labels(scored(spark, d), truth(spark, d)), 0.5)


# profile and validation


def _tables(spark, d) -> dict[str, DataFrame]:
    r = fixtures.directory(spark, d)
    return {s: r.where(F.col("source") == s).select(*delimited.SOURCE_COLUMNS) for s in ("S1", "S2", "S3")}


@query(sql("select source as table_name, count(*) as n_rows, 4 as n_columns, 'entity_id,business_name,business_address,country' as column_names, 'string,string,string,string' as dtypes from d group by 1", "d"))
def dataset_summary(spark, d):
    return profile.dataset_summary(_tables(spark, d))


@query(sql("select c as column_name, n as n_missing, round(n * 100.0 / t, 3) as pct_missing from (select unnest(['entity_id', 'business_name', 'business_address', 'country']) as c, unnest([count(*) filter (where entity_id is null), count(*) filter (where business_name is null), count(*) filter (where business_address is null), count(*) filter (where country is null)]) as n, count(*) as t from d where source = 'S2') x", "d"))
def missing_values(spark, d):
    return profile.missing_values(_tables(spark, d)["S2"])


@query(sql("select count(*) as n_rows, count(*) - (select count(*) from (select distinct business_name, country from d where source = 'S1') y) as n_duplicates, round((count(*) - (select count(*) from (select distinct business_name, country from d where source = 'S1') y)) * 100.0 / count(*), 3) as pct_duplicates from d where source = 'S1'", "d"))
def duplicate_report(spark, d):
    return profile.duplicates(_tables(spark, d)["S1"], ["business_name", "country"])


@query(sql("select source as table_name, country, n, round(n * 100.0 / t, 3) as pct from (select source, coalesce(country, '<missing>') as country, count(*) as n, sum(count(*)) over (partition by source) as t, row_number() over (partition by source order by count(*) desc, coalesce(country, '<missing>')) as r from d group by 1, 2) x where r <= 15", "d"))
def country_distribution(spark, d):
    return profile.country_distribution(_tables(spark, d))


@query(sql("select entity_id, business_name, business_address, country from d where source = 'S1' order by entity_id limit 10", "d"))
def sample_records(spark, d):
    return profile.sample_records(_tables(spark, d)["S1"], 10, "entity_id")


@query(sql("select 'missing_ids' as \"check\", count(*) as n_bad from d where source = 'S1' and owner_k % 10 = 0 union all select 'extra_ids', 1 union all select 'duplicate_rows', 0 union all select 'duplicate_ids_in_row', 0 union all select 'unsorted_ids_in_row', 0 union all select 'not_among_candidates', count(distinct t.source1_entity_id) from truth t left join pairs p using (source1_entity_id, candidate_entity_id) where p.source is null and substr(t.source1_entity_id, 4)::int % 10 <> 0", "d", "truth", "pairs"))
def validate_results(spark, d):
    """The truth as results, with a tenth of the entities left out and one unknown added, against blocked candidates."""
    lists = truth_lists(spark, d).where(F.substring(ENTITY, 4, 20).cast("int") % 10 != 0)
    unknown = spark.createDataFrame([("S1-x", "")], f"{ENTITY} string, matched_entity_ids string")
    return validate.checks(lists.unionByName(unknown), decision.submission(blocked(spark, d), sides(spark, d)[0]), ids(spark, d))


# whole workflows


@query()
def pairwise_inference(spark, d):
    """Blocked, scored by a model trained on labelled pairs, thresholded, grouped and validated."""
    s1, tg = sides(spark, d)
    train = _training(spark, d)
    model = models.train_trees(train, features.NATIVE, rounds=5, depth=3)
    results, _ = pipelines.run_inference(s1, tg, lambda x: models.predict(model, x), 0.5, 0.5, blocking.default_rules(CAP))
    return results


@query()
def assignment_workflow(spark, d):
    """Trained, tuned and applied: the target-centric system's lists."""
    s = pipelines.Settings(name_max_df=NAME_MAX_DF)
    r, t = records(spark, d), truth(spark, d)
    matrix = pipelines.candidate_matrix(r, s)
    found: dict[str, DataFrame] = {}
    tuned, _, _ = pipelines.train_assignment(r, t, s, matrix=matrix, found=found)
    return pipelines.owner_lists(found["best"], sides(spark, d)[0], tuned)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
