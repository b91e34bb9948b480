"""SQL that DuckDB runs on the driver's tables to give the registered queries' rows: common tables, composed by name."""

from __future__ import annotations

from kinweave.functions import text
from kinweave.operators.blocking import STOP_TOKENS

CAP = 0.05


def sub(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"


def collapse(x: str) -> str:
    return f"trim({sub(x, r'\s+', ' ')})"


def normalize(x: str, legal: bool = False, streets: bool = False) -> str:
    out = sub(f"replace(lower(coalesce({x}, '')), '&', ' and ')", r"[^a-z0-9\s]", " ")
    out = sub(out, r"\b0+(\d)", r"\1")
    if legal:
        out = sub(out, rf"\b({'|'.join(text.LEGAL_SUFFIXES)})\b", " ")
    if streets:
        for short, word in (("rd", "road"), ("ave", "avenue"), ("blvd|bd", "boulevard"), ("rte", "route"), ("chem", "chemin")):
            out = sub(out, rf"\b({short})\b", word)
    return collapse(out)


def to_ascii(x: str) -> str:
    """Of Latin text."""
    out = f"strip_accents(coalesce({x}, ''))"
    for k, v in text.LATIN.items():
        out = f"replace({out}, '{k}', '{v}')"
    return sub(out, r"[^\x00-\x7F]", "")


def skeleton(x: str) -> str:
    for pattern, to in (("x", "ks"), ("([pbktdscg])h", r"\1"), ("c([eiy])", r"s\1"), ("g([eiy])", r"j\1"), ("[cqg]", "k"), ("f", "p"), ("[vw]", "b"), ("d", "t"), ("[zj]", "s"), ("m", "n"), ("[aeiouyh]", "")):
        x = sub(x, pattern, to)
    for c in "bklnprst":
        x = sub(x, f"{c}+", c)
    return collapse(sub(x, r"\b(prbt|pbt|lnt|lt|pr|l)\b", ""))


def ngrams(x: str, n: int) -> str:
    return f"(case when length({x}) = 0 then []::varchar[] else list_distinct([substr({x}, i, {n}) for i in range(1, greatest(length({x}) - {n} + 1, 1) + 1)]) end)"


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def numbers(x: str) -> str:
    return rf"list_distinct(regexp_extract_all({x}, '\d+'))"


def jaccard(a: str, b: str) -> str:
    return f"coalesce(len(list_intersect({a}, {b}))::double / nullif(len(list_distinct(list_concat({a}, {b}))), 0), 0.0)"


def dice(a: str, b: str) -> str:
    return f"coalesce(2.0 * len(list_intersect({a}, {b})) / nullif(len({a}) + len({b}), 0), 0.0)"


def postal(x: str) -> str:
    return rf"list_extract(regexp_extract_all({x}, '\d{{5,6}}\b'), -1)"


def key_of(seed: int, *cols: str) -> str:
    return f"('0x' || substr(md5('{seed}' || {' || '.join(chr(39) + '|' + chr(39) + ' || ' + c for c in cols)}), 1, 8))::bigint"


_RULES = {
    "country_name_prefix6": "upper(country) || '|' || substr(name_clean, 1, 6)",
    "country_name_firstword": "upper(country) || '|' || split_part(name_clean, ' ', 1)",
    "country_address_prefix16": "upper(country) || '|' || substr(replace(address_clean, ' ', ''), 1, 16)",
    "country_name_lastword": "upper(country) || '|' || regexp_extract(name_clean, '([^ ]*)$', 1)",
}


def _index(rules) -> str:
    parts = []
    for r in rules:
        if r in _RULES:
            parts.append(f"select source, '{r}' as rule, key, entity_id from (select source, {_RULES[r]} as key, entity_id from c) x where key <> '' and key not like '%|'")
        elif r == "name_token":
            stop = ", ".join(f"'{t}'" for t in STOP_TOKENS)
            parts.append(f"select source, '{r}' as rule, key, entity_id from (select source, unnest({words('name_clean')}) as key, entity_id from c) x where length(key) >= 5 and key not in ({stop})")
        else:
            parts.append(rf"select source, '{r}' as rule, unnest(regexp_extract_all(address_clean, '\d{{3,}}')) as key, entity_id from c")
    union = " union all ".join(parts)
    return f"select source, rule, key, entity_id from (select x.*, count(*) over (partition by source, rule, key) as df, n from ({union}) x join (select source, count(*) as n from c group by 1) m using (source)) y where df <= {CAP} * n"


ALL_RULES = ("country_name_prefix6", "country_name_firstword", "country_address_prefix16", "name_token", "address_numeric_token", "country_name_lastword")
_PAIRS = "select distinct a.entity_id as source1_entity_id, b.entity_id as candidate_entity_id, b.source from {i} a join {i} b on a.source = 'S1' and b.source <> 'S1' and a.rule = b.rule and a.key = b.key join (select x.rule, x.key, y.source from (select rule, key, count(*) as n from {i} where source = 'S1' group by 1, 2) x join (select source, rule, key, count(*) as n from {i} where source <> 'S1' group by 1, 2, 3) y on x.rule = y.rule and x.key = y.key and x.n * y.n <= 50000) g on g.rule = b.rule and g.key = b.key and g.source = b.source"


def _tfidf(name: str, terms: str, least: int, most: str) -> list[tuple[str, str]]:
    return [
        (f"{name}_t", f"select country, entity_id, source, term, count(*) as c from (select country, entity_id, source, unnest({terms}) as term from k) x group by 1, 2, 3, 4"),
        (f"{name}_i", f"select country, term, ln((1.0 + n) / (1.0 + df)) + 1.0 as idf from (select country, term, count(*) as df from {name}_t where source = 'S1' group by 1, 2) x join (select country, count(*) as n from c where source = 'S1' group by 1) y using (country) where df <= {most} and df >= {least}"),
        (f"{name}_w", f"select country, term, entity_id, source, raw / sqrt(sum(raw * raw) over (partition by source, country, entity_id)) as w from (select t.country, t.term, entity_id, source, (1.0 + ln(c)) * idf as raw from {name}_t t join {name}_i i on t.country = i.country and t.term = i.term) x"),
        (f"{name}_c", f"select b.entity_id as tgt, a.entity_id as s1, round(sum(a.w * b.w), 9) as cos from {name}_w a join {name}_w b on a.source = 'S1' and b.source <> 'S1' and a.country = b.country and a.term = b.term group by 1, 2"),
    ]


#: Half of the name-token Jaccard and half of the shared numbers.
def score(n1: str, n2: str, a1: str, a2: str) -> str:
    return f"round(({jaccard(f'list_distinct({words(n1)})', f'list_distinct({words(n2)})')} + {jaccard(numbers(a1), numbers(a2))}) / 2, 6)"


NAME_MAX_DF = 0.5
TABLES: dict[str, str] = dict([
    ("p", "select c.c_custkey as k, n.n_name as nat, pt.p_name as pn, pt.p_brand as pb from customer c join nation n on c.c_nationkey = n.n_nationkey join part pt on pt.p_partkey = c.c_custkey * 7 % 200"),
    ("d", "select 'S1-' || k::varchar as entity_id, pn || ' ' || pb || ' Pvt. Ltd.' as business_name, 'No-00' || k::varchar || ' Main Rd, ' || nat || ' ' || (10000 + k)::varchar as business_address, nat as country, k as owner_k, 'S1' as source from p union all select 'S2-' || k::varchar, upper(pn || ' & ' || pb), case when k % 11 = 0 then null else k::varchar || ' main road ' || (10000 + k)::varchar end, nat, k, 'S2' from p where k % 3 <> 0 union all select 'S3-' || k::varchar, pb || ' ' || pn || ' Private Limited', 'Main Ave ' || nat, nat, case when k % 4 = 0 then -1 else k end, 'S3' from p where k % 2 = 0"),
    ("c", f"select *, {normalize('business_name', legal=True)} as name_clean, {normalize('business_address', streets=True)} as address_clean from d"),
    ("k", f"select *, {skeleton('name_clean')} as name_skeleton from c"),
    ("s1", "select * from k where source = 'S1'"),
    ("tg", "select * from k where source <> 'S1'"),
    ("truth", "select 'S1-' || owner_k::varchar as source1_entity_id, entity_id as candidate_entity_id, source from d where source <> 'S1' and owner_k <> -1"),
    ("truth_lists", "select s.entity_id as source1_entity_id, coalesce(string_agg(t.candidate_entity_id, ',' order by t.candidate_entity_id), '') as matched_entity_ids from (select entity_id from d where source = 'S1') s left join truth t on t.source1_entity_id = s.entity_id group by 1"),
    ("idx", _index(ALL_RULES)),
    ("pairs", _PAIRS.format(i="idx")),
    ("texts", "select p.*, a.name_clean as name1, a.address_clean as address1, a.country as country1, b.name_clean as name2, b.address_clean as address2, b.country as country2 from pairs p join s1 a on a.entity_id = p.source1_entity_id join tg b on b.entity_id = p.candidate_entity_id"),
    ("scored", f"select source1_entity_id, candidate_entity_id, {score('name1', 'name2', 'address1', 'address2')} as match_probability from texts"),
    ("best", "select candidate_entity_id, source1_entity_id, match_probability from (select *, row_number() over (partition by candidate_entity_id order by match_probability desc, source1_entity_id) as r from scored) x where r = 1"),
    *_tfidf("w", r"regexp_extract_all(name_clean || ' ' || address_clean, '\w+')", 1, "5000"),
    *_tfidf("n", f"flatten([flatten([[substr(' ' || t || ' ', i, n) for i in range(1, length(t) + 2 - n + 2)] for n in [3, 4, 5] if length(t) + 2 >= n]) for t in {words('name_clean')}])", 2, f"{NAME_MAX_DF} * n"),
    ("w_top", "select tgt, s1 from (select *, row_number() over (partition by tgt order by cos desc, s1) as r from w_c) x where r <= 10"),
    ("n_top", "select tgt, s1 from (select *, row_number() over (partition by tgt order by cos desc, s1) as r from n_c) x where r <= 10"),
    ("bth", "select tgt, s1, coalesce(w_c.cos, 0.0) as cos, coalesce(n_c.cos, 0.0) as cos_name, coalesce(a.f, 0)::int as in_combined_retrieval, coalesce(b.f, 0)::int as in_name_retrieval from (select tgt, s1 from w_top union select tgt, s1 from n_top) u left join (select tgt, s1, 1 as f from w_top) a using (tgt, s1) left join (select tgt, s1, 1 as f from n_top) b using (tgt, s1) left join w_c using (tgt, s1) left join n_c using (tgt, s1)"),
    ("noisy", r"select doc_id::varchar as entity_id, array_to_string((list_filter(regexp_split_to_array(lower(text), '\s+'), lambda t: t <> ''))[1:6], ' ') as business_name from documents"),
    ("n_true", "select e.entity_id as source1_entity_id, count(t.candidate_entity_id) as n_true from (select entity_id from d where source = 'S1') e left join truth t on t.source1_entity_id = e.entity_id group by 1"),
])
NEEDS = {"d": "p", "c": "d", "k": "c", "s1": "k", "tg": "k", "truth": "d", "truth_lists": "truth d", "idx": "c", "pairs": "idx", "texts": "pairs s1 tg", "scored": "texts", "best": "scored", "w_t": "k", "w_i": "w_t c", "w_w": "w_i w_t", "w_c": "w_w", "n_t": "k", "n_i": "n_t c", "n_w": "n_i n_t", "n_c": "n_w", "w_top": "w_c", "n_top": "n_c", "bth": "w_top n_top", "n_true": "truth d"}


def sql(body: str, *needs: str) -> str:
    """body, after the common tables that it needs, each once and materialized."""
    order: list[str] = []

    def add(name: str) -> None:
        for x in NEEDS.get(name, "").split():
            add(x)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    if not order:
        return body
    return "with " + ", ".join(f"{n} as materialized ({TABLES[n]})" for n in order) + " " + body


def f05(tp: str = "tp", n_pred: str = "n_pred", n_true: str = "n_true") -> str:
    return f"case when {n_true} = 0 and {n_pred} = 0 then 1.0 when {tp} = 0 then 0.0 else 1.25 * ({tp}::double / {n_pred}) * ({tp}::double / {n_true}) / (0.25 * ({tp}::double / {n_pred}) + ({tp}::double / {n_true})) end"
