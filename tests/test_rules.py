import itertools
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from kinweave.operators import blocking, decision, metrics, prepare, profile, retrieval, sampling, validate
from kinweave.plans import pipelines
from kinweave.sources import delimited

E, O, P = decision.ENTITY, decision.OTHER, decision.PROB


def pairs(spark, rows):
    return spark.createDataFrame(rows, f"{E} string, {O} string, {P} double")


def lists(spark, rows, column="matched_entity_ids"):
    return spark.createDataFrame(rows, f"{E} string, {column} string")


def f_half(tp, n_pred, n_true):
    if not n_pred and not n_true:
        return 1.0
    return 1.25 * tp / (n_pred + 0.25 * n_true) if tp else 0.0


def fixture(seed=5, n=40):
    """Scored pairs with tied scores, their truth and all entities."""
    rng = random.Random(seed)
    ids = [f"e{i:02}" for i in range(n)]
    rows = [(rng.choice(ids[: n - 5]), f"t{j}", rng.randint(0, 20) / 20) for j in range(3 * n)]
    truth = sorted({(e, t) for e, t, _ in rows if rng.random() < 0.4} | {(ids[-1], "none")})
    return ids, rows, truth


def macro(ids, kept, truth):
    kept, truth = set(kept), set(truth)
    of = lambda s, e: {t for x, t in s if x == e}
    return round(sum(f_half(len(of(kept, e) & of(truth, e)), len(of(kept, e)), len(of(truth, e))) for e in ids) / len(ids), 6)


@pytest.fixture(scope="module")
def scored(spark):
    ids, rows, truth = fixture()
    return ids, rows, truth, pairs(spark, rows), spark.createDataFrame(truth, f"{E} string, {O} string"), spark.createDataFrame([(i, "x" if i < "e20" else None) for i in ids], f"{E} string, country string")


def test_threshold_curve(scored):
    ids, rows, truth, df, t, who = scored
    got = {r["t"]: r["macro_f05"] for r in metrics.threshold_curve(df, t, who, [0.05, 0.5, 0.51, 0.95, 1.5]).collect()}
    assert got == {x: macro(ids, [(e, o) for e, o, p in rows if p >= x], truth) for x in (0.05, 0.5, 0.51, 0.95, 1.5)}
    parts = {(r["country"], r["t"]): r["macro_f05"] for r in metrics.threshold_curve(df, t, who, [0.5], by=["country"]).collect()}
    assert parts == {(c, 0.5): macro([i for i in ids if (i < "e20") == (c == "x")], [(e, o) for e, o, p in rows if p >= 0.5], truth) for c in ("x", None)}


def test_guard_grid(scored):
    ids, rows, truth, df, t, who = scored
    got = {(r["t"], r["sole"]): r["macro_f05"] for r in metrics.guard_grid(df, t, who, 0.3).collect()}
    for at, sole in [(0.3, None), (0.3, 0.31), (0.5, 0.7), (0.55, 0.95), (0.8, None)]:
        kept = [(e, o, p) for e, o, p in rows if p >= at]
        alone = {e for e, g in itertools.groupby(sorted(kept), key=lambda x: x[0]) if len(list(g)) == 1}
        assert got[at, sole] == macro(ids, [(e, o) for e, o, p in kept if sole is None or e not in alone or p >= sole], truth), (at, sole)


def test_means_that_end_in_a_half_go_up(spark):
    # 64 entities, so that means of few eighths end in a 5 at the seventh digit
    rng = random.Random(20)
    truth, pairs = [], []
    for i in range(64):
        truth += [(f"e{i}", f"t{i}-{j}") for j in range(1 + i % 2)]
        pairs += [(f"e{i}", f"t{i}-{j}", round(rng.uniform(0.05, 0.95), 2)) for j in range(3)]
    own, true = spark.createDataFrame(pairs, f"{E} string, {O} string, {P} double"), spark.createDataFrame(truth, f"{E} string, {O} string")
    ids, half = true.select(E, F.lit("x").alias("c")).distinct(), Fraction(1, 2)

    def mean(t):
        total = Fraction(0)
        for i in range(64):
            kept, n = [p for p in pairs if p[0] == f"e{i}" and p[2] >= t], 1 + i % 2
            tp = sum(p[1] in (f"t{i}-0", f"t{i}-1")[:n] for p in kept)
            total += Fraction(5 * tp, n + 4 * len(kept))
        return total / 64

    # F0.5 is 1.25 tp / (0.25 n_true + n_pred)
    want = {t: mean(t) for t in metrics.CURVE}
    assert any((v * 10**6) % 1 == half for v in want.values())
    want = {t: math.floor(v * 10**6 + half) / 10**6 for t, v in want.items()}
    assert {r["t"]: r["macro_f05"] for r in metrics.threshold_curve(own, true, ids, by=["c"]).collect()} == want
    assert metrics.macro_f05(own.where(F.col(P) >= 0.4), true, ids).first()["macro_f05"] == want[0.4]


def test_dual_threshold_and_its_grid(scored):
    ids, rows, truth, df, t, who = scored
    grid = metrics.dual_grid(df, t, who, [0.2, 0.6, 0.95], [0.2, 0.4, 0.6, 0.95]).collect()
    assert {(r["ts"], r["tm"]) for r in grid} == {(a, b) for a in (0.2, 0.6, 0.95) for b in (0.2, 0.4, 0.6, 0.95) if b >= a}
    for r in grid:
        top = {e: max(p for x, _, p in rows if x == e) for e, _, _ in rows}
        kept = [(e, o) for e, o, p in rows if top[e] >= r["ts"] and p >= r["tm"]]
        assert r["macro_f05"] == macro(ids, kept, truth)
    kept = [(e, o) for e, o, p in rows if p >= 0.4 and max(q for x, _, q in rows if x == e) >= 0.8]
    assert sorted((r[E], r[O]) for r in decision.dual_threshold(df, 0.8, 0.4).collect()) == sorted(kept)
    found = pipelines.tune_on_entities(df, t, who, [0.2, 0.6], [0.4, 0.95])
    assert found["macro_f05"] == max(r["macro_f05"] for r in metrics.dual_grid(df, t, who, [0.2, 0.6], [0.4, 0.95]).collect())


def test_class_curve_and_precision_recall(spark):
    rng = random.Random(8)
    rows = [(rng.randint(-2, 24) / 20, int(rng.random() < 0.4)) for _ in range(300)]
    df = spark.createDataFrame(rows, f"{P} double, label int")
    for r in metrics.class_curve(df, [0.1, 0.5, 0.9]).collect():
        tp, fp = (sum(p >= r["t"] and y == k for p, y in rows) for k in (1, 0))
        assert (r["precision"], r["recall"]) == (round(tp / (tp + fp), 6), round(tp / sum(y for _, y in rows), 6))
    curve = {r["threshold"]: (r["tp"], r["n_pred"]) for r in metrics.pr_curve(df).collect()}
    assert curve == {t: (sum(y for p, y in rows if p >= t), sum(p >= t for p, _ in rows)) for t in {p for p, _ in rows}}
    levels = sorted({p for p, _ in rows}, reverse=True)
    ap = sum(sum(y for p, y in rows if p == t) / sum(y for _, y in rows) * curve[t][0] / curve[t][1] for t in levels)
    assert metrics.precision_recall_ap(df, 0.5).first()["average_precision"] == round(ap, 6)


def test_scores_of_lists(spark):
    truth = lists(spark, [("k1", "u,v"), ("k2", ""), ("k3", "w"), ("k4", None)])
    pred = lists(spark, [("k1", "v, u"), ("k2", "z"), ("k3", "w,z"), ("k4", "")])
    assert metrics.score_lists(pred, truth, truth.select(E)).first()["macro_f05"] == round((1 + 0 + f_half(1, 2, 1) + 1) / 4, 6)
    assert metrics.score_lists(pred, truth, truth.select(E).limit(0)).first()["macro_f05"] == 0.0
    grouped = decision.group_ids(pairs(spark, [("k1", "b", 0.1), ("k1", "a", 0.1), ("k1", "b", 0.2)]), truth.select(E))
    assert dict(grouped.collect()) == {"k1": "a,b", "k2": "", "k3": "", "k4": ""}


def test_assignment_and_guard(spark):
    s = pairs(spark, [("k2", "u", 0.7), ("k1", "u", 0.7), ("k1", "v", 0.6), ("k3", "w", 0.45), ("k3", "v", 0.2)])
    assert {r[O]: r[E] for r in decision.assign(s).collect()} == {"u": "k1", "v": "k1", "w": "k3"}
    assert {r[O] for r in decision.sole_guard(decision.threshold(decision.assign(s), 0.4), 0.5).collect()} == {"u", "v"}


def test_tsv_and_missing_values(spark, tmp_path):
    head = "\t".join(delimited.SOURCE_COLUMNS)
    (tmp_path / "x.tsv").write_text(head + '\n5\tN/A\t"one ""two"" three"\tNaN\n6\tNancy\t\tIT\n', encoding="utf-8")
    rows = [tuple(r) for r in delimited.read_tsv(spark, str(tmp_path / "x.tsv")).orderBy("entity_id").collect()]
    assert rows == [("5", None, 'one "two" three', None), ("6", "Nancy", None, "IT")]
    delimited.write_tsv(spark.createDataFrame([("p", "")], "x string, y string"), str(tmp_path / "out"), single=True)
    assert next((tmp_path / "out").glob("part-*")).read_text() == "x\ty\np\t\n"
    check = lambda name: dict(validate.raw_file(spark, str(tmp_path / name), delimited.SOURCE_COLUMNS).collect())
    assert check("x.tsv") == {"tabs": 0, "header": 0}
    (tmp_path / "late.tsv").write_text(f"1\t2\t3\t4\n{head}\n\n5\t6\n", encoding="utf-8")
    assert check("late.tsv") == {"tabs": 1, "header": 1}


def test_splits_share_no_entity(spark, monkeypatch):
    monkeypatch.setattr(sampling, "PARTS", 8)
    rows = [(f"m{i}", f"n{i}-{j}", int(j < i % 3)) for i in range(66) for j in range(2)]
    df = spark.createDataFrame(rows, f"{E} string, {O} string, label int")
    s1 = spark.createDataFrame([(f"m{i}", "PT" if i % 2 else "BR") for i in range(66)], "entity_id string, country string")
    out = sampling.stratified_split(df, s1)
    assert out.count() == 132 and out.groupBy(E).agg(F.countDistinct("is_validation").alias("n")).where("n > 1").count() == 0
    held = sampling.strata(df, s1).join(out.where("is_validation"), E).select("stratum").distinct().count()
    assert held == sampling.strata(df, s1).select("stratum").distinct().count()
    from kinweave.functions.text import order_key

    order = [r[0] for r in df.select(E).distinct().orderBy(order_key(42, F.col(E)), E).collect()]
    for n in (0, 1, 13, 66):
        assert {r[0] for r in sampling.first_in_order(df.select(E).distinct(), E, n, 42).collect()} == set(order[:n])
    assert {r[0] for r in sampling.split(df).where("is_validation").select(E).collect()} == set(order[:13])
    lonely = s1.withColumn("country", F.when(F.col("entity_id") == "m0", "IS").otherwise(F.col("country")))
    plain = sampling.stratified_split(df, lonely)  # one stratum of one entity, merged to one of one: the split is plain
    assert {r[0] for r in plain.where("is_validation").select(E).collect()} == set(order[:13])


def test_validation(spark):
    ids = spark.createDataFrame([("k1",), ("k2",)], f"{E} string")
    good, pool = lists(spark, [("k1", "p,q"), ("k2", "")]), lists(spark, [("k1", "p,q,r"), ("k2", None)], "candidate_entity_ids")
    validate.require_valid(good, pool, ids)
    assert validate.messages(good, pool, ids) == []
    bad = lists(spark, [("k1", "q,p,p,zz"), ("k9", "")])
    assert dict(validate.checks(bad, pool, ids).collect()) == {"missing_ids": 1, "extra_ids": 1, "duplicate_rows": 0, "duplicate_ids_in_row": 1, "unsorted_ids_in_row": 1, "not_among_candidates": 1}
    assert len(validate.messages(bad, pool, ids)) == 4 and validate.messages(lists(spark, [("k1", "zz"), ("k2", "")]), pool, ids) == ["not_among_candidates: 1"]
    with pytest.raises(ValueError):
        validate.require_valid(bad, pool, ids)


def test_blocking_skips_and_caps(spark):
    r = [(f"a{i}", "lark press" if i < 4 else f"mill {i}", f"{i} quay", "Chile", "S1") for i in range(12)] + [(f"b{i}", "lark print", "2 quay", "CHILE", "S2") for i in range(3)] + [("c0", "Lark", "", "chile", "S3")]
    df = prepare.add_clean_columns(spark.createDataFrame(r, "entity_id string, business_name string, business_address string, country string, source string"))
    assert prepare.ensure_clean_columns(df) is df
    s1, tg = df.where("source = 'S1'"), df.where("source <> 'S1'")
    rules = [blocking.Rule("w", lambda: blocking.by_key(blocking.first_word()), 1.0)]
    found = blocking.candidate_pairs(s1, tg, rules, with_rules=True)
    assert {tuple(x) for x in found.collect()} == {(f"a{i}", t, s, "w", "") for i in range(4) for t, s in (("b0", "S2"), ("b1", "S2"), ("b2", "S2"), ("c0", "S3"))}
    assert {x["source"] for x in blocking.candidate_pairs(s1, tg, rules, max_block_pairs=11).collect()} == {"S3"}  # blocks are each source's own
    assert blocking.block_index(s1, blocking.first_word(), 0.3).count() == 0  # lark x4 and mill x8 are over 3.6
    assert {x["key"] for x in blocking.token_index(s1, "name_clean", 4, 0.5).collect()} == {"lark", "press"}
    assert blocking.token_index(s1, "name_clean", 4, 0.5, ["lark"]).select("key").distinct().count() == 1
    assert "phonetic" not in {x.name for x in blocking.default_rules()}
    by_sound = blocking.Rule("sound", lambda: blocking.by_key(blocking.phonetic_key()), 1.0)
    assert blocking.candidate_pairs(s1, tg, [by_sound]).count() >= 16


def test_top_cosines_equal_all_products(spark):
    rng = random.Random(4)
    word = lambda: f"w{min(rng.randint(0, 60), rng.randint(0, 60))}"
    rows = [(f"x{i}", " ".join(word() for _ in range(5)), "N" if i % 3 else "M") for i in range(90)]
    df = spark.createDataFrame(rows, "entity_id string, name string, country string")
    w1, wt = retrieval.weights(df.where("entity_id < 'x5'"), df.where("entity_id >= 'x5'"), retrieval.word_terms(F.col("name")), 5000)
    a, b = (({(r["country"], r["entity_id"]): {} for r in w.collect()}) for w in (w1, wt))
    for table, w in ((a, w1), (b, wt)):
        for r in w.collect():
            table[r["country"], r["entity_id"]][r["term"]] = r["w"]
    want = set()
    for (c, t), v in b.items():
        near = sorted((-round(sum(x * u.get(k, 0) for k, x in v.items()), 7), s) for (d, s), u in a.items() if c == d and set(u) & set(v))
        want |= {(t, s, -x) for x, s in near[:3]}
    for rows_ in (4000, 7):
        got = retrieval.top_cosines(w1, wt, 3, rows_).collect()
        assert {(r["tgt"], r["s1"]) for r in got} == {x[:2] for x in want}
        assert all(abs(r["cos"] - dict((x[:2], x[2]) for x in want)[r["tgt"], r["s1"]]) < 1e-6 for r in got)


def test_rows_of_one_text_share_a_vector(spark):
    rng = random.Random(5)
    rows = [(f"{'rs'[i % 2]}{i}", " ".join(rng.choice("uvwxyz") for _ in range(rng.randint(0, 2))), "MN"[i % 3 == 0]) for i in range(120)]
    rows += [("r4", "u w", "M"), ("r4", "u w", "N"), ("r200", "u", None), ("s200", "", "")]  # an id that repeats, also in another country
    df = spark.createDataFrame(rows, "entity_id string, name string, country string")
    s1, tg, terms = df.where("entity_id < 's'"), df.where("entity_id >= 's'"), retrieval.word_terms
    own = retrieval.channel(s1, tg, F.col("name"), terms, 5000)
    plain = retrieval.weights(s1, tg, terms(F.col("name")), 5000)
    listed = lambda x: sorted((r["tgt"], r["s1"], round(r["cos"], 7)) for r in x.collect())
    assert listed(own.top(3)) == listed(retrieval.top_cosines(*plain, 3))
    assert own.w1.select("entity_id").distinct().count() < plain[0].select("country", "entity_id").distinct().count()
    pairs = tg.select(F.col("entity_id").alias("tgt")).where("entity_id < 's3'").crossJoin(s1.where("entity_id <> 'r4'").select(F.col("entity_id").alias("s1")))
    assert listed(own.cosines(pairs)) == listed(retrieval.pair_cosines(pairs, *plain))


def test_char_terms(spark):
    terms = spark.createDataFrame([("no x",)], "x string").select(retrieval.char_terms(F.col("x"), 3, 5)).first()[0]
    assert sorted(terms) == sorted([" no", "no ", " no ", " x "])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "entity_id string, business_name string, business_address string, country string, source string")
    df = prepare.add_skeleton(prepare.add_clean_columns(none))
    assert blocking.candidate_pairs(df, df).count() == 0
    assert retrieval.retrieve(df, df, 3, 5000, 3).count() == 0
    assert profile.missing_values(none).agg(F.sum("pct_missing")).first()[0] == 0.0
    score = lambda x: x.withColumn(P, F.lit(0.5))
    empty = pipelines.score_pairs(spark.createDataFrame([], f"{E} string, {O} string"), df, df, score, F.col(P) > 0.1)
    assert empty.count() == 0 and dict(empty.dtypes)[P] == "double"


def test_thresholds_resolve_one_by_one():
    assert pipelines.resolve_threshold(0.4, {"singleton": 0.5}, None, "singleton") == 0.4
    assert pipelines.resolve_threshold(None, {"singleton": 0.5}, {"threshold": 0.3}, "match") == 0.3
    with pytest.raises(ValueError):
        pipelines.resolve_threshold(None, None, None, "match")


def test_hopeful_cells_hold_the_best():
    import numpy as np

    from kinweave.operators import retrieval

    rng = np.random.default_rng(1)
    for wide, k, kinds in ((16, 3, 4), (320, 10, 5), (320, 19, 10**6), (320, 20, 3), (1600, 10, 50)):
        cells = rng.integers(0, kinds, (30, wide)) / kinds * (rng.random((30, wide)) < 0.7)
        cells[1], cells[2, :3] = 0, 1 - np.array([0, 4e-10, 6e-10])
        i, j = retrieval.hopeful(cells, k)
        rounded = cells.round(retrieval.DIGITS)
        for t in range(len(cells)):
            best = lambda at: sorted((-rounded[t, x], x) for x in at if rounded[t, x] > 0)[:k]
            assert best(j[i == t]) == best(range(wide))


def test_grams_scored_with_names_equal_native_ones(spark):
    from kinweave.functions import fuzzy
    from kinweave.operators import features

    odd = ["", "a", "ab", "abc", "abab abab", "blue bolt brand 9", "bolt blue and brand 9", "\U0001f600\U0001f601x", "e\u0301e\u0301", " x "]
    rows = [(x, "", "", "", y, "", "", "") for x in odd for y in odd]
    texts = spark.createDataFrame(rows, ", ".join(f"{c}{i} string" for i in (1, 2) for c in ("name", "address", "country", "skeleton")))
    seen = lambda df: sorted(map(tuple, df.select("name1", "name2", *fuzzy.GRAMS).collect()))
    assert seen(features.add_fuzzy(texts, fuzzy.FIELDS + fuzzy.GRAMS)) == seen(features.add_native(texts))
