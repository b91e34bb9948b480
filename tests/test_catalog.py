"""Queries against their SQL on the smallest tables, where those are there."""

import os

import pytest

D = "/root/testdata/sf0.001"
NAMES = ["clean_columns", "name_skeleton", "token_functions", "blocking_keys", "candidate_pairs", "channel_union", "retrieval_features", "pair_features_native", "top_k_join", "pair_cosines", "class_threshold_curve", "country_threshold_curve", "dual_threshold_grid", "pr_curve", "precision_recall_ap", "entity_split", "hard_negatives", "sole_guard", "linkage_f05", "threshold_curve", "guard_grid", "validate_results"]


@pytest.mark.skipif(not os.path.isdir(D), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    import duckdb
    import pandas as pd

    from kinweave.plans import catalog

    con = duckdb.connect()
    for t in ("customer", "nation", "part", "documents"):
        con.sql(f"create view {t} as select * from '{D}/{t}.parquet'")
    got, want = catalog.queries()[name](spark, D).toPandas(), con.sql(catalog.oracle_sql()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)

    def rows(df):
        return sorted(tuple("" if pd.isna(v) else round(float(v), 6) if not isinstance(v, str) else v for v in r) for r in df[cols].itertuples(index=False))

    assert rows(got) == rows(want)


def test_every_sql_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(D), reason="the driver's tables are not here")
def test_whole_workflows_have_the_default_candidates(spark, monkeypatch):
    from kinweave.operators import retrieval
    from kinweave.plans import catalog, pipelines

    s1, tg = catalog.sides(spark, D)
    pairs = lambda df: {(r["tgt"], r["s1"]) for r in df.select("tgt", "s1").collect()}
    word, name = retrieval.channels(s1, tg, 5000, catalog.NAME_MAX_DF, "skeleton")
    want = pairs(retrieval.union_channels(word, name, 10, 10))
    assert pairs(catalog.queries()["feature_matrix"](spark, D)) == want

    class Seen(Exception):
        pass

    def seen(records, truth_long, s, rounds=pipelines.train_assignment.__defaults__[0], **kw):
        raise Seen(s.k, s.k_name, rounds)

    monkeypatch.setattr(pipelines, "train_assignment", seen)
    with pytest.raises(Seen) as e:
        catalog.queries()["assignment_workflow"](spark, D)
    assert e.value.args == (10, 10, 20)


@pytest.mark.skipif(not os.path.isdir(D), reason="the driver's tables are not here")
def test_assignment_retrieves_once_and_does_not_hang_on_partitions(spark, monkeypatch):
    from kinweave.operators import models, retrieval
    from kinweave.plans import catalog

    calls, retrieve, trees = [], retrieval.retrieve, models.train_trees
    monkeypatch.setattr(retrieval, "retrieve", lambda *a, **kw: calls.append(1) or retrieve(*a, **kw))
    monkeypatch.setattr(models, "train_trees", lambda train, columns, rounds, **kw: trees(train, columns, 2, **kw))
    got, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (4, 7):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(sorted(map(tuple, catalog.queries()["assignment_workflow"](spark, D).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(calls) == 2 and got[0] == got[1] and any(x for _, x in got[0])


@pytest.mark.skipif(not os.path.isdir(D), reason="the driver's tables are not here")
def test_assignment_scores_once_and_gives_the_models_lists(spark, monkeypatch):
    from pyspark.sql import functions as F

    from kinweave.operators import models
    from kinweave.plans import catalog, pipelines

    calls, kept, predict, trees, train = [], [], models.predict, models.train_trees, pipelines.train_assignment
    monkeypatch.setattr(models, "train_trees", lambda rows, columns, rounds, **kw: trees(rows, columns, 2, **kw))
    monkeypatch.setattr(models, "predict", lambda *a, **kw: calls.append(1) or predict(*a, **kw))
    monkeypatch.setattr(pipelines, "train_assignment", lambda r, t, s, matrix, **kw: kept.append((r, matrix, train(r, t, s, matrix=matrix, **kw))) or kept[0][2])
    got = sorted(map(tuple, catalog.queries()["assignment_workflow"](spark, D).collect()))
    assert len(calls) == 2
    r, matrix, (tuned, found, _) = kept[0]

    def score(df):
        both = predict(found["b"][0], predict(found["a"][0], df, "p_a"), "p_b")
        return both.withColumn(catalog.PROB, F.col("p_a") * found["a"][1] + F.col("p_b") * found["b"][1])

    assert any(x for _, x in got)
    assert got == sorted(map(tuple, pipelines.predict_assignment(r, score, tuned, matrix=matrix).collect()))


def test_training_rows_fill_their_partitions():
    from kinweave.plans import pipelines

    assert [pipelines.train_parts(n) for n in (0, 20_001, 4_150_000, 100_000_000)] == [1, 2, 24, 500]
