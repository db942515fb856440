import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from lodestrata.plans.catalogue import QUERIES
from lodestrata.plans.oracles import ORACLES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    from tests.conftest import SF

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(frame, columns):
    def plain(x):
        return None if x is None or (isinstance(x, float) and math.isnan(x)) else x

    return sorted((tuple(plain(x) for x in r) for r in frame[columns].astype(object).itertuples(index=False)), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert entry_point.queries().keys() >= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    got = QUERIES[name](spark, sf).toArrow().to_pandas()
    assert len(got) > 0
    if name in ORACLES:
        want = duck.execute(ORACLES[name]).fetchdf()
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        assert rows(got, columns) == rows(want, columns)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert "chunk_id" in df.columns and df.count() > 0


def test_recall_is_high(spark, sf):
    assert QUERIES["ann_recall"](spark, sf).first()["recall"] >= 0.9


def test_no_query_plans_a_cross_join(spark, sf):
    for name in ("rag_inputs", "eval_grid", "demo_select", "promote_alias", "rerank_topk", "topk_cosine"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
