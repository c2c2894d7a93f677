"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import pytest

from registry import bindings, oracle
from tools.check import comparable, duck, type_differences

SF = "/root/testdata/sf0.001"
QUERIES, SQL = bindings.queries, oracle.SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    rel = con.sql(SQL[name])
    assert comparable(df.columns, df.collect()) == comparable(rel.columns, rel.fetchall())
    assert not type_differences(df, rel)
    assert not [c for c in df.columns if df.columns.count(c) > 1]


@pytest.mark.parametrize("most, sent", [(bindings.MOST_LABELS, True), (5, False)])
def test_texts_are_not_shuffled_for_few_labels(spark, monkeypatch, most, sent):
    def rows(df):
        return sorted(map(tuple, df.collect()), key=repr)

    usual = rows(bindings.labelled(spark, SF)), rows(bindings.review_rows(spark, SF))
    monkeypatch.setattr(bindings, "MOST_LABELS", most)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as if both tables were large
    try:
        joined = bindings.labelled(spark, SF), bindings.review_rows(spark, SF)
        plans = [df._jdf.queryExecution().sparkPlan().toString() for df in joined]
        assert [("BroadcastHashJoin [doc_id" in plan) for plan in plans] == [sent, sent]
        assert usual == tuple(map(rows, joined))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
