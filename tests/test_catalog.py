"""Every registered query against its check SQL, and plan rules that must hold at any scale."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lakeops.plans.registry import CATALOG

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "MapInPandas", "FlatMapGroupsInPandas")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 9))
        return repr(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", CATALOG)  # the corpus operators have tests of their own
def test_query(spark, duck, name):
    df = queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
    got = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cur = duck.execute(sql)
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(got, df.columns) == canonical(cur.fetchall(), columns)


def test_entry(spark):
    assert entry(spark).count() > 0


def formatted(spark, name):
    qe = queries()[name](spark, SF)._jdf.queryExecution()
    return spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(qe, "formatted")


def test_filters_and_columns_reach_the_scan(spark):
    plan = formatted(spark, "filters")
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThan(o_totalprice,200000.0)" in pushed and "In(o_orderstatus" in pushed
    assert "o_custkey" not in plan
    assert "l_comment" not in formatted(spark, "gold_top_10_items")
    recent = formatted(spark, "access_log")
    assert "GreaterThan(ts," in recent and "props" not in recent


def test_top_k_is_limited_before_the_shuffle(spark):
    plan = queries()["top_orders_per_customer"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_small_reference_tables_are_broadcast(spark):
    plan = queries()["join_broadcast"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "AdaptiveSparkPlan" in plan


def test_a_merge_is_not_a_full_outer_join(spark):
    plan = formatted(spark, "merge_latest_of_batch")
    assert "SortMergeJoin FullOuter" not in plan and "WindowGroupLimit" in plan
