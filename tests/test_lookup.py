"""Lookups never pass a table through the driver."""

import datetime

import pytest
from pyspark.sql import functions as F

from tradebinder.operators.lookup import spread_join
from tradebinder.plans.queries import registered

CUSTOMERS = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
PARTS = "p_partkey long, p_name string, p_type string, p_size int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A few rows of the given tables."""
    path = tmp_path_factory.mktemp("given")
    segments = ["MACHINERY", "BUILDING", "AUTOMOBILE", "HOUSEHOLD", "FURNITURE"]
    tables = {
        "customer": ([(i, f"Customer#{i:09}", i % 25, 10.0 * i, segments[i % 5]) for i in range(60)], CUSTOMERS),
        "part": ([(i, f"part {i % 9}", "SMALL" if i % 3 else "PROMO", i % 50) for i in range(80)], PARTS),
        "supplier": ([(i, i % 25, 30.0 * i) for i in range(8)], "s_suppkey long, s_nationkey int, s_acctbal double"),
        "events": (
            [(i, datetime.datetime(2024, 1, 1 + i % 28), i % 6, "view", 5.0 + i, '{"k": 3}') for i in range(90)],
            "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
        ),
        "orders": (
            [(1, 1, "O", 90.0, datetime.date(2024, 1, 1), "5-LOW")],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_does_not_broadcast(spark, how):
    facts = spark.createDataFrame([(i, i % 3 if i % 5 else None) for i in range(20)], "row long, key long")
    table = spark.createDataFrame([(0, "a"), (1, "b")], "key long, word string")
    found = spread_join(facts, table, ["key"], how, ["row"])
    assert "Broadcast" not in plan(found)
    assert sorted(found.collect(), key=str) == sorted(facts.join(table, ["key"], how).collect(), key=str)


@pytest.mark.parametrize(
    "name",
    ["staging_match", "promoted_items", "staging_after_promotion", "recheck_waiting", "possible_duplicates",
     "staging_re_evaluated", "new_products"],
)
def test_import_and_views_do_not_broadcast(spark, folder, name):
    rows = registered()[name](spark, folder)
    assert "Broadcast" not in plan(rows)
    assert rows.agg(F.count("*")).first()[0] >= 0
