"""One order, product, client and user with a third of all rows each.

Broadcasts are off and the limits of a skewed partition tiny, so that the joins take
the paths they take on large tables.
"""

import pytest
from pyspark.sql import functions as F

from compare import connect, differences, duck_rows, spark_rows
from oracle import statements
from packhouse.plans.registry import queries
from packhouse.sources.testdata import Testdata

SF = "/root/testdata/sf0.001"
CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    # Several map tasks: a hot partition is split along their outputs.
    "spark.sql.files.maxPartitionBytes": "32KB",
    "spark.sql.files.openCostInBytes": "1KB",
}
CHECKED = [
    "apply_order_updates", "apply_price_changes", "apply_product_changes", "client_order_number", "client_performance",
    "create_orders_payments", "debounced_changes", "delivery_note_lines", "deduct_waste", "line_revenue", "order_documents_flat",
    "order_economics", "price_fanout_clients", "price_history", "product_performance", "product_trend", "sales_fact",
    "stock_recommendations", "weekly_kpis",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = connect(SF)
    for table in "region nation customer supplier part documents embeddings pages benchmark labels conversations".split():
        con.execute(f"COPY {table} TO '{folder}/{table}.parquet'")
    # Line numbers are made unique, as the rows of the hot keys would else share their id.
    con.execute(f"""COPY (SELECT * EXCLUDE (rn) REPLACE (
        CASE WHEN rn % 3 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey, CASE WHEN rn % 3 = 1 THEN 2 ELSE l_partkey END AS l_partkey,
        CAST(rn AS INTEGER) AS l_linenumber)
        FROM (SELECT *, row_number() OVER () AS rn FROM lineitem)) TO '{folder}/lineitem.parquet' (ROW_GROUP_SIZE 2048)""")
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE o_custkey END AS o_custkey) FROM orders)
        TO '{folder}/orders.parquet'""")
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id) FROM events)
        TO '{folder}/events.parquet'""")
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield folder
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", CHECKED)
def test_results_hold_under_skew(spark, skewed, name):
    con = connect(skewed)
    assert differences(spark_rows(queries()[name](spark, skewed)), duck_rows(con, statements()[name])) == []


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_split(spark, skewed):
    """Adaptive execution splits the hot order and the hot product."""
    for name in ("line_revenue", "order_documents_flat"):
        assert "skew=true" in final_plan(queries()[name](spark, skewed)), name
