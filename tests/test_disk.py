"""What goes over the disk: how often order lines are shuffled, and how narrow, and that narrower paths give the same rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from packhouse.config import Params
from packhouse.operators import quality
from packhouse.operators.lookups import in_two, with_parent
from packhouse.plans import catalog, maintenance
from packhouse.plans.orders import lines_as_drafts
from packhouse.sources.schemas import schema
from packhouse.sources.testdata import Testdata
from small import Small, day, frame

P = Params(as_of=day("2001-08-01"))
AT = dt.datetime(2001, 7, 1)
TABLES = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
}


def line(order, part, number, **more):
    return {"l_orderkey": order, "l_partkey": part, "l_suppkey": 3, "l_linenumber": number, "l_quantity": 3, "l_extendedprice": 100.005 * number, "l_discount": 0.05,
            "l_tax": 0.02, "l_returnflag": "R" if number == 2 else "N", "l_linestatus": "O", "l_shipdate": AT} | more


ROWS = {
    "customer": [{"c_custkey": k, "c_name": f"c{k}", "c_nationkey": k, "c_mktsegment": "FURNITURE" if k % 2 else "MACHINERY"} for k in range(3)],
    "part": [{"p_partkey": k, "p_name": f"p{k}", "p_size": 1, "p_retailprice": 9.5 + k} for k in range(4)],
    "orders": [{"o_orderkey": k, "o_custkey": k % 4, "o_orderstatus": "POF"[k % 3], "o_totalprice": 7.0, "o_orderdate": AT, "o_orderpriority": "4-NOT SPECIFIED"} for k in range(7)]
    + [{"o_orderkey": None, "o_custkey": 1, "o_orderdate": AT}],
    # Order 6 has no lines; there are lines of an order that isn't there, of none, of an unknown part and of none.
    "lineitem": [line(o, o % 3, n) for o in range(6) for n in range(1, 4)] + [line(90, 1, 1), line(None, 1, 2), line(1, 50, 4), line(2, None, 5, l_quantity=0), line(3, 1, 6, l_quantity=None)],
}


@pytest.fixture
def far(spark):
    """Joins as on large tables: no side is sent to all tasks."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(params=[1, 2], ids=["single", "twice"])
def given(spark, tmp_path, request):
    """The tables from a few rows; and with every row twice."""
    for name, ddl in TABLES.items():
        frame(spark, ddl, ROWS[name] * request.param).write.parquet(f"{tmp_path}/{name}.parquet")
    t = Testdata(spark, str(tmp_path))
    t.copies = request.param
    return t


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def reads(df, table):
    """How often a plan reads a table."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(leaves.apply(i).relation().location().rootPaths().head().toString().endswith(f"/{table}.parquet") for i in range(leaves.size()))


def rows(df):
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_items_in_two_steps_are_the_items(given):
    """Also where a parent comes twice, and with a lookup in between that has columns of the same names."""
    cols = schema("order_items").names
    first, complete = in_two(given, "order_items", *cols)
    assert rows(complete(first)) == rows(given.order_items(*cols))
    products = {"unit": "unit", "order_key": "name"}
    between = complete(with_parent(first, given.products("id", "name", "unit"), "product_id", products))
    assert rows(between) == rows(with_parent(given.order_items(*cols), given.products("id", "name", "unit"), "product_id", products))


def test_orders_in_two_steps_are_the_orders(given):
    cols = ["id", "client_id", "order_date", "total_revenue", "net_profit", "margin_zone"]
    first, complete = in_two(given, "orders", *cols)
    clients = given.clients("id", "name")
    assert rows(complete(with_parent(first, clients, "client_id", {"client_name": "name"}))) == rows(with_parent(given.orders(*cols), clients, "client_id", {"client_name": "name"}))


def test_other_sources_give_all_columns_at_once(spark):
    first, complete = in_two(Small(spark, orders=[{"id": "o", "total_revenue": 5}]), "orders", "id", "total_revenue")
    assert complete(first) is first and rows(first) == [("o", 5)]


def test_items_are_shuffled_before_they_have_ids(given, far):
    """Lines go to their product, then to their order, as numbers; ids and other texts are made of them after the last shuffle."""
    for name in ("order_documents", "order_documents_flat"):
        text = plan(getattr(catalog, name)(given, P))
        assert text.count("concat_ws") == 1 and text.index("concat_ws") < text.index("Exchange hashpartitioning"), (name, text)


def test_order_documents_read_lines_twice(given):
    """For items and for sums, not once more to count ids."""
    assert reads(catalog.order_documents(given, P), "lineitem") == 2


def test_positions_count_lines_once(given, far):
    """However often parents come; a line that is there twice takes both of its positions."""
    got = {}
    for r in catalog.order_documents(given, P).collect():
        got.setdefault((r["order_id"], r["item_id"]), set()).add(r["position"])
    n = given.copies
    ids = sorted(i for o, i in got if o == "1")
    assert len(ids) == 4 and [got["1", i] for i in ids] == [{n * k + j for j in range(1, n + 1)} for k in range(4)]
    assert got["6", None] == {0} and got[None, None] == {0} and not [k for k in got if k[0] == "90"]


def test_flat_documents_shuffle_heads_once(given, far):
    """Two joins ask for the heads, and get the same: no join asks for those with an id and the other for all."""
    df = catalog.order_documents_flat(given, P)
    scans = [x for x in plan(df).splitlines() if "FileScan parquet" in x and "o_orderdate" in x]
    asked = {x.split("DataFilters: [")[1].split("],")[0].split("#")[0].strip() for x in scans}
    assert len(scans) == 3 and all("null(" in x for x in asked), scans
    got = df.collect()
    assert {r["order_id"] for r in got} == {str(k) for k in range(7)} | {None}
    assert {r["item_id"] for r in got if r["order_id"] in (None, "6")} == {None}


def test_refused_forms_ask_for_no_parents(given, far):
    """A form's lines are counted by their own fields: neither product nor client's type is looked up for them, as it was."""
    headers, lines = maintenance.order_forms(given, typed_only=True)
    whole = maintenance.order_forms(given)
    assert reads(maintenance.refused_forms(headers, lines), "part") == reads(maintenance.refused_forms(headers, lines), "customer") - 1 == 0
    want = quality.rejected(maintenance._checked_forms(headers, maintenance._typed_lines(*whole, given.clients("id", "type"))))
    shown = ["id", "failures"]
    assert rows(maintenance.refused_forms(headers, lines).select(*shown)) == rows(want.select(*shown)) != []


def test_typed_fields_of_drafts(given):
    few = lines_as_drafts(given, typed_only=True)
    if given.copies == 1:
        assert rows(few) == rows(lines_as_drafts(given).select(*few.columns))
    assert set(rows(few)) == set(rows(lines_as_drafts(given).select(*few.columns)))


def test_deletes_are_not_read_for_rejects(given, far):
    """Only upserts can be refused: lines that delete are left out before they are shuffled."""
    refused = quality.split_changes(given.price_changes(), quality.price_rules())[1]
    text = refused._jdf.queryExecution().optimizedPlan().toString()
    join = text.index("Join LeftOuter")
    assert "l_returnflag" in "".join(x for x in text[join:].splitlines(True) if "Filter" in x), text


def test_batch_forms_are_grouped_once(given, far):
    forms = given.batch_forms()
    assert reads(forms, "lineitem") == 1
    plain = given._batch_forms()
    bad = plain.filter(F.col("product_id").cast("long") % 40 < 5).count()
    assert bad and forms.count() == plain.count() + bad and forms.schema == plain.schema
