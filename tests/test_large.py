"""Steps whose bytes and tasks have to grow no faster than their rows: what the plans do, and that large groups give the same rows."""

import datetime as dt

import pytest

from packhouse.config import Params
from packhouse.operators import quality, slices
from packhouse.plans import catalog, order_log
from packhouse.sources.testdata import Testdata
from packhouse.streaming import kept
from small import Small, day, frame

P = Params(as_of=day("2001-08-01"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


@pytest.fixture
def tables(spark):
    """Orders of 0 to 9 items, one id twice, a product twice, an item without an order and one without a head; prices of few clients and products."""
    orders = [{"id": f"o{i}", "client_id": f"c{i % 3}" if i % 4 else None, "order_date": day("2001-07-01")} for i in range(10)]
    items = [{"id": f"i{i}-{k}", "order_id": f"o{i}", "product_id": f"p{k}", "quantity": k} for i in range(10) for k in range(i)]
    items += [items[0], {"id": "x", "order_id": None}, {"id": "y", "order_id": "gone"}]
    prices = [
        {"id": f"h{i:02d}", "client_id": f"c{i % 2}" if i % 7 else None, "product_id": f"p{i % 3}" if i % 9 else None, "selling_price": i,
         "changed_at": dt.datetime(2001, 1 + i % 5, 1) if i % 11 else None}
        for i in range(60)
    ]
    return Small(spark, orders=orders, order_items=items, price_history=prices, products=[{"id": "p1", "name": "n"}] * 2, clients=[{"id": "c1", "name": "n"}])


def test_prices_are_numbered_in_one_shuffle(spark, tables):
    text = plan(catalog.price_history(tables, P))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text, text


def test_order_items_are_not_written_to_be_numbered(spark, tables, monkeypatch):
    def refuse(*_):
        raise AssertionError("dealt out")

    monkeypatch.setattr(slices, "dealt", refuse)
    got = catalog.order_documents(tables, P)
    assert sorted((r["order_id"], r["position"]) for r in got.collect() if r["order_id"] in ("o0", "o1", "o3")) == [
        ("o0", 0), ("o1", 1), ("o1", 1), ("o1", 2), ("o1", 2), ("o3", 1), ("o3", 2), ("o3", 2), ("o3", 3)
    ]


@pytest.mark.parametrize("name", ["price_history", "order_documents"])
@pytest.mark.parametrize("most_named", [1000, 0])
def test_large_groups_give_the_same_rows(spark, tables, monkeypatch, name, most_named):
    query = getattr(catalog, name)
    whole = rows(query(tables, P))
    monkeypatch.setattr(slices, "CROWDED", 6)
    monkeypatch.setattr(slices, "_MOST_NAMED", most_named)
    cut = query(tables, P)
    assert rows(cut) == whole and "_size" in plan(cut)


def test_a_larger_feed_has_more_files(spark, monkeypatch, tmp_path):
    """No task writes or reads more of it, and it still takes two batches."""
    seen, batches = [], []
    write = kept.feed_files
    monkeypatch.setattr(slices, "RANGE_BYTES", 64)
    monkeypatch.setattr(kept, "feed_files", lambda feed, folder, files: (seen.append(files), write(feed, folder, files)))
    at = dt.datetime(2001, 7, 1)
    events = [{"id": f"b{i}", "harvested_qty": 1, "op": "upsert", "changed_at": at + dt.timedelta(days=i), "seq": str(i)} for i in range(60)]
    feed = frame(spark, f"id string, {kept.BATCH_COLUMNS}, op string, changed_at timestamp, seq string", events)
    feed.write.parquet(f"{tmp_path}/feed")
    (sums,) = kept.run_kept(spark.read.parquet(f"{tmp_path}/feed"), [kept.WASTE], after=lambda n, _: batches.append(n))
    assert seen[0] > 4 and len(batches) == 2 and [r["harvested"] for r in sums.collect()] == [60]


def test_figures_over_one_table_share_its_rows(spark, tmp_path):
    ddl = f"id string, {kept.ORDER_COLUMNS}, op string, changed_at timestamp, seq string"
    event = {"id": "o", "client_id": "c", "order_date": day("2001-07-01"), "total_revenue": 5, "op": "upsert", "changed_at": dt.datetime(2001, 7, 1), "seq": "1"}
    after = {}
    days, clients = kept.run_kept(frame(spark, ddl, [event, {**event, "seq": "2", "client_id": "d"}]), [kept.DAYS, kept.CLIENT_REVENUE], after=lambda n, k: after.update({f.figure.name: f for f in k}))
    assert after["client-revenue"].rows_of is after["days"]
    assert [(r["client_id"], r["revenue"]) for r in clients.collect()] == [("d", 5)] and [r["revenue"] for r in days.collect()] == [5]


def test_the_log_is_not_dealt_out_for_small_orders(spark, monkeypatch):
    kinds = ["update", "deduct", "set_amount", "mark_paid"]
    log = [{"action_id": f"a{i}", "order_id": f"o{i % 3}", "kind": kinds[i % 4], "changed_at": dt.datetime(2001, 7, 1 + i), "total_revenue": 90 + i, "waste_value": 2, "amount": 70 + i} for i in range(24)]
    orders = [{"id": f"o{i}", "total_revenue": 10, "net_profit": 1} for i in range(4)]
    payments = [{"id": f"p{i}", "order_id": f"o{i}", "amount": 10, "status": "pending"} for i in range(4)]
    t, dealt = Small(spark, orders=orders, payments=payments), []
    deal = order_log.dealt
    monkeypatch.setattr(order_log, "dealt", lambda *a: (dealt.append(1), deal(*a))[1])

    def run():
        done = order_log.apply_log(t.orders("id", *order_log.HEADER), t.payments("order_id", "amount", "due_date", "status", "paid_date"), frame(spark, order_log.ACTION, log))
        return rows(done.orders), rows(done.payments)

    whole = run()
    assert not dealt
    monkeypatch.setattr(slices, "CROWDED", 4)
    assert run() == whole and dealt


def test_lines_meet_their_order_once_for_price_changes(spark, tmp_path):
    """One scan of the lines, whatever the faults, and no text of an id made before the join."""
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    order = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    at = dt.datetime(2001, 7, 1)
    lines = [{"l_orderkey": 1, "l_partkey": 2, "l_suppkey": 3, "l_linenumber": n, "l_quantity": 2, "l_extendedprice": 10, "l_discount": 0, "l_tax": 0, "l_returnflag": "R" if n == 4 else "N", "l_linestatus": "O", "l_shipdate": at} for n in range(1, 7)]
    frame(spark, line, lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    frame(spark, order, [{"o_orderkey": 1, "o_custkey": 9, "o_orderstatus": "F", "o_totalprice": 1, "o_orderdate": at, "o_orderpriority": "x"}]).write.parquet(f"{tmp_path}/orders.parquet")
    changes = Testdata(spark, str(tmp_path)).price_changes()
    assert plan(changes).count("Scan parquet") == 2
    refused = quality.split_changes(changes, quality.price_rules())[1]
    assert changes.count() == 8 and sorted(r["failures"][0] for r in refused.collect()) == ["client_missing", "price_missing"]
