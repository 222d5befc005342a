"""Sources, documents and sinks."""

import datetime as dt
from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from packhouse.config import Params, Settings
from packhouse.plans import analytics, catalog, pricing
from packhouse.session import RUNTIME_DEFAULTS, size_shuffles, work_dir
from packhouse.sinks import exports
from packhouse.sources import documents
from packhouse.sources.lake import Lake
from packhouse.sources.schemas import SchemaMismatch, TABLES, checked
from packhouse.sources.testdata import Testdata

SF = "/root/testdata/sf0.001"
P = Params(as_of=dt.date(2001, 8, 1))


def docs(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "doc string")


def test_settings_documents(spark):
    texts = ['{"overhead_pct": 20, "labor_pct": 5}', '{"overhead_pct": 20}', "{}", "{oops", "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, doc string")
    got = {r.n: (r.overhead_pct, r.labor_pct) for r in documents.resolved_settings(frame).collect()}
    assert got == {0: (20.0, 5.0), 1: (20.0, 0.0), 2: (0.0, 0.0), 3: (15.0, 0.0), 4: (15.0, 0.0), 5: (15.0, 0.0)}


def test_map_documents(spark):
    assert sorted(map(tuple, documents.margins(docs(spark, '{"a": 5, "b": 7.5}', "{bad", None)).collect())) == [("a", 5.0), ("b", 7.5)]
    rows = documents.variants(docs(spark, '{"a": [{"weight": 0.5, "price": 3}, {"weight": 1, "price": 5}], "b": []}')).collect()
    assert [tuple(r) for r in rows] == [("a", 0, 0.5, 3.0), ("a", 1, 1.0, 5.0)]
    links = documents.waste_links(docs(spark, '{"b1": {"clientId": "c", "clientName": "Nile", "orderId": "o", "orderLabel": "x"}}')).collect()
    assert [tuple(r) for r in links] == [("b1", "c", "Nile", "o", "x")]


def test_ledger_documents(spark):
    good = '[{"id": "1", "date": "2001-01-02", "type": "deposit", "amount": 2.5, "description": "x"}]'
    frame = docs(spark, good, "[{", None)
    entry = documents.ledger(frame).collect()
    assert len(entry) == 1 and str(entry[0].date) == "2001-01-02" and float(entry[0].amount) == 2.5
    assert documents.unreadable(frame, documents.LEDGER).count() == 1


def test_schema_is_checked(spark):
    good = Testdata(spark, SF).clients()
    assert checked(good, "clients").columns == [c.split()[0] for c in TABLES["clients"].split(", ")]
    with pytest.raises(SchemaMismatch, match="credit_days"):
        checked(good.withColumn("credit_days", F.col("credit_days").cast("string")), "clients")
    with pytest.raises(SchemaMismatch, match="phone"):
        checked(good.drop("phone"), "clients")


def test_stored_tables_give_the_same_reports(spark, tmp_path):
    """The given tables written as business tables and documents, and read back."""
    t = Testdata(spark, SF)
    tables = {
        "clients": t.clients(), "products": t.products(), "orders": t.orders(), "order_items": t.order_items(),
        "payments": t.payments().withColumn("created_at", F.lit(None).cast("timestamp")), "client_pricing": t.client_pricing(),
    }
    base = exports.write_snapshot(tables, str(tmp_path), "1")
    assert exports.snapshot_is_complete(spark, base, list(tables))
    assert not exports.snapshot_is_complete(spark, base, ["nothing"])
    t.margin_documents().select("doc").write.text(f"{base}/product_margins")
    t.variant_documents().select("doc").write.text(f"{base}/weight_variants")
    # A document over several lines.
    docs(spark, '{\n  "overhead_pct": 15\n}').write.text(f"{base}/pricing_settings_doc")
    t.product_changes().write.parquet(f"{base}/changes/product_changes")
    lake = Lake(spark, base)
    for plan in (analytics.product_performance, catalog.receivables_aging, pricing.price_list_export):
        assert sorted(map(str, plan(lake, P).collect())) == sorted(map(str, plan(t, P).collect()))
    # Other settings change every price.
    docs(spark, '{"overhead_pct": 50, "labor_pct": 5}').coalesce(1).write.mode("overwrite").text(f"{base}/pricing_settings_doc")
    given = replace(P, settings=Settings(50.0, 5.0))
    for plan in (pricing.suggested_price, pricing.pack_cost, pricing.price_list_export, analytics.price_suggestions):
        saved = sorted(map(str, plan(lake, P).collect()))
        assert saved == sorted(map(str, plan(t, given).collect())) != sorted(map(str, plan(t, P).collect()))
    assert lake.product_changes().count() == t.product_changes().count()
    with pytest.raises(AttributeError):
        lake.nonsense


def test_pushdown_reaches_the_scan(spark, tmp_path):
    Testdata(spark, SF).orders().write.parquet(str(tmp_path / "orders"))
    week = Lake(spark, str(tmp_path)).orders("id", "order_date").filter(F.col("order_date") >= dt.date(2001, 7, 25))
    plan = week._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_date,2001-07-25)" in plan
    assert "ReadSchema: struct<id:string,order_date:date>" in plan


def test_price_list_files(spark, tmp_path):
    rows = pricing.price_list_export(Testdata(spark, SF), P)
    path = exports.write_price_list(rows, str(tmp_path), P.as_of)
    assert path.endswith("export_date=2001-08-01")
    back = spark.read.csv(path, header=True)
    assert back.columns == list(exports.PRICE_LIST_HEADINGS.values()) and back.count() == rows.count()
    again = exports.write_price_list(rows, str(tmp_path / "p"), P.as_of, "parquet")
    assert spark.read.parquet(again).columns == list(exports.PRICE_LIST_HEADINGS)
    with pytest.raises(ValueError):
        exports.write_price_list(rows, str(tmp_path), P.as_of, "xlsx")


def test_documents_by_delivery_date(spark, tmp_path):
    from packhouse.plans import orders

    lines = orders.invoice_lines(Testdata(spark, SF), P)
    exports.write_by_delivery_date(lines, str(tmp_path / "invoices"))
    back = spark.read.parquet(str(tmp_path / "invoices"))
    assert back.count() == lines.count()
    one = back.filter(F.col("delivery_date") == dt.date(2001, 8, 1))
    assert "PartitionFilters: [isnotnull(delivery_date" in one._jdf.queryExecution().executedPlan().toString()


def cluster(master, settings):
    """Stands in for a session on a cluster."""
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_work_dir_is_the_shared_folder(spark):
    shared = {"spark.checkpoint.dir": "hdfs://shared/checkpoints/"}
    one, two = (work_dir(cluster("yarn", shared), "x") for _ in range(2))
    assert one.startswith("hdfs://shared/checkpoints/packhouse/x-") and one != two
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(cluster("yarn", {}), "x")


def test_every_default_can_be_set_on_a_running_session(spark):
    assert [k for k in RUNTIME_DEFAULTS if not spark.conf.isModifiable(k)] == []


def test_shuffles_grow_with_the_data(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        size_shuffles(spark, 100 * 10**12)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) > 700_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
