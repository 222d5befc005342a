"""Versions of the stored tables: published together or not at all, and pinned by readers."""

import pytest
from pyspark.sql import functions as F

from packhouse.plans import maintenance as m
from packhouse.plans import publish
from packhouse.plans.documents import ledger_entries
from packhouse.config import Params
from packhouse.sinks.snapshots import IncompleteVersion, PublishedMeanwhile, Snapshots
from packhouse.sources import documents
from packhouse.sources.lake import Lake
from packhouse.sources.testdata import Testdata
from small import day

SF = "/root/testdata/sf0.001"
P = Params(as_of=day("2001-08-01"))


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """The given tables, cut to some orders, as stored tables and documents."""
    t, root = Testdata(spark, SF), str(tmp_path_factory.mktemp("lake"))
    some = F.col("order_id").cast("long") < 60
    few = F.col("id").cast("long") < 60
    tables = {
        "orders": t.orders().filter(few), "order_items": t.order_items().filter(some), "payments": t.payments().filter(some),
        "clients": t.clients(), "products": t.products(), "inventory_batches": t.batches().filter(F.col("product_id").cast("long") < 9),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{root}/{name}")
    for part, rows in zip(("headers", "lines"), t.order_updates()):
        rows.filter((F.col("id") if part == "headers" else F.col("order_id")).cast("long") < 60).write.parquet(f"{root}/changes/order_update_{part}")
    forms = t.batch_forms().filter(F.expr("coalesce(try_cast(product_id AS LONG), 0) < 9")).withColumn("order_id", F.lit("7"))
    for name, rows in {"batch_forms": forms, "order_log": t.order_log().filter(some), "deleted_batches": t.deleted_batches()}.items():
        rows.write.parquet(f"{root}/changes/{name}")
    documents.waste_link_documents(t.waste_links().limit(5)).write.text(f"{root}/waste_links")
    return root


def rows(df):
    return sorted(map(str, df.collect()))


def test_readers_stay_at_their_version(spark, base):
    before = Lake(spark, base)
    assert before.manifest.version == 0
    was = rows(before.orders())
    done = publish.order_updates(before, P)
    after = Lake(spark, base)
    assert (done.version, after.manifest) == (before.manifest.version + 1, done)
    assert rows(before.orders()) == was != rows(after.orders())
    want = m.update_orders(before.orders(), before.order_items(), before.payments(), *before.order_updates(), before.clients("id", "type", "credit_days"), P)
    for got, wanted in zip((after.orders(), after.order_items(), after.payments()), want):
        assert got.count() == wanted.count()
    assert after.payments("amount").agg(F.sum("amount")).first() == want[2].agg(F.sum("amount")).first()
    # Tables that the job doesn't change stay where they are.
    assert set(done.tables) == {"orders", "order_items", "payments"} and rows(after.clients()) == rows(before.clients())
    assert rows(Lake(spark, base, 0).orders()) == was
    with pytest.raises(PublishedMeanwhile):
        publish.order_updates(before, P)
    assert Snapshots(spark, base).versions()[-1] == done.version


def test_a_job_that_stops_between_tables_changes_nothing(spark, base, monkeypatch):
    lake = Lake(spark, base)
    was = rows(lake.payments())
    store = Snapshots(spark, base)
    broken = lake.payments().withColumn("amount", F.raise_error(F.lit("stopped")).cast("decimal(18,2)"))
    with pytest.raises(Exception, match="stopped"):
        store.publish({"orders": lake.orders().limit(1), "payments": broken}, lake.manifest)
    again = Lake(spark, base)
    assert again.manifest == lake.manifest and rows(again.payments()) == was and again.orders().count() > 1
    with pytest.raises(IncompleteVersion):
        Lake(spark, base, lake.manifest.version + 1)


def test_intake_is_published_with_its_links(spark, base):
    lake = Lake(spark, base)
    want = m.take_in(lake, lake.batch_forms(), lake.batches(), lake.orders(), lake.payments())
    publish.intake(lake, P)
    after = Lake(spark, base)
    assert rows(after.waste_links()) == rows(want.links) and after.waste_links().count() > lake.waste_links().count()
    assert after.batches().count() == want.batches.count() > lake.batches().count()
    taken = [x.orders("id", "net_profit").filter("id = '7'").first()["net_profit"] for x in (lake, after)]
    assert taken[0] > taken[1]
    publish.batch_deletes(after, P)
    assert Lake(spark, base).batches().count() < after.batches().count()


def test_a_log_is_applied_once(spark, base):
    publish.order_log(Lake(spark, base), P)
    once = Lake(spark, base)
    publish.order_log(once, P)
    twice = Lake(spark, base)
    assert twice.manifest.version == once.manifest.version + 1
    assert rows(twice.orders()) == rows(once.orders()) and rows(twice.payments()) == rows(once.payments())


def test_documents_are_read_as_they_were_written(spark):
    t = Testdata(spark, SF)
    settings = documents.resolved_settings(t.settings_documents())
    assert rows(documents.resolved_settings(documents.settings_documents(settings)).select("owner", "overhead_pct", "labor_pct")) == rows(settings)
    assert rows(documents.margins(documents.margin_documents(t.margins()))) == rows(t.margins())
    variants = t.variants().withColumn("position", F.col("position").cast("int"))
    assert rows(documents.variants(documents.variant_documents(variants))) == rows(variants)
    ledger = t.ledger().limit(500)
    assert rows(documents.ledger(documents.ledger_documents(ledger))) == rows(ledger)
    assert rows(documents.waste_links(documents.waste_link_documents(t.waste_links()))) == rows(t.waste_links())


def test_settings_are_saved_whole(spark):
    docs = spark.createDataFrame([("a", '{"overhead_pct": 1, "labor_pct": 2}'), ("b", None), ("c", "{")], "owner string, doc string")
    changes = spark.createDataFrame(
        [("a", '{"labor_pct": 5}', 2, 1), ("a", '{"overhead_pct": 9}', 1, 1), ("a", None, 3, 1), ("b", '{"overhead_pct": 3}', 1, 1), ("d", "[", 1, 1), ("c", "{}", 1, 2)],
        "owner string, doc string, changed_at long, seq long",
    )
    got = {r["owner"]: (r["overhead_pct"], r["labor_pct"]) for r in documents.resolved_settings(documents.saved_settings(docs, changes)).collect()}
    assert got == {"a": (0.0, 5.0), "b": (3.0, 0.0), "c": (0.0, 0.0), "d": (15.0, 0.0)}
