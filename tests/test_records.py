"""Ledger documents split by record, against the same documents read whole."""

import json
import random

import pytest

from packhouse.plans.documents import ledger_bad_documents, ledger_entries
from packhouse.sources import documents
from packhouse.sources.lake import Lake

NASTY = ["plain", "a } b", '} "quoted" {', "back\\slash", '\\"', "},{", "]", "[", "é 😀", "", "line\nbreak", '"}']


def entries(n, seed=0):
    pick = random.Random(seed)
    return [{"id": f"{seed}-{i}", "date": "2001-01-02", "type": "deposit", "amount": i + 0.5, "description": pick.choice(NASTY) * pick.randrange(3)} for i in range(n)]


GOOD = [json.dumps(entries(40, 1)), json.dumps(entries(25, 2), indent=2), "[]", json.dumps(entries(3, 3), ensure_ascii=False), "[ ]", json.dumps(entries(30, 4), indent=1)]
BAD = [json.dumps(entries(6, 7))[:-1], json.dumps(entries(6, 8))[:-30], "[1, 2]", json.dumps(entries(4, 9)).replace("},", "} ", 1), '[{"id": "x"', json.dumps(entries(2, 5)) + "]"]


def put(root, files):
    (root / "capital_ledger").mkdir(parents=True)
    for i, text in enumerate(files):
        (root / "capital_ledger" / f"f{i}.json").write_text(text, encoding="utf-8")
    return str(root)


def listed(df):
    return sorted((r["id"], float(r["amount"]), r["description"]) for r in df.collect())


def wanted(seeds):
    sizes = {1: 40, 2: 25, 3: 3, 4: 30}
    return sorted((e["id"], e["amount"], e["description"]) for s in seeds for e in entries(sizes[s], s))


@pytest.mark.parametrize("bytes_a_task", ["134217728", "37"])
@pytest.mark.parametrize("together", [True, False])
def test_any_split_gives_the_same(spark, tmp_path, together, bytes_a_task):
    """Good and bad documents in one file, or one each, over ranges that cut records anywhere."""
    docs = [d for pair in zip(GOOD, BAD) for d in pair]
    root = put(tmp_path, ["\n".join(docs) + "\n"] if together else docs)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_a_task)
    try:
        lake = Lake(spark, root)
        assert listed(ledger_entries(lake, None)) == wanted((1, 2, 3, 4))
        assert tuple(ledger_bad_documents(lake, None).first()) == (12, 6)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_document_is_read_by_many_tasks(spark, tmp_path):
    rows = entries(4000, 6)
    root = put(tmp_path, [json.dumps(rows)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = Lake(spark, root).ledger()
        assert listed(found) == sorted((e["id"], e["amount"], e["description"]) for e in rows)
        from packhouse.sources import records

        assert records.pieces(spark, f"{root}/capital_ledger").select("range_start").distinct().count() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_written_documents_are_read_again(spark, tmp_path):
    root = put(tmp_path, [json.dumps(entries(20, 1))])
    table = Lake(spark, root).ledger()
    documents.ledger_documents(table).write.text(str(tmp_path / "again" / "capital_ledger"))
    assert listed(Lake(spark, str(tmp_path / "again")).ledger()) == listed(table)
