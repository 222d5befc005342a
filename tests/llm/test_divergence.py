"""Source divergence: both reports against whole-number arithmetic over every term."""

import random
import re
from collections import Counter
from itertools import islice, product

import pyarrow as pa
import pytest

from packhouse.llm import divergence

DOCS = "text string, lang string, source string, term string, n int, value string, doc_id long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "x", None) for r in rows], DOCS)


def brute(rows, least, top):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [((l or ""), (s or ""), re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate(low))) for t, l, s in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(w for _, _, ws in mine for w in set(ws))
        kept = [w for w, n in df.items() if n >= least]
        whole = Counter(w for _, _, ws in mine for w in ws)
        groups = {g: Counter(w for _, s, ws in mine if s == g for w in ws) for g in {d[1] for d in mine}}

        def p(counts):
            total = sum(counts[w] for w in kept)
            return {w: 1 + 10**9 * (counts[w] + 2) // (total + 2 * len(kept)) for w in kept}

        shares, q = {g: p(c) for g, c in groups.items()}, p(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for g in groups:
            pair = [(sum(f(shares[g][w], shares[h][w]) for w in kept), h) for h in groups if h != g]
            term = [(f(shares[g][w], q[w]), w) for w in kept if groups[g][w] and shares[g][w] > q[w]]
            for part, found in (("pair", pair), ("term", term)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, g, part, item, v, i) for i, (v, item) in enumerate(ranked, 1) if part == "pair" or i <= top]
    return sorted(out)


@pytest.mark.parametrize("least,top", [(3, 10), (1, 2), (10, 10)])
def test_against_every_term(spark, least, top):
    pick = random.Random(least)
    words = ["the", "The", "éa", "ÉA", "x1y", "a", "b", "c", "😀", "zz", "ab", "ß", "　w"] + [f"r{chr(97 + i)}" for i in range(20)]
    rows = [
        (" ".join(pick.choices(words, k=pick.randrange(40))), pick.choice(["en", "de", None]), pick.choice(["s", "s", "s", "t", "u", None, "é"]))
        for _ in range(150)
    ]
    rows += rows[:5] + [(None, "en", "empty"), ("", "fr", "only"), ("12 34", "fr", "other"), ("one", "it", "alone")]
    got = divergence.audit(frame(spark, rows), least, top)
    assert sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in got.collect()) == brute(rows, least, top)


def test_ties_are_cut_in_utf8_order(spark):
    """Twenty-six terms of one value: ten reach the report, by their bytes."""
    names = [chr(0x61 + i) * 2 for i in range(13)] + [chr(0xE0 + i) * 2 for i in range(13)]
    rows = [(" ".join(names + ["b"] * 30), "en", "s"), ("b " * 90, "en", "t")] * 3
    got = [r for r in divergence.audit(frame(spark, rows), 1).collect() if (r["source"], r["part"]) == ("s", "term")]
    assert [r["item"] for r in sorted(got, key=lambda r: r["rank"])] == sorted(names, key=str.encode)[:10]
    assert len({r["value"] for r in got}) == 1


def test_counts_beyond_64_bits_and_many_flushes(spark, monkeypatch):
    c = spark.sql("select 9000000000000000L as n, 27000000000000000L as total, 3000L as v")
    (got,) = c.select(divergence.share(c.n, c.total, c.v)).first()
    assert got == 1 + 10**9 * (9 * 10**15 + 2) // (27 * 10**15 + 6000)
    long = ("word Other " * 200_000).encode()
    assert divergence.terms(long) == {b"word": 200_000, b"other": 200_000}


def test_empty_table(spark):
    out = divergence.audit(frame(spark, []))
    assert out.count() == 0 and out.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_hot_source(spark):
    """A third of all rows in one source, of one text."""
    rows = [("hot words here and there", "en", "hot")] * 400 + [(f"cold words {chr(97 + i % 26)}{chr(97 + i // 26)}", "en", f"s{i % 40}") for i in range(600)]
    got = divergence.audit(frame(spark, rows), 10, 10)
    assert sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in got.collect()) == brute(rows, 10, 10)


def test_terms_of_a_task_are_handed_on_once():
    """Half a million terms, met again in a later batch, are rows once."""
    text = " ".join(map("".join, islice(product("abcdefghij", repeat=6), 500_000)))
    one = pa.RecordBatch.from_pylist([{"lang": "en", "source": "s", "text": text.encode()}])
    out = list(divergence._count(iter([one, one])))
    assert sum(b.num_rows for b in out) == 500_000
    assert {x for b in out for x in b.column(3).to_pylist()} == {x for b in out for x in b.column(4).to_pylist()} == {2}
