"""Prefix trie: every column against a walk over the conversations' own prefixes."""

import hashlib
import random

import pytest

from packhouse.llm import queries, trie

ROWS = "conv_id long, turn long, role string, text string, key string, depth int, ends boolean"
COLS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, True) for r in rows], ROWS)


def brute(said):
    """said: {conv_id: [(role, text), ...]}"""
    members = {}
    for c, turns in said.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    out = {}
    for k in sorted(members, key=len, reverse=True):
        below = [out[x] for x in children.get(k, [])]
        own = (len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0)
        ends = ",".join(str(c) for c in sorted(c for c in members[k] if len(said[c]) == len(k)))
        out[k] = (
            min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(below),
            sum(x[5] for x in below) or 1, own + sum(x[6] for x in below), hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(out.values(), key=lambda r: (r[1], r[0], r[3]))


def turns_of(rows):
    said = {}
    for c, t, r, x in rows:
        if c is not None:
            said.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in said.items()}


def lent(said, every=5, most=9):
    import zlib

    out = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % most
        out[c] = said.get(c - c % every, [])[:h] + own[h:]
    return out


def listed(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=lambda r: (r[1], r[0], r[3]))


def plain(spark, rows, band):
    said = trie.turns(frame(spark, rows))
    steps = said.withColumnRenamed("place", "depth")
    return trie.summary(trie.Trie(steps, said.select("conv_id").distinct(), band))


def some(n, depth, seed, words=2):
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(pick.randrange(1, depth)):
            rows.append((c, t, pick.choice(["user", None, ""]), "é" * pick.randrange(words)))
    return rows


@pytest.mark.parametrize("band,depth", [(2, 40), (3, 12), (16, 5)])
def test_bands_against_brute_force(spark, band, depth):
    rows = some(30, depth, band) + [(100 + i, t, "user", "" if t < depth - 1 else str(i % 3)) for i in range(20) for t in range(depth)]
    assert listed(plain(spark, rows, band)) == brute(turns_of(rows))


def test_lent_heads(spark):
    rows = [r for r in some(60, 14, 7) if r[0] % 10 != 5]
    said = trie.turns(frame(spark, rows))
    steps, ids = trie.with_lent_heads(said)
    want = lent(turns_of(rows))
    assert min(len(v) for v in want.values()) == 0, "a conversation without turns is among them"
    assert listed(trie.summary(trie.Trie(steps, ids, 4))) == brute(want)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 2, "user", "x"), (1, 2, "user", "x"), (1, 2, "a", "y"), (2, None, "", ""), (None, 1, "user", "lost"), (-7, 0, "user", "x" * 300_000), (9, 5, "a", "y")]
    assert listed(plain(spark, rows, 2)) == brute(turns_of(rows))
    assert plain(spark, [(None, 1, "user", "lost")], 2).count() == 0
    assert plain(spark, [], 2).count() == 0


def test_boundaries_of_role_and_text(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc"), (4, 0, "1:a", ""), (5, 0, "1", ":a")]
    assert [r[3] for r in listed(plain(spark, rows, 16))] == [5, 1, 1, 1, 1, 1]


def test_hot_conversation_and_chunks(spark, monkeypatch):
    """One conversation of many blocks, and many conversations that end at one node in many chunks."""
    monkeypatch.setattr(trie, "_BLOCK", 7)
    rows = [(1, t, "user", str(t)) for t in range(60)] + [(c, 0, "user", "0") for c in range(2, 400)]
    want = brute(turns_of(rows))
    assert listed(plain(spark, rows, 4)) == want


def test_digest_of_chunks_in_one_stream():
    import pyarrow as pa

    ids = sorted(random.Random(1).sample(range(10**9), 30_000))
    rows = pa.RecordBatch.from_arrays([pa.array(["k"] * len(ids) + ["z"], pa.string()), pa.array([*ids, 5], pa.int64())], ["key", "conv_id"])
    chunks = list(trie._chunks(iter([rows])))
    assert len(chunks) > 4
    got = [r for b in trie._digests(iter(chunks)) for r in b.to_pylist()]
    assert got == [{"key": k, "ends_sha256": hashlib.sha256(t.encode()).hexdigest()} for k, t in (("k", ",".join(map(str, ids))), ("z", "5"))]


def test_query_of_lent_heads(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    said = turns_of((r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows)
    assert listed(queries.QUERIES["op13_prefix_trie"](spark, "/root/testdata/sf0.001")) == brute(lent(said))
