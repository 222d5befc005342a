"""Near duplicates against brute force."""

import random

import pyarrow as pa

from packhouse.llm import graph, minmax
from packhouse.llm.work import Work

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets(docs, n):
    out = {}
    for k, t in docs.items():
        w = (t or "").translate(LOWER).encode().split()
        out[k] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    return out


def brute(docs, s):
    have = sets(docs, s.shingle)
    root = {k: k for k in docs}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(docs)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if have[a] and have[b]:
                both = len(have[a] & have[b])
                if 100 * both >= s.percent * (len(have[a]) + len(have[b]) - both):
                    x, y = sorted((top(a), top(b)))
                    root[y] = x
    return {k: (len(have[k]), top(k), top(k) == k) for k in docs}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_groups_and_chains(frame):
    """Copies of copies: a chain whose ends aren't linked, and groups whose members aren't all linked with the first."""
    draw = random.Random(1)
    docs, k = {}, 1000
    for group in range(6):
        text = [f"g{group}w{i}" for i in range(120)]
        own = list(text)
        for step in range(12):
            if group % 2:
                own = list(text)
            for _ in range(draw.randrange(1, 5)):
                own[draw.randrange(len(own))] = f"e{draw.randrange(10**6)}"
            docs[k] = " ".join(own).title() if step % 3 else " ".join(own)
            k -= draw.randrange(1, 4)
    for s in (minmax.Settings(shingle=3, percent=85), minmax.Settings()):
        assert found(minmax.near_duplicates(frame(docs), s)) == brute(docs, s)


def test_star_whose_center_is_not_the_first(frame):
    """Documents linked only through one that isn't the least of their bucket."""
    base = [f"b{i}" for i in range(200)]
    docs = {50: " ".join(base)}
    for k in range(12):
        own = list(base)
        for j in range(5):
            own[(k * 15 + j * 3) % 200] = f"x{k}_{j}"
        docs[k] = " ".join(own)
    s = minmax.Settings(shingle=3, percent=85)
    want = brute(docs, s)
    assert len({v[1] for v in want.values()}) == 1
    assert found(minmax.near_duplicates(frame(docs), s)) == want


def test_links_that_no_pivot_sees(spark, monkeypatch):
    """A crowd under one pivot, of more than a block of entries outside of its largest component: links come from the blocks alone."""
    monkeypatch.setattr(minmax, "BLOCK", 4)
    draw = random.Random(3)
    base = [f"b{i}" for i in range(150)]
    docs = {}
    for k in range(90):
        own = list(base)
        for j in range(draw.choice((0, 1, 3, 6, 9))):
            own[draw.randrange(150)] = f"x{k}_{j}"
        docs[k] = " ".join(own)
        if k % 3 == 0:
            own[draw.randrange(150)] = f"y{k}"
            docs[100 + k] = " ".join(own)
    s = minmax.Settings(shingle=3, percent=85)
    want = {k: v[1] for k, v in brute(docs, s).items()}
    assert len(set(want.values())) > 10
    batch = pa.RecordBatch.from_pydict({"id": list(docs), "text": list(docs.values())})
    marks = {r["doc_id"]: [r[m] for m in minmax.MARKS] for b in minmax._signatures([batch], s) for r in b.to_pylist()}
    sets = spark.createDataFrame([(r["id"], bytearray(r["members"])) for b in minmax._sets([batch], s) for r in b.to_pylist()], "id long, members binary")
    # The first has nothing joined yet; in the second, most of the largest component is.
    big = max(set(want.values()), key=list(want.values()).count)
    joined = {k: big for k in docs if want[k] == big and k % 5}
    for known in ({}, joined):
        rest = [(0, k, *marks[k], known.get(k, k)) for k in docs]
        rest = spark.createDataFrame(rest, "pivot long, id long, m0 long, m1 long, m2 long, m3 long, root long")
        work = Work(spark, "test")
        out = minmax._finish(rest, lambda ids: sets.join(ids, "id", "left_semi"), s, work)
        edges = [(r["a"], r["b"]) for r in out.collect()]
        assert edges
        more = spark.createDataFrame(edges + list(known.items()), "a long, b long")
        got = {k: k for k in docs} | {r["id"]: r["root"] for r in graph.components(more, work).collect()}
        assert got == want


def test_odd_rows(frame):
    long = " ".join(f"z{i}" for i in range(150_000))
    docs = {1: None, 2: "", 3: " \n ", 4: "one", 5: "ONE", 6: "one two", 7: "one two three", 8: long, 9: long + " tail", 10: "É x y", 11: "é x y", 12: "two one"}
    s = minmax.Settings(shingle=3, percent=85)
    assert found(minmax.near_duplicates(frame(docs), s)) == brute(docs, s)
    rows = minmax.near_duplicates(frame([(1, "a b c"), (1, "a b c"), (2, "a b c"), (None, "a b c")]), s).collect()
    assert len(rows) == 4
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in rows if r["doc_id"]) == [(1, 1, True), (1, 1, True), (2, 1, False)]
    assert minmax.near_duplicates(frame({1: "a"}).limit(0), s).count() == 0


def test_components(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(draw.randrange(100, 200), draw.randrange(100, 200)) for _ in range(60)] + [(300, x) for x in range(301, 400)]
    root = {}

    def top(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    got = graph.components(spark.createDataFrame(edges, "a long, b long"), Work(spark, "test"))
    rows = {r["id"]: r["root"] for r in got.collect()}
    assert rows == {k: top(k) for a, b in edges if a != b for k in (a, b)}
    assert graph.components(spark.createDataFrame([], "a long, b long"), Work(spark, "test")).count() == 0
