"""Fingerprints, their neighbours, and the order of rows."""

import random

import pyarrow as pa

from packhouse.llm import neighbours, simhash


def prints(texts):
    return [x.hex() for x in simhash.of_column(pa.array(texts))]


def test_fingerprints(frame):
    draw = random.Random(4)
    texts = [" ".join(f"w{draw.randrange(900)}" for _ in range(120)) for _ in range(40)]
    docs = dict(enumerate(texts + [texts[0], None, "", " \n"]))
    got = {r["doc_id"]: r["fingerprint"] for r in simhash.fingerprints(frame(docs)).collect()}
    assert [got[k] for k in docs] == prints(list(docs.values()))
    assert got[40] == got[0] and got[41] == got[42] == got[43] == "0" * (simhash.BITS // 4)
    half = bytes.fromhex(prints([" ".join(texts[1].split()[:80] + texts[2].split()[:40])])[0])
    assert simhash.likeness(bytes.fromhex(got[1]), half) > 0.62
    assert all(0.3 < simhash.likeness(bytes.fromhex(got[a]), bytes.fromhex(got[a + 1])) < 0.7 for a in range(38))
    long = simhash.fingerprints(frame({1: "a b c " * 500_000})).collect()
    assert len(long) == 1


def test_within_finds_all(spark):
    draw = random.Random(6)
    values = [draw.getrandbits(simhash.BITS) for _ in range(60)]
    for v in list(values):
        for flips in (1, 3, 5):
            x = v
            for b in draw.sample(range(simhash.BITS), flips):
                x ^= 1 << b
            values.append(x)
    shown = [f"{v:0{simhash.BITS // 4}x}" for v in values]
    rows = [(i, x, "clash") for i, x in enumerate(shown + shown[:5])] + [(999, None, "clash")]
    got = simhash.within(spark.createDataFrame(rows, "doc_id long, fingerprint string, bits string"), 4).collect()
    want = {(a, b, bin(int(a, 16) ^ int(b, 16)).count("1")) for a in shown for b in shown if a < b}
    assert {(r["left"], r["right"], r["bits"]) for r in got} == {x for x in want if x[2] <= 4}
    assert len(got) == len({(r["left"], r["right"]) for r in got})


def test_order(frame):
    docs = {k: f"text {k}" for k in random.Random(1).sample(range(-500, 10**15), 200)}
    rows = neighbours.in_order(frame(docs))
    got = {}
    for keys, texts, nexts in neighbours.pairs(iter(rows.coalesce(1).toArrow().to_batches())):
        got |= {k: (t, n) for k, t, n in zip(keys, texts, nexts)}
    ids = sorted(docs, reverse=True)
    assert got == {k: (docs[k], docs[ids[(i + 1) % len(ids)]]) for i, k in enumerate(ids)}


def test_order_of_odd_rows(frame):
    def run(rows):
        out = neighbours.in_order(frame(rows)).coalesce(1).toArrow().to_batches()
        return [x for keys, texts, nexts in neighbours.pairs(iter(out)) for x in zip(keys, texts, nexts)]

    assert run([(3, "a")]) == [(3, "a", "a")]
    assert sorted(run([(3, "a"), (3, "a"), (None, None)]), key=str) == sorted([(3, "a", "a"), (3, "a", ""), (None, "", "a")], key=str)
    assert neighbours.in_order(frame({1: "a"}).limit(0)).count() == 0
