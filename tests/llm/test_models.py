"""Held-out accuracy and odd rows of the two classifiers."""

import random
import tracemalloc
from collections import Counter
from dataclasses import replace
from itertools import pairwise
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from packhouse.llm import embedding, queries, text, toxicity

SF = "/root/testdata/sf0.01"


def accuracy(spark, query, column, only=None):
    labels = {r["doc_id"]: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.QUERIES[query](spark, SF).collect()
    folds = {"quality": (3, 1), "toxic": (4, 2)}[column]
    for r in rows:
        assert r["held_out"] == (toxicity.fold(r["doc_id"], folds[0]) == folds[1]) and 0 <= r["score"] <= 1
    told = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    return sum(a == b for a, b in told) / len(told)


def test_quality(spark):
    assert accuracy(spark, "op4_quality_classifier", "quality") >= 0.97


def test_quality_holds_a_part_of_a_batch():
    """Buckets of a batch of 1.8 MB take a few MB at a time."""
    draw = random.Random(1)
    words = ["".join(draw.choices("abcdefghij", k=5)) for _ in range(500)]
    texts = pa.array([" ".join(draw.choices(words, k=300)) for _ in range(1000)])
    s = embedding.Settings()
    assert sum(n for _, _, n in embedding._features(texts.slice(0, 10), s)) == 10
    tracemalloc.start()
    try:
        assert sum(n for _, _, n in embedding._features(texts, s)) == 1000
        assert tracemalloc.get_traced_memory()[1] < 40e6
    finally:
        tracemalloc.stop()


def test_toxicity_of_few_labels(spark):
    assert accuracy(spark, "op10_toxicity", "toxic") >= 0.9


def test_toxic_words_in_new_company(spark, frame):
    """Words seen with many neighbours count; a copied text's rare words don't."""
    draw = random.Random(8)
    plain = lambda n: [f"w{int(draw.paretovariate(0.6)) % 3000}" for _ in range(n)]
    bad, copied = ["vile", "nasty"], " ".join(f"rare{i}" for i in range(40))
    rows = []
    for i in range(400):
        w = plain(60)
        if i % 4 == 0:
            for _ in range(3):
                w.insert(draw.randrange(60), draw.choice(bad).title())
        rows.append((" ".join(w), int(i % 4 == 0)))
    rows += [(f"{copied} vile", 1)] * 10
    model = toxicity.fit(spark.createDataFrame(rows, "text string, label int"))
    docs = {1: "a VILE, w3 w5", 2: " ".join(plain(300)), 3: None, 4: "", 5: f"w1 {copied} w2", 6: "w1 " * 300_000 + "nasty"}
    got = {r["doc_id"]: r["score"] for r in toxicity.score(frame(docs), model).collect()}
    assert got[1] > 0.8 and got[6] > 0.8 and max(got[k] for k in (3, 4, 5)) < 0.3 and got[3] == got[4], got
    assert got[2] < min(got[1], got[6])


def test_no_word_is_cut_from_the_model(spark, frame):
    """Very many rare words of toxic texts, all above a frequent one by ratio, leave it in the model, sent or joined."""
    draw = random.Random(9)
    rare = [f"r{i}" for i in range(66_000)]
    rows = []
    for label, pool, every in ((1, rare, 500), (0, [f"o{i % 3000}" for i in range(66_000)], 2000)):
        for _ in range(4):
            w = draw.sample(pool, len(pool))
            w = [x for i, y in enumerate(w) for x in ((y, "vile") if i % every == 0 else (y,))]
            rows += [(" ".join(w[i : i + 500]), label) for i in range(0, len(w), 500)]
    rows = spark.createDataFrame(rows, "text string, label int").repartition(4)
    docs = frame([(1, "a VILE o1"), (2, None), (3, "r7 o2"), (None, "vile r5"), (None, "vile r5"), (4, "o1 o2")])
    got = []
    for s in (toxicity.Settings(), toxicity.Settings(small=100)):
        out = toxicity.score(docs, toxicity.fit(rows, s)).collect()
        got.append(sorted((r["doc_id"] or 0, round(r["score"], 5), round(r["ratio"], 9)) for r in out))
    ratio = {k: r for k, _, r in got[0]}
    assert got[0] == got[1] and len(got[0]) == 6
    assert ratio[3] == ratio[0] > ratio[1] > 0 == ratio[2] == ratio[4], got[0]


def test_pair_of_ordinary_words(spark, frame):
    """Words that both classes have, toxic only side by side, are told by the bigram; sent and joined models agree."""
    draw = random.Random(10)
    rows = []
    for i in range(600):
        w = [f"w{draw.randrange(200)}" for _ in range(20)]
        at = draw.randrange(20)
        w[at:at] = ["green", "snake"] if i % 5 == 0 else ["green"]
        rows.append((" ".join(w if i % 5 == 0 else [*w, "w0", "snake"]), int(i % 5 == 0)))
    docs = frame([(1, "w3 w5 green snake w9 w11 w4"), (2, "w3 w5 snake green w9 w11 w4"), (3, "green w1 w2 w8 snake w1 w6")])
    got = []
    for s in (toxicity.Settings(), toxicity.Settings(small=100)):
        model = toxicity.fit(spark.createDataFrame(rows, "text string, label int"), s)
        assert (model.table is None) == (s.small > 100)
        got.append({r["doc_id"]: (r["score"], r["mean"], r["peak"]) for r in toxicity.score(docs, model).collect()})
    assert all(abs(x - y) < 1e-5 for k in got[0] for x, y in zip(got[0][k], got[1][k], strict=True)), got
    assert got[0][1][0] >= 0.3 > max(got[0][k][0] for k in (2, 3)), got[0]


def test_likelihoods_by_hand(spark):
    """A text's number is the difference of its log-likelihoods under two whole models, by its words; copies count once."""
    toxic, plain = ["a b c a b", "b c d", "e a b e"], ["a c b a", "c d f c", "b a f", "d d a c b"]
    rows = spark.createDataFrame([(x, 1) for x in toxic + toxic[:1] * 5] + [(x, 0) for x in plain], "text string, label int")
    d = 0.75
    pairs = [Counter(p for x in texts for p in set(pairwise(x.split()))) for texts in (plain, toxic)]
    known = set(pairs[1])
    follows = [Counter(w for _, w in c) for c in pairs]
    total = [sum(c.values()) for c in follows]
    less = lambda n: max(n - d, 0)

    def q(k, w):
        free = 1 - sum(less(follows[k][x]) for x in follows[1]) / total[k]
        return (less(follows[k][w]) if w in follows[1] else 0) / total[k] + free * sum(c[w] for c in follows) / sum(total)

    def p(k, h, w):
        n = [sum(v for (x, _), v in c.items() if x == h) for c in pairs]
        own = {x: less(pairs[k][h, x]) / n[k] if n[k] else 0 for g, x in known if g == h}
        both = {x: less(pairs[0][h, x] + pairs[1][h, x]) / sum(n) for g, x in known if g == h}
        rest = 1 - sum(own.values())
        return own.get(w, 0) + rest * (both.get(w, 0) / 2 + (1 - sum(both.values()) / 2) * q(k, w))

    for k in (0, 1):
        for h in "abce":
            assert abs(sum(p(k, h, w) for w in {*follows[0], *follows[1]}) - 1) < 1e-9
    s = toxicity.Settings(held=1 << 60)
    model = toxicity.fit(rows, s)
    for x in [*toxic, *plain, "c c c a", "d e"]:
        w = x.split()
        places = [log(q(1, w[0]) / q(0, w[0]))] + [log(p(1, *g) / p(0, *g)) for g in pairwise(w)]
        got = toxicity._rate(pa.array([x]), model)[0]
        assert abs(got[1] - sum(places) / len(w)) < 1e-5, x


def test_search_in_a_large_model():
    """A name is found next to the place its first bits lead to, however many names there are; what isn't there is not found."""
    for n in (0, 1, 2, 1000, 300_000):
        names = np.unique(np.append(text.seeds(n, 5), np.array([0, 2**64 - 1], np.uint64)[:n]))
        asked = np.concatenate([names[::-1], names + np.uint64(1), text.seeds(2000, 6), np.zeros(1, np.uint64), ~np.zeros(1, np.uint64)])
        index = toxicity._Index.of(names)
        there, at = index.find(asked)
        assert np.array_equal(there, np.flatnonzero(np.isin(asked, names))) and np.array_equal(names[at], asked[there])
        assert np.diff(index.first, append=n).max() <= 12


def test_joined_model_by_blocks(spark, frame):
    """A block asks for each of its names once, not once a text; joined and sent models give the same numbers to the last bit."""
    batch = pa.RecordBatch.from_arrays([pa.array(["a b c", None, "A b", ""] * 50), pa.array([7] * 100 + [8] * 100)], ["text", "block"])
    got = [tuple(r.values()) for b in toxicity._named(iter([batch])) for r in b.to_pylist()]
    assert len(got) == len(set(got)) == 2 * (3 + 3 + 2)
    draw = random.Random(11)
    rows = [(" ".join(f"w{draw.randrange(80) + 20 * (i % 4 == 0)}" for _ in range(30)), int(i % 4 == 0)) for i in range(400)]
    texts = [x for x, _ in rows[:40]] * 3 + [None, "", "nothing known here", "w3 " * 9000]
    docs = frame(list(enumerate(texts))).repartition(3)
    model = toxicity.fit(spark.createDataFrame(rows, "text string, label int"))
    none = toxicity.Grams.none()
    table = toxicity._as_rows(spark, model.grams).unionByName(
        spark.createDataFrame([(int(x), float(y)) for x, y in zip(text.as_long(model.name ^ np.uint64(toxicity._TAIL)), model.ratio, strict=True)], "name long, ratio double"), allowMissingColumns=True
    ).groupBy("name").agg(*[F.coalesce(F.max(x), F.lit(0.0)).alias(x) for x in ("delta", "peak", "ratio")])
    joined = replace(model, grams=replace(none, each=model.grams.each), name=none.name, table=table)
    sent, asked = (sorted(map(tuple, toxicity.score(docs, m).collect())) for m in (model, joined))
    assert len(model.grams.name) and len(sent) == len(texts) and sent == asked


def test_without_labels(spark, frame):
    none = spark.createDataFrame([], "text string, label int")
    docs = frame([(1, "a b"), (1, "a b"), (None, None), (2, "x " * 400_000)])
    model = toxicity.fit(none)
    assert [r["score"] for r in toxicity.score(docs, model).collect()] == [0.5] * 4
    assert toxicity.score(docs.limit(0), model).count() == 0
    one = toxicity.fit(spark.createDataFrame([("a b", 1), ("c", 1)], "text string, label int"))
    assert all(r["score"] > 0.5 for r in toxicity.score(docs, one).collect())
    model = embedding.fit(none)
    assert [r[1] for r in embedding.score(docs, model).collect()] == [0.5] * 4
    assert embedding.score(docs.limit(0), model).count() == 0


def test_sample_is_bounded(spark, frame):
    docs = frame({k: f"text {k}" for k in range(60)})
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(None, 1), (7, None), (8, 5)], "doc_id long, quality int")
    rows = embedding.sample(docs, labels, "quality", embedding.Settings(sample=10)).collect()
    assert sorted(r["label"] for r in rows) == [0] * 10 + [1] * 10
