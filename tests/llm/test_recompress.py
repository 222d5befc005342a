"""Substring dedup against brute force."""

import hashlib
import random

import pytest

from packhouse.llm import recompress


def brute(docs, window=50):
    """{id: kept words}"""
    first = {}
    for k in sorted(k for k in docs if k is not None):
        w = (docs[k] or "").encode().split()
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), k)
    out = {}
    for k, t in docs.items():
        w = (t or "").encode().split()
        gone = set()
        if k is not None:
            for i in range(len(w) - window + 1):
                if first[tuple(w[i : i + window])] < k:
                    gone.update(range(i, i + window))
        out[k] = (len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())
    return out


def found(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()}


def words(draw, n, size):
    return " ".join(f"w{draw.randrange(size)}" for _ in range(n))


@pytest.mark.parametrize("size", [1, 2, 3, 5, 1000])
def test_random_passages(frame, size):
    """Alphabets down to one word: runs, periods, and passages in every place."""
    draw = random.Random(size)
    shared = [words(draw, n, size) for n in (20, 49, 50, 51, 75, 130)]
    docs = {}
    for k in range(40):
        parts = []
        for _ in range(draw.randrange(1, 5)):
            parts.append(draw.choice(shared) if draw.random() < 0.6 else words(draw, draw.randrange(1, 60), size))
        docs[k * 3 + 1] = draw.choice([" ", "\n", "\t "]).join(parts)
    assert found(recompress.deduplicate(frame(docs))) == brute(docs)


def test_periods_and_runs(frame):
    docs = {
        9: "a b c " * 60,
        4: "b c a " * 40 + "end",
        5: "x " * 200,
        6: "x " * 49,
        7: "x " * 50 + "y",
        8: "q " + "x " * 77 + "q " + "x " * 20,
        1: "a b " * 100,
        2: "b a " * 26,
    }
    assert found(recompress.deduplicate(frame(docs))) == brute(docs)


def test_near_copies_with_edits(frame):
    draw = random.Random(3)
    base = [f"v{draw.randrange(400)}" for _ in range(400)]
    docs = {}
    for k in range(60):
        own = list(base)
        for _ in range(k % 7):
            own[draw.randrange(len(own))] = f"edit{k}"
        docs[100 - k] = " ".join(own[: draw.randrange(200, 400)])
    assert found(recompress.deduplicate(frame(docs))) == brute(docs)


def test_odd_rows(spark, frame):
    long = " ".join(f"z{i % 977} {i}" for i in range(200_000))
    docs = {1: None, 2: "", 3: " \n\t ", 4: "é" * 5, 5: long, 6: "front " + long, None: long[:5000], 8: "one two"}
    assert found(recompress.deduplicate(frame(docs))) == brute(docs)
    assert recompress.deduplicate(frame({1: "a"}).limit(0)).count() == 0
    twice = recompress.deduplicate(frame([(1, "a b"), (1, "a b"), (2, "a b")])).collect()
    assert len(twice) == 3 and all(r["n_removed"] == 0 for r in twice)


def test_kept_text_and_columns(frame):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = recompress.deduplicate(frame({1: passage, 2: f"a\n{passage}  b", 3: "c\nd"}), keep=("lang", "spans", "anchor"), kept_text=True).collect()
    got = {r["doc_id"]: r for r in rows}
    assert got[2]["kept_text"] == "a b" and got[3]["kept_text"] == "c\nd" and got[1]["kept_text"] == passage
    assert got[2]["spans"] == "x" and got[2]["anchor"] == "extra"
