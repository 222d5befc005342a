"""Packing: every id in one piece, little padding, retrieval by BM25."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from packhouse.llm import packing, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_the_library(tokenizer):
    draw = random.Random(0)
    texts = ["", " ", "A<|ENDOFTEXT|> b <|endoftext|>c's don't x\x1cy", "İI ÀB é ﬁ 漢字 Ωmega x\x85y", "😀😀 ÉCOLE ß ſ", "x" * 5000]
    texts += ["".join(draw.choice("aB'sé .,!1\n\tÉ<|>") for _ in range(60)) for _ in range(200)]
    found = tokens.word_ids(PATH).encode([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u2").tolist() for x in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_tile_documents_and_sequences(frame, tokenizer):
    draw = random.Random(1)
    docs = {k: " ".join(f"word{draw.randrange(500)}" for _ in range(draw.choice([0, 3, 60, 300, 900]))) for k in range(120)}
    docs |= {500: None, 501: "", 502: "the cat sat " * 20_000}
    s = packing.Settings(window=512, shard_docs=32)
    rows = packing.pack(frame(docs), PATH, s, ids=True).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(docs)
    for k, t in docs.items():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(by_doc[k], key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], "<u4")
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(part.tobytes())
            assert np.frombuffer(r["ids"], "<u2").tolist() == part.tolist()
            at += r["length"]
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 512 and at & (at - 1) == 0


def test_scores_are_bm25():
    draw = random.Random(2)
    docs = [np.array([draw.randrange(40) for _ in range(draw.randrange(1, 60))], "<u2") for _ in range(30)]
    s = packing.Settings()
    index = packing.Index(docs, s)
    mean = sum(map(len, docs)) / len(docs)
    counts = [Counter(d.tolist()) for d in docs]
    df = Counter(t for c in counts for t in c)
    for seed in range(30):
        want = []
        for d, c in zip(docs, counts):
            total = 0.0
            for t in counts[seed]:
                if t in c:
                    idf = math.log(1 + (30 - df[t] + 0.5) / (df[t] + 0.5))
                    total += idf * c[t] * (s.k1 + 1) / (c[t] + s.k1 * (1 - s.b + s.b * len(d) / mean))
            want.append(total)
        assert np.allclose(index.scores(seed), want)


def test_neighbours_share_windows():
    """Documents of one subject meet in a window."""
    draw = random.Random(3)
    docs = [np.array([1000 * (i % 4) + draw.randrange(50) for _ in range(100)], "<u2") for i in range(40)]
    placed = packing.order(docs, packing.Settings(window=1000))
    assert sorted(placed) == list(range(40))
    assert all(len({i % 4 for i in placed[at : at + 10]}) == 1 for at in range(0, 40, 10))


def test_repeated_rows_and_empty_table(frame):
    rows = packing.pack(frame([(1, "a b"), (1, "a b"), (None, "c")]), PATH).collect()
    assert Counter(r["doc_id"] for r in rows if r["start"] == 0) == {1: 2, None: 1}
    assert packing.pack(frame({1: "a"}).limit(0), PATH).count() == 0


def test_rows_of_one_key_spread_over_shards(frame):
    """Different texts of a null or repeated key don't meet in one shard."""
    rows = [(k, f"text number {i} of many") for k in (None, 7) for i in range(400)]
    got = packing.pack(frame(rows), PATH, packing.Settings(shard_docs=20)).where("start = 0").collect()
    assert Counter(r["doc_id"] for r in got) == {None: 400, 7: 400}
    sizes = Counter(r["sequence_id"] >> 32 for r in got)
    assert len(sizes) > 30 and max(sizes.values()) <= 60, sizes
