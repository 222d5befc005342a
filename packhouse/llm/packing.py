"""Lexical retrieval packing: neighbours of a seed document fill its window.

Texts are tokenized whole and end with an end id.  Whole windows of a long
document are sequences of their own; what is left of each document goes to a
shard, by a hash of its key and ids, of about ``shard_docs`` documents.  In a shard, a
BM25 inverted index over token ids returns, for a seed, the unused documents by
likeness; those that fit fill the window, and the best of the rest is cut at its
end.  The rest of a cut document is the next seed.  Only a shard's last
window isn't full; it is cut into sequences of powers of two, which need no
padding.

A null text is empty and yields the end id alone.  Ties are taken in the order
of key and ids; repeated rows are packed as often as they occur.  An empty table
gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packhouse.llm import text as X
from packhouse.llm import tokens


@dataclass(frozen=True)
class Settings:
    window: int = 4096
    end_id: int = 2
    shard_docs: int = 1024
    # Neighbours tried for a fit before one is cut.
    tries: int = 64
    k1: float = 1.2
    b: float = 0.75


_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _tokenize(batches: Iterator[pa.RecordBatch], path: str, s: Settings) -> Iterator[pa.RecordBatch]:
    """(doc_id, start, length, doc_tokens, ids): whole windows and the rest of each document."""
    encoder = tokens.word_ids(path)
    for b in batches:
        keys = b.column(0).to_pylist()
        for c in X.chunks(b.column(1)):
            out: list[tuple] = []
            for i, raw in enumerate(encoder.encode([c.text(i) for i in range(c.hi - c.lo)])):
                ids = np.append(np.frombuffer(raw, "<u2"), np.uint16(s.end_id)).astype("<u2")
                n = len(ids)
                out += [(keys[c.lo + i], at, min(s.window, n - at), n, ids[at : at + s.window].tobytes()) for at in range(0, n, s.window)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                ["doc_id", "start", "length", "doc_tokens", "ids"],
            )


class Index:
    """BM25 over the token ids of a shard's documents."""

    def __init__(self, docs: list[np.ndarray], s: Settings):
        self.n = len(docs)
        length = np.array([len(d) for d in docs], float)
        row = np.repeat(np.arange(self.n), [len(d) for d in docs])
        term = np.concatenate(docs).astype(np.int64)
        key, tf = np.unique(term * self.n + row, return_counts=True)
        term, self.doc = key // self.n, key % self.n
        self.terms, first, df = np.unique(term, return_index=True, return_counts=True)
        idf = np.log1p((self.n - df + 0.5) / (df + 0.5))
        norm = s.k1 * (1 - s.b + s.b * length / length.mean())
        self.weight = np.repeat(idf, df) * tf * (s.k1 + 1) / (tf + norm[self.doc])
        self.first, self.df = first, df
        at = np.repeat(np.arange(len(self.terms)), df)
        order = np.argsort(self.doc, kind="stable")
        self.of = np.split(at[order], np.searchsorted(self.doc[order], np.arange(1, self.n)))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of each document for the distinct tokens of a seed."""
        t = self.of[seed]
        df = self.df[t]
        at = np.repeat(self.first[t] - np.concatenate([[0], np.cumsum(df)[:-1]]), df) + np.arange(df.sum())
        return np.bincount(self.doc[at], self.weight[at], self.n)


def order(docs: list[np.ndarray], s: Settings) -> list[int]:
    """The order in which documents, laid end to end, fill windows by retrieval."""
    if not docs:
        return []
    index = Index(docs, s)
    size = [len(d) for d in docs]
    used = np.zeros(len(docs), bool)
    out: list[int] = []
    fresh = 0
    seed, room = None, s.window
    while len(out) < len(docs):
        if seed is None:
            while used[fresh]:
                fresh += 1
            seed = fresh
            used[seed] = True
            out.append(seed)
            room -= size[seed]
        score = index.scores(seed)
        score[used] = -1
        near = np.argsort(-score, kind="stable")[: len(docs) - len(out)]
        best = None
        for i in near[: s.tries].tolist():
            if size[i] <= room:
                used[i] = True
                out.append(i)
                room -= size[i]
                if not room:
                    break
            elif best is None:
                best = i
        if not room or (best is None and len(near) <= s.tries):
            # Full, or nothing is left.
            seed, room = None, room or s.window
            continue
        if best is None:
            # All tried ones fitted: go on with the same seed.
            continue
        used[best] = True
        out.append(best)
        seed, room = best, s.window - (size[best] - room)
    return out


def _ends(total: int, window: int) -> list[int]:
    """Ends of sequences: whole windows, then powers of two."""
    ends = list(range(window, total + 1, window))
    at = total - total % window
    while at < total:
        at += 1 << ((total - at).bit_length() - 1)
        ends.append(at)
    return ends


def _pack(table: pa.Table, s: Settings) -> Iterator[tuple]:
    shard = table.column("shard")[0].as_py()
    rows = list(zip(*(table.column(c).to_pylist() for c in ("doc_id", "start", "length", "doc_tokens", "ids"))))
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1], r[4]))
    next_id = shard << 32
    rest = []
    for r in rows:
        if r[2] == s.window:
            yield (*r[:3], crc(np.frombuffer(r[4], "<u2")), r[3], next_id, 0, r[4])
            next_id += 1
        else:
            rest.append(r)
    ids = [np.frombuffer(r[4], "<u2") for r in rest]
    placed = order(ids, s)
    ends = _ends(sum(len(x) for x in ids), s.window)
    at = seq = begin = 0
    for i in placed:
        key, start, length, whole, _ = rest[i]
        done = 0
        while done < length:
            take = min(length - done, ends[seq] - at)
            part = ids[i][done : done + take]
            yield (key, start + done, take, crc(part), whole, next_id + seq, at - begin, part.tobytes())
            done += take
            at += take
            if at == ends[seq]:
                begin, seq = at, seq + 1


def pack(docs: DataFrame, tokenizer: str, s: Settings = Settings(), key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """The pieces of all documents, one row each; with ``ids``, also their ids as 16-bit little-endian bytes."""
    part = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    shards = max(1, -(-docs.count() // s.shard_docs))
    cut = part.mapInArrow(lambda b: _tokenize(b, tokenizer, s), "doc_id long, start long, length long, doc_tokens long, ids binary")
    # Long documents have many windows; those are spread by their start as well.  The ids spread the rows of a null or hot key.
    whole = F.col("length") == s.window
    shard = F.pmod(F.xxhash64("doc_id", F.when(whole, F.col("start")).otherwise(0), "ids"), F.lit(shards))
    schema = _PIECE + (", ids binary" if ids else "")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.binary()]

    def run(table: pa.Table) -> pa.Table:
        found = list(_pack(table, s))
        return pa.table([pa.array([r[i] for r in found], kinds[i]) for i in range(len(names))], names)

    return cut.withColumn("shard", shard).groupBy("shard").applyInArrow(run, schema)
