"""Quality classifier: supervised subword embeddings.

Words and character n-grams of a text are hashed into buckets, as are two
tokens for a word said again and a run of words said again; each bucket has
a learned vector, a text is the average of its buckets' vectors, and a softmax
over the average gives the classes.  Vectors and weights are trained by
stochastic gradient descent in numpy, on a bounded sample of labelled texts.

As the output is linear in the average, a bucket adds a fixed number to the
difference of the two classes: scoring needs one number a bucket, sent to the
tasks, and one pass over the texts.

A null or empty text has no buckets and gets the score of the bias alone.
Without labelled rows every score is 0.5.  Equal texts get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packhouse.llm import text as X


@dataclass(frozen=True)
class Settings:
    """Sizes of the model, n-gram lengths, the bound of the sample (rows of each class) and the descent."""

    bits: int = 16
    width: int = 16
    lengths: tuple[int, ...] = (3, 4)
    sample: int = 1500
    epochs: int = 6
    rate: float = 0.5
    seed: int = 5


@dataclass
class Model:
    bucket: np.ndarray
    bias: float


_POINT = X.seeds(4, 29) | np.uint64(1)
# Bytes of text worked on together: the n-grams of a byte take some 200 bytes meanwhile.
_CHUNK = 1 << 17


def _again(w: X.Words, row: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Words that equal the one before, and words that end a run of three found earlier in their text: two tokens of their own."""
    yield 0, 1 + np.flatnonzero((w.name[1:] == w.name[:-1]) & (row[1:] == row[:-1]))
    run = X.grams(w.name, 3)
    at = np.flatnonzero(row[: len(run)] == row[2:]) if len(run) else np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        key = run[at] + X.seeds(len(w.first), 7)[row[at]]
    _, first = np.unique(key, return_index=True)
    later = np.ones(len(at), bool)
    later[first] = False
    yield 1, at[later] + 2


def _features(column: pa.Array, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For runs of rows: buckets, the row of each, and the number of rows."""
    shift = np.uint64(64 - s.bits)
    for c in X.chunks(column, _CHUNK):
        w = X.words(c)
        rows = c.hi - c.lo
        of = w.rows()
        parts, owner = [w.name >> shift], [of]
        for n, again in _again(w, of):
            parts.append(np.full(len(again), n, np.uint64))
            owner.append(of[again])
        texts = [c.text(i).decode("utf-8", "replace") for i in range(rows)]
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        space = (points == 32) | ((points >= 9) & (points <= 13))
        code = np.where(space, 32, points).astype(np.uint64)
        row = np.repeat(np.arange(rows), np.diff(off))
        for n in s.lengths:
            m = len(code) - n + 1
            if m <= 0:
                continue
            # Within a word and the spaces around it, within a row.
            fine = row[:m] == row[n - 1 :]
            for j in range(1, n - 1):
                fine &= ~space[j : j + m]
            at = np.flatnonzero(fine)
            name = np.full(len(at), n, np.uint64)
            with np.errstate(over="ignore"):
                for j in range(n):
                    name += code[at + j] * _POINT[j]
                name = X.mix(name)
            parts.append(name >> shift)
            owner.append(row[at])
        yield np.concatenate(parts).astype(np.int64), np.concatenate(owner), rows


def _featurize(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    for b in batches:
        label = b.column(1).to_pylist()
        done = 0
        out: list[tuple[bytes, bytes]] = []
        for bucket, row, rows in _features(b.column(0), s):
            key, count = np.unique(row * (1 << s.bits) + bucket, return_counts=True)
            edge = np.searchsorted(key, np.arange(rows + 1) << s.bits)
            low = (key & ((1 << s.bits) - 1)).astype(np.uint32)
            share = count.astype(np.float32)
            out += [(low[a:z].tobytes(), share[a:z].tobytes()) for a, z in zip(edge[:-1], edge[1:])]
            done += rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(label[:done], pa.int32()), pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.binary())], ["label", "bucket", "count"]
        )


def sample(docs: DataFrame, labels: DataFrame, column: str, s: Settings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, label) of at most ``sample`` rows of each class, those of the smallest hash of their key."""
    known = labels.where(f"{key} is not null and {column} in (0, 1)").groupBy(key).agg(F.max(column).cast("int").alias("label"))
    drawn = None
    for k in (0, 1):
        part = known.where(F.col("label") == k).orderBy(F.xxhash64(key), key).limit(s.sample)
        drawn = part if drawn is None else drawn.unionByName(part)
    return docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(drawn), key).select("text", "label")


def fit(rows: DataFrame, s: Settings = Settings()) -> Model:
    """Trains on rows (text, label), whose number the caller bounds."""
    found = rows.mapInArrow(lambda batches: _featurize(batches, s), "label int, bucket binary, count binary").collect()
    data = sorted((r["label"], bytes(r["bucket"]), bytes(r["count"])) for r in found if r["bucket"])
    if len({y for y, _, _ in data}) < 2:
        only = {y for y, _, _ in data}
        return Model(np.zeros(1 << s.bits, np.float32), 0.0 if not only else (4.0 if 1 in only else -4.0))
    texts = []
    for y, bucket, count in data:
        c = np.frombuffer(count, np.float32)
        texts.append((y, np.frombuffer(bucket, np.uint32), (c / c.sum())[:, None]))
    weight = len(texts) / (2 * np.bincount([y for y, _, _ in texts], minlength=2))
    draw = np.random.default_rng(s.seed)
    vectors = draw.uniform(-1 / s.width, 1 / s.width, (1 << s.bits, s.width)).astype(np.float32)
    out = np.zeros((s.width, 2), np.float32)
    bias = np.zeros(2, np.float32)
    steps = s.epochs * len(texts)
    step = 0
    for _ in range(s.epochs):
        for i in draw.permutation(len(texts)):
            y, bucket, share = texts[i]
            rate = np.float32(s.rate * (1 - step / steps) * weight[y])
            mean = (vectors[bucket] * share).sum(axis=0)
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= rate * p
            # The average spreads a step over all buckets; each vector takes it by its share, scaled to the text.
            vectors[bucket] -= rate * share * back * np.float32(min(len(bucket), 64))
            step += 1
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def score(docs: DataFrame, model: Model, s: Settings = Settings(), keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns of ``keep`` and score, the probability of class 1, a row for each row."""
    names = list(dict.fromkeys([*keep, text]))
    part = docs.select(*names)
    at = names.index(text)
    ddl = ", ".join(f"`{c}` {part.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        for b in batches:
            logits = [np.zeros(0)]
            for bucket, row, rows in _features(b.column(at), s):
                n = np.maximum(np.bincount(row, minlength=rows), 1)
                logits.append(np.bincount(row, model.bucket[bucket], rows) / n + model.bias)
            p = 1 / (1 + np.exp(-np.clip(np.concatenate(logits), -40, 40)))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(np.round(p, 6))], [*keep, "score"])

    return part.mapInArrow(run, f"{ddl}, score double")
