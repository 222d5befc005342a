"""Toxicity by class-conditional Kneser-Ney models of words and bigrams.

Words are runs of letters and digits, A-Z lower-cased.  Each class has a model of
words and of bigrams, both counted once a distinct text, so that copies of a text
count once.  A bigram's count is the number of texts that have it, a word's is its
Kneser-Ney continuation count, the number of different words it follows.  Counts
are discounted; what the discount frees goes to the next shorter level, and from
words to the counts that both classes share:

    q(w)   = (a(w) - D) / A + m shared(w)
    p(w|h) = (c(hw) - D) / C(h) + l(h) [half both(hw) + (1 - half of both's sum for h) q(w)]

with both(hw) the discounted share of hw after h in the two classes together.  A
text's log-likelihoods under the two models are divided by its words; their
difference is the first of the three numbers that tell of a text.  It is thin where
a long text has one toxic expression, so there are two more: the highest difference
of one of its bigrams or words, and that of one of its words by a model of words alone, with
a discount that leaves out what follows few words.  The score is a logistic curve
over the three.  A text's own bigrams would tell its class, so the curve is fitted
on a quarter of the training texts, and the models of words and bigrams are made of
the others.

Both models have the words and bigrams that the toxic class has, however rare.  A
bigram or word that only ordinary texts have is left to the next level in both,
with the weight that its own counts free there, so each p still sums to 1.

A null or empty text has the difference 0 in all three and the score that goes with
it.  With training texts of one class only (or none) all are 0 and the score is the
smoothed share of the toxic class.  Rows are scored one by one, so repeated rows get
equal scores.

The model is a table of any size.  One measured small is sent to every task;
a larger one is joined to the distinct words and bigrams of each block of texts, and
what is found goes back to the block, with the same result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packhouse.llm import text as X
from packhouse.llm.work import Work

# A byte that isn't a letter or digit of ASCII, nor part of a longer character, ends a word.
_OTHER = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])


@dataclass(frozen=True)
class Settings:
    """Discount, weight of the shared counts, and up to how many words (16 bytes each) a table is sent to every task.

    Words are candidates if the toxic class uses them at least ``least_lift`` times as often as the ordinary one.
    These are of the model of words alone; ``kneser_ney`` is the discount of the models of words and bigrams, whose tables
    have bigrams too and are sent up to four times as many rows.
    """

    discount: float = 3.0
    shared: float = 0.1
    least_lift: float = 1.5
    small: int = 1 << 20
    kneser_ney: float = 0.75
    # One in so many training texts is kept for the curve.
    held: int = 4


@dataclass
class Grams:
    """What words and bigrams add to the difference of a text's log-likelihoods, by name, and the difference of a place that has them.

    Sorted arrays, or a table (name, delta, peak) where they are too many for every task.  Every word adds ``each``.
    """

    name: np.ndarray
    delta: np.ndarray
    peak: np.ndarray
    each: float
    rows: DataFrame | None = None

    @staticmethod
    def none() -> Grams:
        return Grams(np.zeros(0, np.uint64), np.zeros(0, np.float32), np.zeros(0, np.float32), 0.0)


@dataclass
class Model:
    """Log-likelihood ratios of words, all above 0, by sorted arrays, and of ``grams``.

    Where one of them is too large for every task, ``table`` has both: (name, delta, peak, ratio).
    """

    name: np.ndarray
    ratio: np.ndarray
    grams: Grams
    curve: np.ndarray
    table: DataFrame | None = None

    def score(self, told: np.ndarray) -> np.ndarray:
        """Of rows (ratio, mean, peak)."""
        return 1 / (1 + np.exp(-(_design(told) @ self.curve)))


# Names of a word as the one that others follow, and as the one that follows, are apart from each other and from bigrams'.
_HEAD = 0x51ED270B7A1F3C25
_TAIL = 0x2545F4914F6CDD1D
_FEATURES = ("ratio", "mean", "peak")


def _design(told: np.ndarray) -> np.ndarray:
    return np.column_stack([told, np.ones(len(told))])


def _pair_name(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Names of words are mixed already."""
    return head ^ (word << np.uint64(1) | word >> np.uint64(63))


def _name_of_pair():
    """The same of columns head and word."""
    return F.col("head").bitwiseXOR(F.shiftleft("word", 1).bitwiseOR(F.shiftrightunsigned("word", 63)))


def tokens(chunk: X.Chunk) -> X.Words:
    low = X.Chunk(chunk.lo, chunk.hi, X.lower_ascii(chunk.buf), chunk.off)
    return X.words(low, _OTHER)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic, n): tokens of each chunk."""
    for b in batches:
        toxic = b.column(1).to_numpy(zero_copy_only=False).astype(np.uint64)
        for c in X.chunks(b.column(0), 8 * X.CHUNK):
            parts = list(_by_class(c, toxic))
            for cls, name, _ in parts:
                word, n = np.unique(name, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(X.as_long(word)), pa.array(np.full(len(word), cls, np.int32)), pa.array(n)], ["word", "toxic", "n"]
                )


def _places(c: X.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, word and the word before it (0: none) of each place."""
    rows, names, before = [], [], []
    for s in X.chunks(pa.Array.from_buffers(pa.large_binary(), c.hi - c.lo, [None, pa.py_buffer(c.off.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(c.buf))])):
        w = tokens(s)
        names.append(w.name)
        before.append(_before(w))
        rows.append(s.lo + w.rows())
    return tuple(np.concatenate(x) if x else np.zeros(0, k) for x, k in ((rows, np.int64), (names, np.uint64), (before, np.uint64)))


def _before(w: X.Words) -> np.ndarray:
    prev = np.zeros(len(w.name), np.uint64)
    prev[1:] = w.name[:-1]
    heads = w.first[:-1]
    prev[heads[heads < len(prev)]] = 0
    return prev


def _by_class(c: X.Chunk, toxic: np.ndarray):
    """For both classes: the words of its rows, and the word before each (0: none)."""
    row, name, prev = _places(c)
    cls = toxic[c.lo + row]
    for k in (0, 1):
        at = cls == k
        if at.any():
            yield k, name[at], prev[at]


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(head, word, c0, c1): the bigrams of each chunk, and how many texts of both classes have them; by head, so that they are compressed well."""
    # 4 MB of text at once: a worker's arrays take some 20 times as much, and an executor has several workers.
    for b in batches:
        toxic = b.column(1).to_numpy(zero_copy_only=False)
        for c in X.chunks(b.column(0), 4 * X.CHUNK):
            row, word, head = _places(c)
            follows = head != 0
            row, word, head = row[follows], word[follows], head[follows]
            name = _pair_name(head, word)
            once = np.lexsort((name, row))
            new = np.ones(len(once), bool)
            new[1:] = np.diff(row[once]) != 0
            new[1:] |= np.diff(name[once]) != 0
            once = once[new]
            _, first, of = np.unique(name[once], return_index=True, return_inverse=True)
            own, head, word = toxic[c.lo + row[once]], head[once][first], word[once][first]
            order = np.argsort(head)
            counts = [np.bincount(of[own == k], minlength=len(first))[order] for k in (0, 1)]
            names = [X.as_long(x[order]) for x in (head, word)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (*names, *counts)], ["head", "word", "c0", "c1"])


def training_rows(docs: DataFrame, labels: DataFrame, column: str, key: str = "doc_id", text: str = "text", small: int = 1 << 20) -> DataFrame:
    """(text, label 0/1) of labelled rows.  Up to ``small`` labels (16 bytes each) are broadcast, more are shuffled."""
    known = labels.where(f"{key} is not null and {column} in (0, 1)").groupBy(key).agg(F.max(column).cast("int").alias("label"))
    known = F.broadcast(known) if known.count() <= small else known
    return docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).join(known, key).select("text", "label")


def fit(rows: DataFrame, settings: Settings = Settings()) -> Model:
    """The model of training rows (text, label)."""
    counts = rows.mapInArrow(_counts, "word long, toxic int, n long")
    by_word = counts.groupBy("word").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("n1"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("n0"))
    total = counts.groupBy("toxic").agg(F.sum("n").alias("n")).collect()
    n = {r["toxic"]: r["n"] for r in total}
    model = Model(np.zeros(0, np.uint64), np.zeros(0), Grams.none(), np.zeros(len(_FEATURES) + 1))
    if not (n.get(0) and n.get(1)):
        return replace(model, curve=_calibrate(rows, model))
    work = Work(rows.sparkSession, "toxicity")
    lift = (F.col("n1") / n[1]) / ((F.col("n0") + 1) / n[0])
    able = work.cut(by_word.where((F.col("n1") > settings.discount) & (lift >= settings.least_lift)).select("word"), "able")
    name, ratio, ratios = _ratios(rows, able, n, settings, work)
    held = F.pmod(F.xxhash64("text"), F.lit(settings.held)) == 0
    texts = rows.where(~held).dropDuplicates(["text", "label"])
    counted = texts.mapInArrow(_pair_counts, "head long, word long, c0 long, c1 long").groupBy("head", "word").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    grams = _grams(work.cut(counted.sortWithinPartitions("head"), "bigrams"), settings, work)
    model = replace(model, grams=grams)
    if name is None or grams.rows is not None:
        own = _as_rows(rows.sparkSession, grams) if grams.rows is None else grams.rows
        both = own.unionByName(ratios.select(F.col("word").bitwiseXOR(F.lit(_TAIL)).alias("name"), "ratio"), allowMissingColumns=True)
        table = work.cut(both.groupBy("name").agg(*[F.coalesce(F.max(x), F.lit(0.0)).alias(x) for x in ("delta", "peak", "ratio")]), "model")
        model = replace(model, table=table)
    if name is not None:
        model = replace(model, name=name, ratio=ratio)
    return replace(model, curve=_calibrate(rows.where(held), model))


def _as_rows(spark, grams: Grams) -> DataFrame:
    return spark.createDataFrame(pa.table([pa.array(c) for c in (X.as_long(grams.name), grams.delta, grams.peak)], ["name", "delta", "peak"]))


def _grams(pairs: DataFrame, s: Settings, work: Work) -> Grams:
    """The two models over bigrams (head, word) that c1 toxic and c0 ordinary texts have."""
    # What is left of a count, only where the toxic class has the word or bigram.
    left = lambda c, toxic: F.when(F.col(toxic) > 0, F.greatest(c - s.kneser_ney, F.lit(0.0))).otherwise(0.0)
    c0, c1, a0, a1 = (F.col(c) for c in ("c0", "c1", "a0", "a1"))
    seen = [F.sum((c > 0).cast("long")).alias(a) for c, a in ((c0, "a0"), (c1, "a1"))]
    words = work.cut(pairs.groupBy("word").agg(*seen), "words")
    t = words.agg(F.sum("a0").alias("a0"), F.sum("a1").alias("a1"), F.sum(left(a0, "a1")).alias("l0"), F.sum(left(a1, "a1")).alias("l1")).first()
    if not (t["a0"] and t["a1"]):
        return Grams.none()
    free = [1 - t[f"l{k}"] / t[f"a{k}"] for k in (0, 1)]
    shared = (a0 + a1) / (t["a0"] + t["a1"])
    q = [left(a, "a1") / t[f"a{k}"] + free[k] * shared for k, a in enumerate((a0, a1))]
    each = float(np.log(free[1] / free[0]))
    words = words.where("a1 > 0").select("word", q[0].alias("q0"), q[1].alias("q1"), (F.log(q[1] / q[0]) - each).alias("tail"))
    heads = pairs.groupBy("head").agg(
        F.sum("c0").alias("n0"), F.sum("c1").alias("n1"),
        F.sum(left(c0, "c1")).alias("l0"), F.sum(left(c1, "c1")).alias("l1"), F.sum(left(c0 + c1, "c1")).alias("l"),
    ).where("n1 > 0")
    n0, n1 = F.col("n0"), F.col("n1")
    free0, free1 = F.when(n0 > 0, 1 - F.col("l0") / n0).otherwise(1.0), 1 - F.col("l1") / n1
    heads = work.cut(heads.select("head", "n0", "n1", free0.alias("free0"), free1.alias("free1"), (1 - 0.5 * F.col("l") / (n0 + n1)).alias("rest"), F.log(free1 / free0).alias("ahead")), "heads")
    heads, words = (F.broadcast(x) if x.count() <= s.small else x for x in (heads, words))
    known = pairs.where("c1 > 0").join(heads, "head").join(words, "word")
    both = 0.5 * left(c0 + c1, "c1") / (n0 + n1)
    p0 = F.when(n0 > 0, left(c0, "c1") / n0).otherwise(0.0) + F.col("free0") * (both + F.col("rest") * F.col("q0"))
    p1 = left(c1, "c1") / n1 + F.col("free1") * (both + F.col("rest") * F.col("q1"))
    peak = F.log(p1 / p0)
    real = lambda c: c.cast("float")
    none = real(F.lit(0.0)).alias("peak")
    # A place adds its word's, and that of the word before; a bigram of both models adds what makes the sum its own.
    of_pairs = known.select(_name_of_pair().alias("name"), real(peak - each - F.col("tail") - F.col("ahead")).alias("delta"), real(peak).alias("peak"))
    of_words = words.select(F.col("word").bitwiseXOR(F.lit(_TAIL)).alias("name"), real(F.col("tail")).alias("delta"), real(F.col("tail") + each).alias("peak"))
    of_heads = heads.select(F.col("head").bitwiseXOR(F.lit(_HEAD)).alias("name"), real(F.col("ahead")).alias("delta"), none)
    rows = work.cut(of_pairs.unionByName(of_words).unionByName(of_heads), "grams")
    if rows.count() > 4 * s.small:
        return replace(Grams.none(), each=each, rows=rows)
    found = rows.toArrow()
    name = found.column("name").to_numpy().view(np.uint64)
    order = np.argsort(name)
    return Grams(name[order], found.column("delta").to_numpy()[order], found.column("peak").to_numpy()[order], each)


@dataclass
class _Index:
    """Where a name stands in sorted names: its first bits lead to a place, as names are spread evenly, so a search costs the same in a model of any size.

    ``first`` has the place of the first name of each bucket; there are as many buckets as names, or up to twice as many.
    """

    names: np.ndarray
    first: np.ndarray
    shift: np.uint64

    @staticmethod
    def of(names: np.ndarray) -> _Index:
        bits = max(1, len(names).bit_length())
        shift = np.uint64(64 - bits)
        first = np.zeros(1 << bits, np.int32)
        if len(names):
            first[1:] = np.cumsum(np.bincount((names >> shift).view(np.int64), minlength=1 << bits), dtype=np.int32)[:-1]
        # The last bucket's search may go one past the end.
        return _Index(np.append(names, ~np.uint64(0)), first, shift)

    def find(self, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the names that are there: which, and their places."""
        at = self.first[(name >> self.shift).view(np.int64)]
        found = self.names[at]
        behind = np.flatnonzero(found < name)
        while len(behind):
            at[behind] += 1
            now = self.names[at[behind]]
            found[behind] = now
            behind = behind[now < name[behind]]
        there = np.flatnonzero((found == name) & (at < len(self.names) - 1))
        return there, at[there]


def _raise(told: np.ndarray, rows: np.ndarray, value: np.ndarray) -> None:
    """The highest value of each row, where it is above the row's own; ``rows`` rise."""
    if len(rows):
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        told[rows[first]] = np.maximum(told[rows[first]], np.maximum.reduceat(value, first))


def _ratios(rows: DataFrame, able: DataFrame, n: dict[int, int], s: Settings, work: Work) -> tuple[np.ndarray | None, np.ndarray | None, DataFrame]:
    """The model of the words of ``able``: sorted arrays where they are few, and as a table (word, ratio)."""
    few = able.count() <= s.small
    words = np.sort(able.toArrow().column("word").to_numpy().view(np.uint64)) if few else None

    def contexts(batches):
        index = _Index.of(words) if few else None
        for b in batches:
            toxic = b.column(1).to_numpy(zero_copy_only=False).astype(np.uint64)
            for c in X.chunks(b.column(0), 8 * X.CHUNK):
                for cls, name, prev in _by_class(c, toxic):
                    if index is not None:
                        there, _ = index.find(name)
                        name, prev = name[there], prev[there]
                    pair = np.unique(np.stack([name, prev], axis=1), axis=0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(X.as_long(np.ascontiguousarray(pair[:, 0]))), pa.array(X.as_long(np.ascontiguousarray(pair[:, 1]))), pa.array(np.full(len(pair), cls, np.int32))],
                        ["word", "before", "toxic"],
                    )

    seen = rows.mapInArrow(contexts, "word long, before long, toxic int")
    seen = (seen if few else seen.join(able, "word", "left_semi")).distinct()
    c1, c0 = (F.sum(F.when(F.col("toxic") == k, 1).otherwise(0)) for k in (1, 0))
    kept = seen.groupBy("word").agg(c1.alias("c1"), c0.alias("c0"))
    shared = s.shared * (F.col("c1") + F.col("c0")) / (n[0] + n[1])
    # The ordinary class is larger; its discount is larger by as much, so that words of no class stay neutral.
    p1 = F.greatest(F.col("c1") - s.discount, F.lit(0.0)) / n[1] + shared
    p0 = F.greatest(F.col("c0") - s.discount * n[0] / n[1], F.lit(0.0)) / n[0] + shared
    table = work.cut(kept.select("word", F.log(p1 / p0).alias("ratio")).where("ratio > 0"), "ratios")
    if table.count() > s.small:
        return None, None, table
    found = table.toArrow()
    name = found.column("word").to_numpy().view(np.uint64)
    order = np.argsort(name)
    return name[order], found.column("ratio").to_numpy()[order], table


def _indexes(model: Model) -> tuple[_Index, _Index]:
    return _Index.of(model.name), _Index.of(model.grams.name)


def _rate(column: pa.Array, model: Model, indexes: tuple[_Index, _Index] | None = None) -> np.ndarray:
    """(ratio, mean, peak) of each text."""
    out = [np.zeros((0, len(_FEATURES)))]
    grams = model.grams
    words, pairs = indexes or _indexes(model)
    for c in X.chunks(column):
        w = tokens(c)
        row, told = w.rows(), np.zeros((c.hi - c.lo, len(_FEATURES)))
        there, at = words.find(w.name)
        _raise(told[:, 0], row[there], model.ratio[at])
        if len(grams.name) or grams.each:
            head = _before(w)
            follows = np.flatnonzero(head)
            head, of = head[follows], row[follows]
            total = grams.each * np.diff(w.first)
            for rows, name in ((row, w.name ^ np.uint64(_TAIL)), (of, head ^ np.uint64(_HEAD)), (of, _pair_name(head, w.name[follows]))):
                there, at = pairs.find(name)
                total += np.bincount(rows[there], grams.delta[at], len(total))
                _raise(told[:, 2], rows[there], grams.peak[at])
            told[:, 1] = total / np.maximum(np.diff(w.first), 1)
        out.append(told)
    return np.concatenate(out)


# Bytes of text of a block, besides its last text.
_BLOCK = 16 * X.CHUNK


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(own, text, block): consecutive rows of a task, dealt to blocks by the bytes before them."""
    task, before = TaskContext.get().partitionId() << 32, 0
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        block = task + (before + np.cumsum(size) - size) // _BLOCK
        before += int(size.sum())
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(block)], ["own", "text", "block"])


def _distinct(name: np.ndarray) -> np.ndarray:
    """Sorted; np.unique puts them into a hash table first, which takes longer."""
    name = np.sort(name)
    return name[np.flatnonzero(np.append(True, name[1:] != name[:-1])[: len(name)])]


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, name): the distinct words and bigrams of a block, as far as they are in one batch."""
    for b in batches:
        block = b.column(1).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(block)]
        for lo, hi in pairwise(cuts):
            found = [np.zeros(0, np.uint64)]
            for c in X.chunks(b.column(0).slice(lo, hi - lo)):
                w = tokens(c)
                word, head = _distinct(w.name), _before(w)
                follows = np.flatnonzero(head)
                found += [word ^ np.uint64(_TAIL), word ^ np.uint64(_HEAD), _distinct(_pair_name(head[follows], w.name[follows]))]
            name = _distinct(np.concatenate(found))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(name), block[lo] if hi else 0)), pa.array(X.as_long(name))], ["block", "name"])


def _rated(rows: DataFrame, model: Model, own: str, text: str) -> DataFrame:
    """(own, ratio, mean, peak), a row for each row."""
    part = rows.select(F.col(own).alias("own"), F.col(text).alias("text"))
    kind = part.schema["own"].dataType.simpleString()
    schema = f"`{own}` {kind}, " + ", ".join(f"{f} double" for f in _FEATURES)

    def table(own_column, told):
        return [own_column, *(pa.array(np.ascontiguousarray(told[:, i])) for i in range(len(_FEATURES)))], [own, *_FEATURES]

    if model.table is None:

        def run(batches):
            indexes = _indexes(model)
            for b in batches:
                yield pa.RecordBatch.from_arrays(*table(b.column(0), _rate(b.column(1), model, indexes)))

        return part.mapInArrow(run, schema)
    each, curve = model.grams.each, model.curve
    texts = Work(rows.sparkSession, "toxicity").cut(part.mapInArrow(_in_blocks, f"own {kind}, text string, block long"), "texts")
    found = texts.select("text", "block").mapInArrow(_named, "block long, name long").join(model.table, "name")

    def told_of(block: pa.Table, found: pa.Table) -> pa.Table:
        name = found.column("name").to_numpy().view(np.uint64)
        order = np.argsort(name)
        ratio = found.column("ratio").to_numpy()
        words = np.flatnonzero(ratio > 0)
        words = words[np.argsort(name[words] ^ np.uint64(_TAIL))]
        grams = Grams(name[order], *(found.column(f).to_numpy()[order].astype(np.float32) for f in ("delta", "peak")), each)
        of_block = Model(name[words] ^ np.uint64(_TAIL), ratio[words], grams, curve)
        return pa.table(*table(block.column("own"), _rate(block.column("text").combine_chunks(), of_block)))

    return texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(told_of, schema)


def _calibrate(rows: DataFrame, model: Model) -> np.ndarray:
    """The logistic curve, over counts of all training texts by rounded features and label."""
    # Steps and bounds keep the rows few at any size.
    grid = {"ratio": (10, 15), "mean": (50, 2), "peak": (10, 10)}
    near = [F.round(F.greatest(F.least(F.col(f), F.lit(float(top))), F.lit(-float(top))) * steps).alias(f) for f, (steps, top) in grid.items()]
    cells = _rated(rows, model, "label", "text").select(*near, "label").groupBy(*grid, "label").count().collect()
    x = np.array([[c[f] / steps for f, (steps, _) in grid.items()] for c in cells] or [[0.0] * len(grid)])
    y = np.array([c["label"] for c in cells] or [0.0], float)
    w = np.array([c["count"] for c in cells] or [0.0], float)
    design = _design(x)
    beta = np.zeros(design.shape[1])
    # A slight pull to zero keeps the curve finite where the classes part completely.
    pull = np.diag([0.05] * len(beta))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (w * (y - p)) - pull @ beta
        hess = (design * (w * p * (1 - p))[:, None]).T @ design + pull
        step = np.linalg.solve(hess, grad)
        beta = beta + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
    return beta


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, ratio, mean, peak), a row for each row."""
    rated = _rated(docs, model, key, text)
    kind = rated.schema[key].dataType.simpleString()
    curve = replace(model, grams=Grams.none(), name=np.zeros(0, np.uint64), ratio=np.zeros(0), table=None)

    def run(batches):
        for b in batches:
            told = np.column_stack([b.column(1 + i).to_numpy(zero_copy_only=False) for i in range(len(_FEATURES))])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.round(curve.score(told), 6)), *b.columns[1:]], [key, "score", *_FEATURES])

    return rated.mapInArrow(run, f"`{key}` {kind}, score double, " + ", ".join(f"{f} double" for f in _FEATURES))


def crc_fold(key: str, folds: int):
    """crc32 of the id as text, modulo folds."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def fold(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds
