"""Near duplicates by min-max hashing.

A text's set is its distinct shingles of words.  Under each of ``hashes`` random
hash functions both the least and the greatest value are kept: two signature
values for one evaluation.  Both agree for two sets with the chance of their
Jaccard similarity.  Bands of ``rows`` values are the buckets in which
candidates meet.

Rows of one set are one entry; their classes are linked by one of them.  In a
bucket, all entries are compared with a few pivots: its smallest id, and those whose
hash is low for its size, so that buckets of one group share their pivots.  Two
bits of each signature value go along with an entry; pairs whose marks agree so
rarely that the similarity is out of reach need no sets, the others are decided on
their full sets.  The bound lies 6.5 standard deviations low: a pair just at the
limit is missed with chance 1e-8 (at 85 percent; 4e-9 at 80).

Entries that weren't pivots may still be linked with each other.  They are gathered
by the pivot of their bucket, however many buckets it has.  What the pivots brought into one
component needn't meet again: only entries outside of the largest component are sent to the
blocks of all others, first with their marks alone, then, those with a partner in
reach, with their sets.  So a large group of copies costs some rows an entry, and
an entry that no pivot reaches costs one a block.  Tasks send out links only.

A text with fewer words than a shingle is one shingle; a null or empty text, or
one without words, has an empty set and is linked with nothing.  Ties don't
arise: components take their smallest id.  Repeated rows of one id are one
document if their texts agree; ids have to be unique otherwise.  A document without
id stands alone, an empty table gives no rows, and other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packhouse.llm import graph
from packhouse.llm import text as X
from packhouse.llm.work import Work


@dataclass(frozen=True)
class Settings:
    """Words in a shingle, least similarity in percent, and the bands.

    With 32 bands of 4 values a pair at similarity 0.8 is missed with chance 5e-8, at 0.85 with 6e-11.
    """

    shingle: int = 5
    percent: int = 80
    hashes: int = 64
    rows: int = 4


def shingles(w: X.Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of shingles, the row of each, and the first shingle of each row."""
    rows = len(w.first) - 1
    of = w.rows()
    full = X.grams(w.name, n)
    at = np.flatnonzero(of[: len(full)] == of[n - 1 :]) if len(full) else np.zeros(0, np.int64)
    name, row = full[at], of[at]
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        extra = np.array([X.grams(w.name[w.first[i] : w.first[i + 1]], int(count[i]), seed=1000 + int(count[i]))[0] for i in short], np.uint64)
        order = np.argsort(np.concatenate([row, short]), kind="stable")
        name, row = np.concatenate([name, extra])[order], np.concatenate([row, short])[order]
    return name, row, np.searchsorted(row, np.arange(rows + 1))


def _lower_words(c: X.Chunk) -> X.Words:
    return X.words(X.Chunk(c.lo, c.hi, X.lower_ascii(c.buf), c.off))


def _sign(name: np.ndarray, first: np.ndarray, full: np.ndarray, s: Settings) -> np.ndarray:
    """Signatures of the rows ``full``: the least and the greatest value of each hash function."""
    a = X.seeds(s.hashes, 3) | np.uint64(1)
    sign = np.zeros((len(full), 2 * s.hashes), np.uint64)
    if len(full):
        head = first[:-1][full]
        with np.errstate(over="ignore"):
            for j in range(s.hashes):
                v = name * a[j]
                v ^= v >> np.uint64(32)
                sign[:, 2 * j] = np.minimum.reduceat(v, head)
                sign[:, 2 * j + 1] = np.maximum.reduceat(v, head)
    return sign


MARKS = ["m0", "m1", "m2", "m3"]


def _signatures(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, k1, k2, m0 to m3, bands): size and 128-bit name of the set, two bits of each value, and the buckets of its bands."""
    bands = 2 * s.hashes // s.rows
    mult = X.seeds(s.rows, 17) | np.uint64(1)
    salt = X.seeds(bands, 19)
    for b in batches:
        for c in X.chunks(b.column(1)):
            name, _, first = shingles(_lower_words(c), s.shingle)
            rows = c.hi - c.lo
            size = np.zeros(rows, np.int64)
            key = np.zeros((rows, 2), np.uint64)
            with np.errstate(over="ignore"):
                for i, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    if hi > lo:
                        part = np.sort(name[lo:hi])
                        part = part[np.append(True, part[1:] != part[:-1])]
                        size[i] = len(part)
                        key[i] = X.mix(part).sum(dtype=np.uint64), X.mix(part + np.uint64(77)).sum(dtype=np.uint64)
                full = np.flatnonzero(size)
                sign = _sign(name, first, full, s)
                folded = X.mix((X.mix(sign.reshape(len(full), bands, s.rows)) * mult).sum(axis=2, dtype=np.uint64) + salt)
            marks = np.zeros((4, rows), np.uint64)
            if len(full):
                low = X.mix(sign)
                for bit in (0, 1):
                    packed = np.packbits(((low >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8), axis=1)
                    marks[2 * bit : 2 * bit + 2, full] = np.ascontiguousarray(packed).view(np.uint64).T
            lists = np.zeros(rows + 1, np.int32)
            lists[1:][full] = bands
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).slice(c.lo, rows),
                    pa.array(size),
                    pa.array(X.as_long(np.ascontiguousarray(key[:, 0]))),
                    pa.array(X.as_long(np.ascontiguousarray(key[:, 1]))),
                    *(pa.array(X.as_long(m)) for m in marks),
                    pa.ListArray.from_arrays(pa.array(np.cumsum(lists, dtype=np.int32)), pa.array(X.as_long(np.ascontiguousarray(folded).ravel()))),
                ],
                ["doc_id", "n", "k1", "k2", *MARKS, "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """(id, members): the sorted set, as bytes."""
    for b in batches:
        for c in X.chunks(b.column(1)):
            name, _, first = shingles(_lower_words(c), s.shingle)
            out = [np.unique(name[lo:hi]).tobytes() for lo, hi in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0).slice(c.lo, c.hi - c.lo), pa.array(out, pa.binary())], ["id", "members"])


# Bits of the filter of ids: 4 MB, whatever the number of ids.
_SLOTS = 1 << 25
_PART = 1 << 15


def _slot(key: str):
    return F.pmod(F.xxhash64(key), F.lit(_SLOTS))


def _filter(ids: DataFrame) -> np.ndarray:
    """A bit for the slot of each id, as bytes; parts of it are put together by Spark."""
    at = ids.select(_slot("id").alias("slot"))
    parts = at.groupBy(F.shiftright("slot", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(_PART - 1)).alias("bits"))
    bits = np.zeros((_SLOTS // _PART, _PART // 8), np.uint8)
    for part, raw in parts.collect():
        bits[part] = np.frombuffer(bytes(raw), np.uint8)
    return bits.ravel()


def _seen(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows (id, text, slot) whose slot has its bit set."""
    for b in batches:
        slot = b.column(2).to_numpy()
        yield b.filter(pa.array((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1))


def _least(s: Settings) -> float:
    """Signature values of which both marks agree, at the least similarity less 6.5 standard deviations."""
    n = 2 * s.hashes
    p = s.percent / 100 + (1 - s.percent / 100) / 4
    return n * p - 6.5 * (n * p * (1 - p)) ** 0.5


def _agree(a: list, b: list):
    """Values of which both marks agree, as a column."""
    return sum((F.bit_count(F.bitwise_not(a[h].bitwiseXOR(b[h]).bitwiseOR(a[h + 2].bitwiseXOR(b[h + 2])))) for h in (0, 1)), F.lit(0))


def _reach(table: pa.Table, s: Settings) -> tuple[pa.Table, pa.Table, np.ndarray]:
    """Of one block: targets, probes, and for each probe and target the marks that agree, or 0 if they needn't be compared."""
    probe = table.column("probe").to_numpy()
    targets, probes = table.filter(pa.array(~probe)), table.filter(pa.array(probe))
    agree = np.zeros((len(probes), len(targets)), np.uint8)
    mark = [[x.column(m).to_numpy().view(np.uint64) for m in MARKS] for x in (probes, targets)]
    for h in (0, 1):
        apart = (mark[0][h][:, None] ^ mark[1][h]) | (mark[0][h + 2][:, None] ^ mark[1][h + 2])
        agree += np.bitwise_count(~apart)
    (pi, pr), (ti, tr) = (tuple(x.column(c).to_numpy() for c in ("id", "root")) for x in (probes, targets))
    # Two probes meet in the blocks of both; one of them counts.
    once = targets.column("main").to_numpy() | (pi[:, None] < ti)
    return targets, probes, np.where((agree >= _least(s)) & (pr[:, None] != tr) & once, agree, 0)


def _near(table: pa.Table, s: Settings) -> pa.Table:
    """(pivot, id) of a block's entries that have a partner in reach."""
    targets, probes, agree = _reach(table, s)
    found = np.concatenate([probes.column("id").to_numpy()[agree.any(axis=1)], targets.column("id").to_numpy()[agree.any(axis=0)]])
    return pa.table({"pivot": pa.array(np.full(len(found), table.column("pivot")[0].as_py(), np.int64)), "id": pa.array(found, pa.int64())})


def _linked(table: pa.Table, s: Settings) -> pa.Table:
    """Linked pairs (a, b) of a block, for each probe one a component, the likeliest partners first."""
    targets, probes, agree = _reach(table, s)
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in targets.column("members")]
    ids, roots = targets.column("id").to_numpy(), targets.column("root").to_numpy()
    out: list[tuple[int, int]] = []
    for key, members, near in zip(probes.column("id").to_pylist(), probes.column("members"), agree):
        a = np.frombuffer(members.as_buffer(), np.uint64)
        done = set()
        at = np.flatnonzero(near)
        for j in at[np.argsort(-near[at].astype(int), kind="stable")].tolist():
            b = sets[j]
            if roots[j] in done or 100 * min(len(a), len(b)) < s.percent * max(len(a), len(b)):
                continue
            both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
            if 100 * both >= s.percent * (len(a) + len(b) - both):
                done.add(roots[j])
                out.append((key, int(ids[j])))
    return pa.table([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])


def _blocks(rows: DataFrame, work: Work) -> DataFrame:
    """Rows (pivot, id, root, marks) dealt out so that each entry outside of its pivot's largest component meets all others.

    Every entry is a target of one block ``i``, for each block ``j`` of probes; the probes are the entries outside of the
    largest component.  Groups of a single component go.
    """
    counts = rows.groupBy("pivot", "root").agg(F.count("*").alias("n"))
    sizes = counts.groupBy("pivot").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("root", F.struct("n", "root")).alias("main_root"))
    tiles = [F.ceil(F.col(c) / BLOCK).cast("int").alias(name) for c, name in (("n", "is"), ("u", "js"))]
    sizes = work.cut(sizes.withColumn("u", F.col("n") - F.col("most")).where("u > 0").select("pivot", "main_root", *tiles), "sizes", few=True)
    dealt = rows.join(sizes, "pivot").withColumn("main", F.col("root") == F.col("main_root"))
    own = [F.pmod(F.hash("id"), F.col("is")).alias("i"), F.pmod(F.hash("id", F.lit(1)), F.col("js")).alias("j")]
    every = [F.explode(F.sequence(F.lit(0), F.col(c) - 1)).alias(c[0]) for c in ("is", "js")]
    targets = dealt.select(*rows.columns, "main", F.lit(False).alias("probe"), own[0], every[1])
    probes = dealt.where("not main").select(*rows.columns, "main", F.lit(True).alias("probe"), every[0], own[1])
    return targets.unionByName(probes)


def _finish(rest: DataFrame, sets, s: Settings, work: Work) -> DataFrame:
    """Linked pairs (a, b) of different roots among the entries (pivot, id, root, marks) of each pivot; ``sets`` takes ids."""
    tile = ["pivot", "i", "j"]
    near = _blocks(rest, work).groupBy(*tile).applyInArrow(lambda t: _near(t, s), "pivot long, id long")
    near = work.cut(near.distinct(), "near", few=True)
    rows = work.cut(rest.join(near, ["pivot", "id"], "left_semi"), "in-reach", few=True)
    have = sets(rows.select("id").distinct())
    full = _blocks(rows, work).join(have, "id")
    return work.cut(full.groupBy(*tile).applyInArrow(lambda t: _linked(t, s), "a long, b long"), "finished")


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pivot, id, both, either) of (pivot, id, left, right); neighbouring rows of one pivot unpack it once."""
    for b in batches:
        both, either = [], []
        last, a = None, None
        for left, right in zip(b.column(2), b.column(3)):
            raw = left.as_buffer()
            if last is None or not raw.equals(last):
                last, a = raw, np.frombuffer(raw, np.uint64)
            x = np.frombuffer(right.as_buffer(), np.uint64)
            at = np.minimum(np.searchsorted(a, x), len(a) - 1)
            n = int((a[at] == x).sum())
            both.append(n)
            either.append(len(a) + len(x) - n)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(both, pa.int64()), pa.array(either, pa.int64())], ["pivot", "id", "both", "either"])


_BLOCK = 512
# Entries of a block that is compared within a task, and pivots of a bucket beside its first entry, on average.
BLOCK = 1024
PIVOTS = 4


def _compare(pairs: DataFrame, sets: DataFrame, work: Work) -> DataFrame:
    """(pivot, id, both, either) for distinct pairs, each side's set looked up; a hot pivot is sent to each block of its partners."""
    sizes = work.cut(pairs.groupBy("pivot").agg(F.ceil(F.count("*") / _BLOCK).cast("int").alias("blocks")), "sizes", few=True)
    p = pairs.join(sizes, "pivot").select("pivot", "id", F.pmod(F.hash("id"), F.col("blocks")).alias("block"))
    wanted = sizes.select("pivot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    left = wanted.join(sets.select(F.col("id").alias("pivot"), F.col("members").alias("left")), "pivot")
    right = p.join(sets.select("id", F.col("members").alias("right")), "id")
    both = right.join(left, ["pivot", "block"]).select("pivot", "id", "left", "right")
    return work.cut(both.mapInArrow(_overlap, "pivot long, id long, both long, either long"), "compared")


def _placed(entries: DataFrame, work: Work) -> DataFrame:
    """(bucket, id, pivot, n, marks) of buckets of two or more entries; of buckets that hold the same entries, one."""
    buckets = entries.select("id", F.explode("bands").alias("bucket"))
    shared = work.cut(buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "shared", few=True)
    held = work.cut(buckets.join(shared, "bucket"), "held", few=True)
    one = held.groupBy("bucket", "n").agg(
        F.min("id").alias("pivot"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(7))).alias("y")
    )
    one = one.groupBy("pivot", "n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "pivot")
    placed = work.cut(held.join(work.cut(one, "chosen", few=True), "bucket"), "kept", few=True)
    return work.cut(placed.join(entries.select("id", *MARKS), "id"), "placed", few=True)


def links(entries: DataFrame, sets_of, s: Settings, work: Work) -> DataFrame:
    """Linked pairs (a, b) that join the entries (id, bands, marks) into their components.

    ``sets_of`` takes ids and returns their (id, members), and maybe those of other ids.
    """
    placed = _placed(entries, work)
    work.drop(keep=("signed", "classes", "placed"))
    # A low hash is low in every bucket of its size, so that buckets of one group share pivots.
    low = F.pmod(F.xxhash64("id"), F.lit(1 << 31)) * F.col("n") < F.lit(PIVOTS << 31)
    placed = placed.withColumn("is_pivot", (F.col("id") == F.col("pivot")) | low)
    pivots = placed.where("is_pivot").select("bucket", F.col("id").alias("with"), *[F.col(m).alias(f"with_{m}") for m in MARKS])
    near = _agree([F.col(m) for m in MARKS], [F.col(f"with_{m}") for m in MARKS]) >= _least(s)
    pairs = placed.select("bucket", "id", *MARKS).join(pivots, "bucket").where("id <> with").where(near)
    pairs = work.cut(pairs.select(F.least("id", "with").alias("pivot"), F.greatest("id", "with").alias("id")).distinct(), "pairs", few=True)
    ids = pairs.select(F.explode(F.array("pivot", "id")).alias("id")).distinct()
    have = work.cut(sets_of(ids), "sets")
    compared = _compare(pairs, have, work)
    found = work.cut(compared.where(F.col("both") * 100 >= F.col("either") * s.percent).select(F.col("pivot").alias("a"), F.col("id").alias("b")), "found", few=True)
    roots = work.cut(graph.components(found, work), "roots", few=True)
    rest = placed.where("not is_pivot").select("pivot", "id", *MARKS).distinct()
    rest = work.cut(rest.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")), "rest", few=True)

    def sets(wanted: DataFrame) -> DataFrame:
        more = work.cut(wanted.join(have.select("id"), "id", "left_anti"), "more", few=True)
        return have if more.isEmpty() else have.unionByName(work.cut(sets_of(more), "more-sets"))

    return found.unionByName(_finish(rest, sets, s, work))


def near_duplicates(docs: DataFrame, s: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each document."""
    if s.hashes != 64:
        raise ValueError("an entry's marks are two bits of each of 64 hashes' two values")
    spark = docs.sparkSession
    work = Work(spark, "minmax")
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    marks = ", ".join(f"{m} long" for m in MARKS)
    signed = work.cut(texts.mapInArrow(lambda b: _signatures(b, s), f"doc_id long, n long, k1 long, k2 long, {marks}, bands array<long>"), "signed")
    some = signed.where("n > 0 and doc_id is not null")
    classes = work.cut(some.groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("id")), "classes", few=True)
    # The bands of a class are those of its first document.
    entries = signed.select(F.col("doc_id").alias("id"), *MARKS, "bands").join(classes.select("id"), "id", "left_semi").dropDuplicates(["id"])
    entries = work.cut(entries, "entries")

    def sets_of(ids: DataFrame) -> DataFrame:
        # Texts aren't shuffled: a filter in the scan lets all wanted ids through, and few others, whose sets no join takes.
        seen = spark.sparkContext.broadcast(_filter(ids))
        chosen = texts.where("doc_id is not null").select("doc_id", "text", _slot("doc_id").alias("slot"))
        return chosen.mapInArrow(lambda b: _sets(_seen(b, seen.value), s), "id long, members binary").dropDuplicates(["id"])

    found = links(entries, sets_of, s, work)
    roots = work.cut(graph.components(found, work), "components", few=True)
    work.drop(keep=("signed", "classes", "components"))
    named = work.cut(classes.join(roots, "id", "left").select("k1", "k2", "n", F.coalesce("root", "id").alias("root")), "named", few=True)
    work.drop(keep=("signed", "named"))
    out = signed.select("doc_id", "n", "k1", "k2").join(named, ["k1", "k2", "n"], "left")
    component = F.coalesce(F.when(F.col("n") > 0, F.col("root")), F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
