"""Conversation prefix trie: shared beginnings of conversations, with totals over subtrees.

A node is a distinct sequence of first d turns (role, text) of any conversation; the root, d = 0, has no turn.  It is
named by a key: sums over its turns of 60-bit hashes of (depth, role, text), so that prefixes of a conversation are
running sums, which can be worked out block by block however long the conversation is.

``Trie`` holds the tables; ``totals`` sums a weight over each node's subtree by depth bands:

1. Depths are cut into bands of ``band`` levels.  A node adds its weight to its band's root.
2. Band roots form a trie of their own, ``band`` times less deep, in which the same is done, until one band is left.
   That completes the totals of all band roots.
3. A completed band root adds its total to its parent, and each node explodes to its ancestors inside its band only.

So a trie of depth D takes log(D) / log(band) rounds, and a node at most ``band`` rows in each.

Odd input: rows are ordered by turn (null first), then role, then text, so that ties have one order; a repeated row is a
turn of its own.  A null role or text is ''.  Rows without conv_id belong to no conversation and are left out.  A
conversation without turns (given in ``ids`` alone) belongs to the root.  No conversations, no rows.  Other columns
aren't read.  Texts are hashed in the scan and don't travel further than the numbering of turns.

Hot groups: a conversation of any length is numbered in slices and summed in blocks, common prefixes are counted
map-side, children are summed by parent before any join, and the ids that end at one node are joined to chunks by many
tasks; only the chunks are read in order by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packhouse.llm.work import Work
from packhouse.operators.slices import numbered

_BLOCK = 4096
_CHUNK = 1 << 16
_NUMBER = "decimal(20,0)"
_SUM = "decimal(38,0)"
NOBODY = hashlib.sha256(b"").hexdigest()


def turns(rows: DataFrame) -> DataFrame:
    """(conv_id, place, turn_hash, bytes): each turn's place in its conversation, from 1, and a hash of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    plain = rows.where("conv_id is not null").select("conv_id", "turn", role, text)
    placed = numbered(plain, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()], "place")
    said = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return placed.select("conv_id", "place", F.sha2(said, 256).alias("turn_hash"), F.octet_length("text").cast("long").alias("bytes"))


def _part(of: str, at: int) -> Column:
    return F.conv(F.substring(of, at, 15), 16, 10).cast(_NUMBER)


def _key(depth: Column, *sums: Column) -> Column:
    return F.md5(F.concat_ws(",", depth.cast("string"), *[s.cast(_SUM).cast("string") for s in sums]).cast("binary"))


def _running(steps: DataFrame) -> DataFrame:
    """Running sums of ``h1`` and ``h2`` by depth: inside blocks of a conversation, then with the blocks before."""
    blocks = steps.withColumn("block", F.floor(F.col("depth") / _BLOCK))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.groupBy("conv_id", "block").agg(*[F.sum(f"h{i}").cast(_SUM).alias(f"h{i}") for i in (1, 2)])
    before = sums.select("conv_id", "block", *[F.coalesce(F.sum(f"h{i}").over(earlier), F.lit(0)).cast(_SUM).alias(f"before{i}") for i in (1, 2)])
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocks.withColumns({f"inside{i}": F.sum(f"h{i}").over(inside).cast(_SUM) for i in (1, 2)})
        .join(before, ["conv_id", "block"])
        .withColumns({f"s{i}": (F.col(f"inside{i}") + F.col(f"before{i}")).cast(_SUM) for i in (1, 2)})
    )


class Trie:
    """``paths`` (conv_id, depth, key, parent, bytes), a row for each prefix of each conversation, and ``nodes``.

    ``steps``: (conv_id, depth, turn_hash, bytes), depths 1, 2, ... of each conversation; ``ids``: conv_id of all of
    them, each once.
    """

    def __init__(self, steps: DataFrame, ids: DataFrame, band: int = 16):
        if band < 2:
            raise ValueError("a band has two levels at least")
        self.band = band
        self.work = Work(steps.sparkSession, "trie")
        zero = F.lit(0).cast(_SUM)
        hashed = steps.withColumn("tagged", F.sha2(F.concat_ws(":", F.col("depth").cast("string"), "turn_hash"), 256))
        hashed = hashed.select("conv_id", "depth", "bytes", _part("tagged", 1).alias("h1"), _part("tagged", 16).alias("h2"))
        s, h = [F.col("s1"), F.col("s2")], [F.col("h1"), F.col("h2")]
        below = _running(hashed).select(
            "conv_id", "depth", _key(F.col("depth"), *s).alias("key"), _key(F.col("depth") - 1, *[a - b for a, b in zip(s, h)]).alias("parent"), "bytes"
        )
        no_turn, none = F.lit(0).cast("long"), F.lit(None).cast("string")
        tops = ids.select("conv_id", no_turn.alias("depth"), _key(no_turn, zero, zero).alias("key"), none.alias("parent"), no_turn.alias("bytes"))
        lengths = steps.groupBy("conv_id").agg(F.max("depth").alias("length"))
        lengths = ids.join(lengths, "conv_id", "left").select("conv_id", F.coalesce("length", F.lit(0)).alias("length"))
        paths = below.unionByName(tops).join(lengths, "conv_id").withColumn("ends", F.col("depth") == F.col("length")).drop("length")
        self.paths = self.work.cut(paths, "paths")
        self.deepest = self.paths.agg(F.max("depth")).first()[0] or 0
        found = self._with_ancestors(self.paths, 0).groupBy("key").agg(
            F.min("conv_id").alias("conv_id"),
            F.first("depth").alias("depth"),
            F.first("parent").alias("parent"),
            F.first("bytes").alias("bytes"),
            F.count(F.lit(1)).alias("n_convs"),
            F.first("ancestors").alias("ancestors"),
        )
        found = self.work.cut(found, "found")
        children = found.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
        self.nodes = self.work.cut(found.join(children, "key", "left").na.fill(0, ["n_children"]), "nodes")

    def _with_ancestors(self, paths: DataFrame, level: int) -> DataFrame:
        """Adds the keys from the top of the band down to the node itself, of depths that are multiples of band^level."""
        step = self.band**level
        up = Window.partitionBy("conv_id", F.floor(F.col("depth") / (step * self.band))).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
        return paths.where(F.col("depth") % step == 0).withColumn("ancestors", F.collect_list("key").over(up))

    def _roots(self, level: int) -> DataFrame:
        """(key, parent, ancestors) of nodes at depths that are multiples of band^level; the parent is that far above."""
        step = self.band**level
        some = self.paths.where(F.col("depth") % step == 0).select("conv_id", "depth", "key")
        above = some.select("conv_id", (F.col("depth") + step).alias("depth"), F.col("key").alias("parent"))
        listed = self._with_ancestors(some, level).join(above, ["conv_id", "depth"], "left")
        return listed.groupBy("key").agg(F.first("parent").alias("parent"), F.first("ancestors").alias("ancestors"))

    def totals(self, weights: DataFrame) -> DataFrame:
        """(key, each weight): sums over subtrees, of the weights (key, ...) that each node has."""
        names = [c for c in weights.columns if c != "key"]
        tree = self.nodes.select("key", "parent", "ancestors").join(weights, "key")
        return self._totals(self.work.cut(tree, "weights"), names, 0)

    def _totals(self, tree: DataFrame, names: list[str], level: int) -> DataFrame:
        def sums(df: DataFrame) -> DataFrame:
            return df.groupBy("key").agg(*[F.sum(n).alias(n) for n in names])

        adds = tree.select("ancestors", *names)
        if self.deepest >= self.band ** (level + 1):
            roots = sums(tree.select(F.element_at("ancestors", 1).alias("key"), *names))
            upper = self.work.cut(self._roots(level + 1).join(roots, "key"), f"roots-{level + 1}")
            done = self.work.cut(self._totals(upper, names, level + 1), f"done-{level + 1}")
            handed = sums(tree.select("key", "parent").join(done, "key").where("parent is not null").select(F.col("parent").alias("key"), *names))
            adds = adds.unionByName(tree.select("key", "ancestors").join(handed, "key").select("ancestors", *names))
        return sums(adds.select(F.explode("ancestors").alias("key"), *names))

    def end_digests(self) -> DataFrame:
        """(key, ends_sha256): digest of the ids, in decimal, ascending, joined by commas, of conversations that end at a node."""
        ends = self.paths.where("ends").select("key", "conv_id")
        dealt = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
        chunks = dealt.mapInArrow(_chunks, "key string, first long, ids string")
        return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key string, ends_sha256 string")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of sorted rows, joined by commas; a chunk holds ids of one node that follow one another."""
    key, ids, size = None, [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key], pa.string()), pa.array([int(ids[0])], pa.int64()), pa.array([",".join(ids)], pa.string())], ["key", "first", "ids"]
        )

    for b in batches:
        for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if ids and (k != key or size >= _CHUNK):
                yield out()
                ids, size = [], 0
            key = k
            ids.append(str(c))
            size += len(ids[-1]) + 1
    if ids:
        yield out()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of sorted chunks, read one after the other."""
    key, state = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([state.hexdigest()], pa.string())], ["key", "ends_sha256"])

    for b in batches:
        for k, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            if k != key:
                if state:
                    yield out()
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
    if state:
        yield out()


def summary(trie: Trie) -> DataFrame:
    """Each node: smallest member, depth, its parent's smallest member, members, children, leaves below, bytes saved, ends."""
    weights = trie.nodes.select(
        "key",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
    )
    parents = trie.nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        trie.nodes.join(trie.totals(weights), "key")
        .join(parents, "parent", "left")
        .join(trie.end_digests(), "key", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NOBODY)).alias("ends_sha256"),
        )
    )


def with_lent_heads(said: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(steps, ids): each conversation c with its first h turns replaced by those of c - c % every, h = crc32(c) % most."""
    ids = said.groupBy("conv_id").agg(F.max("place").alias("own"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    ids = ids.withColumns({"lender": F.col("conv_id") - F.col("conv_id") % every, "h": h})
    lenders = ids.select(F.col("conv_id").alias("lender"), F.col("own").alias("lent"))
    ids = ids.join(lenders, "lender", "left").withColumn("lent", F.least("h", F.coalesce("lent", F.lit(0))))
    heads = said.where(F.col("place") < most).withColumnRenamed("conv_id", "lender").join(ids.select("lender", "conv_id", "lent"), "lender")
    heads = heads.where("place <= lent").withColumn("depth", F.col("place"))
    rest = said.join(ids.select("conv_id", "h", "lent"), "conv_id").where("place > h").withColumn("depth", F.col("place") - F.col("h") + F.col("lent"))
    cols = ["conv_id", "depth", "turn_hash", "bytes"]
    return heads.select(*cols).unionByName(rest.select(*cols)), ids.select("conv_id")
