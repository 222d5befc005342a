"""SentencePiece encoding over a lattice, and decoding.

A text's spaces become U+2581, one is put in front, and it is cut into units
where no piece spans the cut: before a run of U+2581, around line feeds and
tabs, and between a letter and punctuation that no piece has after one.
The lattice of many units is made and folded at once: from each place the prefixes of
pieces are followed, a character at a time, to the substrings that are pieces, and
then the units' first places, second places and so on take the
highest summed score that reaches them, whose last pieces are walked back.  Of paths that tie at a place, the one with
the longer last piece stays.  A character without a piece is spelled as bytes.

Scores are the piece table's.  So the result is the library's own encoding of the
table as a unigram model.  For a table of merges the library applies merges
greedily instead, and its ids may differ; decoding is the same, and gives back
the text exactly.

Units of a bounded list, the most frequent of a sample, are folded once and
looked up.  Texts are dealt to blocks of a few megabytes, and the units of a block that aren't
on the list are folded once for the block; they meet its texts in the task that holds both, so that texts are
shuffled once.  The list and the blocks change no result.

A null text is empty and has no pieces; an empty table gives no rows.  U+2581 in a text is read back as a
space, as the format has it.  Rows go to blocks by their number, so that copies, null keys
and repeated ones spread like others.  A very long unit (a text without spaces) has to fit into a task with its
lattice, of some 150 bytes a character.  Other columns aren't read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packhouse.llm.work import Work

SPACE = "▁"


@dataclass(frozen=True)
class Settings:
    """Texts in the sample for the list of frequent units, its length, and bytes of text in a block."""

    sample: int = 1 << 15
    frequent: int = 1 << 19
    block_bytes: int = 8 << 20


@dataclass(frozen=True)
class Table:
    """Pieces by id, their scores, the ids of bytes, and the id of the unknown piece."""

    pieces: tuple[tuple[str, int, float], ...]
    bytes: tuple[int, ...]
    longest: int
    unknown: float
    shown: tuple[str | int, ...]

    @staticmethod
    def load(path: str) -> Table:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        normal, spelled, shown = [], {}, []
        for i, p in enumerate(model.pieces):
            if p.type == p.BYTE:
                spelled[int(p.piece[3:5], 16)] = i
                shown.append(int(p.piece[3:5], 16))
            elif p.type == p.NORMAL:
                normal.append((p.piece, i, p.score))
                shown.append(p.piece)
            else:
                shown.append("")
        if len(spelled) != 256:
            raise ValueError("the model has no pieces for bytes")
        return Table(
            tuple(normal), tuple(spelled[b] for b in range(256)), max(len(p) for p, _, _ in normal), min(s for _, _, s in normal) - 10, tuple(shown)
        )

    def unit_pattern(self) -> str:
        """Units as a regular expression, by what pieces have inside."""
        inner = "".join(p for p, _, _ in self.pieces)
        breaks = "".join(c for c in "\n\t" if c not in inner)
        after = {m for p, _, _ in self.pieces for m in re.findall(r"(?<=[^\W\d_])[!-/:-@\[-`{-~]", p)}
        marks = "".join(f"\\{c}" for c in "!\"#$%&*+,./:;<=>?@|~" if c not in after)
        plain = f"[^{SPACE}{breaks}]"
        ends = f"{SPACE}*\\p{{L}}+(?=[{marks}])|" if marks else ""
        return f"{ends}{SPACE}+{plain}*|{plain}+|[{breaks}]" if breaks else f"{ends}{SPACE}+{plain}*|{plain}+"


def units(text: Column, table: Table) -> Column:
    """The units of a text, in order."""
    marked = F.when(F.length(text) > 0, F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE)))).otherwise(F.lit(""))
    return F.regexp_extract_all(marked, F.lit(table.unit_pattern()), F.lit(0))


# Code points of units that are folded together.
_FOLDED = 1 << 16


@dataclass(frozen=True)
class Prefixes:
    """Prefixes of pieces, numbered from the empty one, 0; the last number is that of a character without a piece.

    ``step`` holds, sorted, a prefix's number times 2^21 plus a code point, ``to`` the number of the prefix they give.
    By number: the piece's id (-1: no piece) and its score (minus infinity: no piece).
    """

    step: np.ndarray
    to: np.ndarray
    id: np.ndarray
    score: np.ndarray
    longest: int

    @staticmethod
    def of(table: Table) -> Prefixes:
        number = {"": 0}
        for p, _, _ in table.pieces:
            for n in range(1, len(p) + 1):
                number.setdefault(p[:n], len(number))
        ids, score = np.full(len(number) + 1, -1, np.int64), np.full(len(number) + 1, -np.inf)
        # Of a piece listed twice, the better score stays, and of equal ones the smaller id.
        for p, i, value in sorted(table.pieces, key=lambda x: (x[2], -x[1])):
            ids[number[p]], score[number[p]] = i, value
        score[-1] = table.unknown
        step = np.array([number[p[:-1]] << 21 | ord(p[-1]) for p in number if p], np.int64)
        order = np.argsort(step)
        return Prefixes(step[order], np.arange(1, len(number))[order], ids, score, table.longest)


def _lattice(points: np.ndarray, last: np.ndarray, known: Prefixes) -> np.ndarray:
    """The prefix number of each piece (0: none), by length, longest first, and by the place where it ends.

    A place is a code point's; each unit has one more in front, and ``longest`` places come before all units.
    ``last`` is the last place of a place's unit.
    """
    made = np.zeros((known.longest, len(points)), np.int32)
    at = np.flatnonzero(np.arange(len(points)) < last)
    node = np.zeros(len(at), np.int64)
    made[-1, at + 1] = len(known.id) - 1
    for length in range(1, known.longest + 1):
        key = node << 21 | points[at + length]
        found = np.minimum(np.searchsorted(known.step, key), len(known.step) - 1)
        hit = known.step[found] == key
        at, node = at[hit], known.to[found[hit]]
        named = known.id[node] >= 0
        made[known.longest - length, at[named] + length] = node[named]
        more = at + length < last[at]
        at, node = at[more], node[more]
    return made


def _paths(units_: list[str], known: Prefixes) -> Iterator[list[int]]:
    """Ids of the best path of each unit, the longest unit first; a character without a piece is -1 minus its code point."""
    size = np.array([len(u) for u in units_], np.int64)
    front = "\0" * known.longest
    points = np.frombuffer((front + "".join(["\0" + u for u in units_])).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    first = known.longest + np.cumsum(size + 1) - (size + 1)
    made = _lattice(points, np.concatenate([np.zeros(known.longest, np.int64), np.repeat(first + size, size + 1)]), known)
    best, row = np.zeros(len(points)), np.zeros(len(points), np.int64)
    lengths = np.arange(known.longest, 0, -1)[:, None]
    # Units that have a place of that number come first.
    many = np.searchsorted(-size, -np.arange(size[0] + 1), side="right").tolist()
    for place in range(1, int(size[0]) + 1):
        ends = first[: many[place]] + place
        # Of equal sums argmax takes the first, that of the longest last piece.
        sums = best[ends - lengths] + known.score[made[:, ends]]
        top = sums.argmax(axis=0)
        best[ends], row[ends] = sums[top, np.arange(len(ends))], top
    node = made[row, np.arange(len(points))]
    ids = np.where(node == len(known.id) - 1, -1 - points, known.id[node]).tolist()
    back = (known.longest - row).tolist()
    for lo, n in zip(first.tolist(), size.tolist()):
        out, at = [], lo + n
        while at > lo:
            out.append(ids[at])
            at -= back[at]
        out.reverse()
        yield out


def fold(names: list[str], known: Prefixes) -> Iterator[tuple[str, list[int]]]:
    """(unit, ids of its best path) of distinct units, in another order; some of about a length are folded together."""
    names = sorted(names, key=len, reverse=True)
    lo, size = 0, 0
    for hi, name in enumerate(names):
        if size and size + len(name) > _FOLDED:
            yield from zip(names[lo:hi], _paths(names[lo:hi], known))
            lo, size = hi, 0
        size += len(name) + 1
    if names:
        yield from zip(names[lo:], _paths(names[lo:], known))


def _spelled(ids, table: Table) -> list[int]:
    """Ids with characters without a piece as bytes."""
    out: list[int] = []
    for i in ids:
        out += [i] if i >= 0 else [table.bytes[b] for b in chr(-1 - i).encode("utf-8", "surrogatepass")]
    return out


def decode(ids, table: Table) -> str:
    """The text of ids: spaces put back, without the one in front."""
    text = spoken(ids, table).replace(SPACE, " ")
    return text[1:] if text.startswith(" ") else text


def spoken(ids, table: Table) -> str:
    """Pieces and bytes in a row."""
    shown, out, spell = table.shown, [], bytearray()
    for i in ids:
        p = shown[i]
        if isinstance(p, int):
            spell.append(p)
            continue
        if spell:
            out.append(spell.decode("utf-8", "replace"))
            spell = bytearray()
        out.append(p)
    out.append(spell.decode("utf-8", "replace"))
    return "".join(out)


def _read_units(names: list[str], table: Table, known: Prefixes) -> pa.RecordBatch:
    """(unit, ids, read): a unit's ids as little-endian 32-bit numbers, and the text these stand for where it is another than the unit."""
    found, raw, read = [], [], []
    for unit, path in fold(names, known):
        ids = _spelled(path, table)
        found.append(unit)
        raw.append(np.array(ids, "<i4").tobytes())
        said = spoken(ids, table)
        read.append(None if said == unit else said)
    return pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(raw, pa.binary()), pa.array(read, pa.string())], ["unit", "ids", "read"])


def _look_up(names: pa.Array, listed: pa.Table, here: pa.RecordBatch) -> tuple[list[bytes], list[str]]:
    """Ids and text of each unit, from the list or the block's own units."""
    raw, read, shown = [None] * len(names), [None] * len(names), names.to_pylist()
    for part in (listed, here):
        if not len(part):
            continue
        place = pc.index_in(names, value_set=part["unit"])
        at = np.flatnonzero(place.is_valid().to_numpy(zero_copy_only=False)).tolist()
        own = place.drop_null()
        for i, r, t in zip(at, part["ids"].take(own).to_pylist(), part["read"].take(own).to_pylist()):
            raw[i], read[i] = r, t
    return raw, [u if t is None else t for u, t in zip(shown, read)]


def frequent_units(docs: DataFrame, table: Table, known: Broadcast, s: Settings) -> pa.Table:
    """(unit, ids, read) of the most frequent units of a sample, at most ``frequent`` of them: all above a count."""
    every = max(1, docs.count() // s.sample)
    few = docs.where(F.pmod(F.xxhash64("key", "text"), F.lit(every)) == 0).select(F.explode(units(F.col("text"), table)).alias("unit"))
    counted = Work(docs.sparkSession, "pieces").cut(few.groupBy("unit").count(), "counted")
    # One row for each count that occurs; they go up by one at least, so there are few.
    least, held = None, 0
    for times, n in counted.groupBy("count").agg(F.count(F.lit(1))).orderBy(F.desc("count")).collect():
        held += n
        if held > s.frequent:
            break
        least = times
    top = counted.where(F.lit(False) if least is None else F.col("count") >= least).select("unit")
    dealt = top.repartition(2 * docs.sparkSession.sparkContext.defaultParallelism, "unit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _read_units(b.column(0).to_pylist(), *known.value)

    return dealt.mapInArrow(run, "unit string, ids binary, read string").toArrow().combine_chunks()


def encode(docs: DataFrame, path: str, s: Settings = Settings(), key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """(key, n_pieces, ids_sha256, decoded_sha256, round_trip), with ``ids`` also the ids, a row for each row.

    ids_sha256 is that of the ids as little-endian 32-bit numbers, decoded_sha256 that of the decoded text.
    """
    spark = docs.sparkSession
    work = Work(spark, "pieces")
    table = Table.load(path)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    known = spark.sparkContext.broadcast((table, Prefixes.of(table)))
    listed = frequent_units(rows, table, known, s)
    frequent = work.cut(spark.createDataFrame(listed.select(["unit"])).coalesce(1), "frequent")
    shared = spark.sparkContext.broadcast(listed)

    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // s.block_bytes))
    # Any deal will do, as a row needs its own text only: rows go by their number, so that copies spread as others do.
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))
    dealt = rows.withColumn("block", block).repartition(blocks, "block")
    # The key comes along, so that both sides read the same columns and the texts are shuffled once for both.
    own = dealt.select("block", F.xxhash64("key").alias("seen"), F.explode(units(F.col("text"), table)).alias("unit"))
    rare = own.join(F.broadcast(frequent), "unit", "left_anti").groupBy("block", "unit").agg(F.max("seen").alias("seen"))
    rare = rare.withColumnRenamed("block", "of_block")
    whole = dealt.select("block", "key", units(F.col("text"), table).alias("units"), "text")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        here = _read_units(right.column("unit").to_pylist(), *known.value)
        n, sums, texts, same, lists = [], [], [], [], []
        lists_ = left.column("units").combine_chunks()
        coded, ends = lists_.flatten().dictionary_encode(), np.cumsum(lists_.value_lengths().to_numpy(zero_copy_only=False)).tolist()
        of, (named, shown) = coded.indices.to_numpy(), _look_up(coded.dictionary, shared.value, here)
        for text, lo, hi in zip(left.column("text"), [0, *ends], ends):
            parts = of[lo:hi].tolist()
            raw = b"".join([named[u] for u in parts])
            read = "".join([shown[u] for u in parts]).replace(SPACE, " ")
            read = read[1:] if read.startswith(" ") else read
            n.append(len(raw) // 4)
            sums.append(hashlib.sha256(raw).hexdigest())
            texts.append(hashlib.sha256(read.encode()).hexdigest())
            same.append(read == text.as_py())
            if ids:
                lists.append(np.frombuffer(raw, "<i4"))
        cols = [left.column("key"), pa.array(n, pa.int64()), pa.array(sums, pa.string()), pa.array(texts, pa.string()), pa.array(same, pa.bool_())]
        return pa.table(cols + [pa.array(lists, pa.list_(pa.int32()))] * ids, names)

    names = ["key", "n_pieces", "ids_sha256", "decoded_sha256", "round_trip"] + ["ids"] * ids
    schema = f"key {kind}, n_pieces long, ids_sha256 string, decoded_sha256 string, round_trip boolean" + ", ids array<int>" * ids
    out = whole.groupBy("block").cogroup(rare.groupBy("of_block")).applyInArrow(run, schema)
    return out.withColumnRenamed("key", key)
