"""Substring deduplication by recompression.

A text's words are named, and rounds replace runs of one symbol and pairs of
neighbouring symbols by new symbols.  A pair is replaced if a coin of its left
symbol shows heads and one of its right symbol tails, so pairs never overlap and
a decision needs the two symbols alone.  Names are fingerprints of what they
stand for: all tasks name equal runs and pairs alike without exchanging a table,
and equal symbols mean equal words.  So occurrences of one substring are cut
alike inside; only at their ends may a symbol reach out.

For each window of ``window`` words the part that is cut alike wherever the window
stands is known at each round: where its first symbol might be taken by a
neighbour outside, the part begins after that symbol, and so at its end.  A window's
anchor is a symbol of that part after the last round: of the wide ones, the one
of the least scrambled name, so that neighbouring windows share it.  If nothing
is left by then, it is the first symbol after the last round that left one.  Equal
windows have equal anchors, at any place, so only windows whose anchor is
shared by documents are looked at:

1. Neighbouring windows of one anchor are a segment, with the name of all its words.
   A Spark round groups segments by anchor: those of one document alone go.
2. Where all segments of an anchor have one name, the first document keeps it.
   Elsewhere segments are grouped by anchor and name, and the first document
   of each name stands for it.
3. Windows of those, and of no others, are named and grouped one by one.

Names are 64 bits; a match needs the anchor's name and the segment's or window's
to agree, 128 bits in all.

Words covered by a window that also starts in a document with a smaller id are
removed.  A null or empty text has no words, a text shorter than a window no
windows.  A row without id has no place in the order: it loses nothing and takes
nothing.  Rows of one id are one document, and are expected to have one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packhouse.llm import text as X
from packhouse.llm.work import Work


@dataclass(frozen=True)
class Settings:
    """Words in a window, rounds (r: runs, p: pairs), the most words of a symbol that is still replaced, and the least of a wide one."""

    window: int = 50
    rounds: str = "rppppp"
    widest: int = 8
    wide: int = 4


class _Symbols:
    """Symbols of a chunk's words; none spans two rows."""

    def __init__(self, name: np.ndarray, row: np.ndarray):
        self.row = row
        self.name = name
        self.start = np.arange(len(name))
        self.end = self.start + 1
        self.by_start = np.arange(len(name) + 1)
        self.by_end = np.arange(-1, len(name))

    def replaced(self, head: np.ndarray, name: np.ndarray, words: int) -> _Symbols:
        """The symbols whose first parts are ``head``."""
        out = object.__new__(_Symbols)
        out.row = self.row
        out.name = name
        out.start = self.start[head]
        out.end = np.append(out.start[1:], words)
        out.by_start = np.zeros(words + 1, np.int64)
        out.by_start[out.start] = np.arange(len(head))
        out.by_end = np.zeros(words + 1, np.int64)
        out.by_end[out.end] = np.arange(len(head))
        return out


def _anchors(name: np.ndarray, row: np.ndarray, at: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """For the windows starting at words ``at``: where the anchor starts, and its name (mixed with its round)."""
    n = len(name)
    sym = _Symbols(name, row)
    lo, hi = at.copy(), at + s.window
    place, anchor = lo.copy(), name[lo].copy()
    live = np.arange(len(at))
    same_row = lambda x: row[x.start[1:]] == row[x.start[:-1]]
    salt = X.seeds(len(s.rounds) + 1, 41)
    for k, kind in enumerate(s.rounds):
        if not len(live) or len(sym.name) < 2:
            break
        first, last = sym.by_start[lo[live]], sym.by_end[hi[live]]
        if kind == "r":
            joined = (sym.name[1:] == sym.name[:-1]) & same_row(sym)
            head = np.flatnonzero(np.append(True, ~joined))
            run = np.cumsum(np.append(True, ~joined)) - 1
            run_end = sym.end[np.append(head[1:], len(sym.name)) - 1]
            # The run at either end may go on outside.
            lo[live] = np.minimum(run_end[run[first]], hi[live])
            hi[live] = np.maximum(sym.start[head[run[last]]], lo[live])
            count = np.diff(np.append(head, len(sym.name)))
            fits = (count > 1) & (run_end - sym.start[head] <= 2 * s.widest)
            whole = np.where(fits[run], np.append(True, ~joined), True)
            head = np.flatnonzero(whole)
            named = sym.name[head]
            times = np.diff(np.append(head, len(sym.name))).astype(np.uint64)
            named = np.where(times > 1, X.mix(named * np.uint64(3) + times + salt[k]), named)
        else:
            active = sym.end - sym.start <= s.widest
            heads = (X.mix(sym.name ^ salt[k]) & np.uint64(1)) == 0
            left, right = active & heads, active & ~heads
            lo[live] = np.where(right[first], sym.end[first], lo[live])
            hi[live] = np.where(left[last], sym.start[last], hi[live])
            taken = np.append(left[:-1] & right[1:] & same_row(sym), False)
            head = np.flatnonzero(~np.append(False, taken[:-1]))
            named = sym.name[head]
            both = taken[head]
            j = head[both]
            named = named.copy()
            named[both] = X.mix(sym.name[j] * np.uint64(5) + sym.name[j + 1] * np.uint64(0x9E3779B97F4A7C15) + salt[k])
        sym = sym.replaced(head, named, n)
        live = live[lo[live] < hi[live]]
        place[live] = lo[live]
        anchor[live] = X.mix(sym.name[sym.by_start[lo[live]]] + salt[k + 1])
    if len(live):
        chosen = _least(sym, sym.by_start[lo[live]], sym.by_end[hi[live]], s)
        place[live] = sym.start[chosen]
        anchor[live] = X.mix(sym.name[chosen] + salt[0])
    return place, anchor


def _least(sym: _Symbols, first: np.ndarray, last: np.ndarray, s: Settings) -> np.ndarray:
    """Of the symbols first..last of each window, the wide one of the least scrambled name; the first of equal ones."""
    value = (X.mix(sym.name ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(1)) | ((sym.end - sym.start < s.wide).astype(np.uint64) << np.uint64(63))
    size = last - first + 1
    best = np.empty(len(first), np.int64)
    table = np.arange(len(value))
    step = 1
    while True:
        # table[i]: the least of the symbols i .. i + step - 1.
        now = (size >= step) & (size < 2 * step)
        if now.any():
            a, b = table[first[now]], table[last[now] - step + 1]
            best[now] = np.where(value[b] < value[a], b, a)
        if 2 * step > size.max():
            return best
        a, b = table[:-step], table[step:]
        table = np.where(value[b] < value[a], b, a)
        step *= 2


class _Hash:
    """Names of word sequences of a chunk."""

    def __init__(self, name: np.ndarray):
        n = len(name)
        powers, inverse, _ = X._Tables.get()
        if n >= len(powers):
            powers, inverse = X._powers(X._BASE, n + 1), X._powers(X._BASE_INV, n + 1)
        self.inverse = inverse
        self.sum = np.zeros(n + 1, np.uint64)
        np.cumsum(name * powers[:n], out=self.sum[1:])

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return X.mix((self.sum[hi] - self.sum[lo]) * self.inverse[lo] + (hi - lo).astype(np.uint64))


def segments(w: X.Words, s: Settings) -> tuple[np.ndarray, ...]:
    """(row, start, windows, anchor, words): runs of windows with one anchor, start counted in the row."""
    row = w.rows()
    n = len(w.name)
    if n < s.window:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, np.uint64),) * 2
    at = np.flatnonzero(row[: n - s.window + 1] == row[s.window - 1 :])
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, np.uint64),) * 2
    with np.errstate(over="ignore"):
        place, anchor = _anchors(w.name, row, at, s)
        new = np.ones(len(at), bool)
        new[1:] = (place[1:] != place[:-1]) | (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(at)))
        begin = at[head]
        words = X.mix(_Hash(w.name)(begin, begin + count + s.window - 1) + (place[head] - begin).astype(np.uint64))
    return row[begin], begin - w.first[row[begin]], count, anchor[head], words


def _segment_rows(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for c in X.chunks(b.column(1)):
            row, start, count, anchor, words = segments(X.words(c), s)
            ids = b.column(0).slice(c.lo, c.hi - c.lo)
            yield pa.RecordBatch.from_arrays(
                [pa.array(X.as_long(anchor)), pa.array(X.as_long(words)), ids.take(pa.array(row)), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))],
                ["anchor", "words", "doc_id", "start", "windows"],
            )


def _window_rows(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """(name, anchor, doc_id, start) of the windows of listed segments; columns doc_id, text, parts."""
    for b in batches:
        for c in X.chunks(b.column(1)):
            w = X.words(c)
            with np.errstate(over="ignore"):
                h = _Hash(w.name)
                parts = b.column(2).slice(c.lo, c.hi - c.lo)
                flat = parts.flatten()
                each = np.diff(np.asarray(parts.offsets if parts.offset == 0 else parts.offsets))
                row = np.repeat(np.arange(len(each)), each)
                start, count, anchor = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                rel = np.repeat(start, count).astype(np.int64) + inner
                of = np.repeat(row, count)
                at = rel + w.first[of]
                name = h(at, at + s.window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(X.as_long(name)), pa.array(np.repeat(anchor, count)), b.column(0).slice(c.lo, c.hi - c.lo).take(pa.array(of)), pa.array(rel.astype(np.int32))],
                ["name", "anchor", "doc_id", "start"],
            )


def covered(docs: DataFrame, s: Settings, work: Work) -> DataFrame:
    """(doc_id, spans): covered words of each document that loses some, as structs (lo, hi)."""
    texts = docs.where("doc_id is not null")
    found = work.cut(
        texts.mapInArrow(lambda b: _segment_rows(b, s), "anchor long, words long, doc_id long, start int, windows int"), "segments"
    )
    shared = (
        found.groupBy("anchor")
        .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), (F.min("words") != F.max("words")).alias("mixed"))
        .where("lo < hi")
        .drop("hi")
    )
    some = work.cut(found.join(work.cut(shared, "anchors"), "anchor").where("mixed or doc_id > lo"), "shared")

    def span(first, windows):
        return F.struct(first.alias("lo"), (first + windows + (s.window - 1)).alias("hi")).alias("span")

    whole = some.where("not mixed").select("doc_id", span(F.col("start"), F.col("windows")))
    mixed = some.where("mixed").drop("lo", "mixed")
    leaders = work.cut(mixed.groupBy("anchor", "words").agg(F.min("doc_id").alias("leader")), "leaders")
    led = work.cut(mixed.join(leaders, ["anchor", "words"]), "led")
    followers = led.where("doc_id > leader").select("doc_id", span(F.col("start"), F.col("windows")))
    parts = led.where("doc_id = leader").groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows", "anchor")).alias("parts"))
    windows = texts.join(parts, "doc_id").select("doc_id", "text", "parts")
    windows = work.cut(windows.mapInArrow(lambda b: _window_rows(b, s), "name long, anchor long, doc_id long, start int"), "windows")
    firsts = windows.groupBy("name", "anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").drop("hi")
    later = windows.join(work.cut(firsts, "firsts"), ["name", "anchor"]).where("doc_id > lo")
    ones = later.select("doc_id", span(F.col("start"), F.lit(1)))
    return whole.unionByName(followers).unionByName(ones).groupBy("doc_id").agg(F.collect_set("span").alias("spans"))


def _kept(text: bytes, spans) -> tuple[int, int, list[bytes]]:
    """Words, words removed, and the words that stay."""
    split = text.split()
    if not spans:
        return len(split), 0, split
    edge = np.zeros(len(split) + 1, np.int64)
    lo = np.array([x["lo"] for x in spans])
    hi = np.minimum(np.array([x["hi"] for x in spans]), len(split))
    np.add.at(edge, lo[lo < len(split)], 1)
    np.add.at(edge, hi[lo < len(split)], -1)
    gone = np.cumsum(edge[:-1]) > 0
    return len(split), int(gone.sum()), [x for x, g in zip(split, gone.tolist()) if not g]


def deduplicate(docs: DataFrame, s: Settings = Settings(), key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), kept_text: bool = False) -> DataFrame:
    """(doc_id, kept columns, n_words, n_removed, kept_sha256), a row for each row.

    With ``kept_text`` also kept_text: the words that stay, joined by one space, or the text itself if it loses none.
    """
    work = Work(docs.sparkSession, "recompress")
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)])
    spans = covered(texts.select("doc_id", "text"), s, work)
    both = texts.join(work.cut(spans, "spans"), "doc_id", "left")
    others = [f"kept_{i}" for i in range(len(keep))]
    both = both.select("doc_id", "text", "spans", *others)
    names = ["doc_id", *others, "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * kept_text
    ddl = ", ".join(["doc_id long", *(f"{c} {both.schema[c].dataType.simpleString()}" for c in others), "n_words long, n_removed long, kept_sha256 string"] + ["kept_text string"] * kept_text)

    def run(batches):
        for b in batches:
            total, lost, sums, left = [], [], [], []
            for raw, spans in zip(b.column(1).cast(pa.binary()), b.column(2)):
                own = raw.as_py() or b""
                n, gone, words = _kept(own, spans.as_py())
                stay = b" ".join(words)
                total.append(n)
                lost.append(gone)
                sums.append(hashlib.sha256(stay).hexdigest())
                if kept_text:
                    left.append((stay if gone else own).decode("utf-8", "replace"))
            out = [b.column(0), *(b.column(3 + i) for i in range(len(keep))), pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(sums, pa.string())]
            yield pa.RecordBatch.from_arrays(out + [pa.array(left, pa.string())] * kept_text, names)

    out = both.mapInArrow(run, ddl)
    return out.select("doc_id", *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)], *names[1 + len(keep) :])
