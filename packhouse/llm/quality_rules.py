"""Quality rules: how much of a text lies in repeated word runs and repeated lines.

Rolling hashes of several run lengths are taken over the words of a whole text
in numpy.  A run found twice in a text covers its words, the first one
included; the rule weighs the characters covered.  A null text counts as empty:
no words, which fails the base rule.  Equal rows get equal results.
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
class Rules:
    """Most of the word characters, in percent, that may lie in repeated runs of n words, and in repeated lines."""

    min_words: int = 50
    max_repeat_words: int = 50
    runs: tuple[tuple[int, int], ...] = ((5, 50), (10, 25))
    max_line_chars: int = 40


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, line_chars long, run_chars array<long>"
_ARROW = pa.schema(
    [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64())]
    + [("n_repeat_words", pa.int64()), ("line_chars", pa.int64()), ("run_chars", pa.list_(pa.int64()))]
)


def _repeated(w: X.Words, row: np.ndarray, n: int) -> np.ndarray:
    """Whether each word of the chunk lies in a run of n words found twice in its row."""
    total = len(w.name)
    covered = np.zeros(total, bool)
    if total < n:
        return covered
    at = np.flatnonzero(row[: total - n + 1] == row[n - 1 :])
    if not len(at):
        return covered
    with np.errstate(over="ignore"):
        name = X.mix(X.grams(w.name, n)[at] + X.seeds(len(w.first), 7)[row[at]])
    order = np.argsort(name)
    same = name[order[1:]] == name[order[:-1]]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    delta = np.zeros(total + 1, np.int32)
    delta[at[twice]] += 1
    delta[at[twice] + n] -= 1
    return np.cumsum(delta[:-1]) > 0


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier one, and their word characters."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    if len(set(lines)) == len(lines):
        return 0, 0
    seen: set[bytes] = set()
    n = chars = 0
    for x in lines:
        if x in seen:
            n += 1
            chars += sum(len(y.decode("utf-8", "replace")) for y in x.split())
        seen.add(x)
    return n, chars


def _measure(b: pa.RecordBatch, rules: Rules, kept: pa.Schema, text: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([*kept, *_ARROW])
    for c in X.chunks(b.column(text)):
        w = X.words(c)
        row = w.rows()
        lead = (c.buf & 0xC0) != 0x80
        points = np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])
        chars = points[w.end] - points[w.start]
        lines = [_lines(c.text(i)) for i in range(c.hi - c.lo)]
        runs = [_sums(np.where(_repeated(w, row, n), chars, 0), w.first) for n, _ in rules.runs]
        out = {
            "n_words": np.diff(w.first).astype(np.int64),
            "word_chars": _sums(chars, w.first),
            "n_symbols": _sums(_SYMBOL[c.buf], c.off),
            "n_dup_lines": [n for n, _ in lines],
            "n_repeat_words": _sums(_repeated(w, row, 3), w.first),
            "line_chars": [n for _, n in lines],
            "run_chars": list(np.stack(runs, axis=1)) if runs else [[]] * len(lines),
        }
        part = b.slice(c.lo, c.hi - c.lo)
        yield X.batch({f.name: part.column(i) for i, f in enumerate(kept)} | out, schema)


def measure(docs: DataFrame, rules: Rules = Rules(), keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns of ``keep``, the counts, base_failed and kept (the verdict of all rules), a row for each row."""
    names = list(dict.fromkeys([*keep, text]))
    part = docs.select(*names)
    kept = part.select(*keep).schema
    at = names.index(text)

    def run(batches):
        for b in batches:
            yield from _measure(b, rules, pa.schema([b.schema.field(i) for i in range(len(keep))]), at)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    out = part.mapInArrow(run, f"{ddl}, {_COLUMNS}")
    base = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_words * F.col("n_words"))
    fine = 100 * F.col("line_chars") <= rules.max_line_chars * F.col("word_chars")
    for i, (_, most) in enumerate(rules.runs):
        fine = fine & (100 * F.col("run_chars")[i] <= most * F.col("word_chars"))
    return out.withColumn("base_failed", base).withColumn("kept", ~base & fine)
