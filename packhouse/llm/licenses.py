"""License scans: winnowed fingerprints find candidate templates, a banded alignment measures what matches.

Words are runs of letters and digits, A-Z lower-cased.  A template's runs of at most
``gram`` words are hashed, and of each ``winnow`` neighbouring hashes at most the least is
kept: any passage of gram + winnow - 1 words shared with a template has a kept
hash.  Where so many words may be changed or left out that no passage of that length need be
left, winnowing keeps more, and the runs are shorter if that isn't enough.  The inverted index of kept hashes is small and goes to all tasks; a text's
runs are looked up in it.

Hits of a template that lie close in the text are one candidate.  Its
surroundings are aligned with the template word by word, in a band around the
diagonals of the hits: a word matched scores 1, a word changed, left out or
put in costs 1.  Of the local alignments with enough of the template the best is taken,
then the best of those beside it, until what lies between has none: a notice
repeated on neighbouring lines is reported each time, with the coverage and the span in words and
in characters of the text.  Where spans of one text overlap, the one with more
matched words stays, then that of the longer template, then the first name, so
that a notice inside a longer license is reported once.

A null or empty text has no match and no row; repeated rows are scanned as often
as they occur.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from packhouse.llm import text as X
from packhouse.llm.license_texts import TEMPLATES
from packhouse.llm.toxicity import tokens


@dataclass(frozen=True)
class Settings:
    gram: int = 3
    winnow: int = 3
    band: int = 8
    least: float = 0.8


@dataclass
class Index:
    """Kept hashes in order, with template and place of each; the words of each template."""

    name: np.ndarray
    template: np.ndarray
    place: np.ndarray
    labels: list[str]
    words: list[np.ndarray]
    # Lengths of the runs.
    sizes: list[int]


def names_of(text: str) -> np.ndarray:
    (c,) = X.chunks(pa.array([text.encode()], pa.large_binary()))
    return tokens(c).name


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places of the least hash of each run of ``width``, the last of equal ones."""
    if len(hashes) <= width:
        return np.array([len(hashes) - 1 - int(np.argmin(hashes[::-1]))]) if len(hashes) else np.zeros(0, np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(hashes, width)
    return np.unique(np.arange(len(runs)) + width - 1 - np.argmin(runs[:, ::-1], axis=1))


def widths(n: int, s: Settings) -> tuple[int, int]:
    """Run length and winnow width for a template of n words: one kept hash at least is left by any changes of words that ``least`` allows."""
    need = math.ceil(s.least * n)
    left = max(1, -(-need // (n - need + 1)))
    gram = min(s.gram, left)
    return gram, max(1, min(s.winnow, left - gram + 1))


def grams_of(name: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Names of a text's runs of all the index's lengths, and their places."""
    runs = [X.grams(name, k) for k in index.sizes]
    return np.concatenate(runs), np.concatenate([np.arange(len(r)) for r in runs])


def build(templates: dict[str, str] = TEMPLATES, s: Settings = Settings()) -> Index:
    labels = sorted(templates)
    words = [names_of(templates[k]) for k in labels]
    name, template, place, sizes = [], [], [], {s.gram}
    for i, w in enumerate(words):
        gram, width = widths(len(w), s)
        sizes.add(gram)
        g = X.grams(w, gram)
        at = winnow(g, width)
        name.append(g[at])
        template.append(np.full(len(at), i))
        place.append(at)
    name, template, place = (np.concatenate(x) for x in (name, template, place))
    order = np.lexsort((place, template, name))
    return Index(name[order], template[order], place[order], labels, words, sorted(sizes))


def _cells(a: np.ndarray, b: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int, int, int]]:
    """(score, matched, begin, end) of the best local alignment of text a with template b that ends at each pair of words.

    Diagonals are low..high of text minus template; the span is in words of a.
    """
    width = high - low + 1
    # By diagonal: score, matched words, begin.
    score, matched, begin = np.zeros(width + 2, np.int64), np.zeros(width + 2, np.int64), np.zeros(width + 2, np.int64)
    for j in range(len(b)):
        s2, m2, b2 = np.zeros(width + 2, np.int64), np.zeros(width + 2, np.int64), np.zeros(width + 2, np.int64)
        for d in range(width):
            i = j + low + d
            if not 0 <= i < len(a):
                continue
            hit = a[i] == b[j]
            # Step along, a template word left out (from the next diagonal), a text word put in (from the one before).
            options = [
                (score[d + 1] + (1 if hit else -1), matched[d + 1] + hit, begin[d + 1] if score[d + 1] else i),
                (score[d + 2] - 1, matched[d + 2], begin[d + 2]),
                (s2[d] - 1, m2[d], b2[d]),
            ]
            top = max(options, key=lambda x: x[0])
            if top[0] > 0:
                s2[d + 1], m2[d + 1], b2[d + 1] = top
                yield int(top[0]), int(top[1]), int(top[2]), i + 1
        score, matched, begin = s2, m2, b2


def align(a: np.ndarray, b: np.ndarray, low: int, high: int) -> tuple[int, int, int, int]:
    """The best local alignment of ``_cells``; of equal scores the first end stays."""
    return max(_cells(a, b, low, high), key=lambda x: x[0], default=(0, 0, 0, 0))


def matches(a: np.ndarray, b: np.ndarray, low: int, high: int, least: float) -> list[tuple[int, int, int]]:
    """(matched, begin, end) of all local alignments with that share of the template that lie beside each other, the best first."""
    out, parts = [], [(0, len(a))]
    while parts:
        start, stop = parts.pop()
        part = a[start:stop]
        # No more words can match than are in the template.
        if np.isin(part, b).sum() < least * len(b):
            continue
        found = [x for x in _cells(part, b, low - start, high - start) if x[1] >= least * len(b)]
        taken = np.zeros(len(part), bool)
        spans = []
        for _, matched, begin, end in sorted(found, key=lambda x: (-x[0], x[3])):
            if not taken[begin:end].any():
                taken[begin:end] = True
                spans.append((begin, end))
                out.append((matched, start + begin, start + end))
        if spans:
            spans.sort()
            gaps = zip([0] + [z for _, z in spans], [y for y, _ in spans] + [len(part)])
            parts += [(start + y, start + z) for y, z in gaps if z > y]
    return out


def _candidates(place: np.ndarray, template: np.ndarray, at: np.ndarray, index: Index, s: Settings) -> Iterator[tuple[int, int, int]]:
    """(template, least and greatest diagonal) of hits, those of one template by neighbouring diagonals."""
    for t in np.unique(template):
        own = template == t
        diagonal = np.unique(place[own] - at[own])
        cuts = np.flatnonzero(np.diff(diagonal) > s.band)
        for lo, hi in zip(np.append(0, cuts + 1), np.append(cuts, len(diagonal) - 1)):
            yield int(t), int(diagonal[lo]), int(diagonal[hi])


def scan_words(name: np.ndarray, index: Index, s: Settings) -> list[tuple[str, int, float, int, int]]:
    """(template, matched, coverage, begin, end) of a text's words, spans that don't overlap, by begin."""
    g, at = grams_of(name, index)
    lo, hi = np.searchsorted(index.name, g, "left"), np.searchsorted(index.name, g, "right")
    count = hi - lo
    if not count.any():
        return []
    place = np.repeat(at, count)
    hit = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
    found = []
    for t, low, high in _candidates(place, index.template[hit], index.place[hit], index, s):
        b = index.words[t]
        first = max(0, low - s.band)
        part = name[first : high + len(b) + s.band]
        for matched, begin, end in matches(part, b, low - s.band - first, high + s.band - first, s.least):
            found.append((matched, len(b), index.labels[t], first + begin, first + end))
    found.sort(key=lambda x: (-x[0], -x[1], x[2], x[3]))
    kept: list[tuple[str, int, float, int, int]] = []
    taken = np.zeros(len(name), bool)
    for matched, size, label, begin, end in found:
        if not taken[begin:end].any():
            taken[begin:end] = True
            kept.append((label, matched, matched / size, begin, end))
    return sorted(kept, key=lambda x: x[3])


def scan(docs: DataFrame, index: Index | None = None, s: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, template, matched_words, coverage, word_begin, word_end, char_begin, char_end), a row for each match."""
    index = build(s=s) if index is None else index
    part = docs.select(key, text)
    kind = part.schema[key].dataType.simpleString()
    names = [key, "template", "matched_words", "coverage", "word_begin", "word_end", "char_begin", "char_end"]

    def run(batches):
        for b in batches:
            for c in X.chunks(b.column(1)):
                w = tokens(c)
                rows, out = [], []
                # One look-up for the chunk tells which rows have a hit at all.
                g, at = grams_of(w.name, index)
                some = np.unique(w.rows()[at[np.isin(g, index.name)]]) if len(g) else []
                for i in some:
                    a, z = w.first[i], w.first[i + 1]
                    for label, matched, coverage, begin, end in scan_words(w.name[a:z], index, s):
                        lo, hi = w.start[a + begin] - c.off[i], w.end[a + end - 1] - c.off[i]
                        raw = c.text(int(i))
                        char = len(raw[:lo].decode("utf-8", "replace"))
                        rows.append(int(i))
                        out.append((label, matched, coverage, begin, end, char, char + len(raw[lo:hi].decode("utf-8", "replace"))))
                cols = list(zip(*out)) or [()] * 7
                kinds = (pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                ids = b.column(0).slice(c.lo, c.hi - c.lo).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array([int(v) if k == pa.int64() else v for v in x], k) for x, k in zip(cols, kinds))], names)

    ddl = "template string, matched_words long, coverage double, word_begin long, word_end long, char_begin long, char_end long"
    return part.mapInArrow(run, f"`{key}` {kind}, {ddl}")
