"""Quality rules against brute force."""

import random
import re
from collections import Counter

from packhouse.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def covered(w, n):
    grams = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    return {j for i in range(len(w) - n + 1) if grams[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}


def brute(text, rules=Q.Rules()):
    text = text or ""
    w = WORD.findall(text)
    chars = sum(map(len, w))
    seen, dup, line_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                dup += 1
                line_chars += sum(map(len, WORD.findall(line)))
            seen.add(line)
    repeat = len(covered(w, 3))
    runs = [sum(len(w[j]) for j in covered(w, n)) for n, _ in rules.runs]
    base = len(w) < rules.min_words or 100 * repeat > rules.max_repeat_words * len(w)
    kept = not base and 100 * line_chars <= rules.max_line_chars * chars and all(100 * x <= most * chars for x, (_, most) in zip(runs, rules.runs))
    return (len(w), chars, len(re.findall(r"[#*$%&|<>]", text)), dup, repeat, line_chars, runs, base, kept)


def test_against_brute_force(frame):
    draw = random.Random(2)
    docs = {}
    for k in range(150):
        size = draw.choice([2, 5, 30, 400, 5000])
        docs[k] = "".join(f"é{draw.randrange(size)}" + draw.choice([" ", " ", "\n", "\t", " #|", "\x1c"]) for _ in range(draw.randrange(0, 300)))
    line = "a line said again"
    docs |= {900: None, 901: "", 902: " \n\n ", 903: f"{line}\n" * 20 + " ".join(f"w{i}" for i in range(80)), 904: " ".join(f"z{i % 90_000}" for i in range(200_000))}
    rows = Q.measure(frame(docs)).collect()
    assert len(rows) == len(docs)
    for r in rows:
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["line_chars"], r["run_chars"], r["base_failed"], r["kept"])
        assert got == brute(docs[r["doc_id"]]), r["doc_id"]


def test_columns_rows_and_empty_table(frame):
    out = Q.measure(frame([(1, "a b"), (1, "a b"), (None, None)]), keep=("doc_id", "text", "lang", "spans"))
    assert sorted((r["doc_id"] or 0, r["spans"], r["n_words"]) for r in out.collect()) == [(0, "x", 0), (1, "x", 2), (1, "x", 2)]
    assert Q.measure(frame({1: "a"}).limit(0)).count() == 0
