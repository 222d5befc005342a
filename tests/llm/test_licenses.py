"""License scans."""

import random

import numpy as np

from packhouse.llm import licenses
from packhouse.llm.license_texts import TEMPLATES


def best_alignment(a, b):
    """Score of the best local alignment, without a band."""
    best, last = 0, [0] * (len(a) + 1)
    for y in b:
        row = [0]
        for i, x in enumerate(a):
            row.append(max(0, last[i] + (1 if x == y else -1), last[i + 1] - 1, row[i] - 1))
        best, last = max(best, max(row)), row
    return best


def test_alignment():
    draw = random.Random(1)
    for _ in range(60):
        a, b = (np.array([draw.randrange(4) for _ in range(draw.randrange(1, 25))]) for _ in range(2))
        assert licenses.align(a, b, -30, 30)[0] == best_alignment(a.tolist(), b.tolist())


def test_winnowing_keeps_one_of_each_run():
    draw = random.Random(2)
    for n in (1, 2, 3, 4, 50):
        hashes = np.array([draw.randrange(100) for _ in range(n)], np.uint64)
        kept = set(licenses.winnow(hashes, 3).tolist())
        for i in range(max(1, n - 2)):
            run = hashes[i : i + 3]
            assert any(j in kept and hashes[j] == run.min() for j in range(i, min(i + 3, n)))


def test_scan(frame):
    noise = " ".join(f"nöise{i}" for i in range(30))
    mit = TEMPLATES["MIT text"].split()
    edited = mit[:20] + ["really"] + mit[20:50] + mit[53:70] + ["changed"] + mit[71:]
    docs = {k: f"{noise}\n{t} {noise}" for k, t in enumerate(TEMPLATES.values())}
    docs |= {
        100: f"{noise} {' '.join(edited)} {noise}",
        101: " ".join(mit[: len(mit) // 2]),
        102: noise,
        103: None,
        104: "",
        105: f"{TEMPLATES['MIT']} {noise} {TEMPLATES['GPL-3.0']} {TEMPLATES['MIT'].upper()}",
        106: "under the terms of the license released and used",
        107: f"{noise} " * 20_000 + TEMPLATES["ISC"],
    }
    rows = licenses.scan(frame(docs)).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["word_begin"])):
        got.setdefault(r["doc_id"], []).append(r["template"])
        own = docs[r["doc_id"]]
        if r["coverage"] == 1.0:
            same = licenses.names_of(own[r["char_begin"] : r["char_end"]]).tolist()
            assert same == licenses.names_of(TEMPLATES[r["template"]]).tolist()
    want = {k: [label] for k, label in enumerate(TEMPLATES)}
    assert got == want | {100: ["MIT text"], 105: ["MIT", "GPL-3.0", "MIT"], 107: ["ISC"]}
    (r,) = [r for r in rows if r["doc_id"] == 100]
    assert 0.93 < r["coverage"] < 1


def places(words, notice):
    """Where a notice's words stand in a text, from left to right, by trying each place."""
    out, i = [], 0
    while i + len(notice) <= len(words):
        same = words[i : i + len(notice)] == notice
        out += [i] * same
        i += len(notice) if same else 1
    return out


def test_repeated_notices(frame):
    """Copies on neighbouring lines are matches of their own."""
    short = {k: t for k, t in TEMPLATES.items() if len(licenses.names_of(t)) <= 10}
    assert len(short) >= 4
    docs = {label: "\n".join([t] * 20) for label, t in short.items()}
    docs |= {f"{label} apart": " x\n".join([t] * 7) + f" {t}" for label, t in short.items()}
    docs["mixed"] = "\n".join(t for t in short.values() for _ in range(3)) + "\nend"
    docs["long"] = "\n".join([TEMPLATES["MIT text"]] * 3)
    docs["many"] = f"{TEMPLATES['MIT']}\n" * 3000
    names = list(docs)
    rows = licenses.scan(frame({i: docs[k] for i, k in enumerate(names)})).collect()
    for i, k in enumerate(names):
        words = licenses.names_of(docs[k]).tolist()
        got = sorted((r["template"], r["word_begin"]) for r in rows if r["doc_id"] == i)
        told = [k.removesuffix(" apart")] if k.removesuffix(" apart") in short else {"long": ["MIT text"], "many": ["MIT"]}.get(k, list(short))
        assert got == sorted((n, at) for n in told for at in places(words, licenses.names_of(TEMPLATES[n]).tolist())), k


def test_changed_words_of_short_notices():
    """Whatever text the threshold accepts, by an alignment over the whole of it, is found."""
    s, index = licenses.Settings(), licenses.build()
    draw = random.Random(4)
    seen = 0
    for label, text in TEMPLATES.items():
        b = licenses.names_of(text)
        if len(b) > 21:
            continue
        for i in range(len(b)):
            others = [np.delete(b, i), np.insert(b, i, 5), np.where(np.arange(len(b)) == i, np.uint64(5), b)]
            picked = draw.sample(range(len(b)), len(b) // 5)
            others.append(np.where(np.isin(np.arange(len(b)), picked), np.uint64(6), b))
            for changed in others:
                a = np.concatenate([np.arange(10, 15, dtype=np.uint64), changed, np.arange(20, 25, dtype=np.uint64)])
                _, matched, begin, end = licenses.align(a, b, -len(a), len(a))
                if matched >= s.least * len(b):
                    seen += 1
                    got = licenses.scan_words(a, index, s)
                    assert any(lo < end and begin < hi for _, _, _, lo, hi in got), (label, i, got)
    assert seen > 100


def test_odd_rows(frame):
    assert licenses.scan(frame([(1, TEMPLATES["MIT"]), (1, TEMPLATES["MIT"]), (None, TEMPLATES["MIT"])])).count() == 3
    assert licenses.scan(frame({1: "a"}).limit(0)).count() == 0
