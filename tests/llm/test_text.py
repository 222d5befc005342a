"""Words and their names."""

import random
import re

import numpy as np
import pyarrow as pa

from packhouse.llm import text as X

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def test_words_are_those_of_the_pattern():
    draw = random.Random(0)
    texts = ["".join(draw.choice("ab \t\n\x0b\x0c\r\x1c\x85é ") for _ in range(draw.randrange(40))) for _ in range(300)] + ["", None, " ", "x"]
    names = {}
    seen = 0
    for c in X.chunks(pa.array(texts), 500):
        w = X.words(c)
        for i in range(c.hi - c.lo):
            want = WORD.findall((texts[c.lo + i] or "").encode())
            a, b = w.first[i], w.first[i + 1]
            assert [c.buf[s:e].tobytes() for s, e in zip(w.start[a:b], w.end[a:b])] == want
            for word, name in zip(want, w.name[a:b].tolist()):
                assert names.setdefault(word, name) == name
            seen += 1
    assert seen == len(texts) and len(set(names.values())) == len(names)


def test_long_texts_have_the_names_of_short_ones():
    (short,) = X.chunks(pa.array(["ab cd"]))
    a, b = X.words(short).name.tolist()
    big = "x" * (3 * X.CHUNK + 17)
    (long,) = X.chunks(pa.array(["ab cd " * 400_000 + big + " ab"]))
    name = X.words(long).name
    assert len(name) == 800_002 and set(name[:800_000].tolist()) == {a, b} and name[-1] == a
    (other,) = X.chunks(pa.array([big + " q"]))
    assert X.words(other).name[0] == name[-2]


def test_grams():
    name = X.seeds(6, 1)
    g = X.grams(np.concatenate([name, name]), 3)
    assert (g[:4] == g[6:]).all() and len(set(g.tolist())) == 6
    assert len(X.grams(name, 7)) == 0
