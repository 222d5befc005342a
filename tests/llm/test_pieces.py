"""SentencePiece: exact round trips, and the library's own lattice over the same pieces."""

import random
import time
import tracemalloc

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from packhouse.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    """The library, reading the table as a unigram model."""
    model = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def score(library, ids):
    return sum(library.get_score(i) for i in ids)


def test_best_paths(frame, library):
    """Each word has the score of the library's best path, and spells the word."""
    draw = random.Random(0)
    alphabet = "aetinorshdlé ñücm.,'-3"
    docs = {k: "".join(draw.choice(alphabet.replace(" ", "")) for _ in range(draw.randrange(1, 14))) for k in range(150)}
    for setting in (pieces.Settings(), pieces.Settings(sample=1, frequent=5)):
        for r in pieces.encode(frame(docs), PATH, setting, ids=True).collect():
            text, ids = docs[r["doc_id"]], r["ids"]
            best = library.nbest_encode_as_ids(text, 2)[0]
            assert r["round_trip"] and library.decode(ids) == text and score(library, ids) == score(library, best), text


def test_round_trips(frame, library):
    table = pieces.Table.load(PATH)
    texts = ["", None, " ", "  a  b ", "\n\t x;\r\n", "漢字 Ωmega 😀", "don't e.g. .com x_.y z²", "a" * 200, "the cat\n" * 20_000, "a\x00b"]
    docs = dict(enumerate(texts))
    rows = pieces.encode(frame(docs), PATH, pieces.Settings(sample=1, frequent=3), ids=True).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["round_trip"] and pieces.decode(r["ids"], table) == (docs[r["doc_id"]] or "") == library.decode(r["ids"])
        assert r["n_pieces"] == len(r["ids"])


def test_units_join_to_the_text(spark):
    table = pieces.Table.load(PATH)
    text = "Hello,  wörld.x\n\n\ta.b 3.5 e.g?! "
    df = spark.createDataFrame([(text,)], "text string").select(pieces.units(pieces.F.col("text"), table).alias("u"))
    assert "".join(df.first()["u"]) == pieces.SPACE + text.replace(" ", pieces.SPACE)


def test_null_and_repeated_keys(frame, library):
    """Rows without a key, or with a key of others, have their own pieces, listed or not."""
    words = ["the", "harvest", "of", "pears", "zzyzx", "crates", "grün"]
    rows = [(None, " ".join(words[i:])) for i in range(6)] + [(None, None), (None, "pears"), (7, "pears of"), (7, "crates the"), (7, "crates the")]
    want = sorted((k or 0, t or "") for k, t in rows)
    for s in (pieces.Settings(), pieces.Settings(sample=1, frequent=1)):
        got = pieces.encode(frame(rows), PATH, s, ids=True).collect()
        assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in got)
        assert sorted((r["doc_id"] or 0, library.decode(r["ids"])) for r in got) == want


def test_blocks_change_nothing(spark, frame):
    """Many blocks, a short list, and copies of one text on a third of all rows."""
    draw = random.Random(3)
    words = ["".join(draw.choice("aeinorst") for _ in range(draw.randrange(2, 9))) for _ in range(300)]
    rows = [(i, " ".join(draw.choices(words, k=30)) if i % 3 else "one text for all of these") for i in range(300)]
    got = [
        sorted((r["doc_id"], r["ids_sha256"], r["round_trip"]) for r in pieces.encode(frame(rows), PATH, s).collect())
        for s in (pieces.Settings(), pieces.Settings(sample=10, frequent=7, block_bytes=500), pieces.Settings(frequent=0, block_bytes=3000))
    ]
    assert got[0] == got[1] == got[2] and all(r[2] for r in got[0]) and len(got[0]) == 300


def test_texts_are_shuffled_once(spark, frame):
    df = pieces.encode(frame({i: f"some words {i}" for i in range(50)}), PATH, pieces.Settings(frequent=3))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("== Initial Plan ==")[0]


def test_long_words(spark, frame, library):
    """Words of many blocks against the library, and 30,000 letters without a space in seconds."""
    draw = random.Random(9)
    word = "".join(draw.choice("aeinorst") for _ in range(30_000))
    docs = {n: word[:n] for n in (63, 64, 65, 79, 255, 256, 257, 2000)}
    for r in pieces.encode(frame(docs), PATH, pieces.Settings(frequent=0), ids=True).collect():
        best = library.nbest_encode_as_ids(docs[r["doc_id"]], 2)[0]
        assert r["round_trip"] and abs(score(library, r["ids"]) - score(library, best)) < 1e-6 * len(best)
    start = time.perf_counter()
    (r,) = pieces.encode(frame({1: word}), PATH, pieces.Settings(frequent=0)).collect()
    assert r["round_trip"] and time.perf_counter() - start < 40


def test_lattices_of_few_units_at_a_time(library):
    """50,000 units not on a list: their lattices take a few MB, and paths are the library's best."""
    draw = random.Random(4)
    table = pieces.Table.load(PATH)
    known = pieces.Prefixes.of(table)
    names = list({pieces.SPACE + "".join(draw.choices("aeinorstlé漢", k=draw.randrange(1, 16))) for _ in range(60_000)})[:50_000]
    tracemalloc.start()
    try:
        size = sum(len(path) for _, path in pieces.fold(names, known))
        assert size > 50_000 and tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()
    found = dict(pieces.fold(names, known))
    assert found.keys() == set(names)
    for unit in names[:300]:
        ids, best = pieces._spelled(found[unit], table), library.nbest_encode_as_ids(unit[1:], 2)[0]
        assert pieces.spoken(ids, table) == unit and abs(score(library, ids) - score(library, best)) < 1e-6


def test_substrings_are_no_rows(spark, frame):
    df = pieces.encode(frame({i: f"some words {i}" for i in range(50)}), PATH, pieces.Settings(frequent=3))
    assert "explode(sequence" not in df._jdf.queryExecution().executedPlan().toString()


def test_odd_rows(frame):
    assert pieces.encode(frame([(None, "a b"), (3, "a b")]), PATH).where("round_trip").count() >= 1
    assert pieces.encode(frame({1: "a"}).limit(0), PATH).count() == 0
