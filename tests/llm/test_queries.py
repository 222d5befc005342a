"""Every query against its SQL twin, the columns it promises, and the pipeline against brute force."""

import functools
import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from compare import connect, differences, duck_rows, spark_rows
from packhouse.llm import minmax, queries, simhash, sql
from packhouse.llm import text as text_words
from test_minmax import brute as brute_groups
from test_quality_rules import brute as brute_rules
from test_recompress import brute as brute_dedup

SF = "/root/testdata/sf0.001"

PROMISED = {
    "op1_chat_formatting": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"},
    "op2_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op3_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op4_quality_classifier": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_minhash": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op7_fingerprints": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op8_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op11_divergence": {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"},
    "op12_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op13_prefix_trie": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint", "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string"},
    "op10_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_one_query_an_operator():
    assert [sum(n.startswith(f"op{k}_") for n in queries.QUERIES) for k in range(1, 14)] == [1] * 13
    assert set(sql.STATEMENTS) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(sql.STATEMENTS))
def test_twin(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    assert PROMISED[name].items() <= dict(df.dtypes).items()
    assert differences(spark_rows(df), duck_rows(con, sql.STATEMENTS[name])) == []


@pytest.mark.parametrize("name", sorted(set(PROMISED) - set(sql.STATEMENTS) - {"op7_fingerprints", "op3_packing"}))
def test_columns_and_rows(spark, texts, name):
    df = queries.QUERIES[name](spark, SF)
    assert PROMISED[name].items() <= dict(df.dtypes).items()
    assert sorted(r["doc_id"] for r in df.collect()) == sorted(texts)


def brute_fingerprint(text):
    """Votes counted bit by bit: words by their 64-bit names, pairs of neighbours twice, each by the root of its count."""
    import numpy as np
    import pyarrow as pa

    (chunk,) = text_words.chunks(pa.array([text.encode()], pa.large_binary()))
    names = text_words.words(chunk).name
    votes = [0.0] * simhash.BITS
    for terms, weight in ((names, simhash.WORD_WEIGHT), (text_words.grams(names, 2), simhash.PAIR_WEIGHT)):
        for name, n in Counter(terms.tolist()).items():
            with np.errstate(over="ignore"):
                second = int(text_words.mix(np.array([name], np.uint64) + np.uint64(0x632BE59BD9B4E019))[0])
            # Eight bytes of each, least first, their bits highest first.
            raw = name.to_bytes(8, "little") + second.to_bytes(8, "little")
            for i in range(simhash.BITS):
                votes[i] += weight * round(n**0.5 * 4) / 4 * (1 if raw[i // 8] >> (7 - i % 8) & 1 else -1)
    bits = "".join("1" if v > 0 else "0" for v in votes)
    return int(bits, 2).to_bytes(simhash.BITS // 8, "big")


def test_fingerprints(spark, texts):
    df = queries.QUERIES["op7_fingerprints"](spark, SF)
    assert PROMISED["op7_fingerprints"].items() <= dict(df.dtypes).items()
    rows = {r["doc_id"]: r for r in df.collect()}
    ids = sorted(texts, reverse=True)
    assert set(rows) == set(ids)
    fingerprint = functools.cache(brute_fingerprint)
    for i, k in enumerate(ids):
        t, n = texts[k], texts[ids[(i + 1) % len(ids)]]
        cut = len(t) // 3
        edited = t[: len(t) - cut] + n[:cut]
        r = rows[k]
        a, b, c = (fingerprint(x) for x in (t, edited, n))
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (a.hex(), b.hex())
        assert (r["near_edited"], r["near_next"]) == (simhash.likeness(a, b), simhash.likeness(a, c))
    assert sum(r["near_edited"] > r["near_next"] for r in rows.values()) >= 0.95 * len(rows)


def test_licenses_and_pieces(spark, texts):
    found = {r["doc_id"] for r in queries.QUERIES["op6_license_scans"](spark, SF).collect()}
    assert found == {k for k, t in texts.items() if "License" in t or "Licensed under CC" in t}
    rows = queries.QUERIES["op9_sentencepiece"](spark, SF).collect()
    assert len(rows) == len(texts) and all(r["round_trip"] for r in rows)


def test_pipeline(spark, tmp_path, texts):
    """Each stage on what the one before left: the models by their effect, the others by brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < 4:
            assert out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        left[name] = docs.collect()
    kept = [{r["doc_id"]: r["text"] for r in left[n]} for n, _ in corpus_pipeline.STAGES[:4]]
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    told = [(k in kept[0]) == bool(q) for k, q in quality.items()]
    assert sum(told) >= 0.95 * len(told)
    assert kept[1] == {k: t for k, t in kept[0].items() if brute_rules(t)[-1]}
    assert kept[2] == {k: kept[1][k] for k, v in brute_groups(kept[1], minmax.Settings()).items() if v[2]}
    want = brute_dedup(kept[2])
    assert set(kept[3]) == set(kept[2])
    for k, t in kept[3].items():
        n, gone, sha = want[k]
        assert hashlib.sha256(b" ".join(t.encode().split())).hexdigest() == sha and (gone or t == kept[2][k])
    assert all(r["n_chars"] == len(r["text"]) for r in left["substring dedup"])
    ends = {}
    for r in left["packing"]:
        ends[r["doc_id"]] = ends.get(r["doc_id"], 0) + r["length"]
    assert ends == {r["doc_id"]: r["doc_tokens"] for r in left["packing"]} and set(ends) == set(kept[3])


def test_pipeline_stages_of_odd_documents(spark, frame):
    docs = spark.createDataFrame(
        [(1, None, "en", None, None, 5), (2, "", None, "s", 0, None), (None, "a b c", "en", "s", 5, 1), (3, "a b c", "en", "s", 5, 1), (3, "a b c", "en", "s", 5, 1)],
        "doc_id long, text string, lang string, source string, n_chars long, kept int",
    )
    for name, stage in corpus_pipeline.STAGES:
        for df in (docs, docs.limit(0)):
            out = stage(spark, df, SF)
            n = out.count()
            if name != "packing":
                assert out.dtypes == df.dtypes and n <= df.count()
