"""WARC archives: what is written is read back, file by file and through Spark."""

import base64
import hashlib
import random
import struct
from pathlib import Path

import pytest
import zstandard

from packhouse.llm import warc

PAGES = "page_id long, url string, html string, frame string, payload_bytes int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES)


def words(n, seed):
    pick = random.Random(seed)
    return "<p>" + " ".join(pick.choice(["quality", "archive", "of", "pages", "märz", "<b>", "x" * 9]) for _ in range(n))


def brute(rows, least=0):
    best = {}
    for p, _, h in rows:
        if p is not None:
            best[h or ""] = max(p, best.get(h or "", p))
    out = []
    for p, _, h in rows:
        body = (h or "").encode()
        response = best.get(h or "") if len(body) >= least else None
        again = response is not None and (p is None or p < response)
        sha1 = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((p, len(body), sha1, "revisit" if again else "response", response if again else None))
    return sorted(out, key=str)


def listed(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=str)


def archive(spark, rows, folder, **settings):
    warc.write(frame(spark, rows), folder, warc.Settings(**settings))
    return folder


ODD = [
    (1, "http://a/ö é\r\nX: y", None), (2, None, ""), (3, "", "same"), (4, "http://b", "same"), (4, "http://b", "same"), (None, "http://n", "same"),
    (None, None, "alone"), (-9, "u", "x" * 3_000_000), (2**63 - 1, "u", "\r\n\r\n"), (-(2**63), "u", "😀"), (7, "u", "P*M\x18\x00\x00\x00\x00" * 3),
]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, tmp_path, least):
    rows = ODD + [(100 + i, f"http://h/{i}", words(200, i % 150)) for i in range(400)]
    folder = archive(spark, rows, str(tmp_path / "a"), least_bytes=least)
    df = warc.read(spark, folder, with_payload=True)
    assert listed(df) == brute(rows, least)
    texts = {(r["page_id"], bytes(r["payload"])) for r in df.where("record_type = 'response'").collect()}
    whole = [r for r in brute(rows, least) if r[3] == "response"]
    assert {(p, hashlib.sha1(b).digest()) for p, b in texts} == {(r[0], base64.b32decode(r[2])) for r in whole}


def test_files_are_zstandard_with_a_leading_dictionary(spark, tmp_path):
    """Each file by hand: skippable frame, dictionary, then a frame a record, from which each reads alone."""
    rows = [(i, f"http://h/{i}", words(150, i)) for i in range(600)]
    archive(spark, rows, str(tmp_path / "a"))
    found, small = [], 0
    for f in sorted((tmp_path / "a").glob("part-*")):
        raw = Path(f).read_bytes()
        if not raw:
            continue
        magic, size = struct.unpack("<II", raw[:8])
        assert magic == 0x184D2A5D
        given = zstandard.ZstdCompressionDict(raw[8 : 8 + size])
        at, n = 8 + size, 0
        while at < len(raw):
            magic, skip = struct.unpack("<II", raw[at : at + 8])
            if magic & 0xFFFFFFF0 == 0x184D2A50:
                at += 8 + skip
                continue
            reader = zstandard.ZstdDecompressor(dict_data=given).decompressobj()
            record = reader.decompress(raw[at:])
            at = len(raw) - len(reader.unused_data)
            head, block = warc.parse(record)
            assert (head["warc-type"] == "warcinfo") == (n == 0)
            if n:
                assert zstandard.get_frame_parameters(raw[raw.index(zstandard.FRAME_HEADER, 8 + size) :]).dict_id == given.dict_id()
                found.append(warc.page_of(head["warc-record-id"]))
            n += 1
    assert sorted(found) == list(range(600))
    plain = sum(len(zstandard.compress(warc.record("d", p, u, h.encode(), None))) for p, u, h in rows)
    assert small < 0.9 * plain


def test_too_few_records_for_a_dictionary(spark, tmp_path):
    rows = [(1, "u", "x"), (2, "u", "y")]
    folder = archive(spark, rows, str(tmp_path / "a"))
    assert warc.dictionaries(spark, folder) == {} and listed(warc.read(spark, folder)) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert warc.read(spark, archive(spark, [], str(tmp_path / "a"))).count() == 0


def test_files_are_read_split(spark, tmp_path):
    """Splits that start in the middle of a file find the dictionary, and no record is read twice."""
    rows = [(i, "u", words(300, i)) for i in range(800)]
    folder = archive(spark, rows, str(tmp_path / "a"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = warc.read(spark, folder)
        assert df.rdd.getNumPartitions() > 2 * len(list((tmp_path / "a").glob("part-*")))
        assert listed(df) == brute(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_changed_archives_are_refused(spark, tmp_path):
    raw = warc.record("d", 5, "u", b"payload", None)
    assert warc.parse(raw)[0]["warc-type"] == "response"
    with pytest.raises(ValueError):
        warc.parse(raw[:-4])
    forged = raw.replace(b"payload", b"pavload")
    folder = tmp_path / "a"
    folder.mkdir()
    (folder / "part-0").write_bytes(zstandard.compress(forged) + warc.SEPARATOR)
    with pytest.raises(Exception, match="isn't the one that was archived"):
        warc.read(spark, str(folder)).collect()


def test_record_ids_hold_any_page():
    for p in (0, 1, -1, 2**63 - 1, -(2**63), None):
        assert warc.page_of(warc.record_id(p, warc.digest(b"x"))) == p
    assert warc.record_id(1, warc.digest(b"x")) != warc.record_id(1, warc.digest(b"y"))


def test_no_frame_holds_the_separator():
    """Incompressible bytes are stored as they are, the separator too, unless a level hides it."""
    frames = warc._Frames(b"")
    raw = random.Random(3).randbytes(5000) + warc.SEPARATOR * 40
    assert warc.SEPARATOR not in frames(raw) and zstandard.decompress(frames(raw)) == raw


def test_hot_payload(spark, tmp_path):
    rows = [(i, "u", "hot" * 500 if i % 3 == 0 else words(60, i)) for i in range(900)]
    assert listed(warc.read(spark, archive(spark, rows, str(tmp_path / "a")))) == brute(rows)
