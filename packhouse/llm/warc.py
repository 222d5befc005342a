"""WARC archives of pages, compressed record by record with a Zstandard dictionary of their own.

An archive is a folder of files, one a write task.  A file is a sequence of Zstandard frames:

- a skippable frame (magic 0x184D2A5D) that holds the dictionary, first of all, where there is one;
- a frame with a ``warcinfo`` record;
- a frame for each page: a ``response`` record, or a ``revisit`` record without payload that refers to the response
  of the same payload.

Each frame is followed by an empty skippable frame, which any Zstandard reader passes over.  It is the line separator
of Spark's text source, so Spark writes (and commits) the files to any store it knows, and reads them split at record
bounds.  No frame holds these eight bytes inside: a record that does is cut into blocks.  A frame names its dictionary
by id, so a task that starts in the middle of a file needs not read its head.

The dictionary is trained on the driver, on a bounded sample: about ``Settings.samples`` of the records to be written,
those of the smallest hashes of their payloads, whole, each at most ``Settings.sample_bytes``.  If these are too few
to train on, records are compressed without a dictionary.

Equal payloads are found by SHA-256.  Odd input: a null html is an empty payload; a null url becomes a URN of the page;
bytes that a header can't hold are percent-encoded.  A null page_id is below all others and is read back as null; of a
payload that has no other id, all rows are responses.  So are all rows of the largest page_id, where it is repeated.
Other columns aren't read.  An empty table gives an archive without records.  A record has to fit into a task.

Hot groups: only ids of payloads that occur twice or more are joined to pages, after a map-side maximum; the join can be
split where a payload is very frequent.  Nothing but the sample is collected.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packhouse.llm.work import Work

# Fixed values of the formats.
DICTIONARY = struct.pack("<I", 0x184D2A5D)
SEPARATOR = struct.pack("<II", 0x184D2A50, 0)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Levels tried in turn, until a frame doesn't hold the separator.
_LEVELS = (3, 4, 5, 1, 9, 12)
_DICTIONARIES = 256
_UNSAFE = re.compile(rb"[\x00-\x20\x7f-\xff]")


@dataclass(frozen=True)
class Settings:
    """``least_bytes``: smaller payloads are written again each time they occur."""

    least_bytes: int = 0
    dictionary_bytes: int = 112_640
    samples: int = 1024
    sample_bytes: int = 1 << 16


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, sha1: str) -> str:
    """A version 8 UUID that holds the page's id, and bits of its payload's digest."""
    bits = (int(page_id is None) << 121) | (((page_id or 0) & (1 << 64) - 1) << 57) | int.from_bytes(base64.b32decode(sha1)[:8], "big") >> 7
    a, b, c = bits >> 74, bits >> 62 & 0xFFF, bits & (1 << 62) - 1
    return f"<urn:uuid:{uuid.UUID(int=a << 80 | 8 << 76 | b << 64 | 2 << 62 | c)}>"


def page_of(record: str) -> int | None:
    """The page's id in a record's id."""
    x = uuid.UUID(record.strip("<>")).int
    bits = (x >> 80) << 74 | (x >> 64 & 0xFFF) << 62 | x & (1 << 62) - 1
    if bits >> 121:
        return None
    page = bits >> 57 & (1 << 64) - 1
    return page - (1 << 64) if page >> 63 else page


def _uri(url: str | None, page_id: int | None) -> bytes:
    if not url:
        return f"urn:page:{'' if page_id is None else page_id}".encode()
    return _UNSAFE.sub(lambda m: b"%%%02X" % m.group()[0], url.encode())


def record(date: str, page_id: int | None, url: str | None, payload: bytes, response: int | None) -> bytes:
    """A record of a page: a revisit if ``response`` is the page that has the payload, itself a response."""
    sha1 = digest(payload)
    head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if response is None else b"revisit"), b"WARC-Record-ID: " + record_id(page_id, sha1).encode()]
    head += [b"WARC-Date: " + date.encode(), b"WARC-Target-URI: " + _uri(url, page_id), b"WARC-Payload-Digest: sha1:" + sha1.encode()]
    if response is not None:
        head += [b"WARC-Profile: " + PROFILE.encode(), b"WARC-Refers-To: " + record_id(response, sha1).encode()]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block += payload if response is None else b""
    head += [b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def information(date: str) -> bytes:
    """The record that a file starts with."""
    block = b"software: packhouse\r\nformat: WARC File Format 1.1\r\n"
    head = [b"WARC/1.1", b"WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>".encode(), b"WARC-Date: " + date.encode()]
    head += [b"Content-Type: application/warc-fields", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(part: bytes) -> dict[str, str]:
    lines = part.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines)}


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record."""
    head, block = raw.split(b"\r\n\r\n", 1)
    found = _headers(head)
    n = int(found["content-length"])
    if not head.startswith(b"WARC/1.") or block[n:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return found, block[:n]


class _Frames:
    """Compresses records to frames without the separator inside.

    A record that has the separator itself is cut in its midst, as blocks of a frame don't touch; should entropy coding
    come upon these eight bytes, it does not at another level.
    """

    def __init__(self, dictionary: bytes):
        self.given = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.usual = self._made(_LEVELS[0])

    def _made(self, level: int) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=level, dict_data=self.given, write_checksum=True)

    def __call__(self, raw: bytes) -> bytes:
        frame = self.usual.compress(raw)
        if SEPARATOR not in frame:
            return frame
        for level in _LEVELS:
            out = self._made(level).compressobj(size=len(raw))
            done, parts = 0, []
            for m in re.finditer(re.escape(SEPARATOR), raw):
                parts += [out.compress(raw[done : m.start() + 4]), out.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK)]
                done = m.start() + 4
            frame = b"".join([*parts, out.compress(raw[done:]), out.flush()])
            if SEPARATOR not in frame:
                return frame
        raise ValueError("a frame holds the separator at each level")


def dictionary_frame(dictionary: bytes) -> bytes:
    return DICTIONARY + struct.pack("<I", len(dictionary)) + dictionary


def train(samples: list[bytes], size: int) -> bytes:
    """A dictionary of sample records; empty if they are too few."""
    try:
        made = zstandard.train_dictionary(size, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b""
    return b"" if SEPARATOR in made else made


def _batches(size: int, rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows in groups of about ``size`` bytes; the first field counts."""
    group, held = [], 0
    for r in rows:
        group.append(r)
        held += len(r[0])
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def planned(pages: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(page_id, url, payload, sha, response_id): the page that has the payload where this one only revisits it."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha2("payload", 256))
    counted = rows.where(F.octet_length("payload") >= s.least_bytes).groupBy("sha").agg(F.count(F.lit(1)).alias("times"), F.max("page_id").alias("response_id"))
    # Written out, so that its size is known when the join is planned: payloads needn't be shuffled for a small one.
    repeated = Work(pages.sparkSession, "warc").cut(counted.where("times > 1 and response_id is not null").drop("times"), "repeated")
    joined = rows.join(repeated, "sha", "left")
    again = F.col("page_id").isNull() | (F.col("page_id") < F.col("response_id"))
    return joined.withColumn("response_id", F.when(again, F.col("response_id")))


def _sample(rows: DataFrame, date: str, s: Settings) -> list[bytes]:
    n = rows.where("response_id is null").count()
    if not n:
        return []
    share = F.pmod(F.xxhash64("sha"), F.lit(1 << 20)) < max(1, -(-(s.samples << 20) // n))
    some = rows.where("response_id is null").where(share).where(F.octet_length("payload") <= s.sample_bytes)
    found = some.select("page_id", "url", "payload", "sha").limit(2 * s.samples).collect()
    return [record(date, r["page_id"], r["url"], bytes(r["payload"]), None) for r in sorted(found, key=lambda r: (r["sha"], r["page_id"] or 0))]


def write(pages: DataFrame, folder: str, s: Settings = Settings(), date: dt.datetime | None = None) -> None:
    """Writes an archive of (page_id, url, html) to a folder that doesn't exist yet."""
    day = (date or dt.datetime.now(dt.timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = planned(pages, s)
    dictionary = train(_sample(rows, day, s), s.dictionary_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = _Frames(dictionary)

        def made() -> Iterator[tuple[bytes]]:
            started = False
            for b in batches:
                for page, url, payload, response in zip(*(b.column(i).to_pylist() for i in range(4))):
                    if not started:
                        if dictionary:
                            yield (dictionary_frame(dictionary),)
                        yield (frames(information(day)),)
                        started = True
                    yield (frames(record(day, page, url, payload, response)),)

        for group in _batches(1 << 22, made()):
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in group], pa.binary())], ["frame"])

    out = rows.select("page_id", "url", "payload", "response_id").mapInArrow(run, "frame binary")
    out.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR.decode()).text(folder)


def frames(spark: SparkSession, folder: str) -> DataFrame:
    """(frame): the frames of an archive's files, as they are."""
    lines = spark.read.option("lineSep", SEPARATOR.decode()).text(folder)
    return lines.select(F.col("value").cast("binary").alias("frame")).where(F.octet_length("frame") > 0)


def dictionaries(spark: SparkSession, folder: str) -> dict[int, bytes]:
    """The dictionaries of an archive by their ids.  Files of one write share one; more than a few hundred are refused."""
    found = frames(spark, folder).where(F.substring("frame", 1, 4) == F.lit(DICTIONARY)).distinct().limit(_DICTIONARIES + 1).collect()
    if len(found) > _DICTIONARIES:
        raise ValueError("too many dictionaries: read the archives one by one")
    by_id: dict[int, bytes] = {}
    for (frame,) in found:
        raw = bytes(frame)[8:]
        key = zstandard.ZstdCompressionDict(raw).dict_id()
        if by_id.setdefault(key, raw) != raw:
            raise ValueError(f"two dictionaries have the id {key}")
    return by_id


RECORD = "record_id string, record_type string, target_uri string, page_id long, payload_bytes long, payload_digest string, refers_to long"


def read(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """The response and revisit records of an archive.

    The digest and length of a response are those of the payload read; they have to agree with its headers.  A revisit has
    them from its headers, and no payload.
    """
    known = dictionaries(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers: dict[int, zstandard.ZstdDecompressor] = {}

        def reader(key: int) -> zstandard.ZstdDecompressor:
            if key not in readers:
                readers[key] = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(known[key]) if key else None)
            return readers[key]

        def rows() -> Iterator[tuple]:
            for b in batches:
                for frame in b.column(0).to_pylist():
                    if frame[:4] == DICTIONARY:
                        continue
                    head, block = parse(reader(zstandard.get_frame_parameters(frame).dict_id).decompress(frame))
                    if head["warc-type"] not in ("response", "revisit"):
                        continue
                    http, payload = block.split(b"\r\n\r\n", 1)
                    told, size = head["warc-payload-digest"].removeprefix("sha1:"), int(_headers(http)["content-length"])
                    if head["warc-type"] == "response" and (digest(payload), len(payload)) != (told, size):
                        raise ValueError(f"{head['warc-record-id']}: the payload isn't the one that was archived")
                    to = head.get("warc-refers-to")
                    shown = payload if with_payload and not to else None
                    own = (head["warc-record-id"], head["warc-type"], head["warc-target-uri"], page_of(head["warc-record-id"]))
                    yield (shown or b"", *own, size, told, page_of(to) if to else None, shown)

        for group in _batches(1 << 22, rows()):
            yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in group], t) for i, t in enumerate(types, 1)], names)

    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in RECORD.split(", ")]
    shape = RECORD
    if with_payload:
        types, names, shape = [*types, pa.binary()], [*names, "payload"], RECORD + ", payload binary"
    return frames(spark, folder).mapInArrow(run, shape)
