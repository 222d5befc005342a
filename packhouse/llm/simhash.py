"""Document fingerprints: weighted term hashes vote on signed bits.

Terms are the words of a text and its pairs of neighbouring words; a term's
weight is the square root of its count times the weight of its kind: pairs
count for more, as the common words of a language are in all its texts.  The sign of each bit's vote
is the bit.  A text without words has the
fingerprint of no votes, all zeros; a null text counts as empty.  Equal texts
have equal fingerprints, in any task.

``within`` finds fingerprints within a Hamming radius by permuted block tables:
with r + 1 blocks, two fingerprints at most r bits apart agree in one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packhouse.llm import text as X

BITS = 128
_BYTES = BITS // 8
WORD_WEIGHT, PAIR_WEIGHT = 1, 2

# The eight signs of each byte value, high bit first, as np.packbits has them.
_SIGNS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64) * 2 - 1
_PLACES = np.arange(_BYTES, dtype=np.int64) * 256


def _votes(name: np.ndarray) -> np.ndarray:
    """Sum of the weighted signs of each bit over the distinct terms."""
    if not len(name):
        return np.zeros(BITS)
    name = np.sort(name)
    head = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
    # Quarters add up exactly, in any order of terms.
    weight = np.round(np.sqrt(np.diff(np.append(head, len(name)))) * 4) / 4
    wide = np.empty((len(head), 2), np.uint64)
    wide[:, 0] = name[head]
    with np.errstate(over="ignore"):
        wide[:, 1] = X.mix(wide[:, 0] + np.uint64(0x632BE59BD9B4E019))
    at = wide.view(np.uint8) + _PLACES
    tally = np.bincount(at.ravel(), np.repeat(weight, _BYTES), _BYTES * 256)
    return (tally.reshape(_BYTES, 256) @ _SIGNS).ravel()


def fingerprint(name: np.ndarray) -> bytes:
    """Fingerprint of a sequence of word names."""
    votes = WORD_WEIGHT * _votes(name) + PAIR_WEIGHT * _votes(X.grams(name, 2))
    return np.packbits(votes > 0).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal bits."""
    return 1 - (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count() / BITS


def of_column(column: pa.Array) -> Iterator[bytes]:
    """The fingerprint of each text."""
    for c in X.chunks(column):
        w = X.words(c)
        for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
            yield fingerprint(w.name[a:b])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint as hex), a row for each row."""
    part = docs.select(key, text)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.hex() for x in of_column(b.column(1))], pa.string())], [key, "fingerprint"])

    return part.mapInArrow(run, part.select(key, F.lit("").alias("fingerprint")).schema)


def distance(a, b):
    """Bits in which two hex fingerprints differ."""
    halves = [F.conv(F.substring(x, p, 8), 16, 10).cast("long") for x in (a, b) for p in range(1, BITS // 4, 8)]
    n = len(halves) // 2
    return sum((F.bit_count(halves[i].bitwiseXOR(halves[n + i])) for i in range(n)), F.lit(0))


def within(prints: DataFrame, radius: int, key: str = "doc_id") -> DataFrame:
    """Pairs (left, right, bits) of different fingerprints at most ``radius`` bits apart, as hex, left < right.

    Rows of equal fingerprints are one entry, so copies aren't paired; join (key, fingerprint) for membership.
    A table is keyed by the block's number and bits.
    """
    blocks = radius + 1
    width = BITS // 4 // blocks
    if width < 1:
        raise ValueError("the radius needs blocks of at least four bits")
    edges = [(i * width + 1, width if i < blocks - 1 else BITS // 4 - i * width) for i in range(blocks)]
    one = prints.select("fingerprint").where("fingerprint is not null").distinct()
    tables = one.select("fingerprint", F.posexplode(F.array(*[F.substring("fingerprint", a, n) for a, n in edges])).alias("block", "bits"))
    left = tables.withColumnRenamed("fingerprint", "left")
    right = tables.withColumnRenamed("fingerprint", "right")
    return (
        left.join(right, ["block", "bits"])
        .where(F.col("left") < F.col("right"))
        .select("left", "right", distance(F.col("left"), F.col("right")).cast("int").alias("bits"))
        .where(F.col("bits") <= radius)
        .distinct()
    )
