"""What the operators share: typed input columns, Arrow text buffers, scratch tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.session import scratch_path

#: Bytes of text that a Python worker handles at once (a longer document is handled alone).
SLICE_BYTES = 1 << 20


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` (bigint) and ``text`` (string, null as empty), and the named columns; nothing else is read."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def rows(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` as the struct ``row``, beside ``doc_id`` and ``text`` as ``texts`` gives them; no name can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def with_row(held: DataFrame, columns: str) -> StructType:
    """The schema of ``held``'s column ``row`` and of more ``columns``; names of any characters are kept, as they are not written out."""
    return StructType([held.schema["row"], *StructType.fromDDL(columns)])


def with_text(docs: DataFrame, text) -> list:
    """The columns of ``docs`` out of ``row``, with ``text`` in its place."""
    return [(text if c.lower() == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]


def computed(df: DataFrame, **columns) -> DataFrame:
    """``df`` with more columns that are computed once a row.

    The optimizer would copy a plain column's expression into each lambda that
    uses it, and so compute it once an element; it copies nothing out of a generator.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: lineage ends here, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def told(df: DataFrame, name: str, **totals) -> tuple[DataFrame, dict]:
    """``stored(df, name)``, and aggregates over ``df`` that its write takes along, so that no second query reads it for them."""
    seen = Observation()
    # Above all of the plan, as what stands below an empty shuffle is dropped with its metrics.
    out = stored(df.observe(seen, *[total.alias(k) for k, total in totals.items()]), name)
    return out, seen.get


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets, starting at 0."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total, start = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        yield batch.slice(start)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): equal for equal, else as if random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Each byte value as a random 64-bit number.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, base in enumerate((_BASE, _BASE_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS


class Substrings:
    """Hashes of substrings of a byte array in O(1) each, from polynomial prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """Of every window of ``width`` bytes, by its start."""
        n = max(0, len(self.sums) - width)
        return mix((self.sums[width : width + n] - self.sums[:n]) * self.down[:n] + np.uint64(width))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and the n + 1 offsets of the documents in them."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    cuts = off[:-1][off[:-1] < len(data)]
    first[cuts] |= solid[cuts]
    ends = cuts[cuts > 0] - 1
    last[ends] |= solid[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, off)


def lower_hashes(data: np.ndarray) -> Substrings:
    return Substrings(_LOWER[data])


#: Longer words are hashed by themselves: strings made for it collide in a polynomial modulo 2**64, the more so the longer they are.
_PLAIN_WORD = 32


def hashed_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of the given spans (A-Z lower-cased)."""
    out = lower_hashes(data)(start, end)
    for i in np.flatnonzero(end - start > _PLAIN_WORD).tolist():
        word = _LOWER[data[start[i] : end[i]]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return out


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (A-Z lower-cased), and the n + 1 offsets of the documents in them."""
    start, end, at = word_spans(data, off)
    return hashed_words(data, start, end), at
