"""Token-id files (operator 7): documents' ids in ascending doc_id order, range coded in independent, checksummed blocks.

A file holds whole documents:

    magic "TIDB", version, then little-endian unsigned 32-bit: vocabulary size, documents n, blocks b, crc32 of the index
    index: n doc ids (signed 64), n null marks (bytes), n token counts (64), b block sizes in ids, b payload sizes, b crc32 of a block's ids and its payload (32 each)
    payloads, end to end

Files are the rows of a table in shared storage, ``(part, seq, n_tokens, file)``, in
ascending order: Spark commits, retries and lists them.  A task cuts its range of
documents into files of about ``FILE_TOKENS`` ids, so memory is bounded; a longer
document is a file by itself.  Any block can be decoded alone, from the index.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import coder
from .bpe import encoder, public
from .common import load, slices, stored, texts

WORD_BPE, END, FILE_TOKENS = "word_bpe_49k.json", 2, 1 << 22
#: Bytes of text that are tokenized at once: the more, the fewer words are looked up again.
TEXT_BYTES = 1 << 22
_HEAD = struct.Struct("<4sIIIII")


def pack(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, vocab: int) -> bytes:
    """A file of documents with ``counts`` ids each."""
    blocks = [ids[i : i + coder.BLOCK] for i in range(0, len(ids), coder.BLOCK)]
    payloads = coder.encode_blocks([b.astype(np.int64) for b in blocks], vocab)
    index = b"".join(
        [
            np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x is None for x in doc_ids], np.uint8).tobytes(), counts.astype("<u8").tobytes(),
            np.array([len(b) for b in blocks], "<u4").tobytes(), np.array([len(p) for p in payloads], "<u4").tobytes(),
            np.array([zlib.crc32(p, zlib.crc32(b.astype("<u4").tobytes())) for b, p in zip(blocks, payloads, strict=True)], "<u4").tobytes(),
        ]
    )
    return b"".join([_HEAD.pack(b"TIDB", 2, vocab, len(doc_ids), len(blocks), zlib.crc32(index)), index, *payloads])


def unpack(file: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Doc ids, counts and ids of a file; a wrong checksum is an error."""
    magic, version, vocab, n, b, crc = _HEAD.unpack_from(file)
    at, cut = _HEAD.size, []
    for kind, k in (("<i8", n), ("u1", n), ("<u8", n), ("<u4", b), ("<u4", b), ("<u4", b)):
        cut.append(np.frombuffer(file, kind, k, at))
        at += cut[-1].nbytes
    if magic != b"TIDB" or version != 2 or zlib.crc32(file[_HEAD.size : at]) != crc:
        raise ValueError("not a token file, or its index is damaged")
    ends = at + np.r_[0, np.cumsum(cut[4].astype(np.int64))]
    payloads = [file[x:y] for x, y in itertools.pairwise(ends.tolist())]
    blocks = coder.decode_blocks(payloads, cut[3].tolist(), vocab)
    for k, ids in enumerate(blocks):
        if zlib.crc32(payloads[k], zlib.crc32(ids.astype("<u4").tobytes())) != cut[5][k]:
            raise ValueError(f"block {k} is damaged")
    ids = np.concatenate(blocks) if blocks else np.zeros(0, np.uint32)
    return [None if null else int(x) for x, null in zip(cut[0], cut[1], strict=True)], cut[2].astype(np.int64), ids


def _write(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        vocab = max(len(tool.token_bytes), end + 1)
        part, seq = TaskContext.get().partitionId(), itertools.count()
        docs: list[int | None] = []
        counts: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        held = 0

        def file() -> pa.RecordBatch:
            raw = pack(docs, np.concatenate(counts), np.concatenate(parts), vocab)
            columns = [pa.array([part], pa.int32()), pa.array([next(seq)], pa.int32()), pa.array([held], pa.int64()), pa.array([raw], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["part", "seq", "n_tokens", "file"])

        for batch in slices(batches, limit=TEXT_BYTES):
            ids, off = tool.encode(batch.column("text"))
            ids = np.insert(ids, off[1:], end)
            docs += batch.column("doc_id").to_pylist()
            counts.append(np.diff(off) + 1)
            parts.append(ids)
            held += len(ids)
            if held >= FILE_TOKENS:
                yield file()
                docs, counts, parts, held = [], [], [], 0
        if docs:
            yield file()

    return run


def write(docs: DataFrame, path: str | None = None, end: int = END) -> DataFrame:
    """The files of ``docs``, stored: ``part, seq, n_tokens, file`` (a binary file each).

    Null texts count as empty; every document ends with the id ``end``.  Rows
    without ``doc_id`` come first; rows that repeat one follow each other, by text.
    An empty table gives no file.
    """
    ordered = texts(docs)
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = ordered.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    files = ordered.mapInArrow(_write(path or public(WORD_BPE), end), "part int, seq int, n_tokens bigint, file binary")
    return stored(files, "token-files")


def _read(whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, file in zip(*(batch.column(c) for c in ("part", "seq", "file")), strict=True):
                docs, counts, ids = unpack(file.as_buffer().to_pybytes())
                off = np.r_[0, np.cumsum(counts)]
                raw = ids.astype("<u4").tobytes()
                columns = [
                    pa.array([part.as_py()] * len(docs), pa.int32()), pa.array([seq.as_py()] * len(docs), pa.int32()), pa.array(docs, pa.int64()), pa.array(off[:-1], pa.int64()),
                    pa.array(counts, pa.int64()), pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in itertools.pairwise(off.tolist())], pa.int64()),
                ]
                names = ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"]
                if whole:
                    columns.append(pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read(files: DataFrame, whole: bool = True) -> DataFrame:
    """The documents in files: ``doc_id, start`` (ids of all documents before), ``n_tokens, ids_crc32``, and ``ids`` if ``whole``.  Damage raises an error."""
    schema = "part int, seq int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * whole
    # One file a batch would be best; the Arrow batch holds few as files are large.
    docs = files.select("part", "seq", "file").mapInArrow(_read(whole), schema)
    # The sum of each part comes to the driver: as many numbers as write tasks.
    sums = sorted((r.part, r.n) for r in files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before = list(zip([p for p, _ in sums], itertools.accumulate([0, *[n for _, n in sums]]), strict=False))
    starts = files.sparkSession.createDataFrame(before, "part int, before bigint")
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    of_file = files.select("part", "seq", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("within")).join(starts, "part").select("part", "seq", (F.col("before") + F.col("within")).alias("first"))
    # A row a file: the documents stay where they are read, and are read once.
    out = docs.join(F.broadcast(of_file), ["part", "seq"])
    return out.select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] * whole))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: every document's ids written to files and read back."""
    return read(write(load(spark, sf_dir, "documents")), whole=False)
