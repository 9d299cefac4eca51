"""Benchmark decontamination with spaced-seed hashing (operator 4).

A fixed mask names the token positions that a seed looks at; the others may
differ.  Seeds of the benchmark and of the documents are joined; around each
hit the two token sequences are laid side by side, and a document is
contaminated by an item if some window of ``WINDOW`` tokens agrees in all but
``MISSES`` places.  The two masks are lossless: any such window holds an
undisturbed seed.  An item shorter than a window must appear whole, with one
place in seven disturbed at most; runs of three tokens are its seeds.  Items
of fewer than ``SHORTEST`` tokens say nothing and are not searched.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` of the lower-cased text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffers, mix, rows, slices, stored, texts, word_hashes

WINDOW, MISSES, SHORTEST = 13, 2, 5
#: Every choice of MISSES places in WINDOW leaves one of the first two untouched somewhere; the last is for short items.
MASKS = ((0, 1, 2, 4, 5, 9), (0, 2, 5, 6, 7, 8), (0, 1, 2))
#: A filter of this many bits, whatever the benchmark's size, tells the scan which seeds can hit.
FILTER_BITS = 1 << 22


def seeds(w: np.ndarray, at: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of a mask's seeds over documents whose tokens are ``w``, cut at ``at``."""
    places = MASKS[mask]
    span = places[-1] + 1
    n = max(0, len(w) - span + 1)
    doc_end = np.repeat(at[1:], np.diff(at))
    pos = np.flatnonzero(np.arange(n) + span <= doc_end[:n])
    sums = np.full(len(pos), mask + 1, np.uint64)
    for p in places:
        sums = mix(sums + w[pos + p])
    return pos, sums


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        w, at = word_hashes(*buffers(pc.utf8_lower(batch.column("text"))))
        size = np.diff(at)
        found = [[] for _ in size]
        for mask in range(len(MASKS)):
            pos, sums = seeds(w, at, mask)
            item = np.searchsorted(at, pos, "right") - 1
            fits = (size[item] >= SHORTEST) & ((size[item] < WINDOW) == (mask == 2))
            for i, p, h in zip(item[fits].tolist(), (pos - at[item])[fits].tolist(), sums[fits].view(np.int64).tolist(), strict=True):
                found[i].append({"at": p, "mask": mask, "hash": h})
        tokens = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(w.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), tokens, pa.array(found, _HITS)], names=["item_id", "tokens", "seeds"])


_HITS = pa.list_(pa.struct([("at", pa.int32()), ("mask", pa.int32()), ("hash", pa.int64())]))
_HITS_SQL = "array<struct<at: int, mask: int, hash: bigint>>"


def _segments(words_of_filter: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(FILTER_BITS // 64, np.uint64)
        for k, bits in words_of_filter:
            known[k] = np.uint64(bits & (1 << 64) - 1)
        known = np.unpackbits(known.view(np.uint8), bitorder="little").astype(bool)
        for batch in slices(batches):
            w, at = word_hashes(*buffers(pc.utf8_lower(batch.column("text"))))
            hits = [seeds(w, at, mask) for mask in range(len(MASKS))]
            kept = [known[(h & np.uint64(FILTER_BITS - 1)).astype(np.int64)] for _, h in hits]
            pos = np.concatenate([p[k] for (p, _), k in zip(hits, kept, strict=True)])
            if not len(pos):
                continue
            mask = np.concatenate([np.full(int(k.sum()), m) for m, k in enumerate(kept)])
            hashes = np.concatenate([h[k] for (_, h), k in zip(hits, kept, strict=True)])
            order = np.argsort(pos, kind="stable")
            pos, mask, hashes = pos[order], mask[order], hashes[order]
            # Hits whose surroundings overlap share a segment of tokens.
            doc = np.searchsorted(at, pos, "right") - 1
            lo, hi = np.maximum(at[doc], pos - WINDOW), np.minimum(at[doc + 1], pos + 2 * WINDOW)
            new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1])])
            ends = np.r_[new[1:], len(pos)]
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            out = {"doc_id": [], "start": [], "tokens": [], "hits": []}
            for a, b in zip(new.tolist(), ends.tolist(), strict=True):
                s, e = int(lo[a]), int(hi[a:b].max())
                out["doc_id"].append(int(ids[doc[a]]))
                out["start"].append(s - int(at[doc[a]]))
                out["tokens"].append(w[s:e].view(np.int64))
                out["hits"].append([{"at": p - s, "mask": m, "hash": h} for p, m, h in zip(pos[a:b].tolist(), mask[a:b].tolist(), hashes[a:b].view(np.int64).tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["start"], pa.int32()), pa.array(out["tokens"], pa.list_(pa.int64())), pa.array(out["hits"], _HITS)],
                names=["doc_id", "start", "tokens", "hits"],
            )

    return run


def agreement(x: np.ndarray, y: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Of tokens ``x`` beside item ``y`` (token i of y by token i + shift of x): the best window's agreeing places, its start in x, and the places asked for."""
    width = min(WINDOW, len(y))
    misses = MISSES if len(y) >= WINDOW else len(y) // 7
    lo, hi = max(0, -shift), min(len(y), len(x) - shift)
    if hi - lo < width:
        return 0, 0, width - misses
    same = np.r_[0, np.cumsum(x[lo + shift : hi + shift] == y[lo:hi])]
    sums = same[width:] - same[:-width]
    k = int(sums.argmax())
    return int(sums[k]), k + lo + shift, width - misses


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = batch.column("tokens"), batch.column("item")
        out = []
        for doc, item, start, shift, i in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "item_id", "start", "shift")), range(batch.num_rows), strict=True):
            n, k, least = agreement(x[i].values.to_numpy(), y[i].values.to_numpy(), shift)
            if n >= least:
                out.append((doc, item, start + k, n))
        cols = list(zip(*out, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "item_id", "at", "agree"])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, at, agree)``: each document and benchmark item that share a passage; the best window's first token and agreeing places.

    Null and empty texts share nothing.  Rows without ``doc_id`` are not
    searched, items without ``item_id`` not searched for.  Rows that repeat an id count
    as one.  Ties go to the first window.  Either table may be empty.
    """
    bench = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("item_id IS NOT NULL")
    items = stored(bench.mapInArrow(_items, f"item_id bigint, tokens array<bigint>, seeds {_HITS_SQL}"), "decontaminate")
    index = items.select("item_id", F.inline("seeds")).select("item_id", F.col("at").alias("item_at"), "mask", "hash")
    # At most FILTER_BITS / 64 rows, whatever the benchmark holds.
    words = index.groupBy(F.expr(f"pmod(hash, {FILTER_BITS}) div 64").alias("k")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(hash, {FILTER_BITS}) % 64 as int))")).alias("bits"))
    known = [(r.k, r.bits) for r in words.collect()]
    segments = texts(docs).where("doc_id IS NOT NULL").mapInArrow(_segments(known), f"doc_id bigint, start int, tokens array<bigint>, hits {_HITS_SQL}")
    segments = stored(segments, "decontaminate")
    # Which item lies beside which segment, and how far shifted; tokens wait outside.
    beside = (
        segments.select("doc_id", "start", F.inline("hits")).join(index, ["mask", "hash"])
        .select("doc_id", "start", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    )
    found = (
        beside.join(items.select("item_id", F.col("tokens").alias("item")), "item_id")
        .join(segments.select("doc_id", "start", "tokens"), ["doc_id", "start"])
        .select("doc_id", "item_id", "start", "shift", "tokens", "item")
        .mapInArrow(_verify, "doc_id bigint, item_id bigint, at bigint, agree bigint")
    )
    best = F.max(F.struct("agree", (-F.col("at")).alias("at")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", (-F.col("b.at")).alias("at"), F.col("b.agree").alias("agree"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones; rows without ``doc_id`` stay.  All columns stay."""
    found = contaminated(docs, benchmark).select(F.col("doc_id").alias("found_id")).distinct()
    return rows(docs).join(found, F.col("doc_id") == F.col("found_id"), "left_anti").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op4: every document against every benchmark item."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
