"""Removal of long repeated byte strings: a depth-limited radix sort of suffixes (operator 6).

Suffixes are told apart only through their first ``WIDTH`` bytes, by digits,
most significant first; a suffix that is alone (in one document) after a digit
needs no further pass.  Groups that are equal after the last digit are exactly
the repeated windows.  Sorting all suffixes of 100 TB byte by byte would move
each of them once a pass, so digits are chosen to let most drop out early:

1. runs: suffixes between two content-defined cuts share one digit, the bytes
   that all of them look at.  A run that a document with a smaller id has too is
   settled as a whole: each of its suffixes is repeated.
2. seeds: of a suffix left, the smallest hash of its windows of ``SEED`` bytes.
   It depends on the WIDTH bytes alone, and neighbours mostly share it.
3. subruns: neighbours with one seed are a run again, about fourteen suffixes long, settled as in 1.
4. windows: all WIDTH bytes, of what is left where a seed was found in two documents.

Each pass is a shuffle of sorted digit arrays to the bucket of their first bits
(the radix step), where equal digits meet, and a shuffle of the answers back.
A group of documents sends a digit once, so one string in a third of all documents is one
entry a group.  Digits are 64-bit hashes; those of windows and runs decide
equality (two different strings meet with probability 2**-64).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, Substrings, buffers, load, slices, texts

WIDTH, SEED, CUT, CUT_EVERY = 50, 24, 16, 64
#: Bytes of text in a group of documents, and digits in a bucket, on average.
GROUP_BYTES, BUCKET_DIGITS = 4 << 20, 1 << 19

_ASKED = "b int, g int, digits binary, ids binary"
_TOLD = "g int, pass int, digits binary, ids binary"


def _sliding(x: np.ndarray, n: int) -> np.ndarray:
    """The minimum of each n neighbours."""
    size = 1
    while 2 * size <= n:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (n - size)], x[n - size :]) if n > size else x


class _Slice:
    """Some documents of a group: their suffixes of at least WIDTH bytes and their digits."""

    def __init__(self, batch: pa.RecordBatch, width: int, seed: int):
        self.width, self.seed = width, seed
        ids = batch.column("doc_id")
        self.known = ~ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.data, self.off = buffers(batch.column("text"))
        self.hash = Substrings(self.data)
        n = np.diff(self.off)
        count = np.where(self.known, np.maximum(0, n - width + 1), 0)
        self.at = np.repeat(self.off[:-1] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
        self.doc = np.repeat(np.arange(len(n)), count)
        self.owner = self.ids[self.doc]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First suffix (index) of each run, the one after its last, and its digit."""
        if not len(self.at):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
        cut = self.hash.windows(CUT)[self.at] % np.uint64(CUT_EVERY) == 0
        return self._spans(cut)

    def _spans(self, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cut[0] = True
        cut[1:] |= self.at[1:] != self.at[:-1] + 1
        cut[1:] |= self.doc[1:] != self.doc[:-1]
        first = np.flatnonzero(cut)
        last = np.r_[first[1:], len(self.at)]
        return first, last, self.hash(self.at[first], self.at[last - 1] + self.width)

    def keep(self, mask: np.ndarray) -> None:
        self.at, self.doc, self.owner = self.at[mask], self.doc[mask], self.owner[mask]

    def seeds(self) -> np.ndarray:
        """The seed digit of every suffix."""
        if not len(self.at):
            return np.zeros(0, np.uint64)
        return _sliding(self.hash.windows(self.seed), self.width - self.seed + 1)[self.at]

    def subruns(self, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cut = np.ones(len(seeds), bool)
        cut[1:] = seeds[1:] != seeds[:-1]
        return self._spans(cut) if len(seeds) else ((np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),))

    def windows(self) -> np.ndarray:
        return self.hash(self.at, self.at + self.width) if len(self.at) else np.zeros(0, np.uint64)


def least(digits: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct digits in order, the smallest and the largest id of each."""
    if not len(digits):
        return digits, ids, ids
    order = np.argsort(digits, kind="stable")
    d, i = digits[order], ids[order]
    first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
    return d[first], np.minimum.reduceat(i, first), np.maximum.reduceat(i, first)


def _short(seeds: np.ndarray, buckets: int) -> np.ndarray:
    """A seed's bucket and 32 bits below it: a seed only lets suffixes through, so that is enough."""
    bits = np.uint64((buckets - 1).bit_length())
    high = seeds >> np.uint64(64) - bits << np.uint64(32) if bits else np.uint64(0)
    return high | (seeds << bits) >> np.uint64(32)


class _Known:
    """What a group has been told: of digits of a pass, the smallest id elsewhere; with the group's own, the smallest of all."""

    def __init__(self, table: pa.Table | None):
        self.by: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if table is not None and table.num_rows:
            for k in set(table.column("pass").to_pylist()):
                part = table.filter(pc.equal(table.column("pass"), k))
                digits = np.concatenate([np.frombuffer(x, np.uint64) for x in part.column("digits").to_pylist()])
                ids = np.concatenate([np.frombuffer(x, np.int64) for x in part.column("ids").to_pylist()])
                order = np.argsort(digits)
                self.by[k] = digits[order], ids[order] if len(ids) else ids

    def smaller(self, k: int, digits: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which digits another group's document with a smaller id has."""
        if k not in self.by:
            return np.zeros(len(digits), bool)
        d, i = self.by[k]
        at = np.minimum(np.searchsorted(d, digits), len(d) - 1)
        return (d[at] == digits) & (i[at] < ids)

    def member(self, k: int, digits: np.ndarray) -> np.ndarray:
        if k not in self.by:
            return np.zeros(len(digits), bool)
        d, _ = self.by[k]
        return d[np.minimum(np.searchsorted(d, digits), len(d) - 1)] == digits


def _own(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return least(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))


def _repeated(pass_: int, parts: list[tuple[np.ndarray, np.ndarray]], told: _Known) -> list[np.ndarray]:
    """Of each slice's digits: which a document with a smaller id has, in this group or another."""
    digits, lows, _ = _own(parts)
    out = []
    for d, i in parts:
        here = lows[np.searchsorted(digits, d)] < i if len(d) else np.zeros(0, bool)
        out.append(here | told.smaller(pass_, d, i))
    return out


class _Group:
    """The documents of a group, pass by pass, as far as the answers so far go."""

    def __init__(self, table: pa.Table, told: pa.Table | None, buckets: int, width: int, seed: int):
        self.buckets = buckets
        self.told = _Known(told)
        self.slices = [_Slice(b, width, seed) for b in slices(iter(table.combine_chunks().to_batches()), limit=SLICE_BYTES)]
        self.covered: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in self.slices]

    def asked(self, pass_: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The digits of a pass: distinct, with the smallest and the largest id here."""
        runs = [s.runs() for s in self.slices]
        parts = [(r[2], s.owner[r[0]]) for s, r in zip(self.slices, runs, strict=True)]
        if pass_ == 1:
            return _own(parts)
        self._settle(runs, _repeated(1, parts, self.told))
        seeds = [s.seeds() for s in self.slices]
        if pass_ == 2:
            change = [np.r_[True, x[1:] != x[:-1]] if len(x) else np.zeros(0, bool) for x in seeds]
            for c, s in zip(change, self.slices, strict=True):
                c[1:] |= s.doc[1:] != s.doc[:-1]
            return _own([(x[c], s.owner[c]) for x, c, s in zip(seeds, change, self.slices, strict=True)])
        for k, s in enumerate(self.slices):
            found = self.told.member(2, _short(seeds[k], self.buckets))
            s.keep(found)
            seeds[k] = seeds[k][found]
        runs = [s.subruns(x) for s, x in zip(self.slices, seeds, strict=True)]
        parts = [(r[2], s.owner[r[0]]) for s, r in zip(self.slices, runs, strict=True)]
        if pass_ == 3:
            return _own(parts)
        self._settle(runs, _repeated(3, parts, self.told))
        self.last = [(s.windows(), s.owner) for s in self.slices]
        return _own(self.last)

    def _settle(self, runs: list, repeated: list[np.ndarray]) -> None:
        for k, (s, r, gone) in enumerate(zip(self.slices, runs, repeated, strict=True)):
            if len(r[0]):
                self.covered[k].append((s.at[r[0][gone]], s.at[r[1][gone] - 1] + s.width))
                s.keep(~np.repeat(gone, r[1] - r[0]))

    def result(self) -> Iterator[tuple]:
        """Each row: doc id (or None), bytes, removed bytes, removed spans, hash of the rest, the rest."""
        self.asked(4)
        for k, (s, gone) in enumerate(zip(self.slices, _repeated(4, self.last, self.told), strict=True)):
            self.covered[k].append((s.at[gone], s.at[gone] + s.width))
            depth = np.zeros(len(s.data) + 1, np.int32)
            for a, b in self.covered[k]:
                np.add.at(depth, a, 1)
                np.subtract.at(depth, b, 1)
            removed = np.cumsum(depth[:-1]) > 0
            for i, (a, b) in enumerate(zip(s.off[:-1].tolist(), s.off[1:].tolist(), strict=True)):
                own = removed[a:b]
                rest = s.data[a:b][~own].tobytes()
                spans = int(own[:1].sum() + (own[1:] & ~own[:-1]).sum())
                yield (int(s.ids[i]) if s.known[i] else None, b - a, int(own.sum()), spans, hashlib.sha256(rest).hexdigest(), rest)


def _ask(pass_: int, buckets: int, width: int, seed: int):
    shift = np.uint64(64 - (buckets - 1).bit_length()) if buckets > 1 else None

    def run(key: tuple, docs: pa.Table, told: pa.Table | None = None) -> pa.Table:
        out: dict[str, list] = {"b": [], "g": [], "digits": [], "ids": []}
        if docs.num_rows:
            digits, low, high = _Group(docs, told, buckets, width, seed).asked(pass_)
            bucket = (digits >> shift).astype(np.int64) if shift is not None else np.zeros(len(digits), np.int64)
            first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(digits) else np.zeros(0, np.int64)
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(digits)], strict=True):
                out["b"].append(int(bucket[a]))
                out["g"].append(docs.column("g")[0].as_py())
                if pass_ == 2:
                    # Those of two documents here are marked.
                    out["digits"].append(_short(digits[a:b], buckets).astype(np.uint32).tobytes())
                    out["ids"].append(np.packbits(low[a:b] < high[a:b]).tobytes())
                else:
                    out["digits"].append(digits[a:b].tobytes())
                    out["ids"].append(low[a:b].tobytes())
        kinds = {"b": pa.int32(), "g": pa.int32(), "digits": pa.binary(), "ids": pa.binary()}
        return pa.table({k: pa.array(v, kinds[k]) for k, v in out.items()})

    if pass_ == 1:
        return lambda key, docs: run(key, docs)
    return lambda key, docs, told: run(key, docs, told)


def _meet(pass_: int):
    def run(table: pa.Table) -> pa.Table:
        groups = table.column("g").to_pylist()
        kind = np.uint32 if pass_ == 2 else np.uint64
        arrays = [np.frombuffer(x, kind) for x in table.column("digits").to_pylist()]
        sizes = [len(x) for x in arrays]
        digits, of = np.concatenate(arrays), np.repeat(np.arange(len(arrays)), sizes)
        if pass_ == 2:
            marks = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(table.column("ids").to_pylist(), sizes, strict=True)])
        else:
            ids = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("ids").to_pylist()])
        order = np.argsort(digits, kind="stable")
        d = digits[order]
        first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]]) if len(d) else np.zeros(0, np.int64)
        width = np.diff(np.r_[first, len(d)])
        if pass_ == 2:
            found = np.repeat((width > 1) | (np.maximum.reduceat(marks[order], first) > 0), width) if len(d) else np.zeros(0, bool)
        else:
            low = np.repeat(np.minimum.reduceat(ids[order], first), width) if len(d) else ids
            found = low < ids[order]  # the group of the smallest id knows it
        if pass_ == 2:
            digits = digits.astype(np.uint64) | np.uint64(table.column("b")[0].as_py() << 32)
        told = order[found]
        by = np.argsort(of[told], kind="stable")
        told, values = told[by], None if pass_ == 2 else low[found][by]
        cuts = np.searchsorted(of[told], np.arange(len(arrays) + 1))
        out: dict[str, list] = {"g": [], "pass": [], "digits": [], "ids": []}
        for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            if b > a:
                out["g"].append(groups[k])
                out["pass"].append(pass_)
                out["digits"].append(digits[told[a:b]].tobytes())
                out["ids"].append(b"" if values is None else values[a:b].tobytes())
        kinds = {"g": pa.int32(), "pass": pa.int32(), "digits": pa.binary(), "ids": pa.binary()}
        return pa.table({k: pa.array(v, kinds[k]) for k, v in out.items()})

    return run


def _finish(whole: bool, buckets: int, width: int, seed: int):
    def run(key: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
        rows = list(_Group(docs, told, buckets, width, seed).result()) if docs.num_rows else []
        cols = list(zip(*rows, strict=True)) or [()] * 6
        out = {"doc_id": pa.array(cols[0], pa.int64()), "n_bytes": pa.array(cols[1], pa.int64()), "n_removed": pa.array(cols[2], pa.int64()), "n_spans": pa.array(cols[3], pa.int64()), "kept_sha256": pa.array(cols[4], pa.string())}
        if whole:
            out["kept_bytes"] = pa.array(cols[5], pa.binary())
        return pa.table(out)

    return run


def without_repeats(docs: DataFrame, width: int = WIDTH, seed: int = SEED, whole: bool = True) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, and ``kept_bytes`` if ``whole``.

    A byte is removed if a ``width``-byte string that covers it also starts in a
    document with a smaller ``doc_id``; texts are UTF-8 bytes, and what is left of
    a character is left.  Null texts count as empty.  Texts shorter than ``width`` stay whole.  A
    row without ``doc_id`` stays whole and removes nothing elsewhere; rows that repeat one are
    one document, so they do not remove each other.  Texts of any length are taken whole.
    """
    if width < seed or width < CUT:
        raise ValueError("a window must be as long as its seed and a cut")
    spark = docs.sparkSession
    read = texts(docs)
    size = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))
    buckets = 1 << max(0, (size // 14 // BUCKET_DIGITS).bit_length())
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The one shuffle of texts; all five consumers below are planned on it, and Spark reuses it.
    grouped = read.select(F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0))), F.lit(groups)).cast("int").alias("g"), "doc_id", "text").repartition(n, "g")
    told = None
    for pass_ in (1, 2, 3, 4):
        ask = _ask(pass_, buckets, width, seed)
        if told is None:
            asked = grouped.groupBy("g").applyInArrow(ask, _ASKED)
        else:
            asked = grouped.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(ask, _ASKED)
        answer = asked.groupBy("b").applyInArrow(_meet(pass_), _TOLD)
        told = answer if told is None else told.unionByName(answer)
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept_bytes binary" * whole
    return grouped.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(_finish(whole, buckets, width, seed), schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op6: every document's text against all others'."""
    return without_repeats(load(spark, sf_dir, "documents"), whole=False)
