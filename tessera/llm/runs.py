"""Periodic run detection in documents' words by recompression (operator 11).

A run is a stretch of words with smallest period q, at least ``LEAST`` words and two
periods long, that no neighbouring word extends.  Words are numbered exactly (a
dictionary of a batch's words), and the batch becomes one sequence in which a
separator of its own ends each document, so nothing matches across documents.

**Grammar.** Rounds of block compression (a stretch of one symbol becomes one symbol) and
pair compression (symbols are dealt to left and right; each left symbol followed by a
right one becomes one symbol with it) go on until each document is one symbol.  Equal
stretches are cut alike except at their rims, as each cut depends on two neighbours.

**Extensions.** The longest common extension of two places climbs the levels while the
symbols there agree, stepping over what doesn't begin (backward: end) at its parent, and
then descends to the first word that differs: a few steps a level, no suffix array.
All queries of a batch climb together.

**Candidates.** A run of period p and m words holds m - p pairs (a, a + p) side by side, so
a grid of step ``max(p, LEAST - p)`` meets one of them: about n ln n pairs in all, of
which those of unequal words go at once.  Equal stretches around a pair, extended both
ways, are the run; of one stretch found with several periods the smallest counts.

A document is handled whole by one task, short ones in batches; memory grows with the
longest document.  A null or empty text has no words and no run.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import buffers, load, mix, slices, texts, word_spans

LEAST = 12
#: Pairs that are extended at once.
_CHUNK = 1 << 19
#: Equal words looked for beside a pair of a long period before it is extended.
_SIDE = 4


class Grammar:
    """The levels of a sequence under recompression; level 0 is the sequence itself.

    ``fixed`` marks symbols that are never joined (separators, each used once).
    """

    def __init__(self, sequence: np.ndarray, fixed: np.ndarray):
        self.symbols = [sequence]
        #: Of each step up: first child of each parent (and the end), parent of each child, right-hand marks (None for blocks).
        self.first: list[np.ndarray] = []
        self.parent: list[np.ndarray] = []
        self.right: list[np.ndarray | None] = []
        names, idle, seed = int(sequence.max(initial=0)) + 1, 0, 0
        free = ~fixed
        while True:
            s = self.symbols[-1]
            solid = free[:-1] & free[1:]
            if not solid.any():
                return
            same = solid & (s[1:] == s[:-1])
            if same.any():
                s, free, names = self._up(s, free, same, None, names)
                solid = free[:-1] & free[1:]
            side = (mix(s.astype(np.uint64) + np.uint64(seed * 0x9E37_79B9)) >> np.uint64(17)) & np.uint64(1) != 0
            seed += 1
            joined = solid & ~side[:-1] & side[1:]
            turned = solid & side[:-1] & ~side[1:]
            if np.count_nonzero(turned) > np.count_nonzero(joined):
                side, joined = ~side, turned
            if joined.any():
                s, free, names = self._up(s, free, joined, side, names)

    def _up(self, s, free, joined, side, names):
        """One level more, in which each place of ``joined`` is one with the next; what was joined gets new names, equal for equal."""
        starts = np.flatnonzero(np.r_[True, ~joined])
        first = np.r_[starts, len(s)]
        size = np.diff(first)
        top = s[starts].copy()
        many = np.flatnonzero(size > 1)
        # A pair is named by both symbols, a block by its symbol and length.
        second = s[starts[many] + 1] if side is not None else size[many]
        code, at = _named(top[many], second)
        top[many] = names + at
        parent = np.zeros(len(s), np.int64)
        parent[starts[1:]] = 1
        self.first.append(first)
        self.parent.append(np.cumsum(parent))
        self.right.append(side)
        self.symbols.append(top)
        return top, free[starts], names + code

    def extend(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from ``a`` on equal those from ``b`` on, going up or down; a and b must differ, and a separator lie ahead."""
        start, step = a, 1 if forward else -1
        out = np.zeros(len(a), np.int64)
        alive = np.arange(len(a))
        stopped: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for level, s in enumerate(self.symbols):
            last = level + 1 == len(self.symbols)
            same = s[a] == s[b]
            if last:
                while same.any():
                    a, b = a + step * same, b + step * same
                    same = s[a] == s[b]
            elif same.any():
                ends = np.zeros(len(a), bool)
                parent, first, side = self.parent[level], self.first[level], self.right[level]
                if side is None:
                    left_a, left_b = self._left(level, a, forward), self._left(level, b, forward)
                    inside = same & ~(self._rim(level, a, forward) & self._rim(level, b, forward))
                    move = np.where(inside, np.minimum(left_a, left_b), 0)
                    ends = inside & (left_a != left_b)
                else:
                    # What lies at its parent's far side, or alone, is stepped over.
                    move = same & (side[a] if forward else ~side[a])
                a, b = a + step * move, b + step * move
                same &= ~ends
            stopped.append((alive[~same], a[~same], b[~same]))
            if last or not same.any():
                break
            alive, a, b = alive[same], parent[a[same]], parent[b[same]]
        # Down again: symbols differ, so all but a few words of their expansions do.
        who, a, b = (np.zeros(0, np.int64) for _ in range(3))
        for level in range(len(stopped) - 1, -1, -1):
            if len(who):
                s, first = self.symbols[level], self.first[level]
                pa_, pb_ = a, b
                a, b = (first[a], first[b]) if forward else (first[a + 1] - 1, first[b + 1] - 1)
                same = s[a] == s[b]
                shared = 1 if self.right[level] is not None else np.minimum(first[pa_ + 1] - first[pa_], first[pb_ + 1] - first[pb_])
                a, b = a + step * same * shared, b + step * same * shared
            more = stopped[level]
            who, a, b = np.r_[who, more[0]], np.r_[a, more[1]], np.r_[b, more[2]]
        out[who] = (a - start[who]) * step
        return out

    def _left(self, level, a, forward):
        """Children of a's parent from a on, itself included."""
        first, parent = self.first[level], self.parent[level][a]
        return first[parent + 1] - a if forward else a - first[parent] + 1

    def _rim(self, level, a, forward):
        first, parent = self.first[level], self.parent[level][a]
        return a == first[parent] if forward else a == first[parent + 1] - 1


def _named(x: np.ndarray, y: np.ndarray) -> tuple[int, np.ndarray]:
    """The number of different pairs (x, y), and of each pair its number."""
    if not len(x):
        return 0, np.zeros(0, np.int64)
    values, at = np.unique(x.astype(np.int64) * (int(y.max()) + 1) + y, return_inverse=True)
    return len(values), at


def _grid(length: int, longest: int, least: int) -> Iterator[tuple[np.ndarray | int, np.ndarray | int, slice, slice]]:
    """Grid pairs of all periods: (first places, periods, and both places as slices of the sequence), a period or a row of the grid at a time."""
    most = longest // 2
    cut = max(least, int(length**0.5))
    for p in range(1, min(most, cut) + 1):
        step = max(p, least - p)
        yield step, p, slice(0, max(0, length - p), step), slice(p, length, step)
    # Row 0 starts at the first separator, which equals nothing.
    for k in range(1, (length - 1) // (cut + 1)):
        end = min(most, (length - 1) // (k + 1))
        if end > cut:
            yield -k, cut + 1, slice(k * (cut + 1), k * end + 1, k), slice((k + 1) * (cut + 1), (k + 1) * end + 1, k + 1)


def find_runs(words: np.ndarray, at: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (exclusive) and periods of all runs of a batch.

    ``words`` are the word numbers of all documents end to end, from 0; ``at`` the n + 1
    offsets of the documents in them.  Places are those of ``words``; sorted by start, then period.
    """
    none = np.zeros(0, np.int64)
    sizes = np.diff(at)
    longest = int(sizes.max(initial=0))
    if longest < least:
        return none, none, none
    # A separator before each document and after the last; symbol ids above all words.
    n, docs = len(words), len(sizes)
    doc = np.repeat(np.arange(docs), sizes)
    place = np.arange(n) + doc + 1
    seq = np.zeros(n + docs + 1, np.int64)
    seq[place] = words
    walls = at + np.arange(docs + 1)
    top = int(words.max(initial=0)) + 1
    seq[walls] = top + np.arange(docs + 1)
    fixed = np.zeros(len(seq), bool)
    fixed[walls] = True
    owner = np.zeros(len(seq), np.int64)
    owner[place] = doc
    owner[walls] = -1
    grammar = Grammar(seq, fixed)
    covered = np.zeros((2, len(seq)), np.int64)  # period and end of a run over each place
    found: list[np.ndarray] = []

    def settle(a: np.ndarray, p: np.ndarray) -> None:
        """Extends pairs of equal words to their runs."""
        # A pair inside a run of a period that divides p gives that run again.
        q, end = covered[0, a], covered[1, a]
        fresh = (q == 0) | (p % np.maximum(q, 1) != 0) | (a + p >= end)
        a, p = a[fresh], p[fresh]
        if not len(a):
            return
        b = a + p
        ahead = grammar.extend(a, b, True)
        behind = grammar.extend(a - 1, b - 1, False)
        start, end = a - behind, b + ahead
        keep = end - start >= np.maximum(least, 2 * p)
        if keep.any():
            got = np.unique(np.stack([start[keep], end[keep], p[keep]]), axis=1)
            found.append(got)
            for s, e, q in got[:, np.argsort(got[1] - got[0])[-1024:]].T.tolist():
                if e - s > max(covered[1, s] - s, 64):
                    covered[0, s:e], covered[1, s:e] = q, e

    held, count = [], 0
    for first, period, left, right in _grid(len(seq), longest, least):
        x, y = seq[left], seq[right]
        hit = np.flatnonzero(x == y)
        if not len(hit):
            continue
        if first > 0:
            a, p = hit * first, np.full(len(hit), period, np.int64)
        else:
            p = period + hit
            a = -first * p
        ok = (owner[a] >= 0) & (owner[a] == owner[a + p])
        if period >= 2 * _SIDE - 2:
            # Of that many equal words around the pair, _SIDE lie from it on, or _SIDE - 1 before it.
            fore, back = ok.copy(), ok.copy()
            for k in range(1, _SIDE):
                fore &= seq[np.minimum(a + k, len(seq) - 1)] == seq[np.minimum(a + p + k, len(seq) - 1)]
                back &= seq[np.maximum(a - k, 0)] == seq[np.maximum(a + p - k, 0)]
            ok = fore | back
        a, p = a[ok], p[ok]
        for k in range(0, len(a), _CHUNK):
            held.append((a[k : k + _CHUNK], p[k : k + _CHUNK]))
            count += len(held[-1][0])
            # Short periods are settled as they come, so that longer ones can skip what they cover.
            if count >= _CHUNK or (first > 0 and period <= 64):
                settle(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                held, count = [], 0
    if held:
        settle(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
    if not found:
        return none, none, none
    start, end, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])]
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    shift = owner[start] + 1
    return start - shift, end - shift, period


def word_numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Each word's number, equal for equal bytes."""
    off = np.r_[0, np.cumsum(end - start)]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(off), pa.py_buffer(_bytes(data, start, end))])
    return pc.dictionary_encode(words).indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _bytes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The bytes of the stretches [start, end), one after the other."""
    size = end - start
    total = int(size.sum())
    if not total:
        return np.zeros(0, np.uint8)
    off = np.cumsum(size) - size
    return data[np.arange(total) + np.repeat(start - off, size)]


def repeated_part(doc_ids: list[int | None], at: np.ndarray) -> np.ndarray:
    """Of each word of a batch the word that stands for it: documents whose crc32 of the id ends in 0 repeat a part of themselves up to their end.

    A document without an id stays as it is.
    """
    stands = np.arange(int(at[-1]))
    for k, i in enumerate(doc_ids):
        n = int(at[k + 1] - at[k])
        h = 1 if i is None else zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            stands[at[k] + a : at[k + 1]] = at[k] + a + np.arange(n - a) % p
    return stands


def _batch(batch: pa.RecordBatch, least: int, altered: bool) -> Iterator[dict]:
    """Of each document of a batch: its runs (arrays of start, length, period) and its text without them."""
    data, off = buffers(batch.column("text"))
    first, last, at = word_spans(data, off)
    ids = batch.column("doc_id").to_pylist()
    if altered:
        stands = repeated_part(ids, at)
        first, last = first[stands], last[stands]
    start, end, period = find_runs(word_numbers(data, first, last), at, least)
    gone = np.zeros(len(first) + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, end, -1)
    kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
    # Kept words with one space before each.
    size = last[kept] - first[kept] + 1
    ends = np.cumsum(size)
    text = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    body = np.ones(len(text), bool)
    body[ends - size] = False
    text[body] = _bytes(data, first[kept], last[kept])
    raw = text.tobytes()
    word_cut = np.searchsorted(kept, at)
    byte_cut = np.r_[0, ends][word_cut]
    run_cut = np.searchsorted(start, at)
    for k, i in enumerate(ids):
        own = slice(run_cut[k], run_cut[k + 1])
        yield {"doc_id": i, "start": start[own] - at[k], "length": (end - start)[own], "period": period[own], "text": raw[byte_cut[k] + 1 : byte_cut[k + 1]]}


def _mapped(docs: DataFrame, least: int, altered: bool, schema: str, row) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_pylist([row(d) for d in _batch(batch, least, altered)], schema=fields)

    return texts(docs).mapInArrow(run, schema)


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, runs, collapsed`` of each row: its runs as an array of (start, length, period) in words, by start, then period,
    and its text in which each run is cut down to one period and words are joined by one space.

    A null text counts as empty.  A null doc_id stays null.
    """

    def row(d):
        runs = np.stack([d["start"], d["length"], d["period"]], axis=1).tolist()
        return {"doc_id": d["doc_id"], "runs": [{"start": s, "length": n, "period": p} for s, n, p in runs], "collapsed": d["text"].decode()}

    return _mapped(docs, least, False, "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string", row)


def digests(docs: DataFrame, least: int = LEAST, altered: bool = True) -> DataFrame:
    """Of each row: ``doc_id, n_runs``, the longest run's ``start, length, period, exponent_milli`` (null without one; ties: smallest start, then period), ``runs_sha256, collapsed_sha256``.

    ``altered`` makes a tenth of the documents repeat a part of themselves first, as ``repeated_part`` says.
    """

    def row(d):
        start, length, period = d["start"], d["length"], d["period"]
        # Runs are in order of start, then period, so the first of greatest length is it.
        k = int(np.argmax(length)) if len(length) else None
        told = "".join(f"{s},{n},{p}\n" for s, n, p in zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
        one = (None, None, None) if k is None else (int(start[k]), int(length[k]), int(period[k]))
        return {
            "doc_id": d["doc_id"], "n_runs": len(start), "start": one[0], "length": one[1], "period": one[2], "exponent_milli": one[0] if k is None else 1000 * one[1] // one[2],
            "runs_sha256": hashlib.sha256(told.encode()).hexdigest(), "collapsed_sha256": hashlib.sha256(d["text"]).hexdigest(),
        }

    schema = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
    return _mapped(docs, least, altered, schema, row)


def query(spark, sf_dir: str) -> DataFrame:
    """op11: the runs of every document, a tenth of which repeat a part of themselves."""
    return digests(load(spark, sf_dir, "documents"))
