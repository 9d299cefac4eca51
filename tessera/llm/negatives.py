"""Hard-negative mining with an inverted multi-index (operator 12): exact, by integer inner products.

A vector is cut into two halves, and each half has a codebook of its own; a pair
of codewords is a cell.  For an anchor (a, b) a row of cell (i, j) scores at most
``a.c_i + |a| r_i + b.d_j + |b| s_j``, where r and s are the radii of the codewords, so
the multi-sequence heap over the two sorted lists of half bounds visits cells by the
greatest score they can hold, and a cell whose least possible score is above all of
an anchor's windows is passed over.  A window (least score, greatest score, k) is
certified when its kth row scores more than any unvisited cell can; an anchor goes on,
with more rows each round, until all its windows are.  First the windows are
"same label, any score", which gives the positives, then "another label, between
the ratios of a positive's score", which gives its negatives.

Rows with equal vector and label are one entry with its smallest ids, cut before
the shuffle; no more of them can count.  The index is a table of blocks of at most
``BLOCK`` entries, a hot cell has many; anchors travel in groups, so the join
of blocks and groups carries each vector once a block or group.  Codebooks are fitted in a
task on about ``SAMPLE`` entries (by hash); they decide the order of visits only.

Rows with a null id, label or vector, or a null or non-finite component, take no
part.  Of rows that repeat an id, the first by label, then vector stays.  Vectors are compared
with those of as many components.  Sums of products must fit in 64 bits (components up to about
a million).  Ties go by id.  An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import load, stored

SCALE, EVERY, POSITIVES, NEGATIVES, LOW, HIGH = 256, 50, 5, 3, 50, 95
SAMPLE, CELL, CODEWORDS, BLOCK, GROUP = 20_000, 256, 256, 1024, 512
#: Index entries an anchor visits in its first round, and how many times more in each later one.
FIRST, GROWTH = 1 << 14, 8
_MIN, _MAX = -(1 << 62), 1 << 62


def quantised(vectors: DataFrame, scale: int = SCALE, label=None) -> DataFrame:
    """``id, label, vec``: each component x of ``embedding`` as floor(scale * x); ``label`` may be a column computed of ``vec_id, label``."""
    label = F.col("label") if label is None else label
    v = vectors.select(F.col("vec_id").cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col("embedding").alias("v"))
    x = v.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    x = x.where(~F.exists("v", lambda c: odd(c.cast("double"))))
    x = x.select("id", F.struct("label", F.transform("v", lambda c: F.floor(c.cast("double") * scale)).alias("vec")).alias("e"))
    return x.groupBy("id").agg(F.min("e").alias("e")).select("id", "e.label", "e.vec")


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices; by floats where all sums are below 2**53."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.argmin((book**2).sum(1)[None, :] - 2.0 * (x @ book.T), axis=1)


def _codebook(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means from rows that lie apart in the sample; codewords are whole numbers."""
    book = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(np.int64)].astype(np.float64)
    for _ in range(rounds):
        at = _nearest(x, book)
        total = np.zeros_like(book)
        np.add.at(total, at, x)
        count = np.bincount(at, minlength=len(book))
        book = np.where(count[:, None] > 0, np.rint(total / np.maximum(count, 1)[:, None]), book)
    return np.unique(book, axis=0)


class MultiIndex:
    """What every task gets of an index: codebooks of both halves, their radii and the cells' sizes (``CODEWORDS`` squared numbers at most)."""

    def __init__(self, books: list[np.ndarray], radii: list[np.ndarray], sizes: np.ndarray):
        self.books, self.radii, self.sizes = books, radii, sizes
        self.cut = books[0].shape[1]
        self.width = self.cut + books[1].shape[1]

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each anchor and codeword of either half the greatest scores and the least."""
        out = []
        for a, book, radius in ((anchors[:, : self.cut], self.books[0], self.radii[0]), (anchors[:, self.cut :], self.books[1], self.radii[1])):
            a = a.astype(np.float64)
            middle, reach = a @ book.T, np.sqrt((a**2).sum(1))[:, None] * radius[None, :]
            slack = 1e-6 + 1e-9 * (np.abs(middle) + reach)
            out.append((middle + reach + slack, middle - reach - slack))
        return out[0][0], out[1][0], out[0][1], out[1][1]

    def visits(self, up_i: np.ndarray, up_j: np.ndarray, low_i: np.ndarray, low_j: np.ndarray, skip: int, budget: int, least: float, most: float):
        """The multi-sequence walk of one anchor: the cells after the first ``skip`` of it, until they hold ``budget`` entries or can score no ``least``;
        cells that only score above ``most`` are left out.  Also how many cells were passed in all, and the greatest score of those that were not."""
        order_i, order_j = np.argsort(-up_i, kind="stable").tolist(), np.argsort(-up_j, kind="stable").tolist()
        bound = lambda x, y: -(up_i[order_i[x]] + up_j[order_j[y]])
        heap, cells, passed, held = [(bound(0, 0), 0, 0)], [], 0, 0
        while heap and held < budget and -heap[0][0] >= least:
            _, x, y = heapq.heappop(heap)
            # Each cell is pushed by one other: along a row, and down the first column.
            if y + 1 < len(order_j):
                heapq.heappush(heap, (bound(x, y + 1), x, y + 1))
            if y == 0 and x + 1 < len(order_i):
                heapq.heappush(heap, (bound(x + 1, 0), x + 1, 0))
            passed += 1
            i, j = order_i[x], order_j[y]
            if passed > skip and self.sizes[i, j] and low_i[i] + low_j[j] <= most:
                cells.append(i * self.sizes.shape[1] + j)
                held += int(self.sizes[i, j])
        return cells, passed, -heap[0][0] if heap else -math.inf


def build(entries: DataFrame, width: int, count: int) -> tuple[MultiIndex, DataFrame]:
    """The index of ``entries`` (``vec, label, ids``) and its table of blocks."""
    books = _fit(entries, width, count)
    placed = stored(_placed(entries, books), "cells")
    radii = []
    for half, book in zip("ij", books, strict=True):
        far = dict(placed.groupBy(half).agg(F.max(f"far_{half}").alias("far")).collect())
        # Rounding of a radius must not lose a row.
        radii.append(np.array([far.get(k, 0.0) * (1 + 1e-9) for k in range(len(book))]))
    sizes = np.zeros((len(books[0]), len(books[1])), np.int64)
    for i, j, n in placed.groupBy("i", "j").agg(F.count("*")).collect():
        sizes[i, j] = n
    # Ranges of (cell, hash), so that a cell of any size is cut evenly.
    dealt = placed.repartitionByRange("i", "j", F.xxhash64("vec", "label")).sortWithinPartitions("i", "j")
    blocks = stored(dealt.mapInArrow(_blocks(width), "cell int, vecs binary, labels binary, ids binary, counts binary"), "blocks")
    return MultiIndex(books, radii, sizes), blocks


def _fit(entries: DataFrame, width: int, count: int) -> list[np.ndarray]:
    """Both codebooks, fitted in one task on a bounded sample."""
    cut = (width + 1) // 2
    words = max(1, min(CODEWORDS, math.isqrt(count // CELL)))
    share = min(1.0, SAMPLE / max(1, count))
    some = entries.where(F.pmod(F.xxhash64("vec", "label"), F.lit(1 << 30)) <= int(share * (1 << 30))).select("vec")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_matrix(b.column("vec"), width) for b in batches if b.num_rows]
        if parts:
            x = np.concatenate(parts)
            # Order of arrival must not matter.
            x = x[np.lexsort(x.T)]
            for half, y in enumerate((x[:, :cut], x[:, cut:])):
                rows = _codebook(y, words).tolist()
                yield pa.RecordBatch.from_pydict({"half": pa.array([half] * len(rows), pa.int32()), "word": pa.array(rows, pa.list_(pa.float64()))})

    got = some.repartition(1).mapInArrow(fit, "half int, word array<double>").collect()
    books = []
    for half, size in ((0, cut), (1, width - cut)):
        rows = sorted(tuple(r.word) for r in got if r.half == half)
        books.append(np.array(rows, np.float64).reshape(len(rows), size) if rows else np.zeros((1, size)))
    return books


def _placed(entries: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``entries`` with the codeword of each half and the distance from it."""
    cut = books[0].shape[1]
    width = cut + books[1].shape[1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("vec"), width).astype(np.float64)
            got = []
            for y, book in ((x[:, :cut], books[0]), (x[:, cut:], books[1])):
                at = _nearest(y, book)
                got += [pa.array(at, pa.int32()), pa.array(np.sqrt(((y - book[at]) ** 2).sum(1)))]
            yield pa.RecordBatch.from_arrays([*b.columns, *got], names=[*b.schema.names, "i", "far_i", "j", "far_j"])

    return entries.select("label", "vec", "ids").mapInArrow(place, "label bigint, vec array<bigint>, ids array<bigint>, i int, far_i double, j int, far_j double")


def _blocks(width: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Consecutive entries of one cell, as bytes."""
        for b in batches:
            i, j = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("i", "j"))
            cuts = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            ends = [*cuts[1:].tolist(), b.num_rows]
            rows = [(s, min(s + BLOCK, e)) for a, e in zip(cuts.tolist(), ends, strict=True) for s in range(a, e, BLOCK)]
            out = []
            for s, e in rows:
                ids = b.column("ids").slice(s, e - s)
                out.append(
                    {
                        "cell": int(i[s]) << 16 | int(j[s]), "vecs": _matrix(b.column("vec").slice(s, e - s), width).tobytes(),
                        "labels": b.column("label").slice(s, e - s).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
                        "ids": ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
                        "counts": ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32).tobytes(),
                    }
                )
            kinds = [("cell", pa.int32()), *[(c, pa.binary()) for c in ("vecs", "labels", "ids", "counts")]]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(kinds))

    return pack


def best(who: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the first k rows of each ``who``: greatest score, then smallest id."""
    order = np.lexsort((ids, -score, who))
    group = who[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    nth = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
    return order[nth < k]


def search(index: MultiIndex, blocks: DataFrame, anchors: DataFrame, k: int, same_label: bool) -> DataFrame:
    """``a, w, score, id``: of each window of ``anchors`` (``a bigint, label, vec, windows array<struct<w: bigint, low: bigint, high: bigint>>``)
    the k rows of the same label, or of others, with greatest score from low to high; of equal scores those of smallest id."""
    open_ = anchors.select("a", "label", "vec", F.transform("windows", lambda w: F.struct(w["w"].alias("w"), w["low"].alias("low"), w["high"].alias("high"), F.lit(_MIN).cast("bigint").alias("kth"))).alias("windows"), F.lit(0).alias("passed"))
    open_ = stored(open_.where(F.size("windows") > 0), "anchors")
    found, budget = None, FIRST
    first = Window.partitionBy("a", "w").orderBy(F.desc("score"), "id")
    while True:
        walks = stored(open_.mapInArrow(_walk(index, budget), "grp string, cell int, places binary, vecs binary, labels binary, keys binary, windows binary, state binary"), "walks")
        told = walks.where("cell IS NULL").select("grp", "vecs", "labels", "keys", "windows")
        # Blocks and groups meet by cell; what a row carries is one block and one group.
        pairs = walks.where("cell IS NOT NULL").select("grp", "cell", "places").join(told.withColumnRenamed("vecs", "avecs").withColumnRenamed("labels", "alabels"), "grp").join(blocks, "cell")
        hits = pairs.mapInArrow(_score(index.width, k, same_label), "a bigint, w bigint, score bigint, id bigint")
        if found is not None:
            hits = hits.unionByName(found)
        found = stored(hits.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k).drop("nth"), "found")
        state = walks.where("cell IS NULL").select(F.explode(F.from_json(F.col("state").cast("string"), "array<struct<a: bigint, passed: int, bound: double>>")).alias("s")).select("s.*")
        full = found.groupBy("a", "w").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") == k)
        full = full.groupBy("a").agg(F.map_from_entries(F.collect_list(F.struct("w", "kth"))).alias("kths"))
        now = open_.drop("passed").join(state, "a").join(full, "a", "left")
        # A window is certified if no unvisited cell can hold its kth row's score, or any of its scores.
        kth = lambda w: F.coalesce(F.element_at("kths", w["w"]), F.lit(_MIN).cast("bigint"))
        new = F.transform("windows", lambda w: F.struct(w["w"].alias("w"), w["low"].alias("low"), w["high"].alias("high"), kth(w).alias("kth")))
        left = F.filter(new, lambda w: (F.col("bound") >= w["low"]) & (F.col("bound") >= w["kth"]))
        open_ = stored(now.select("a", "label", "vec", left.alias("windows"), "passed").where(F.size("windows") > 0), "anchors")
        if open_.isEmpty():
            return found
        budget *= GROWTH


def _walk(index: MultiIndex, budget: int):
    width = index.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        schema = pa.schema([("grp", pa.string()), ("cell", pa.int32()), *[(c, pa.binary()) for c in ("places", "vecs", "labels", "keys", "windows", "state")]])
        for batch in batches:
            for s in range(0, batch.num_rows, GROUP):
                b = batch.slice(s, GROUP)
                vecs, windows = _matrix(b.column("vec"), width), b.column("windows").to_pylist()
                keys, passed = b.column("a").to_numpy().astype(np.int64), b.column("passed").to_pylist()
                up_i, up_j, low_i, low_j = index.bounds(vecs)
                cells: dict[int, list[int]] = {}
                state = []
                for n, own in enumerate(windows):
                    least = min(max(w["low"], w["kth"]) for w in own)
                    seen, done, bound = index.visits(up_i[n], up_j[n], low_i[n], low_j[n], passed[n], budget, least, max(w["high"] for w in own))
                    for c in seen:
                        cells.setdefault(c, []).append(n)
                    state.append({"a": int(keys[n]), "passed": done, "bound": max(bound, -1e300)})
                grp, wide = f"{task}-{number}", index.sizes.shape[1]
                number += 1
                table = np.array([(n, w["w"], w["low"], w["high"], w["kth"]) for n, own in enumerate(windows) for w in own], np.int64)
                rows = [{"grp": grp, "vecs": vecs.tobytes(), "labels": b.column("label").to_numpy().astype(np.int64).tobytes(), "keys": keys.tobytes(), "windows": table.tobytes(), "state": json.dumps(state).encode()}]
                rows += [{"grp": grp, "cell": c // wide << 16 | c % wide, "places": np.array(p, np.int32).tobytes()} for c, p in cells.items()]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _score(width: int, k: int, same_label: bool):
    """Scores blocks against groups; a task keeps the best k rows a window of the groups it holds, and gives them out when they are many."""

    def hits(row: dict) -> np.ndarray | None:
        load_ = lambda c, kind=np.int64: np.frombuffer(row[c], kind)
        vecs, labels, ids, counts = load_("vecs").reshape(-1, width), load_("labels"), load_("ids"), load_("counts", np.int32)
        places, windows = load_("places", np.int32), load_("windows").reshape(-1, 5)
        scores = _product(load_("avecs").reshape(-1, width)[places], vecs)
        fits = (load_("alabels")[places][:, None] == labels[None, :]) == same_label
        slot = np.full(len(load_("keys")), -1)
        slot[places] = np.arange(len(places))
        windows = windows[slot[windows[:, 0]] >= 0]
        row_of = slot[windows[:, 0]]
        own = scores[row_of]
        low = np.maximum(windows[:, 2], windows[:, 4])
        own = np.where(fits[row_of] & (own >= low[:, None]) & (own <= windows[:, 3][:, None]), own, _MIN)
        if own.shape[1] > k:
            kth = np.partition(own, own.shape[1] - k, axis=1)[:, own.shape[1] - k]
            own = np.where(own >= kth[:, None], own, _MIN)
        x, y = np.nonzero(own > _MIN)
        if not len(x):
            return None
        n = counts[y]
        first = np.cumsum(counts) - counts
        each = np.repeat(first[y] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.stack([load_("keys")[windows[x, 0]].repeat(n), windows[x, 1].repeat(n), own[x, y].repeat(n), ids[each]])

    def cut(parts: list[np.ndarray]) -> np.ndarray:
        rows = np.concatenate(parts, axis=1)
        _, who = np.unique(rows[:2], axis=1, return_inverse=True)
        return rows[:, best(who.reshape(-1), rows[2], rows[3], k)]

    def out(rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names=["a", "w", "score", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, kept = [], 0, 0
        for batch in batches:
            for r in range(batch.num_rows):
                got = hits(batch.slice(r, 1).to_pylist()[0])
                if got is None:
                    continue
                held.append(got)
                size += got.shape[1]
                if size > max(1 << 17, 2 * kept):
                    held = [cut(held)]
                    size = kept = held[0].shape[1]
                    if kept > 1 << 20:
                        yield out(held[0])
                        held, size, kept = [], 0, 0
        if held:
            yield out(cut(held))

    return run


def mined(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``vectors`` (``id, label, vec`` as ``quantised`` gives them)
    and ``anchors`` (``id``): with each of the anchor's first ``positives`` rows of its label the first ``negatives`` rows
    of other labels that score between ``low`` and ``high`` percent of it."""
    rows = stored(vectors, "vectors")
    out = None
    # Vectors have one width in nearly all tables; each other one is an index by itself.
    for width in sorted(r[0] for r in rows.select(F.size("vec").alias("n")).distinct().collect()):
        if width:
            one = _mined(rows.where(F.size("vec") == width), anchors, width, positives, negatives, low, high)
            out = one if out is None else out.unionByName(one)
    if out is None:
        return rows.sparkSession.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    return out


def _mined(rows: DataFrame, anchors: DataFrame, width: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    most = max(positives + 1, negatives)
    by_id = Window.partitionBy("vec", "label").orderBy("id")
    entries = rows.withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= most)
    entries = stored(entries.groupBy("vec", "label").agg(F.array_sort(F.collect_list("id")).alias("ids")), "entries")
    index, blocks = build(entries, width, entries.count())
    # Anchors of one vector and label are one search; an anchor may find itself, so one row more is asked for.
    named = stored(rows.join(anchors.select("id").distinct(), "id", "left_semi"), "named")
    asked = stored(named.select("vec", "label").distinct().withColumn("a", F.monotonically_increasing_id()), "asked")
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("w"), F.lit(_MIN + 1).cast("bigint").alias("low"), F.lit(_MAX).cast("bigint").alias("high")))
    near = search(index, blocks, asked.withColumn("windows", whole), positives + 1, True)
    # All whole scores s with low * p <= 100 * s <= high * p.
    least = F.expr(f"-((-(score * {low}) - pmod(-(score * {low}), 100)) div 100)")
    top = F.expr(f"(score * {high} - pmod(score * {high}, 100)) div 100")
    per = near.select("a", "score").distinct().select("a", F.struct(F.col("score").alias("w"), least.cast("bigint").alias("low"), top.cast("bigint").alias("high")).alias("window"))
    per = per.where("window.low <= window.high").groupBy("a").agg(F.collect_list("window").alias("windows"))
    hard = search(index, blocks, asked.join(per, "a"), negatives, False)
    nth = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    own = named.select(F.col("id").alias("anchor_id"), "vec", "label").join(asked, ["vec", "label"]).select("anchor_id", "a")
    pairs = own.join(near.select("a", F.col("score").alias("positive_score"), F.col("id").alias("positive_id")), "a").where("anchor_id <> positive_id")
    pairs = pairs.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= positives)
    order = Window.partitionBy("a", "w").orderBy(F.desc("score"), "id")
    ranked = hard.select("a", F.col("w").alias("positive_score"), F.row_number().over(order).alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(ranked, ["a", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark, sf_dir: str) -> DataFrame:
    """op12: anchors are the rows whose id is divisible by 50; labels of ids divisible by 7 move on by one."""
    vectors = load(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = quantised(vectors, label=moved)
    return mined(rows, vectors.where(F.col("vec_id") % EVERY == 0).select(F.col("vec_id").cast("bigint").alias("id")))


ORACLE = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.vec, b.vec)::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
