"""Near-duplicate documents: MinHash with tensored banding (operator 2).

Two small collections of minhash groups are computed for each set of word
shingles, ``left`` and ``right``.  Every pair (left group i, right group j) is
the key of one table, so ``groups`` ** 2 tables of ``2 * rows`` minhashes each
cost only ``2 * groups * rows`` minhash computations.  A pair of sets of
similarity s shares a table unless no left group or no right group agrees: it
is missed with probability at most ``2 * (1 - s**rows) ** groups`` (1e-4 at
0.75, 5e-6 at 0.8, with the defaults).

Candidates are confirmed on full sets.  Documents in one table bucket need not
all be compared in pairs: links within one component add nothing, so each document
is linked with a hub first, the tables are dealt again with the components that
this gives, and a bucket of several is compared to one hub at a time, components are contracted, and pairs across
components are compared in full only when few are left.  So no link between
different components is lost, and a group of n copies costs about n comparisons.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import buffers, mix, rows, slices, stored, texts, told, word_hashes
from .components import components, roots

WORDS, PERCENT, GROUPS, ROWS = 5, 75, 12, 2
#: Bits of a set's parity sketch: of how many shingles with a bit's hash there are, odd or even.  Where two
#: sketches differ, some shingle is in one set alone, so their distance bounds what sets do not share.
SKETCH = 2048
#: Documents in a block of a bucket whose pairs are looked through together.
CELL = 512
#: Documents in a bucket up to which equal buckets are looked for.
SMALL = 64
_MIXERS = mix(np.arange(1, 12, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct word shingles of each document as sorted 64-bit hashes, end to end, and their n + 1 offsets.

    A document of fewer words than a shingle has one: all its words.  Without words it has none.
    """
    w, at = word_hashes(data, off)
    n = np.diff(at)
    sums = np.zeros(len(w), np.uint64)
    for k in range(words):
        sums[: max(0, len(w) - k)] += mix(w[k:] * _MIXERS[k % 11] + np.uint64(k))
    sums = mix(sums + np.uint64(words))
    out, sizes = [], np.zeros(len(n), np.int64)
    for i, (s, c) in enumerate(zip(at[:-1].tolist(), n.tolist(), strict=True)):
        if not c:
            continue
        if c >= words:
            found = np.unique(sums[s : s + c - words + 1])
        else:
            found = mix(np.array([int(sum(int(x) for x in mix(w[s : s + c] * _MIXERS[:c] + np.arange(c, dtype=np.uint64)))) + c & (1 << 64) - 1], np.uint64))
        out.append(found)
        sizes[i] = len(found)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def minhashes(sets: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """(documents with a set, count) minhashes."""
    filled = off[:-1][np.diff(off) > 0]
    out = np.empty((len(filled), count), np.uint64)
    for k in range(count if len(filled) else 0):
        a, b = mix(np.array([2 * k + 1, 2 * k + 2], np.uint64) * np.uint64(0xA0761D6478BD642F))
        out[:, k] = np.minimum.reduceat((sets ^ b) * (a | np.uint64(1)), filled)
    return out


def _sign(words: int, groups: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets, off = shingle_sets(*buffers(batch.column("text")), words)
            low = minhashes(sets, off, 2 * groups * rows)
            keys = np.zeros(low.shape[:1] + (2 * groups,), np.uint64)
            for r in range(rows):
                keys = mix(keys + low[:, r::rows])
            sizes = np.diff(off)
            has = sizes > 0
            row = np.cumsum(has) - 1
            prints = [hashlib.blake2b(sets[off[i] : off[i + 1]].tobytes(), digest_size=16).digest() if has[i] else None for i in range(len(sizes))]
            take = lambda cols: pa.array([keys[row[i], cols].view(np.int64) if has[i] else None for i in range(len(sizes))], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), take(slice(0, groups)), take(slice(groups, None))],
                names=["doc_id", "n_shingles", "print", "left", "right"],
            )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets, off = shingle_sets(*buffers(batch.column("text")), words)
            lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(sets.view(np.int64)))
            place = np.repeat(np.arange(len(off) - 1), np.diff(off)) * SKETCH + (sets % np.uint64(SKETCH)).astype(np.int64)
            odd = np.packbits((np.bincount(place, minlength=(len(off) - 1) * SKETCH) & 1).astype(np.uint8)).view(np.int64)
            words_of = pa.ListArray.from_arrays(pa.array(np.arange(len(off)) * (SKETCH // 64), pa.int32()), pa.array(odd))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, words_of], names=["doc", "items", "odd"])

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the rows of ``pairs``, those whose documents ``a`` and ``b`` have full sets that are similar enough."""
    one = sets.select(F.col("doc").alias("a"), F.col("items").alias("x"))
    two = sets.select(F.col("doc").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(two, "b").join(one, "a")
        .select(*pairs.columns, both.alias("both"), (F.size("x") + F.size("y")).alias("sum"))
        .where(f"100 * both >= {percent} * (sum - both)").select(*pairs.columns)
    )


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, groups: int = GROUPS, per_group: int = ROWS) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Null or wordless texts have no shingles, link with nothing and are kept.  A
    row without ``doc_id`` takes no part: its component is null, kept is true.
    Rows that repeat a ``doc_id`` are one document each with that id, so their
    components meet in it; all rows with the id of their component are kept.
    Other columns are not read.  An empty table gives an empty table.
    """
    docs = texts(docs)
    signed = stored(
        docs.mapInArrow(_sign(words, groups, per_group), "doc_id bigint, n_shingles bigint, print binary, left array<bigint>, right array<bigint>"), "minhash"
    )
    # Equal sets are one class: the smallest id stands for it (a partial aggregate, so a large group of copies is one row a task).
    classes = stored(
        signed.where("doc_id IS NOT NULL AND print IS NOT NULL").groupBy("print")
        .agg(F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"), F.first("left").alias("left"), F.first("right").alias("right")),
        "minhash",
    )
    # Of each document that shares a table bucket with another: the hub (the smallest id) that most of its tables name, if it isn't always that itself.
    # Two sets with one smallest id (rows that repeat a doc_id) are one document here: the tables may hold either.
    whole = Window.partitionBy("key")
    hubs = (
        _tables(classes).withColumns({"hub": F.min("doc").over(whole), "last": F.max("doc").over(whole)}).where("hub < last")
        .groupBy("doc", F.when(F.col("hub") < F.col("doc"), F.col("hub")).alias("hub")).agg(F.count("*").alias("times"))
        .groupBy("doc").agg(F.max_by("hub", F.when(F.col("hub").isNotNull(), F.struct("times", -F.col("hub")))).alias("hub"))
    )
    members = hubs.join(classes.groupBy("doc").agg(F.max("n").alias("n"), F.min("n").alias("least")), "doc")
    members = stored(members.select("doc", "hub", "n", "least", F.col("doc").alias("component")), "minhash")
    sets = stored(docs.join(members.select(F.col("doc").alias("doc_id")), "doc_id", "left_semi").mapInArrow(_sets(words), "doc bigint, items array<bigint>, odd array<bigint>"), "minhash")
    # First they are linked with their hubs; after that few buckets hold several components, and only these are compared further.
    links = stored(_confirmed(members.where("hub IS NOT NULL").select(F.col("hub").alias("a"), F.col("doc").alias("b")), sets, percent), "minhash")
    joined = roots(links).toDF("doc", "joined")
    members = stored(members.join(joined, "doc", "left").select("doc", "n", "least", F.coalesce("joined", "component").alias("component")), "minhash")
    apart = lambda held: held.withColumns({"lo": F.min("component").over(whole), "hi": F.max("component").over(whole)}).where("lo < hi")
    shared = stored(apart(_tables(classes.join(members.select("doc", "component"), "doc"), "component")).select("key", "doc", "component"), "minhash")
    # Documents that can't have a link with any other left need no comparison; twice, as the first time takes others' partners away.
    able = stored(_bounded(stored(_bounded(shared, sets, percent), "minhash"), sets, percent), "minhash")
    shared = stored(apart(shared.join(able.select("doc"), "doc", "left_semi")).select("key", "doc", F.count("*").over(whole).alias("all")), "minhash")
    members = stored(members.join(able, "doc", "left").select("doc", "n", "least", "component", F.coalesce("most", F.lit(0)).alias("most")), "minhash")
    # Most of the tables group the same few documents: of small buckets one of each distinct content is enough.  Large ones are hardly ever equal, and all stay.
    small = shared.where(F.col("all") <= SMALL).select("key", "doc")
    content = small.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.xxhash64("doc").cast("decimal(38,0)")).alias("s"), F.sum(F.xxhash64("doc", F.lit(7)).cast("decimal(38,0)")).alias("t"))
    one = small.join(content.groupBy("n", "s", "t").agg(F.min("key").alias("key")).select("key"), "key", "left_semi")
    buckets = stored(one.unionByName(shared.where(F.col("all") > SMALL).select("key", "doc")), "minhash")
    members, checked, stuck = _link(buckets, members, sets, percent)
    found = classes.join(members.select("doc", "component"), "doc", "left").select("print", F.coalesce("component", "doc").alias("component_id"))
    # Of rows that repeat a doc_id each class may name another smallest id; the id joins them.
    ids = signed.where("doc_id IS NOT NULL")
    repeated = ids.groupBy("doc_id").agg(F.count_distinct("print").alias("n"), F.count("print").alias("c")).where("n > 1")
    named = signed.join(found, "print", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    if not repeated.isEmpty():
        ties = named.where("doc_id IS NOT NULL").join(repeated, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))
        more = components(stored(ties, "minhash")).select(F.col("node").alias("component_id"), F.col("component").alias("joined"))
        named = named.join(more, "component_id", "left").withColumn("component_id", F.coalesce("joined", "component_id"))
    return named.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _tables(classes: DataFrame, *more: str) -> DataFrame:
    """``(key, doc)`` and the named columns: a row for each table that holds a class."""
    lefts = classes.select("doc", *more, F.posexplode("left").alias("i", "l"), "right")
    return lefts.select("doc", *more, "i", "l", F.posexplode("right").alias("j", "r")).select(F.xxhash64("i", "j", "l", "r").alias("key"), "doc", *more)


def _bounded(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(doc, most)`` of the documents that can still have a link: how many of its shingles any other of ``open_`` has.

    Two sets have no more in common than the smaller of these numbers; a document
    whose number is under ``percent`` of its size is linked with none.
    """
    items = sets.join(open_.select("doc").distinct(), "doc", "left_semi").select("doc", F.size("items").alias("n"), F.explode("items").alias("x"))
    shared = items.withColumn("uses", F.count("*").over(Window.partitionBy("x"))).where("uses > 1")
    most = shared.groupBy("doc", "n").agg(F.count("*").alias("most"))
    return most.where(f"100 * most >= {percent} * n").select("doc", "most")


def _across(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of one table bucket, with their two components ``(ca, cb)``, that sizes, bounds and sketches allow a link.

    A bucket is cut into blocks of about ``CELL`` documents by a hash, and each two
    blocks are a cell of their own, so no task holds a large bucket.
    """
    cuts = F.ceil(F.col("all") / CELL).cast("int")
    rows_ = open_.join(sets.select("doc", "odd"), "doc").select("key", "doc", "component", "n", "least", "most", "odd", cuts.alias("cuts"), F.pmod(F.xxhash64("doc", F.lit(3)), cuts).cast("int").alias("block"))
    rows_ = rows_.select("*", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other"))
    cell = (F.least("block", "other") * F.col("cuts") + F.greatest("block", "other")).alias("cell")
    return rows_.select("key", cell, "block", "doc", "component", "n", "least", "most", "odd").groupBy("key", "cell").applyInArrow(_cell(percent), "a bigint, b bigint, ca bigint, cb bigint").distinct()


def _cell(percent: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc")
        block, doc, part, n, least, most = (table.column(c).to_numpy() for c in ("block", "doc", "component", "n", "least", "most"))
        odd = table.column("odd").combine_chunks().values.to_numpy().reshape(len(doc), -1).view(np.uint64)
        one = block.min() == block.max()
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]  # by place
        for i in range(len(doc) - 1):
            j = np.arange(i + 1, len(doc))
            j = j[(part[j] != part[i]) & (one | (block[j] != block[i])) & (doc[j] != doc[i])]
            j = j[(100 * n[j] >= percent * least[i]) & (100 * n[i] >= percent * least[j])]
            j = j[(100 + percent) * np.minimum(most[j], most[i]) >= percent * (least[j] + least[i])]
            if len(j):
                apart = np.bitwise_count(odd[j] ^ odd[i]).sum(1, dtype=np.int64)
                j = j[(100 + percent) * apart <= (100 - percent) * (n[j] + n[i])]
                a.append(np.full(len(j), i))
                b.append(j)
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.table({k: pa.array(v, pa.int64()) for k, v in {"a": doc[a], "b": doc[b], "ca": part[a], "cb": part[b]}.items()})

    return run


def _link(buckets: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, int, int]:
    """``members`` with the component that the confirmed links give; the rounds taken (with the first, to the hubs), and rounds that joined nothing."""
    rounds, stuck = 1, 0
    while True:
        held = buckets.join(members, "doc")
        # Of a bucket: its hub, another one each round, and what is left to compare across components.
        hub = F.struct(F.xxhash64("doc", F.lit(rounds)).alias("o"), "doc", "component", "n", "least", "most")
        whole = Window.partitionBy("key")
        open_ = (
            held.withColumns({"all": F.count("*").over(whole), "hub": F.min(hub).over(whole), "lo": F.min("component").over(whole), "hi": F.max("component").over(whole)})
            .where("lo < hi").select("key", "doc", "component", "n", "least", "most", "hub", "all")
        )
        # At most so many pairs are left (a bucket of n has n rows that each tell n).
        open_, work = told(open_, "minhash", pairs=F.sum("all") / 2, rows=F.count("*"), docs=F.approx_count_distinct("doc"))
        if not work["rows"]:
            return members, rounds, stuck
        last = work["pairs"] <= 8 * work["rows"] or stuck > 0
        if last:
            pairs = _across(open_, sets, percent)
        else:
            pairs = open_.where("component <> hub.component AND doc <> hub.doc").select(
                F.least("doc", "hub.doc").alias("a"), F.greatest("doc", "hub.doc").alias("b"),
                F.least("component", "hub.component").alias("ca"), F.greatest("component", "hub.component").alias("cb"),
                F.col("n").alias("na"), F.col("hub.n").alias("nb"), F.col("least").alias("la"), F.col("hub.least").alias("lb"), F.col("most").alias("ma"), F.col("hub.most").alias("mb"),
            )
            # Sizes and bounds that can't reach the similarity need no sets.
            pairs = pairs.where(f"100 * na >= {percent} * lb AND 100 * nb >= {percent} * la AND {100 + percent} * least(ma, mb) >= {percent} * (la + lb)")
        # The pairs carry their components, so what is confirmed is at once the edges between these.
        linked = _confirmed(pairs.select("a", "b", "ca", "cb").distinct(), sets, percent)
        linked = linked.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()
        linked, total = told(linked, "minhash", n=F.count("*"))
        rounds += 1
        merged = total["n"]
        stuck = 0 if 50 * merged > work["docs"] else stuck + 1
        if merged:
            joined = components(linked).select(F.col("node").alias("component"), "component")
            joined = joined.toDF("component", "joined")
            members = stored(members.join(joined, "component", "left").select("doc", "n", "least", "most", F.coalesce("joined", "component").alias("component")), "minhash")
        if last:
            return members, rounds, stuck


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the near copies: of each component the rows of its smallest ``doc_id`` stay, one row if they repeat it.

    Rows without ``doc_id`` stay.  All columns stay as they are.
    """
    found = near_duplicates(docs, **options)
    kept = found.where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("kept_id")).distinct()
    held = rows(docs).select("row", "doc_id")
    by = Window.partitionBy("doc_id").orderBy(F.to_json("row"))
    held = held.join(kept, F.col("doc_id") == F.col("kept_id")).withColumn("nth", F.row_number().over(by)).where("nth = 1")
    return held.select("row.*").unionByName(docs.where("doc_id IS NULL"))


def query(spark, sf_dir: str) -> DataFrame:
    """op2: every document against every other."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
