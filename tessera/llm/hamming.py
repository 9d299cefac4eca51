"""Exact top-k search of binary codes: incremental multi-index hashing (operator 3).

A code is cut into segments, and each segment is the key of one hash index.
Codes within distance d of a query agree with it up to d / segments places in
some segment; so after all segments were searched to radius r, every code
nearer than ``segments * (r + 1)`` was seen.  The radius grows until each
query has k neighbours provably among the nearest.

Codes are the signs of a vector's components.  Equal codes are one entry with
the k smallest ids (no more can be among the nearest k), cut down before
the shuffle, so a vector that a third of the rows hold is one entry.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import load, stored

K, EVERY = 10, 100


def codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, bits)``: the signs of each vector as an array of 0 and 1; rows without id or vector, or with a null component, go."""
    v = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v"))
    v = v.where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").where(~F.exists("v", lambda x: x.isNull()))
    return v.select("id", F.transform("v", lambda x: (x >= 0).cast("int")).alias("bits"))


def _segments(bits: DataFrame, width: int, places: int) -> DataFrame:
    """``bits`` packed into one bigint for each segment of at most ``places`` places."""
    value = lambda a, n: sum((F.shiftleft(F.get("bits", F.lit(a + k)).cast("bigint"), k) for k in range(n)), F.lit(0).cast("bigint"))
    cuts = [(a, min(places, width - a)) for a in range(0, width, places)]
    return bits.where(F.size("bits") == width).select("id", F.array(*[value(a, n) for a, n in cuts]).alias("code"))


def _apart(x: str, y: str, segments: int):
    return sum((F.bit_count(F.get(x, F.lit(s)).bitwiseXOR(F.get(y, F.lit(s)))) for s in range(segments)), F.lit(0))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", places: int | None = None) -> DataFrame:
    """``(query_id, rank, id, distance)``: the k codes nearest to each query's by Hamming distance, ties by id, the query's own row left out.

    Exact: no candidate is dropped.  With fewer than k other codes all are
    given.  Codes are compared only with those of as many components.  Rows
    without id or vector take no part; rows that repeat an id are one entry each code.
    ``places`` is the width of a segment, by default about log2 of the number of codes (16 at most).
    """
    spark = vectors.sparkSession
    base, asked = codes(vectors, id_col, vector_col), codes(queries, id_col, vector_col)
    # Vectors have as many components in nearly all tables; each other size is searched by itself.
    widths = sorted(r[0] for r in asked.select(F.size("bits")).distinct().collect())
    out = [_search(base, asked, w, k, places) for w in widths]
    if not out:
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, distance int")
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def _search(base: DataFrame, asked: DataFrame, width: int, k: int, places: int | None) -> DataFrame:
    counted = base.where(F.size("bits") == width)
    if places is None:
        places = min(16, width, max(4, math.ceil(math.log2(counted.count() + 2))))
    segments = math.ceil(width / places)
    # Of equal codes k + 1 ids: a query may find itself among them.
    order = Window.partitionBy("code").orderBy("id")
    entries = _segments(counted, width, places).distinct().withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
    entries = stored(entries.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "hamming")
    index = entries.select("code", F.posexplode("code").alias("segment", "key"))
    # Queries of one code are one search.
    named = stored(_segments(asked, width, places).distinct(), "hamming")
    open_ = named.select("code").distinct()
    done = []
    best = Window.partitionBy("qcode").orderBy("distance", "id")
    seen = None
    for radius in range(places + 1):
        reach = segments * (radius + 1) - 1 if radius < places else width
        probes = (
            open_.select("code", F.posexplode("code").alias("segment", "part"))
            .select(F.col("code").alias("qcode"), "segment", "part", F.explode(_masks(places, radius)).alias("mask"))
            .select("qcode", "segment", F.col("part").bitwiseXOR(F.col("mask")).alias("key"))
        )
        # Probes are far more than their source tells the planner, so neither side may be broadcast.
        hits = probes.hint("merge").join(index, ["segment", "key"]).select("qcode", "code", _apart("qcode", "code", segments).alias("distance"))
        # The k + 1 nearest codes seen bound what can still count; ties stay.  A pair meets in each
        # segment at most once a radius, so the first cut, before the shuffle, leaves room for that.
        hits = _ranked(hits, (k + 1) * segments)
        if seen is not None:
            hits = hits.unionByName(seen.join(open_.withColumnRenamed("code", "qcode"), "qcode", "left_semi"))
        seen = stored(_ranked(hits.distinct(), k + 1), "hamming")
        sure = seen.where(F.col("distance") <= reach).join(entries, "code").select("qcode", "distance", F.explode("ids").alias("id"))
        got = sure.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).drop("nth")
        full = got.groupBy("qcode").agg(F.count("*").alias("n"))
        if radius < places and reach < width:
            full = full.where(F.col("n") >= k + 1)
        full = full.select("qcode")
        done.append(stored(got.join(full, "qcode", "left_semi"), "hamming"))
        open_ = stored(open_.join(full, open_["code"] == full["qcode"], "left_anti"), "hamming")
        if reach >= width or open_.isEmpty():
            break
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    out = found.join(named.select(F.col("id").alias("query_id"), F.col("code").alias("qcode")), "qcode").where("id <> query_id")
    last = Window.partitionBy("query_id").orderBy("distance", "id")
    return out.select("query_id", F.row_number().over(last).alias("rank"), "id", "distance").where(F.col("rank") <= k)


def _masks(places: int, radius: int):
    """All values of ``places`` bits with ``radius`` ones, as an array: a constant of bounded size."""
    return F.filter(F.sequence(F.lit(0).cast("bigint"), F.lit((1 << places) - 1).cast("bigint")), lambda x: F.bit_count(x) == radius)


def _ranked(hits: DataFrame, n: int) -> DataFrame:
    near = Window.partitionBy("qcode").orderBy("distance")
    return hits.withColumn("place", F.rank().over(near)).where(F.col("place") <= n).drop("place")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: every vector whose id is divisible by 100, against all vectors."""
    vectors = load(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % EVERY == 0)).select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


ORACLE = f"""
WITH c AS (
  SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x >= 0 THEN '1' ELSE '0' END), '')::BIT AS code FROM embeddings
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id, bit_count(xor(q.code, c.code))::INT AS distance
  FROM c AS q JOIN c ON q.vec_id % {EVERY} = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank, vec_id, distance FROM d
)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= {K}
"""
