"""Mixing sources to target weights by weighted fair queueing (operator 13), in DataFrame functions only.

Each source has a target in words: its share, by weight, of ``share`` times all
words, but at most ``cap`` times its own words; what a capped source leaves is
shared again by weight until none is above.  Each source queues its documents
in shuffled order, ``cap`` times over (the second pass in another order).  A
queued document's virtual finish time is the source's words up to its end over
the source's target.  The queues of all sources, sorted by that time, are the mix;
it ends where the budget (the sum of targets) is used up, within a document if need be.
So all sources come to their targets at about time 1, each to within a document.

Nothing is ordered in one task: a running total over a global order is a range
sort, the sums of its ranges, and a running total inside each range.  One such
order, by source and shuffle key, serves all sources, so a hot source is cut in
many ranges.  Texts are read once, for their sizes; everything later moves numbers.

Nulls and ties: a null or blank text has size 0 and takes 0; a null source is a
source, the last by code point; a null doc_id is an id.  Each row is a document;
rows that repeat doc_id, source and size are alike, so any may be first.  A source
whose documents are all empty has target 0.  An empty table gives no rows.
Columns other than doc_id, text and source are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import load, stored

WEIGHTS, SHARE, CAP = (5, 2, 1), 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"


def running(df: DataFrame, order: list, amount: str, out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``amount`` (bigint) over all rows before this one in ``order``, which must be total up to equal rows.

    The ranges are written, as a range sort that is done again may cut elsewhere.
    Their sums are one row a shuffle partition, so broadcasting them is bounded.
    """
    cut = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sums = cut.groupBy("_range").agg(F.sum(amount).alias("_sum"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("_start") + F.coalesce(F.sum(amount).over(inside), F.lit(0))
    return cut.join(F.broadcast(starts), "_range").withColumn(out, total).drop("_range", "_start")


def level(sources: DataFrame, share: float = SHARE) -> tuple[float, float]:
    """(budget, words for a weight of 1) for ``sources`` with ``source_size, weight, limit``.

    Each round shares what the capped sources leave among the others, and caps those
    that come above; only sums come to the driver.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget, unit, before = share * total, 0.0, -1
    while True:
        over = F.col("limit") < unit * F.col("weight")
        got = sources.agg(
            F.count_if(over).alias("n"), F.sum(F.when(over, F.col("limit")).otherwise(0)).alias("held"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("weights"),
        ).first()
        if got.n == before or not got.weights:
            return budget, unit
        before, unit = got.n, (budget - got.held) / got.weights


def targets(thin: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: int = CAP) -> tuple[DataFrame, int]:
    """``source, source_size, number, ahead, target`` of each source of ``thin`` (``source, size``), and the budget in whole words.

    ``number`` counts sources by code point, null last; ``ahead`` is the queue length of those before.
    """
    each = stored(thin.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    by_code_point = [F.col("source").asc_nulls_last()]
    each = running(each.select("*", F.lit(1).cast("bigint").alias("one"), (F.col("source_size") * cap).alias("limit")), by_code_point, "one", "number")
    each = stored(running(each, by_code_point, "limit", "ahead"), "sources")
    given = F.array(*[F.lit(w) for w in weights])
    each = each.withColumn("weight", F.get(given, F.pmod("number", F.lit(len(weights))).cast("int")))
    budget, unit = level(each, share)
    target = F.least(F.col("limit").cast("double"), F.lit(unit) * F.col("weight"))
    # Sources may all be capped; then the mix is all there is.
    return each.select("source", "source_size", "number", "ahead", target.alias("target")), int(budget)


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = 0) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``, a row for each row of ``docs``.

    ``weights`` go to the sources by code point, repeating; ``cap`` is a whole number of passes.
    ``taken`` counts words, each pass anew; the same rows give the same result.
    """
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")
    thin = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))
    thin = stored(thin.withColumn("rid", F.monotonically_increasing_id()), "sizes")
    sources, budget = targets(thin, weights, share, cap)
    told = thin.join(sources.withColumnRenamed("source", "its"), F.col("source").eqNullSafe(F.col("its"))).drop("its")
    name = F.concat_ws(":", F.lit(seed), F.col("pass"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    queued = told.withColumn("pass", F.explode(F.array(*[F.lit(k) for k in range(cap)])))
    queued = queued.withColumn("key", F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint"))
    place = [F.col(c) for c in ("number", "pass", "key", "doc_id", "size", "rid")]
    queued = running(queued, place, "size", "before")
    finish = F.when(F.col("target") > 0, (F.col("before") - F.col("ahead") + F.col("size")) / F.col("target")).otherwise(0.0)
    queued = running(queued.withColumn("finish", finish), [F.col("finish"), *place], "size", "used")
    took = F.greatest(F.lit(0), F.least(F.col("size"), F.lit(budget) - F.col("used")))
    return queued.groupBy("rid", "doc_id", "source", "size", "source_size", "target").agg(F.sum(took).alias("taken")).drop("rid")


def query(spark, sf_dir: str) -> DataFrame:
    """op13: all documents, sources weighing 5, 2, 1 and sharing 150 % of all words."""
    return mixed(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, row_number() OVER () AS rid FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS number FROM d GROUP BY source
), w AS (
  SELECT *, [{", ".join(map(str, WEIGHTS))}][1 + number % {len(WEIGHTS)}] AS weight, {CAP} * source_size AS cap, sum(source_size) OVER () AS total FROM s
), f AS (
  SELECT *, coalesce(sum(cap) OVER o, 0) AS held, coalesce(sum(weight) OVER (), 0) - coalesce(sum(weight) OVER o, 0) AS weights
  FROM w WINDOW o AS (ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), u AS (
  SELECT max((total * {SHARE}::DOUBLE - held) / weights) AS unit FROM f WHERE cap >= (total * {SHARE}::DOUBLE - held) / weights * weight
), t AS (
  SELECT source, number, source_size, least(cap::DOUBLE, unit * weight) AS target, floor(total * {SHARE}::DOUBLE)::BIGINT AS budget FROM w, u
), q AS (
  SELECT d.*, number, source_size, target, budget, pass,
    ('0x' || substr(md5('0:' || pass || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS key
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, range({CAP}) AS p(pass)
), v AS (
  SELECT *, CASE WHEN target > 0 THEN sum(size) OVER (PARTITION BY number ORDER BY pass, key, doc_id, size, rid ROWS UNBOUNDED PRECEDING)::DOUBLE / target ELSE 0 END AS finish
  FROM q
), g AS (
  SELECT *, sum(size) OVER (ORDER BY finish, number, pass, key, doc_id, size, rid ROWS UNBOUNDED PRECEDING) - size AS used FROM v
)
SELECT doc_id, size, source_size, target, sum(greatest(0, least(size, budget - used)))::BIGINT AS taken
FROM g GROUP BY rid, doc_id, size, source_size, target
"""
