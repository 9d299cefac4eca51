"""Line dedup over content-defined chunks (operator 1), in DataFrame functions only.

A text is split at newlines.  A rolling hash over the hashes of ``window`` lines
ends a chunk where it is 0 modulo ``modulus``; so boundaries depend on nearby
lines alone and stay in place when lines are put in or taken out elsewhere.  A
chunk of at least two lines, not all blank, that occurs more than once anywhere
is kept where it occurs first (smallest doc_id, then position) and removed
elsewhere, after its bytes were compared.

Only 64-bit hashes of chunks meet in the global grouping, pre-aggregated a task;
the texts of chunks move only where a hash occurs twice.

Many of those chunks have one line, so repeated runs that are cut there stay; the
oracle fixes these chunks, and with them the query's results.  The pipeline
takes ``without_repeated_runs``, which knows no chunks: each two lines beside each
other are looked up, so every line of every repeated run of two or more goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import computed, rows, stored, with_text

WINDOW, MODULUS, LEAST = 2, 3, 2
_FACTOR = 31


def _chunks(window: int, modulus: int):
    """From ``text``: its lines and the ends of its chunks (line counts), as two steps of columns."""
    lines = F.split("text", "\n")
    hashes = F.transform("lines", lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("bigint"))
    rolled = lambda i: sum((F.coalesce(F.get("hashes", i - 1 - k), F.lit(0)) * _FACTOR**k for k in range(window)), F.lit(0))
    count = F.size("lines")
    ends = F.filter(F.sequence(F.lit(1), count), lambda i: (i == F.size("hashes")) | (F.pmod(rolled(i), F.lit(modulus)) == 0))
    return lines, hashes, ends


def chunked(docs: DataFrame, window: int = WINDOW, modulus: int = MODULUS) -> DataFrame:
    """``docs`` (with ``text``) and ``chunks``: an array of (at, n lines, chunk text); null texts have null chunks."""
    lines, hashes, ends = _chunks(window, modulus)
    keep = docs.columns
    cut = computed(computed(computed(docs, lines=lines), hashes=hashes), ends=ends)
    start = lambda k: F.when(k == 0, 0).otherwise(F.get("ends", k - 1))
    chunk = lambda e, k: F.struct(
        k.alias("at"), (e - start(k)).alias("n"), F.array_join(F.slice("lines", start(k) + 1, e - start(k)), "\n").alias("chunk")
    )
    return computed(cut, chunks=F.transform("ends", chunk)).select(*keep, "chunks")


def repeated_chunks(docs: DataFrame, window: int = WINDOW, modulus: int = MODULUS, least: int = LEAST) -> DataFrame:
    """``(doc_id, drop)``: the chunks to remove of each document, as an array of (at, hash)."""
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    whole = (F.col("c.n") >= least) & F.col("c.chunk").rlike(r"\S")
    each = chunked(docs, window, modulus).select("doc_id", F.explode("chunks").alias("c")).where(whole)
    where = F.struct("doc_id", "at")
    spots = each.select("doc_id", F.col("c.at").alias("at"), F.xxhash64("c.chunk").alias("hash"))
    firsts = spots.groupBy("hash").agg(F.min(where).alias("first"), F.max(where).alias("last")).where("first <> last").select("hash", "first")
    twice = spots.join(firsts, "hash")
    # The bytes of those chunks, each distinct text once a task.
    asked = twice.groupBy("doc_id").agg(F.collect_set("hash").alias("asked"))
    texts = (
        chunked(docs.join(asked, "doc_id"), window, modulus).select("doc_id", "asked", F.explode("chunks").alias("c")).where(whole)
        .select("doc_id", F.col("c.at").alias("at"), F.col("c.chunk").alias("chunk"), F.xxhash64("c.chunk").alias("hash"), "asked")
        .where(F.array_contains("asked", F.col("hash")))
    )
    equal = texts.groupBy("hash", "chunk").agg(F.min(where).alias("first"))
    # One hash, several texts: there the first spot is that of the text.
    clashing = equal.groupBy("hash").agg(F.count("*").alias("texts")).where("texts > 1").select("hash")
    plain = twice.join(clashing, "hash", "left_anti").where(where > F.col("first")).select("doc_id", "at", "hash")
    apart = (
        texts.join(clashing, "hash", "left_semi").join(equal, ["hash", "chunk"]).where(where > F.col("first")).select("doc_id", "at", "hash")
    )
    return plain.unionByName(apart).groupBy("doc_id").agg(F.collect_set(F.struct("at", "hash")).alias("drop"))


def dedup_lines(docs: DataFrame, window: int = WINDOW, modulus: int = MODULUS, least: int = LEAST) -> DataFrame:
    """``docs`` with the repeated chunks taken out of ``text``: struct ``row`` of its columns, ``doc_id``, the new ``text``, ``n_chunks``, ``n_removed``.

    A null text stays null, with null counts; an empty one has one chunk.  A row without
    ``doc_id`` stays as it is.  Rows that repeat a ``doc_id`` with one text are
    one document: what is first in one is first in all.  Other columns stay.
    """
    held = rows(docs)
    drops = repeated_chunks(held, window, modulus, least).withColumnRenamed("doc_id", "drop_id")
    joined = chunked(held.join(drops, F.col("doc_id") == F.col("drop_id"), "left").drop("drop_id"), window, modulus)
    kept = F.filter("chunks", lambda c: ~F.array_contains("drop", F.struct(c["at"].alias("at"), F.xxhash64(c["chunk"]).alias("hash"))))
    new = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda c: c["chunk"]), "\n"))
    return joined.select(
        "row", "doc_id", new.alias("text"), F.size("chunks").cast("bigint").alias("n_chunks"),
        F.when(F.col("chunks").isNotNull(), F.coalesce(F.size("drop"), F.lit(0))).cast("bigint").alias("n_removed"),
    )


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the repeated chunks removed; a document of which nothing is left goes, as all of it stands elsewhere."""
    out = dedup_lines(docs, **options).where("n_removed IS NULL OR n_removed = 0 OR text <> ''")
    return out.select(*with_text(docs, F.col("text")))


def _keyed(docs: DataFrame, key) -> DataFrame:
    """``docs`` (with ``text``), ``version`` (a hash of the text, as rows may share a doc_id), ``lines`` and their ``keys``."""
    split = computed(docs, version=F.xxhash64("text"), lines=F.split("text", "\n"))
    return computed(split, keys=F.transform("lines", lambda x: key(x)))


def _both(at: str):
    """The lines of the pairs that start at the places in the array ``at``."""
    return F.array_union(at, F.transform(at, lambda i: i + 1))


def repeated_lines(docs: DataFrame, key=F.xxhash64) -> DataFrame:
    """``(doc_id, version, gone)``: the numbers of the lines to remove of each text.

    These are the lines of each pair of neighbours, not both blank, that stands at an
    earlier place too (smaller doc_id, then line), and so all lines of a repeated
    run.  Pairs are matched by the ``key`` of their lines, and the bytes of matched
    lines are compared; if two lines share a key, the lines are their own keys.
    """
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    solid = lambda i: F.get("lines", i).rlike(r"\S")
    count = F.size("lines")
    at = F.filter(F.sequence(F.lit(0), count - 1), lambda i: (i + 1 < F.size("lines")) & (solid(i) | solid(i + 1)))
    pair = lambda i: F.struct(i.alias("at"), F.get("keys", i).alias("a"), F.get("keys", i + 1).alias("b"))
    spots = _keyed(docs, key).select("doc_id", "version", "keys", at.alias("starts"))
    # Keys and places only; the first count is of plain numbers, so that it is hashed, not sorted.
    spots = spots.select("doc_id", "version", F.inline(F.transform("starts", pair)))
    often = spots.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b")
    twice = stored(spots.join(often, ["a", "b"]), "pairs")
    where = F.struct("doc_id", "at", "version")
    firsts = twice.groupBy("a", "b").agg(F.min(where).alias("first"), F.max(where).alias("last")).where("first <> last").select("a", "b", "first")
    twice = stored(twice.join(firsts, ["a", "b"]).select("doc_id", "version", "at", (where > F.col("first")).alias("later")), "lines")
    if key is not _itself:
        asked = twice.groupBy("doc_id", "version").agg(F.collect_set("at").alias("starts")).select("doc_id", "version", _both("starts").alias("asked"))
        line = lambda i: F.struct(key(F.get("lines", i)).alias("key"), F.get("lines", i).alias("line"))
        # Texts move once, and are split after that.
        told = docs.select("doc_id", F.xxhash64("text").alias("version"), "text").join(asked, ["doc_id", "version"])
        texts = computed(told.select("asked", "text"), lines=F.split("text", "\n")).select(F.inline(F.transform("asked", line))).distinct()
        if not texts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            return repeated_lines(docs, _itself)
    return twice.where("later").groupBy("doc_id", "version").agg(F.collect_set("at").alias("starts")).select("doc_id", "version", _both("starts").alias("gone"))


def _itself(line):
    return line


def without_repeated_runs(docs: DataFrame, key=F.xxhash64) -> DataFrame:
    """``docs`` with all lines of repeated runs of two or more lines removed; a document of which nothing is left goes.

    Each removed line stands at an earlier place that stays.  A null text and a row
    without ``doc_id`` stay as they are.  Rows that repeat a ``doc_id`` with one text
    are one document.  Other columns stay.
    """
    gone = repeated_lines(rows(docs), key).select(F.col("doc_id").alias("gone_id"), F.col("version").alias("gone_version"), "gone")
    # The row holds its text already.
    held = rows(docs).select("row", "doc_id", F.xxhash64("text").alias("version"))
    joined = held.join(gone, (F.col("doc_id") == F.col("gone_id")) & (F.col("version") == F.col("gone_version")), "left").select("row", "gone")
    (name,) = [c for c in docs.columns if c.lower() == "text"]
    text = F.col(f"row.`{name}`").cast("string")
    lines = computed(joined, lines=F.when(F.col("gone").isNotNull(), F.split(text, "\n")))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    new = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    out = computed(lines, new=F.when(F.col("gone").isNull(), text).otherwise(new))
    return out.where("gone IS NULL OR new <> ''").select(*with_text(docs, F.col("new")))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: every document's lines against all others'."""
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_chunks", "n_removed", F.length("text").cast("bigint").alias("n_left"), F.md5(F.col("text")).alias("text_md5"))


ORACLE = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents
), h AS (
  SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h, max(i) OVER (PARTITION BY doc_id) AS n FROM l
), e AS (
  SELECT *, (i = n OR (h + {_FACTOR} * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % {MODULUS} = 0)::INT AS ends FROM h
), k AS (
  SELECT *, coalesce(sum(ends) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS spot FROM e
), c AS (
  SELECT doc_id, spot, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS lines FROM k GROUP BY ALL
), r AS (
  SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, spot) > 1 AND lines >= {LEAST} AND regexp_matches(chunk, '\\S') AS gone FROM c
), d AS (
  SELECT doc_id, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(chunk, chr(10) ORDER BY spot) FILTER (NOT gone), '') AS text FROM r GROUP BY doc_id
)
SELECT doc_id, n_chunks, n_removed, length(text)::BIGINT AS n_left, md5(text) AS text_md5 FROM d
"""
