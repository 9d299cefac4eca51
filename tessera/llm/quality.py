"""Document quality: a classifier's evidence under hierarchical site priors (operator 5).

A logistic model over words and shape gives each document's evidence (its log
odds less the log odds of the training labels).  Grouped aggregation sums up
what is known of each host and of each path below it, labels where there are some and the
classifier's probability elsewhere, and empirical Bayes shrinks it: a
host's rate towards the global one, a path's towards its host's, by a strength
estimated from how much sites really differ (method of moments).  A document's
posterior is its evidence under its path's rate.  Sparse sites so
keep close to the global prior, and large ones speak for themselves.

The same runs for two labels, ``quality`` and ``toxic``; a document is kept if it is good and not toxic.

The model is fitted on at most about ``SAMPLE`` labelled documents, chosen by a
hash of their ids (a documented bound); rates are counted over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffers, load, lower_hashes, rows, slices, stored, texts, word_spans

SAMPLE, BUCKETS, SIGNIFICANT, LEAST, STEPS = 20_000, 1 << 20, 4.0, 4, 300
#: The probability from which a document counts as toxic: missing one costs more than dropping one.
TOXIC = 0.3
LABELS = ("quality", "toxic")


def _classes() -> np.ndarray:
    """Byte classes: upper, lower, digit, white space, sentence marks, other marks, beyond ASCII, newline."""
    kind = np.full(256, 5)
    kind[65:91], kind[97:123], kind[48:58], kind[[9, 11, 12, 13, 32]] = 0, 1, 2, 3
    kind[[33, 44, 46, 58, 59, 63]], kind[128:], kind[10] = 4, 6, 7
    return kind


_KIND = _classes()
_BARE = np.where(np.isin(_KIND, (4, 5)), 32, np.arange(256)).astype(np.uint8)
#: Bytes of a word's beginning that count as features of their own.
STEMS = (5, 6, 7)
SHAPE = 8 + 4


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of each document: its shape (a dense row) and the distinct buckets of its words and of their first ``STEMS`` bytes."""
    bare = _BARE[data]  # words without marks around them
    start, end, at = word_spans(bare, off)
    hashes = lower_hashes(bare)
    bucket = lambda h: (h & np.uint64(BUCKETS - 1)).astype(np.int32)
    parts = [bucket(hashes(start, end))]
    for k in STEMS:
        longer = end - start > k
        stem = bucket(hashes(start, np.minimum(start + k, end)) ^ np.uint64(k))
        parts.append(np.where(longer, stem, parts[0]))
    bucket = np.stack(parts, 1)
    n = np.diff(off)
    filled = off[:-1][n > 0]
    shape = np.zeros((len(n), SHAPE), np.float32)
    if len(filled):
        kinds = _KIND[data]
        for k in range(8):
            shape[n > 0, k] = np.add.reduceat((kinds == k).astype(np.int64), filled) / n[n > 0]
    words = [np.unique(bucket[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    count, distinct = np.diff(at), np.array([len(np.unique(bucket[a:b, 0])) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])
    shape[:, 8] = np.log1p(count)
    shape[:, 9] = distinct / np.maximum(count, 1)
    shape[:, 10] = np.log1p(n / np.maximum(count, 1))
    shape[:, 11] = np.log1p(shape[:, 7] * n)
    return shape, words


@dataclass
class Model:
    """Weights of significant buckets and of the shape; ``prior``: the log odds of the training labels."""

    buckets: np.ndarray
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    dense: np.ndarray
    bias: float
    prior: float

    def table(self) -> np.ndarray:
        out = np.zeros(BUCKETS, np.float32)
        out[self.buckets] = self.weights
        return out

    def evidence(self, shape: np.ndarray, words: list[np.ndarray], table: np.ndarray) -> np.ndarray:
        return (shape - self.mean) / self.scale @ self.dense + self.bias + np.array([table[x].sum() for x in words]) - self.prior


def fit(shape: np.ndarray, words: list[np.ndarray], label: np.ndarray) -> Model:
    """Logistic regression (L2, Adam) over the shape and the buckets whose documents' labels differ significantly from the rest."""
    n, pos = len(label), float(label.sum())
    prior = float(np.log((pos + 1) / (n - pos + 1)))
    mean, scale = (shape.mean(0), shape.std(0) + 1e-6) if n else (np.zeros(SHAPE), np.ones(SHAPE))
    if not n or pos in (0, n):
        return Model(np.zeros(0, np.int64), np.zeros(0), mean, scale, np.zeros(SHAPE), prior, prior)
    flat = np.concatenate(words) if words else np.zeros(0, np.int32)
    doc = np.repeat(np.arange(n), [len(x) for x in words])
    uses = np.bincount(flat, minlength=BUCKETS)
    good = np.bincount(flat, weights=label[doc], minlength=BUCKETS)
    p = pos / n
    z = (good - uses * p) / np.sqrt(np.maximum(uses * p * (1 - p), 1e-9))
    chosen = np.flatnonzero((uses >= LEAST) & (np.abs(z) >= SIGNIFICANT))
    place = np.full(BUCKETS, -1)
    place[chosen] = np.arange(len(chosen))
    kept = place[flat] >= 0
    col, row = place[flat][kept], doc[kept]
    x = (shape - mean) / scale
    theta = np.zeros(len(chosen) + SHAPE + 1)
    theta[-1] = prior
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, STEPS + 1):
        logit = np.bincount(row, weights=theta[:-1][col], minlength=n) + x @ theta[len(chosen) : -1] + theta[-1]
        error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label
        grad = np.r_[np.bincount(col, weights=error[row], minlength=len(chosen)), error @ x, error.sum()] / n
        grad[:-1] += theta[:-1] * 1e-5
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(chosen, theta[: len(chosen)], mean, scale, theta[len(chosen) : -1], float(theta[-1]), prior)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        shape, words = features(*buffers(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array([x.tobytes() for x in shape], pa.binary()), pa.array([x.tobytes() for x in words], pa.binary())],
            names=[*batch.schema.names[:-1], "shape", "words"],
        )


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, Model]:
    """A model for each label from at most about ``sample`` labelled documents (their share by a hash of the id)."""
    known = _labels(labels)
    total = known.count()
    part = known.where(F.pmod(F.xxhash64("label_id"), F.lit(1_000_000)) < int(1_000_000 * min(1, sample / max(total, 1))))
    both = texts(docs).join(part, F.col("doc_id") == F.col("label_id")).select(*LABELS, "text")
    got = both.mapInArrow(_featured, "quality int, toxic int, shape binary, words binary").toArrow()
    shape = np.frombuffer(b"".join(got["shape"].to_pylist()), np.float32).reshape(-1, SHAPE)
    words = [np.frombuffer(x, np.int32) for x in got["words"].to_pylist()]
    out = {}
    for name in LABELS:
        y = got[name].to_pylist()
        has = [i for i, v in enumerate(y) if v is not None]
        out[name] = fit(shape[has], [words[i] for i in has], np.array([y[i] for i in has], np.float64))
    return out


def _labels(labels: DataFrame) -> DataFrame:
    """One row a labelled document; of rows that repeat an id the highest labels."""
    return labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("label_id")).agg(*[F.max(F.col(x).cast("int")).alias(x) for x in LABELS])


def _evidence(raw):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = raw.value
        tables = {k: m.table() for k, m in models.items()}
        for batch in slices(batches):
            shape, words = features(*buffers(batch.column("text")))
            cols = [pa.array(models[k].evidence(shape, words, tables[k]).astype(np.float64)) for k in LABELS]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], names=[*batch.schema.names[:-1], *[f"e_{k}" for k in LABELS]])

    return run


def _rates(scored: DataFrame, label: str) -> DataFrame:
    """The posterior rate of each path: ``host, path, r_<label>``, by grouped aggregation of all rows."""
    sums = stored(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(f"p_{label}").alias("s")), "quality")
    hosts = sums.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))

    def strength(table: DataFrame, n: str, s: str, towards) -> tuple[float, float]:
        """The global rate, and the strength of the prior: within-site variance over what sites differ beyond it."""
        t = table.select(F.col(n).alias("n"), (F.col(s) / F.col(n)).alias("r"), towards.alias("m"))
        got = t.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("n") * F.col("r")).alias("s"), F.sum(F.col("n") * F.pow(F.col("r") - F.col("m"), 2)).alias("d"), F.count("*").alias("k")).first()
        if not got.n:
            return 0.5, 1.0
        rate = min(max(got.s / got.n, 1e-4), 1 - 1e-4)
        within = rate * (1 - rate)
        spread = max((got.d - got.k * within) / max(got.n - got.nn / got.n, 1e-9), within / 1e4) if got.k > 1 else within / 1e4
        return rate, max(within / spread, 1.0)

    total = hosts.agg((F.sum("hs") / F.sum("hn")).alias("r")).first().r
    rate, k = strength(hosts, "hn", "hs", F.lit(total))
    hosts = hosts.withColumn("host_rate", (F.col("hs") + k * rate) / (F.col("hn") + k))
    paths = sums.join(hosts, "host")
    _, kp = strength(paths, "n", "s", F.col("host_rate"))
    return paths.select("host", "path", ((F.col("s") + kp * F.col("host_rate")) / (F.col("n") + kp)).alias(f"r_{label}"))


def score(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", models: dict[str, Model] | None = None, sample: int = SAMPLE) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, p_quality, p_toxic, kept``.

    ``host`` and ``path`` name the columns of a document's site and of the part
    of the site it is in; null is a site of its own.  A null text counts as empty.  Without labels
    every probability is that of the prior, one half.  A quality of one half counts as good.
    """
    models = models or learn(docs, labels, sample)
    raw = docs.sparkSession.sparkContext.broadcast(models)
    site = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")).alias(name) for c, name in ((host, "host"), (path, "path"))]
    read = texts(docs, *site).select("doc_id", "host", "path", "text")
    scored = read.mapInArrow(_evidence(raw), "doc_id bigint, host string, path string, e_quality double, e_toxic double")
    known = _labels(labels)
    sure = scored.join(known, F.col("doc_id") == F.col("label_id"), "left")
    own = lambda x: F.coalesce(F.col(x).cast("double"), 1 / (1 + F.exp(-(F.col(f"e_{x}") + models[x].prior)))).alias(f"p_{x}")
    scored = stored(sure.select("doc_id", "host", "path", "e_quality", "e_toxic", *map(own, LABELS)), "quality")
    for x in LABELS:
        scored = scored.join(_rates(scored.select("host", "path", f"p_{x}"), x), ["host", "path"], "left")
    post = lambda x: (1 / (1 + F.exp(-(F.col(f"e_{x}") + F.log(F.col(f"r_{x}") / (1 - F.col(f"r_{x}"))))))).alias(f"p_{x}")
    clip = lambda x: F.least(F.greatest(F.col(f"r_{x}"), F.lit(1e-4)), F.lit(1 - 1e-4)).alias(f"r_{x}")
    out = scored.select("doc_id", "e_quality", "e_toxic", *map(clip, LABELS)).select("doc_id", *map(post, LABELS))
    return out.withColumn("kept", (F.col("p_quality") >= 0.5) & (F.col("p_toxic") < TOXIC))


def good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` that are kept; rows without ``doc_id`` stay.  All columns stay."""
    drop = score(docs, labels, **options).where("doc_id IS NOT NULL AND NOT kept").select(F.col("doc_id").alias("drop_id")).distinct()
    return rows(docs).join(drop, F.col("doc_id") == F.col("drop_id"), "left_anti").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op5: every document's quality, from the labelled ones."""
    return score(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
