"""Language identification by prediction by partial matching (operator 10).

For each language a context tree over bytes is counted from labelled texts and
then frozen.  A byte is predicted from the longest context that is known; a
byte unseen there costs an escape and is predicted from the next shorter
context (method C, without exclusion), down to a uniform byte.  The language
whose tree gives a text the shortest code is predicted.

The tree has all contexts of up to two bytes, and of three bytes the
``CONTEXTS`` most frequent ones.  Bytes beyond the ``ALPHABET - 1`` most
frequent share a symbol, whose bytes are equally likely.  Its size is bounded
by these parameters, so it can be sent to every task.  It is learnt from at
most ``SAMPLE`` labelled documents of each language, chosen by a hash.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import buffers, rows, slices, texts, told, with_row

SAMPLE, ALPHABET, CONTEXTS, HELD_OUT = 1500, 96, 6000, 2
#: Parts of a language whose smallest hashes are found apart from each other.
PARTS = 16
#: Chosen ids are sent to every task if they are so many at most (they are SAMPLE a language).
BROADCAST = 100_000
#: Trees come to the driver as rows of so many bytes, dealt out over so many tasks, as it holds a task's result in one array.
ROW_BYTES, ROW_TASKS = 1 << 17, 64
#: Bits of a text beyond which it is no surer of its language: the score's evidence is scaled to so many bytes.
SCORE_BYTES = 200
_LETTER = re.compile(r"[^\W\d_]")
#: Bytes of text that are judged at once: each takes a number a language.
PREDICT_BYTES = 1 << 18


def _symbols(data: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """The symbol of each byte value (frequent bytes have their own), and how many bytes share the last one."""
    order = np.argsort(-np.bincount(data, minlength=256), kind="stable")
    symbol = np.full(256, size - 1, np.int64)
    symbol[order[: size - 1]] = np.arange(size - 1)
    return symbol, 256 - (size - 1)


#: Symbols that are counted at once, so that the driver holds little beside the texts.
_PART = 1 << 20


def _joined(parts: tuple[np.ndarray, ...], size: int, n: int) -> np.ndarray:
    """One number for the n first symbols of each part beside each other."""
    out = np.zeros(n, np.int64)
    for p in parts:
        out = out * size + p[:n]
    return out


def _counted(parts: tuple[np.ndarray, ...], size: int, n: int) -> np.ndarray:
    """How often each tuple of symbols comes, over n places."""
    out = np.zeros(size ** len(parts), np.int64)
    for at in range(0, n, _PART):
        out += np.bincount(_joined(tuple(p[at:] for p in parts), size, min(_PART, n - at)), minlength=len(out))
    return out


def _escaped(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Method C: bits of each symbol (last axis) from its counts in a context and the bits that the shorter context gives."""
    total = counts.sum(-1, keepdims=True)
    kinds = (counts > 0).sum(-1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        seen = -np.log2(counts / (total + kinds))
        escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0)
    return np.where(counts > 0, seen, escape + shorter).astype(np.float32)


class Trees:
    """The frozen trees of all languages: bits[context, symbol, language]."""

    def __init__(self, texts_of: dict[str, bytes], alphabet: int = ALPHABET, contexts: int = CONTEXTS):
        self.langs = sorted(texts_of)
        a = self.alphabet = alphabet
        self.within = np.float32(0)
        joined = np.frombuffer(b"".join(texts_of[x] for x in self.langs), np.uint8)
        self.symbol, shared = _symbols(joined, a)
        del joined
        codes = {x: self.symbol.astype(np.uint8)[np.frombuffer(texts_of[x], np.uint8)] for x in self.langs}
        uses = np.zeros(a**3, np.int64)
        for c in codes.values():
            uses += _counted((c, c[1:], c[2:]), a, len(c) - 3)
        often = np.argsort(-uses, kind="stable")[:contexts]
        often = often[uses[often] > 0]
        self.row = np.full(a**3, -1, np.int32)
        self.row[often] = np.arange(len(often))
        self.two = np.empty((a * a, a, len(self.langs)), np.float32)
        self.three = np.empty((len(often), a, len(self.langs)), np.float32)
        for k, x in enumerate(self.langs):
            c = codes[x]
            uniform = np.full(a, np.log2(256))
            uniform[-1] -= np.log2(shared)  # the bits within the shared symbol come on top
            zero = _escaped(_counted((c,), a, len(c)), uniform)
            one = _escaped(_counted((c, c[1:]), a, len(c) - 1).reshape(a, a), zero)
            two = _escaped(_counted((c, c[1:], c[2:]), a, len(c) - 2).reshape(a, a, a), one[None])
            counts = np.zeros(len(often) * a, np.int64)
            for at in range(0, len(c) - 3, _PART):
                n = min(_PART, len(c) - 3 - at)
                row = self.row[_joined((c[at:], c[at + 1 :], c[at + 2 :]), a, n)]
                counts += np.bincount(row[row >= 0] * np.int64(a) + c[at + 3 : at + 3 + n][row >= 0], minlength=len(counts))
            counts = counts.reshape(len(often), a)
            self.two[:, :, k] = two.reshape(a * a, a)
            self.three[:, :, k] = _escaped(counts, two.reshape(a * a, a)[often % (a * a)])
            if k == 0:
                self.within = np.float32(np.log2(shared))

    def bits(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """(documents, languages) code lengths in bits; a document starts after three newlines."""
        a = self.alphabet
        if not len(data):
            return np.zeros((len(off) - 1, len(self.langs)))
        c = self.symbol[data]
        before = [np.r_[np.full(k, self.symbol[10]), c[:-k]] if k < len(c) else np.full(len(c), self.symbol[10]) for k in (1, 2, 3)]
        first = off[:-1][np.diff(off) > 0]
        for k in (1, 2, 3):
            for j in range(k):
                at = first + j
                fits = at < np.r_[first[1:], len(c)]
                before[k - 1][at[fits]] = self.symbol[10]
        pair = before[1] * a + before[0]
        row = self.row[before[2] * (a * a) + pair]
        cost = self.two[pair, c]
        deep = np.flatnonzero(row >= 0)
        cost[deep] = self.three[row[deep], c[deep]]
        cost[c == a - 1] += self.within
        out = np.zeros((len(off) - 1, len(self.langs)))
        out[np.diff(off) > 0] = np.add.reduceat(cost, first, axis=0, dtype=np.float64)
        return out

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, langs=np.array(self.langs), symbol=self.symbol, row=self.row, two=self.two.astype(np.float16), three=self.three.astype(np.float16), within=self.within)
        return out.getvalue()

    @classmethod
    def restore(cls, raw: bytes) -> Trees:
        self, z = cls.__new__(cls), np.load(io.BytesIO(raw))
        self.langs, self.symbol, self.row, self.within = [str(x) for x in z["langs"]], z["symbol"], z["row"], z["within"]
        self.two, self.three = z["two"].astype(np.float32), z["three"].astype(np.float32)
        self.alphabet = self.two.shape[1]
        return self


def is_held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == HELD_OUT


def learn(docs: DataFrame, sample: int = SAMPLE, alphabet: int = ALPHABET, contexts: int = CONTEXTS) -> bytes:
    """Trees (as ``Trees.dump`` gives them) from at most ``sample`` labelled documents a language that are not held out, those of the smallest hashes."""
    labelled = texts(docs, F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL AND doc_id IS NOT NULL").where(~is_held_out())
    # First within parts of a language, so that however many tasks name a hot one, at most PARTS * sample ids of it meet.
    chosen = labelled.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(PARTS)).alias("part"))
    for group in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*group).orderBy(F.xxhash64("doc_id"), "doc_id")
        chosen = chosen.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= sample).drop("nth")
    chosen = chosen.select("doc_id", "lang")
    chosen, total = told(chosen.distinct(), "language", n=F.count("*"))
    if total["n"] <= BROADCAST:
        chosen = F.broadcast(chosen)
    sampled = labelled.join(chosen, ["doc_id", "lang"], "left_semi").select("doc_id", "lang", "text")
    # At most sample documents of each language meet in one task, which counts the trees; the driver sees only these.
    fitted = sampled.repartition(1).mapInArrow(_fit(alphabet, contexts), "nth int, trees binary")
    fitted = sorted(fitted.repartition(ROW_TASKS, "nth").collect())
    return b"".join(r.trees for r in fitted) if fitted else Trees({}, alphabet, 0).dump()


def _fit(alphabet: int, contexts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, list[tuple[int, bytes]]] = {}
        for batch in batches:
            for i, lang, text in zip(*(batch.column(c) for c in ("doc_id", "lang", "text")), strict=True):
                got.setdefault(lang.as_py(), []).append((i.as_py(), text.as_buffer().to_pybytes()))
        trees = Trees({x: b"\n\n\n" + b"\n\n\n".join(t for _, t in sorted(v)) for x, v in got.items()}, alphabet, contexts)
        if got:
            raw = trees.dump()
            for nth, at in enumerate(range(0, len(raw), ROW_BYTES)):
                yield pa.RecordBatch.from_arrays([pa.array([nth], pa.int32()), pa.array([raw[at : at + ROW_BYTES]], pa.binary())], names=["nth", "trees"])

    return run


def _predict(raw, place: int | None = None):
    """``place``: the text's place in the struct ``row``; else it is the column ``text``, and goes."""

    def beside(batch: pa.RecordBatch) -> pa.RecordBatch:
        row = batch.column("row")
        return pa.RecordBatch.from_arrays([row, pc.cast(pc.struct_field(row, [place]), pa.string())], names=["row", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees.restore(raw.value)
        langs = np.array([*trees.langs, "und"], object)
        for batch in slices(batches if place is None else map(beside, batches), limit=PREDICT_BYTES):
            text = batch.column("text")
            data, off = buffers(text)
            bits = trees.bits(data, off)
            best, score = np.full(len(bits), len(langs) - 1), np.zeros(len(bits))
            if trees.langs:
                n = np.maximum(np.diff(off), 1)[:, None]
                odds = np.exp2((bits.min(1, keepdims=True) - bits) * np.minimum(1, SCORE_BYTES / n))
                odds /= odds.sum(1, keepdims=True)
                letters = np.array([bool(x) and _LETTER.search(x) is not None for x in text.to_pylist()], bool)
                best[letters], score[letters] = bits.argmin(1)[letters], odds.max(1)[letters]
            per_byte = bits.min(1, initial=np.inf) / np.maximum(np.diff(off), 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(langs[best], pa.string()), pa.array(score, pa.float64()), pa.array(np.where(np.isfinite(per_byte), per_byte, 0.0), pa.float64())],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "bits_per_byte"],
            )

    return run


def predict(docs: DataFrame, trees: bytes) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, lang_pred, score, bits_per_byte``.

    Only the text is an input.  Null texts and texts without a letter are
    ``und`` with score 0, as is every text if nothing was learnt; ties go to the
    first language by name.  A text of any length is scored whole.
    """
    raw = docs.sparkSession.sparkContext.broadcast(trees)
    return texts(docs).mapInArrow(_predict(raw), "doc_id bigint, lang_pred string, score double, bits_per_byte double")


def identify(docs: DataFrame, **options) -> DataFrame:
    """Learn from the labelled rows of ``docs`` and predict all of them: ``doc_id, held_out, lang_pred, score, bits_per_byte``."""
    out = predict(docs, learn(docs, **options))
    return out.select("doc_id", F.coalesce(is_held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def known_language(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the texts that are in no language (``und``: null, or no letter); a null ``lang`` becomes the predicted one, all else stays."""
    raw = docs.sparkSession.sparkContext.broadcast(learn(docs, **options))
    held = rows(docs).select("row")
    place = [c.lower() for c in docs.columns].index("text")
    # The row goes through Arrow once; only the prediction is put beside it.
    out = held.mapInArrow(_predict(raw, place), with_row(held, "lang_pred string, score double, bits_per_byte double"))
    fill = F.coalesce(*[F.col(f"row.`{c}`").cast("string") for c in docs.columns if c.lower() == "lang"], F.col("lang_pred"))
    return out.where("lang_pred <> 'und'").select(*[(fill if c.lower() == "lang" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op10: the language of every document."""
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "held_out", "lang_pred", "score")
