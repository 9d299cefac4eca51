"""Personal data with offset-preserving deobfuscation (operator 9).

Detectors for email, ip, card and phone run over the source text (base spans).
Then transducers rewrite the places where data may be disguised: homoglyphs and
other scripts' digits, invisible characters, digits spelled as words, and
"at" / "dot" written out.  Each character of the rewritten text carries the
source characters it came from, so what the same detectors find there is
mapped back to source spans.  Such a span is added unless it lies within a
span of its kind that is there already; base spans always stay.

Spans are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows, slices, texts, with_row

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match starts at the first digit of a run: the one before it ended at the last digit of another.
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches: a match holds the run of local characters before an @, back to the last match."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        # What failed is passed over as the pattern passes it over: no later start can take in this @.
        if domain:
            last = domain.end()
            yield start, last
        else:
            last = at + 1
        at = text.find("@", last)


def _ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0")[-3:] or 0) <= 255 for x in m[0].split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if k % 2 == 0 else v * 2 - 9 * (v > 4)
    return total % 10 == 0


def _cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGIT.findall(m[0])) <= 15:
            yield m.span()


def detect(text: str) -> dict[str, list[Span]]:
    """The base spans of each kind, leftmost and non-overlapping within a kind."""
    found = {"email": list(_emails(text)) if "@" in text else []}
    digits = _DIGIT.search(text) is not None
    found["ip"] = list(_ips(text)) if digits and "." in text else []
    found["card"] = list(_cards(text)) if digits else []
    found["phone"] = list(_phones(text)) if digits and "+" in text else []
    return found


# Cyrillic and Greek letters that look like Latin ones, in the order of the Latin letters.
_ALIKE = dict(zip("АВСЕНІЈКМОРЅТХУ" + "асеһіјорѕхуѵԁԛԝ" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" + "οα", "ABCEHIJKMOPSTXY" + "acehijopsxyvdqw" + "ABEZHIKMNOPTYX" + "oa", strict=True))
_INVISIBLE = "­​‌‍⁠﻿"
_ODD = re.compile(r"[­Ͱ-ԯ٠-٩۰-۹०-९​-‍‐-―․⁠①-⑨﹒﹫﻿！-～\U0001d400-\U0001d7ff]")
_SPELLED = {w: str(k) for k, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
_NAMED = "(?<![^\\W\\d])(?:zero|one|two|three|four|five|six|seven|eight|nine|oh)(?![^\\W\\d])"
_DOTS = r"\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+|\."
# Digits and spelled ones, with what may stand between them.
_CHAIN = re.compile(rf"(?:[0-9]++|{_NAMED})(?:(?:{_DOTS}|[ ,().-]{{0,3}})(?:[0-9]++|{_NAMED}))*+", re.I)
_CHAINED = re.compile(rf"({_NAMED})|{_DOTS}|[0-9]", re.I)
_GLUE = re.compile(r"[ ,-]{1,2}")
_PLUS = re.compile(r"(?<!\w)plus[ ]+(?=[0-9])", re.I)
_AT = re.compile(r"\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*", re.I)
_DOT = re.compile(r"\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*", re.I)
# Bare words count between characters of a name or host; a bare "at" before a host of which a label begins with two letters (not "at 5.30").
_BARE_DOT = re.compile(r"(?<=[A-Za-z0-9_%+-])\s+dot\s+(?=[A-Za-z0-9_%+-])", re.I)
_BARE_AT = re.compile(r"(?<=[A-Za-z0-9._%+-])\s+at\s+(?=[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2})", re.I)
_HINT = re.compile(r"[\[({<]\s*(?:at|@|dot|\.)\s*[\])}>]|\sdot\s|\sat\s+[A-Za-z0-9-]++\.|" + _NAMED, re.I)


class Traced:
    """A text whose every character knows the span of the source that it stands for."""

    def __init__(self, text: str):
        self.text = text
        # Two arrays of places, 16 bytes a character.
        self.start = np.arange(len(text))
        self.end = self.start + 1

    def rewrite(self, changes: list[tuple[int, int, str]]) -> None:
        """Replace [start, end) by a string, for all changes in order; each new character stands for all of the old ones."""
        if not changes:
            return
        out, starts, ends, last = [], [], [], 0
        for start, end, new in changes:
            out += self.text[last:start], new
            starts += self.start[last:start], np.repeat(self.start[start], len(new))
            ends += self.end[last:start], np.repeat(self.end[end - 1], len(new))
            last = end
        self.text = "".join([*out, self.text[last:]])
        self.start, self.end = np.concatenate([*starts, self.start[last:]]), np.concatenate([*ends, self.end[last:]])


def _glyphs(t: Traced) -> None:
    changes = []
    for m in _ODD.finditer(t.text):
        c = m[0]
        new = "" if c in _INVISIBLE else _ALIKE.get(c) or ("-" if "‐" <= c <= "―" else unicodedata.normalize("NFKC", c))
        if len(new) == 1 and not new.isascii():
            digit = unicodedata.decimal(new, None)
            new = str(digit) if digit is not None else new
        if new != c:
            changes.append((m.start(), m.end(), new))
    t.rewrite(changes)


def _digits(t: Traced) -> None:
    """Spelled digits become digits where digits or dots stand among them, or four or more of them."""
    changes = []
    for m in _CHAIN.finditer(t.text):
        parts = list(_CHAINED.finditer(t.text, m.start(), m.end()))
        spelled = [p for p in parts if p[1]]
        if not spelled or len(spelled) == len(parts) < 4:
            continue
        last = None
        for p in spelled:
            glued = last is not None and _GLUE.fullmatch(t.text, last, p.start())
            changes.append((last if glued else p.start(), p.end(), _SPELLED[p[0].lower()]))
            last = p.end()
    t.rewrite(changes)
    t.rewrite([(m.start(), m.end(), "+") for m in _PLUS.finditer(t.text)])


def _ats(t: Traced) -> None:
    """Each form by itself, so that any mix of bare, bracketed and plain ones is undone; the detectors decide."""
    for form, plain in ((_AT, "@"), (_DOT, "."), (_BARE_DOT, "."), (_BARE_AT, "@")):
        t.rewrite([(m.start(), m.end(), plain) for m in form.finditer(t.text)])


def deobfuscated(text: str) -> Traced | None:
    """The rewritten text, or None if nothing is disguised in it."""
    if not _ODD.search(text) and not _HINT.search(text):
        return None
    t = Traced(text)
    for step in (_glyphs, _digits, _ats):
        step(t)
    return None if t.text == text else t


def find(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans, and all spans: base ones and those found in the rewritten text, by start."""
    base = detect(text)
    every = {k: list(v) for k, v in base.items()}
    t = deobfuscated(text)
    if t is not None:
        for kind, spans in detect(t.text).items():
            for a, b in spans:
                start, end = int(t.start[a]), int(t.end[b - 1])
                if not any(x <= start and end <= y for x, y in every[kind]):
                    every[kind].append((start, end))
            every[kind].sort()
    return base, every


def _told(found: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in found[k])


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        every, base = [], []
        for text in batch.column("text").to_pylist():
            own, more = find(text or "")
            every.append([{"kind": k, "start": a, "end": b} for k in KINDS for a, b in more[k]])
            base.append(_told(own))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(every, _SPANS), pa.array(base, pa.string())], names=["doc_id", "found", "base"])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def personal_data(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs``: ``doc_id``, ``found`` (array of kind, start, end; by kind, then start) and ``base`` (the spans of the source text alone, as a string).

    A null or empty text has none.  Texts are searched whole.
    """
    return texts(docs).mapInArrow(_run, "doc_id bigint, found array<struct<kind: string, start: bigint, end: bigint>>, base string")


def _mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch.column("text").to_pylist():
            spans = sorted((a, b, k) for k, v in find(text)[1].items() for a, b in v) if text else []
            parts, last = [], 0
            for a, b, k in spans:
                if b > last:
                    parts += text[last : max(a, last)], f"<{k}>" if a >= last else ""
                    last = b
            out.append(text if text is None else "".join([*parts, text[last:]]))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], names=["row", "text"])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of personal data replaced by its kind in angle brackets; all else stays."""
    held = rows(docs).select("row", "text")
    out = held.mapInArrow(_mask, with_row(held, "text string"))
    return out.select(*[(F.col("text") if c.lower() == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op9: personal data in every document."""
    found = personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    spans = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", *map(count, KINDS), F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))
