"""BPE encoding and decoding with tree concatenation (operator 8).

A long text is halved until its leaves are short; leaves are encoded on their
own, and each join is mended: the last k parts of the left side and the first k
of the right are encoded again as one window, and k grows until the window
begins and ends as the two sides do.  That holds on two levels:

* pieces: the tokenizer's split pattern looks only ahead, so from an agreed
  boundary on the right side is what the whole text gives;
* tokens of one long unsplit piece: a sequence of tokens is the encoding of its
  bytes if each two neighbours are the encoding of theirs, so one agreed token at either end
  of the window is enough.

Distinct pieces are encoded by the tokenizers library, many at once, and kept in a bounded cache.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import buffers, rows, slices, texts, with_row

#: Characters of a leaf of the split, bytes of a leaf of one piece, and pieces kept in the cache.
LEAF, PIECE_LEAF, CACHE = 1 << 14, 256, 1 << 18
#: Bytes as the printable characters of byte-level BPE: printable Latin-1 stand for themselves, the rest follow U+0100 in order.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_CHARS = {b: chr(b) for b in _PLAIN} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(_PLAIN))}
_TABLE = {b: c for b, c in _CHARS.items() if b != 32}
_BYTES = {c: b for b, c in _CHARS.items()}
SPLIT_BYTES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: A word vocabulary's split of ASCII, by classes of bytes: 0 white space, 1 letters, 2 digits, 3 the rest (control characters 28 to 31 among them).
_KIND = np.full(256, 3, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: What is split here: ASCII and the letters of Latin-1, which are in all versions of Unicode and have composed forms and lower case of one character.
_OWN = regex.compile(r"[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*").fullmatch
#: Pieces in the cache of a word vocabulary, and their characters.
CACHE_WORDS, CACHE_CHARS = 1 << 20, 1 << 25
#: Pieces that are given to the library at once.
LEARN = 1 << 15


def joined(left: list, right: list, encode: Callable[[Sequence], list], text: Callable[[list], Sequence]) -> list:
    """The parts of two neighbouring texts as one: windows around the join grow until they begin and end as the sides do."""
    if not left or not right:
        return left or right
    k = 2
    while True:
        a, b = left[-k:], right[:k]
        window = encode(text(a + b))
        begins = len(a) == len(left) or window[:1] == a[:1]
        ends = len(b) == len(right) or window[-2:] == b[-2:]
        if begins and ends:
            return left[: len(left) - len(a)] + window + right[len(b) :]
        k *= 2


def tree(text: Sequence, leaf: int, encode: Callable[[Sequence], list], back: Callable[[list], Sequence], leaves: Callable[[list], list] | None = None) -> list:
    """The parts of ``text``: its leaves' parts (``leaves`` encodes all of them at once), joined in pairs, pairs of pairs, and so on."""
    cut = [text[i : i + leaf] for i in range(0, len(text), leaf)]
    level = leaves(cut) if leaves else [encode(x) for x in cut]
    while len(level) > 1:
        level = [joined(level[i], level[i + 1], encode, back) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0] if level else []


class Encoder:
    """One vocabulary file of the tokenizers library: ``byte`` keeps every byte, ``word`` lower-cases, drops white space and marks word ends."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_padding()
        self.whole.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.bare = Tokenizer(self.whole.model)
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self.words = spec.get("normalizer") is not None
        self.added = [x["content"] for x in spec.get("added_tokens", ())]
        vocab = self.whole.get_vocab(with_added_tokens=True)
        self.marked = np.zeros(max(vocab.values()) + 1, bool)
        self.marked[[i for x, i in vocab.items() if self.suffix and x.endswith(self.suffix)]] = True
        self.token_bytes = [b""] * (max(vocab.values()) + 1)
        for x, i in vocab.items():
            own = x.removesuffix(self.suffix) if self.suffix else x
            self.token_bytes[i] = x.encode() if x in self.added else bytes(_BYTES[c] for c in own) + b" " * (own != x)
        self.byte_ends = np.cumsum([0, *map(len, self.token_bytes)])
        self.byte_pool = np.frombuffer(b"".join(self.token_bytes), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.cache: dict[str, int] = {}
        self.held = 0
        self.pool, self.size, self.starts = np.empty(1 << 16, np.uint32), 0, np.zeros(1, np.int64)

    def split(self, text: str) -> list[str]:
        """The pieces of a text in a byte vocabulary, each encoded on its own."""
        if len(text) <= LEAF:
            return SPLIT_BYTES.findall(text)
        return tree(text, LEAF, SPLIT_BYTES.findall, "".join)

    def _bare(self, pieces: list[str]) -> list[list[int]]:
        return [x.ids for x in self.bare.encode_batch_fast(pieces, add_special_tokens=False)]

    def _long(self, piece: str) -> list[int]:
        """One unsplit piece, in the characters of bytes."""
        if self.suffix:  # word ends make the last token of a leaf another; such a piece is encoded whole
            return self._bare([piece])[0]
        back = lambda ids: "".join(map(self.bare.id_to_token, ids))
        return tree(piece, PIECE_LEAF, lambda x: self._bare([x])[0], back, self._bare)

    def _learn(self, pieces: list[str]) -> None:
        if self.words:  # other letters are lower-cased, composed and split by the library, whose tables may be of another Unicode than Python's
            foreign = [] if _OWN(" ".join(pieces)) else [p for p in pieces if not _OWN(p)]
            self._keep(foreign, [x.ids for x in self.whole.encode_batch_fast(foreign, add_special_tokens=False)])
            own = [p for p in pieces if _OWN(p)] if foreign else pieces
            for i in range(0, len(own), LEARN):
                self._learn_words(own[i : i + LEARN])
            return
        mapped = {p: "".join(map(_CHARS.__getitem__, p.encode())) for p in pieces}
        short = [p for p, m in mapped.items() if len(m) <= PIECE_LEAF]
        self._keep(short, self._bare([mapped[p] for p in short]))
        long = [p for p, m in mapped.items() if len(m) > PIECE_LEAF]
        self._keep(long, [self._long(mapped[p]) for p in long])

    def _learn_words(self, pieces: list[str]) -> None:
        """Many pieces at once, as one sequence of the library: a piece's last token is marked as the end of a word."""
        mapped = " ".join(pieces).encode().decode("latin-1").translate(_TABLE).split(" ")
        found = self.bare.encode_batch_fast([mapped[i : i + 512] for i in range(0, len(mapped), 512)], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(list(itertools.chain.from_iterable(x.ids for x in found)), np.int64)
        ends = np.flatnonzero(self.marked[ids]) + 1
        if len(ends) == len(pieces):
            self._store(pieces, ids, ends)
        else:  # a vocabulary in which some byte is no token
            self._keep(pieces, self._bare(mapped))

    def _keep(self, pieces: list[str], found: list[list[int]]) -> None:
        self._store(pieces, np.array(list(itertools.chain.from_iterable(found)), np.int64), np.cumsum([len(ids) for ids in found], dtype=np.int64))

    def _store(self, pieces: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """The pieces' ids, end to end, go to the pool, and the pieces to the cache."""
        while self.size + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.size : self.size + len(ids)] = ids
        self.cache.update(zip(pieces, itertools.count(len(self.starts) - 1)))
        self.starts = np.concatenate([self.starts, self.size + ends])
        self.size += len(ids)
        self.held += sum(map(len, pieces))

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and the n + 1 offsets of the texts."""
        if self.words and isinstance(texts, pa.Array) and not pc.any(pc.match_substring(texts, "<|")).as_py():
            special, plain = [], texts
        else:
            texts = texts.to_pylist() if isinstance(texts, pa.Array) else texts
            special = [any(a.lower() in t.lower() for a in self.added) if "<|" in t else False for t in texts]
            plain = ["" if s else t for t, s in zip(texts, special, strict=True)]
            plain = pa.array(plain, pa.large_string()) if self.words else plain
        index, at = self._words(plain) if self.words else self._pieces(plain)
        first = self.starts[index]
        size = self.starts[index + 1] - first
        ids = _ragged(self.pool, first, size)
        ends = np.r_[0, np.cumsum(size)][at]
        if any(special):
            parts = [self.whole.encode(t, add_special_tokens=False).ids if s else ids[a:b] for t, s, a, b in zip(texts, special, ends[:-1], ends[1:], strict=True)]
            ids, ends = np.concatenate([np.asarray(p, np.uint32) for p in parts]), np.r_[0, np.cumsum([len(p) for p in parts])]
        return ids, ends

    def _known(self, distinct: list[str], limit: int = CACHE, characters: float = np.inf) -> list[int]:
        """The numbers of the distinct pieces in the cache; new ones are learnt."""
        found = list(map(self.cache.get, distinct))
        new = [p for p, number in zip(distinct, found, strict=True) if number is None]
        if not new:
            return found
        if len(self.cache) + len(new) > limit or self.held > characters:
            self._forget()
            new = distinct
        self._learn(new)
        return list(map(self.cache.__getitem__, distinct))

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the texts' pieces in the cache, and the n + 1 offsets of the texts in them."""
        pieces = [self.split(t) for t in texts]
        flat = list(itertools.chain.from_iterable(pieces))
        self._known(list(set(flat)))
        return np.fromiter(map(self.cache.__getitem__, flat), np.int64, len(flat)), np.r_[0, np.cumsum([len(p) for p in pieces])].astype(np.int64)

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``_pieces``, in a word vocabulary, whose pieces never hold white space.

        Words of ASCII and the letters of Latin-1 are split here, by classes of bytes; a
        word with any other character is one piece, which the library splits.
        """
        data, off = buffers(texts)
        kind = _KIND[data]
        solid = kind > 0
        word = solid.copy()
        word[1:] &= ~solid[:-1]
        # A word begins after a gap, or where a text does.
        cuts = off[:-1][off[:-1] < len(data)]
        word[cuts] |= solid[cuts]
        at = np.cumsum([0, *[np.count_nonzero(solid[a:b]) for a, b in itertools.pairwise(off.tolist())]])
        data, kind, word = data[solid], kind[solid], word[solid]
        data_low = _LOWER[data]
        # The letters U+00C0 to U+00FF are two bytes, C3 and one more; between them are the signs of multiplication and division.
        tail = np.flatnonzero(data == 0xC3) + 1
        tail = tail[(data[tail] != 0x97) & (data[tail] != 0xB7)]
        kind[tail - 1] = kind[tail] = 1
        data_low[tail[data[tail] < 0x9F]] += 32
        piece = word | (kind == 2)
        piece[1:] |= kind[1:] != kind[:-1]
        # An apostrophe that begins a piece takes the letters of a contraction with it.
        after = np.r_[data_low, np.zeros(2, np.uint8)]
        inside = np.r_[~word, np.zeros(2, bool)]
        quote = np.flatnonzero(piece & (data == 39))
        one, two = np.where(inside[quote + 1], after[quote + 1], 0), np.where(inside[quote + 1] & inside[quote + 2], after[quote + 2], 0)
        for tail in (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"):
            cut = quote[(one == tail[0]) & ((two == tail[1]) if len(tail) > 1 else True)]
            piece[cut + 1] = False
            over = cut + 1 + len(tail)
            piece[over[over < len(piece)]] = True
        strange = (data > 127) & (kind != 1)
        if strange.any():
            begins = np.flatnonzero(word)
            foreign = np.repeat(np.logical_or.reduceat(strange, begins), np.diff(np.r_[begins, len(data)]))
            piece = np.where(foreign, word, piece)
            # Other characters keep their case: the library lower-cases them.
            data_low = np.where(foreign, data, data_low)
        starts = np.flatnonzero(piece)
        column = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.r_[starts, len(data)]), pa.py_buffer(data_low))
        coded = column.dictionary_encode()
        # No piece holds a newline.
        distinct = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary.cast(pa.string())), "\n")[0].as_py().split("\n") if len(starts) else []
        number = np.array(self._known(distinct, CACHE_WORDS, CACHE_CHARS), np.int64)
        return number[coded.indices.to_numpy(zero_copy_only=False)], np.searchsorted(starts, at)

    def bytes_of(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the tokens end to end, and the offsets of the texts in them."""
        i = ids.astype(np.int64)
        size = self.byte_ends[i + 1] - self.byte_ends[i]
        return _ragged(self.byte_pool, self.byte_ends[i], size), np.r_[0, np.cumsum(size)][off]

    def decode(self, ids: np.ndarray, off: np.ndarray) -> list[str]:
        """The texts of a byte vocabulary's ids; bytes that are not UTF-8 become U+FFFD."""
        data, at = self.bytes_of(ids, off)
        raw = data.tobytes()
        return [raw[a:b].decode("utf-8", "replace") for a, b in itertools.pairwise(at.tolist())]


def _ragged(pool: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    at = np.repeat(first - ends + size, size)
    at += np.arange(len(at))
    return pool[at]


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


BYTE_BPE = "byte_bpe_50k.json"


def _encode(path: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in slices(batches):
            ids, off = tool.encode([x or "" for x in batch.column("text").to_pylist()])
            columns, names = list(batch.columns[:-1]), batch.schema.names[:-1]
            if not digests:
                columns.append(pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids.astype(np.int32))))
                names.append("ids")
            columns.append(pa.array(np.diff(off), pa.int64()))
            names.append("n_tokens")
            raw = ids.astype("<u4").tobytes()
            columns.append(pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in itertools.pairwise(off.tolist())]))
            columns.append(pa.array([hashlib.sha256(x.encode()).hexdigest() for x in tool.decode(ids, off)]))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "ids_sha256", "decoded_sha256"])

    return run


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, ids, n_tokens, ids_sha256, decoded_sha256``.

    Null and empty texts have no ids.  Ids are those of the tokenizers library
    without special tokens (their strings in a text count as the library counts them).
    """
    path = path or public(BYTE_BPE)
    return texts(docs).mapInArrow(_encode(path, False), "doc_id bigint, ids array<int>, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of a table with ``doc_id, ids``; null ids give a null text."""
    path = path or public(BYTE_BPE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                lists = part.column("ids").to_pylist()
                ids = np.array(list(itertools.chain.from_iterable(x or () for x in lists)), np.uint32)
                out = tool.decode(ids, np.r_[0, np.cumsum([len(x or ()) for x in lists])].astype(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([None if x is None else t for x, t in zip(lists, out, strict=True)], pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("bigint"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id bigint, text string")


def encoded_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``text`` replaced by its tokens: ``row`` columns but the text, then ``n_tokens, token_ids, ids_sha256, decoded_sha256``.

    A column of ``docs`` that has one of these names gives way to the new one.
    """
    path = path or public(BYTE_BPE)
    held = rows(docs)
    new = {"n_tokens": "n_tokens", "token_ids": "ids", "ids_sha256": "ids_sha256", "decoded_sha256": "decoded_sha256"}
    rest = [c for c in docs.columns if c.lower() != "text" and c.lower() not in new]
    # A struct has one field at least, if it is one that is left out again.
    row = F.struct(*[F.col(f"row.`{c}`") for c in rest or docs.columns[:1]]).alias("row")
    held = held.select(row, F.col("text"))
    out = held.mapInArrow(_encode(path, False), with_row(held, "ids array<int>, n_tokens bigint, ids_sha256 string, decoded_sha256 string"))
    return out.select(*[F.col(f"row.`{c}`") for c in rest], *[F.col(c).alias(name) for name, c in new.items()])


def query(spark, sf_dir: str) -> DataFrame:
    """op8: every document, encoded and decoded."""
    docs = texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return docs.mapInArrow(_encode(public(BYTE_BPE), True), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
