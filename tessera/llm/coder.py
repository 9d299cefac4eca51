"""A context-mixing range coder for token ids, many lanes in step (for operator 7).

An id's probability is a mixture: the id last seen after the two ids before it
(order 2), the one last seen after the id before it (order 1), each weighted by
how often such a prediction of its confidence came true, and what is left by
the frequencies of ids in the block (order 0).  A 64-bit range coder codes the id
in that distribution.

A block is coded on its own, from its own fresh state: its ids are numbered
densely, with their frequencies in the block's head, and cut into up to ``LANES``
lanes of neighbouring ids.  Numpy steps through the lanes, an id of each, and all
lanes share one model, which learns from a step's ids after the step.  So the
state is small and each call is wide.  All arithmetic is on integers, so decoding
repeats it exactly.

A block's bytes: little-endian unsigned 32-bit number of distinct ids and size of the head; the head, deflated: the
distinct ids as differences, their frequencies; 16-bit words of each lane; lanes' 32-bit words, end to end.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Ids of a block at most, lanes of a block at most, and ids of a lane at least (but in a block of fewer).
BLOCK, LANES, LEAST_LANE = 1 << 20, 1 << 12, 1 << 8
#: Frequencies add up to 2**FINE at least, probabilities to 2**SPARE times that; order 0 keeps one part of these 2**SPARE, enough for each id to have a place.
FINE, SPARE = 18, 6
#: Contexts of order 2, confidences of a prediction (the first is: none), and after so many tries of one the older count half.
TWO, CONFIDENCE, MEMORY = 18, 9, 1 << 14
_HALF, _ALL, _WORD = np.uint64(32), np.uint64(0xFFFFFFFF), np.uint64(1 << 32)
_HEAD = struct.Struct("<II")
#: What is added to a confidence 0 to 7: a false prediction halves it, a true one adds 1.
_MOVE = np.r_[np.arange(8) // 2 - np.arange(8), np.ones(7, int), 0]


class _State:
    def __init__(self, lanes: int, freq: np.ndarray):
        self.fine = int(freq.sum()).bit_length() - 1
        self.bits = self.fine + SPARE
        self.edges = np.r_[0, np.cumsum(freq)].astype(np.int64)
        self.none = len(freq)
        # A prediction is 8 times its id and its confidence; none is an id that isn't there, which begins and ends where all ends.
        self.edges = np.r_[self.edges, self.edges[-1]]
        self.after = self.edges[1:]
        self.tables = [np.full(size, 8 * self.none, np.int64) for size in (self.none, 1 << TWO)]
        self.tries = [np.full(CONFIDENCE, 16, np.int64) for _ in range(2)]
        self.right = [self.tries[0] * (4000 + 7000 * np.arange(CONFIDENCE)) >> 16 for _ in range(2)]
        self.last = np.zeros((2, lanes), np.int64)

    def predict(self, n: int) -> None:
        """For the first n lanes: predictions, their weights, and what is left."""
        a, b = self.last[0, :n], self.last[1, :n]
        self.at = [a, ((a * 0x9E3779B1 ^ b * 0x85EBCA77) * 0x27D4EB2F & 0xFFFFFFFF) >> (32 - TWO)]
        self.held = [table.take(at) for table, at in zip(self.tables, self.at, strict=True)]
        self.ids = [held >> 3 for held in self.held]
        self.sure = [held & 7 for held in self.held]
        one_level, two_level = (sure + (g < self.none) for sure, g in zip(self.sure, self.ids, strict=True))
        self.level = two_level * CONFIDENCE + one_level
        most = (1 << self.bits) - (1 << self.fine)
        two = most * self.right[1] // self.tries[1]
        two[0] = 0
        one = (most - two)[:, None] * self.right[0] // self.tries[0]
        one[:, 0] = 0
        left = (1 << self.bits) - two[:, None] - one
        self.weight = [one.ravel().take(self.level), two.take(two_level)]
        self.rest = left.ravel().take(self.level)

    def place(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the ids' part of all."""
        start = self.edges.take(ids) * self.rest >> self.fine
        size = (self.after.take(ids) * self.rest >> self.fine) - start
        self.same = [ids == g for g in self.ids]
        for g, w, same in zip(self.ids, self.weight, self.same, strict=True):
            start += w * (ids > g)
            size += w * same
        return start, size

    def look(self) -> None:
        """For decoding: the id of each unit of frequency."""
        self.of = np.repeat(np.arange(self.none), np.diff(self.edges[:-1]))

    def find(self, value: np.ndarray) -> np.ndarray:
        """The ids whose part holds the values."""
        one, two = self.ids
        swap = one > two
        low, high = np.minimum(one, two), np.maximum(one, two)
        wl = np.where(swap, self.weight[1], self.weight[0])
        low_at, low_end = self.edges.take(low) * self.rest >> self.fine, (self.after.take(low) * self.rest >> self.fine) + wl
        # Of one id that both predict the parts are counted one after the other; each way it is found.
        high_at, high_end = (self.edges.take(high) * self.rest >> self.fine) + wl, (self.after.take(high) * self.rest >> self.fine) + self.weight[0] + self.weight[1]
        past_low, past_high = value >= low_end, value >= high_end
        left = value - wl * past_low - (self.weight[0] + self.weight[1] - wl) * past_high
        # Below 2**53, so a float's division, cut off, is the exact one.
        target = (((left + 1 << self.fine) - 1) / self.rest).astype(np.int64)
        got = self.of.take(target, mode="clip")
        in_low, in_high = (value >= low_at) & ~past_low, (value >= high_at) & ~past_high
        return np.where(in_low, low, np.where(in_high, high, got))

    def update(self, n: int, ids: np.ndarray) -> None:
        """The model learns the ids that ``place`` had last."""
        # Tries by both confidences, and by whether each prediction came true.
        seen = np.bincount(self.level * 4 + self.same[1] * 2 + self.same[0], minlength=4 * CONFIDENCE**2).reshape(CONFIDENCE, CONFIDENCE, 2, 2)
        for k, (count, right) in enumerate([(seen.sum((0, 2, 3)), seen[..., 1].sum((0, 2))), (seen.sum((1, 2, 3)), seen[:, :, 1].sum((1, 2)))]):
            self.tries[k] += count
            old = self.tries[k] > MEMORY
            self.right[k] = self.right[k] + right >> old
            self.tries[k] >>= old
            # At least one try is held to have failed, so that no other id is left without room.
            self.right[k] = np.minimum(self.right[k], self.tries[k] - 1)
            # Of lanes in one context the last one tells.
            case = self.same[k] * 8 + self.sure[k]
            self.tables[k][self.at[k]] = np.where(case == 0, ids << 3, self.held[k] + _MOVE.take(case))
        self.last[1, :n] = self.last[0, :n]
        self.last[0, :n] = ids


def _narrowed(state: _State, low: np.ndarray, span: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lanes' intervals with one more id each: low and span, the lanes that give out a word of 32 bits, and these words."""
    start, size = state.place(ids)
    unit = span >> np.uint64(state.bits)
    low = low + unit * start.astype(np.uint64)
    span = unit * size.astype(np.uint64)
    g = np.flatnonzero(span <= _WORD)
    # A span that reaches over the end of a word is cut there.
    least = low[g]
    short = np.minimum(span[g], _WORD - (least & _ALL))
    low[g] = least << _HALF
    span[g] = np.minimum(short, _ALL) << _HALF
    return low, span, g, least >> _HALF


def _lens(size: int) -> np.ndarray:
    """Ids of each lane of a block: all alike, but the last."""
    steps = max(LEAST_LANE, -(-size // LANES))
    lens = np.full(-(-size // steps), steps)
    if size:
        lens[-1] = size - steps * (len(lens) - 1)
    return lens


def _grid(lens: np.ndarray) -> tuple[int, int, int]:
    """Steps, lanes, and the step at which the last lane has ended."""
    return (int(lens[0]), len(lens), int(lens[-1])) if len(lens) else (0, 0, 0)


def encode_blocks(blocks: list[np.ndarray], vocab: int) -> list[bytes]:
    """Each block's ids (0 to vocab - 1) as bytes, independently of the others."""
    return [_encode(np.asarray(b), vocab) for b in blocks]


def decode_blocks(payloads: list[bytes], sizes: list[int], vocab: int) -> list[np.ndarray]:
    """The ids of each block, from its bytes and its number of ids."""
    return [_decode(p, n, vocab) for p, n in zip(payloads, sizes, strict=True)]


def _encode(ids: np.ndarray, vocab: int) -> bytes:
    if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < vocab:
        raise ValueError("an id is not in the vocabulary")
    counts = np.bincount(ids, minlength=1)
    distinct = np.flatnonzero(counts)
    counts = counts[distinct]
    whole = 1 << max(FINE, len(distinct).bit_length() + 1)
    freq = 1 + counts * (whole - len(distinct)) // max(1, len(ids))
    if len(ids):
        freq[np.argmax(freq)] += whole - freq.sum()
    head = zlib.compress(np.r_[np.diff(distinct, prepend=0), freq].astype("<u4").tobytes())
    lens = _lens(len(ids))
    steps, lanes, last = _grid(lens)
    dense = np.zeros(steps * lanes, np.int64)
    number = np.zeros(len(counts) and int(distinct[-1]) + 1, np.int64)
    number[distinct] = np.arange(len(distinct))
    dense[: len(ids)] = number[ids]
    dense = np.ascontiguousarray(dense.reshape(lanes, steps).T)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    out, used = np.zeros((lanes, steps + 1), np.uint32), np.zeros(lanes, np.int64)
    state = _State(lanes, freq) if lanes else None
    for t in range(steps):
        n = lanes if t < last else lanes - 1
        state.predict(n)
        low[:n], span[:n], g, words = _narrowed(state, low[:n], span[:n], dense[t, :n])
        out[g, used[g]] = words
        used[g] += 1
        state.update(n, dense[t, :n])
    # A span is 2**32 at least, so one word more names a value in it.
    out[np.arange(lanes), used] = (low + _ALL) >> _HALF
    used += 1
    words = out[np.arange(steps + 1) < used[:, None]]
    return b"".join([_HEAD.pack(len(distinct), len(head)), head, used.astype("<u2").tobytes(), words.astype("<u4").tobytes()])


def _decode(payload: bytes, size: int, vocab: int) -> np.ndarray:
    n_distinct, n_head = _HEAD.unpack_from(payload)
    at = _HEAD.size + n_head
    head = np.frombuffer(zlib.decompress(payload[_HEAD.size : at]), "<u4").astype(np.int64)
    distinct, freq = np.cumsum(head[:n_distinct]), head[n_distinct:]
    if len(distinct) and distinct[-1] >= vocab:
        raise ValueError("an id is not in the vocabulary")
    lens = _lens(size)
    steps, lanes, last = _grid(lens)
    if not lanes:
        return np.zeros(0, np.uint32)
    used = np.frombuffer(payload, "<u2", lanes, at).astype(np.int64)
    words = np.r_[np.frombuffer(payload, "<u4", offset=at + 2 * lanes), 0, 0].astype(np.uint64)
    # A lane reads zeros after its last word.
    begin = np.cumsum(used) - used
    ends, zero = begin + used, len(words) - 1
    word = lambda i, end: words[np.where(i < end, i, zero)]
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    code, spot = word(begin, ends) << _HALF | word(begin + 1, ends), begin + 2
    ids = np.zeros((steps, lanes), np.int64)
    state = _State(lanes, freq)
    state.look()
    top = np.uint64((1 << state.bits) - 1)
    for t in range(steps):
        n = lanes if t < last else lanes - 1
        state.predict(n)
        value = np.minimum((code[:n] - low[:n]) // (span[:n] >> np.uint64(state.bits)), top).astype(np.int64)
        ids[t, :n] = got = state.find(value)
        low[:n], span[:n], g, _ = _narrowed(state, low[:n], span[:n], got)
        code[g] = code[g] << _HALF | word(spot[g], ends[g])
        spot[g] += 1
        state.update(n, got)
    return distinct[np.ascontiguousarray(ids.T).ravel()[:size]].astype(np.uint32)
