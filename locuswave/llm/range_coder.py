"""Adaptive context-mixing range coder for token ids, many independent blocks in step.

A stripe is cut into blocks of equal length.  Each block starts with empty models and holds its own checksum, so it
can be decoded alone with the stripe's header.  Blocks of a stripe advance together, one id each per step, so every
operation is one numpy call over all of them.

Each step asks three predictors of the block: the id last seen behind the last two ids (order 2), behind the last
id (order 1), and the one that leads the block's votes (order 0).  Each has a confidence, and counts of how often a
prediction of that confidence was right; the counts share the probability among the three ids and an escape.  An
escaped id is coded by its frequency in the stripe, which the header holds.  Probabilities drive a carry-less range
coder with 64-bit state that puts out 16 bits at a time.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TIDS"
LONGEST_BLOCK, SHORTEST_BLOCK, BLOCKS = 2048, 128, 1024
SLOTS, LEVELS = 512, 8
# Together at most 32: a block's range keeps that many bits over from one id to the next.
FREQ_BITS, MIX_BITS = 18, 14
RATE = 4
# Ids below this are counted in a table; higher ones are sorted.
COUNTED = 1 << 20

_U = np.uint64
_TOP, _BOTTOM = _U(1 << 48), _U(1 << 32)
_16, _48 = _U(16), _U(48)


class _Streams:
    """Range coder states of all blocks; ``words`` is written when encoding and read when decoding."""

    def __init__(self, count: int, words: np.ndarray, decode: bool) -> None:
        self.low, self.range = np.zeros(count, _U), np.full(count, (1 << 64) - 1, _U)
        self.words, self.wide = words.reshape(-1), words.shape[1]
        self.at, self.code = np.arange(count) * self.wide, None
        if decode:
            self.code = np.zeros(count, _U)
            for k in range(4):
                self.code = self.code << _16 | words[:, k].astype(_U)
            self.at += 4

    def value(self, bits: int) -> np.ndarray:
        """Place of each block's code among 2 ** bits."""
        found = (self.code - self.low) // (self.range >> _U(bits))
        return np.minimum(found, _U((1 << bits) - 1)).astype(np.int64)

    def narrow(self, start: np.ndarray, size: np.ndarray, bits: int) -> None:
        unit = self.range >> _U(bits)
        self.low += unit * start.astype(_U)
        self.range = unit * size.astype(_U)

    def shift(self) -> None:
        """Moves settled words out (or the next ones in) until every range is wide enough for another id."""
        alike = (self.low ^ (self.low + self.range)) < _TOP
        todo = np.flatnonzero(alike | (self.range < _BOTTOM))
        while len(todo):
            low, span = self.low[todo], self.range[todo]
            alike = (low ^ (low + span)) < _TOP
            span = np.where(alike, span, (_U(0) - low) & (_BOTTOM - _U(1))) << _16
            at = self.at[todo]
            if self.code is None:
                self.words[at] = (low >> _48).astype(np.uint16)
            else:
                self.code[todo] = self.code[todo] << _16 | self.words[at].astype(_U)
            self.at[todo] = at + 1
            low <<= _16
            self.low[todo], self.range[todo] = low, span
            todo = todo[((low ^ (low + span)) < _TOP) | (span < _BOTTOM)]

    def finish(self) -> np.ndarray:
        """Ends all blocks; their numbers of words."""
        for _ in range(4):
            self.words[self.at] = (self.low >> _48).astype(np.uint16)
            self.low <<= _16
            self.at += 1
        return self.at - np.arange(len(self.at)) * self.wide


class _Predictors:
    """Order-2, order-1 and order-0 predictions of all blocks, adapted after every id.

    A slot holds an id and its confidence (id * LEVELS + level).  ``trust`` is the probability, in 1 / 65,536, that
    a prediction of one order and confidence is right; it moves by 1 / 2 ** RATE of its error.
    """

    def __init__(self, count: int) -> None:
        row = np.arange(count, dtype=np.int32)
        self.base, self.cells = row * SLOTS, row * LEVELS
        # No id is -1: at first every slot is wrong and soon has little trust.
        self.table = [np.full(count * n, 1 - LEVELS, np.int32) for n in (SLOTS, SLOTS, 1)]
        self.trust = [np.full(count * LEVELS, 1 << 14, np.int32) for _ in range(3)]
        self.slot: list = [None, None, slice(None)]
        self.last = self.before = np.zeros(count, np.int32)

    def predict(self) -> None:
        first = self.last * np.int32(40_503)
        self.slot[0] = self.base + ((first ^ self.before * np.int32(30_727)) >> 7 & (SLOTS - 1))
        self.slot[1] = self.base + (first >> 7 & (SLOTS - 1))
        self.held = [t[s] for t, s in zip(self.table, self.slot)]
        self.held[2] = self.held[2].copy()
        self.guess = [h >> 3 for h in self.held]
        self.level = [h & (LEVELS - 1) for h in self.held]
        self.cell = [self.cells + n for n in self.level]
        self.p = [t[c] for t, c in zip(self.trust, self.cell)]
        # Trust stays below 65,536, so every share leaves at least one part to the rest.
        a = self.p[0] * (1 << MIX_BITS) >> 16
        b = (self.p[1] * ((1 << MIX_BITS) - a) >> 16) * (self.guess[1] != self.guess[0])
        c = self.p[2] * ((1 << MIX_BITS) - a - b) >> 16
        c *= (self.guess[2] != self.guess[0]) & (self.guess[2] != self.guess[1])
        self.share, left = [a, b, c], (1 << MIX_BITS) - a - b - c
        self.left = left

    def place(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and size of the part that stands for the ids, and whether it is the escape."""
        a, b, c = self.share
        named = [(g == ids) & (s > 0) for g, s in zip(self.guess, self.share)]
        start = np.where(named[0], 0, np.where(named[1], a, np.where(named[2], a + b, a + b + c)))
        size = np.where(named[0], a, np.where(named[1], b, np.where(named[2], c, self.left)))
        return start, size, ~(named[0] | named[1] | named[2])

    def read(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, size and id of the part at a value, and whether it is the escape."""
        a, b, c = self.share
        ab = a + b
        abc = ab + c
        in_a, in_b, in_c = value < a, value < ab, value < abc
        start = np.where(in_a, 0, np.where(in_b, a, np.where(in_c, ab, abc)))
        size = np.where(in_a, a, np.where(in_b, b, np.where(in_c, c, self.left)))
        ids = np.where(in_a, self.guess[0], np.where(in_b, self.guess[1], self.guess[2]))
        return start, size, ids, ~in_c

    def learn(self, ids: np.ndarray) -> None:
        fresh = ids * LEVELS + 1
        for k in range(3):
            held, level, p = self.held[k], self.level[k], self.p[k]
            hit = self.guess[k] == ids
            self.trust[k][self.cell[k]] = p + ((hit.astype(np.int32) << 16) - p >> RATE)
            self.table[k][self.slot[k]] = np.where(
                hit, held + (level < LEVELS - 1), np.where(level > 1, held - 1, fresh))
        self.before, self.last = self.last, ids


def _shares(counts: np.ndarray) -> np.ndarray:
    """Frequencies of the ids that occur, at least one each, with a sum of 2 ** FREQ_BITS."""
    total = 1 << FREQ_BITS
    if len(counts) > total // 2:
        raise ValueError("more different ids in a stripe than the literal model can tell apart")
    out = np.maximum(1, counts * (total - len(counts)) // counts.sum())
    out[np.argmax(counts)] += total - out.sum()
    return out


def _kinds(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different ids, rising, the number of each id among them, and how often each occurs."""
    if ids.max() >= COUNTED:
        return np.unique(ids.astype(np.int64), return_inverse=True, return_counts=True)
    counts = np.bincount(ids)
    values = np.flatnonzero(counts)
    place = np.zeros(len(counts), np.int32)
    place[values] = np.arange(len(values))
    return values, place[ids], counts[values]


def encode(ids: np.ndarray) -> bytes:
    """A stripe: header, blocks and checksums, from at least one id."""
    n = len(ids)
    length = int(min(LONGEST_BLOCK, max(SHORTEST_BLOCK, -(-n // 256))))
    count = -(-n // length)
    values, place, counts = _kinds(ids)
    share = _shares(counts)
    start = np.concatenate([[0], np.cumsum(share)[:-1]])
    # The last block is filled up with the first value; the number of ids tells where it ends.
    grid = np.zeros(count * length, np.int32)
    grid[:n] = place
    grid = np.ascontiguousarray(grid.reshape(count, length).T)
    words = np.zeros((count, 4 * length + 16), np.uint16)
    streams, model, whole = _Streams(count, words, False), _Predictors(count), 1 << FREQ_BITS
    for now in grid:
        model.predict()
        first, size, escaped = model.place(now)
        streams.narrow(first, size, MIX_BITS)
        streams.narrow(np.where(escaped, start[now], 0), np.where(escaped, share[now], whole), FREQ_BITS)
        streams.shift()
        model.learn(now)
    used = streams.finish()
    raw = np.ascontiguousarray(ids.astype("<u4"))
    coded = [w[:a].astype("<u2").tobytes() for w, a in zip(words, used)]
    sums = [zlib.crc32(c, zlib.crc32(raw[k * length:(k + 1) * length].tobytes())) for k, c in enumerate(coded)]
    table = zlib.compress(np.diff(values, prepend=0).astype("<u4").tobytes() + counts.astype("<u4").tobytes(), 1)
    head = struct.pack("<QIII", n, length, len(values), len(table)) + table
    sizes = used.astype("<u4").tobytes() + np.array(sums, "<u4").tobytes()
    return MAGIC + struct.pack("<I", zlib.crc32(head)) + head + sizes + b"".join(coded)


def decode(data: bytes) -> np.ndarray:
    """The ids of a stripe (uint32); a damaged header or block raises ValueError."""
    if data[:4] != MAGIC:
        raise ValueError("not a stripe of ids")
    (crc,) = struct.unpack_from("<I", data, 4)
    n, length, kinds, packed = struct.unpack_from("<QIII", data, 8)
    at = 28 + packed
    if zlib.crc32(data[8:at]) != crc:
        raise ValueError("damaged stripe header")
    table = np.frombuffer(zlib.decompress(data[28:at]), "<u4").astype(np.int64)
    values, share = np.cumsum(table[:kinds]), _shares(table[kinds:])
    start = np.concatenate([[0], np.cumsum(share)[:-1]])
    owner = np.repeat(np.arange(kinds, dtype=np.int32), share)  # value of each place of the literal model
    count = -(-n // length)
    sizes = np.frombuffer(data, "<u4", count, at).astype(np.int64)
    sums = np.frombuffer(data, "<u4", count, at + 4 * count)
    flat = np.frombuffer(data, "<u2", int(sizes.sum()), at + 8 * count)
    words = np.zeros((count, int(sizes.max()) + 8), np.uint16)
    for k, (first, size) in enumerate(zip(np.cumsum(sizes) - sizes, sizes)):
        words[k, :size] = flat[first:first + size]
    streams, model, whole = _Streams(count, words, True), _Predictors(count), 1 << FREQ_BITS
    grid = np.empty((length, count), np.int32)
    for now in grid:
        model.predict()
        first, size, guess, escaped = model.read(streams.value(MIX_BITS))
        streams.narrow(first, size, MIX_BITS)
        literal = owner[streams.value(FREQ_BITS)]
        now[:] = np.where(escaped, literal, guess)
        streams.narrow(np.where(escaped, start[literal], 0), np.where(escaped, share[literal], whole), FREQ_BITS)
        streams.shift()
        model.learn(now)
    ids = values[grid.T.reshape(-1)[:n]].astype("<u4")
    for k in range(count):
        crc = zlib.crc32(words[k, :sizes[k]].astype("<u2").tobytes(), zlib.crc32(ids[k * length:(k + 1) * length].tobytes()))
        if crc != sums[k]:
            raise ValueError(f"damaged block {k}")
    return ids
