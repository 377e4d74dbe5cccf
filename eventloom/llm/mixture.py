"""Token ids as blocks of a range coder that mixes predictions of orders 0 to 2.

Ids are cut into blocks that are coded independently, each from a fresh model, and carry the crc32 of their ids. The odds of
an id are those of three predictions, added up by weight: order 0 (its share among the ids of the chunk), order 1 (the id that
last followed the one before it in the block) and order 2 (the one that last followed the two before it). The weights of orders
1 and 2 adapt after each id, apart for each case of what the two predict; order 0 has the rest. So an id narrows the interval
once. All blocks of a chunk advance together, one id at a time, so each step is a few array operations over all of them.

Chunk layout, little-endian: ``mix1``; ``<5I`` ids, ids per block, distinct ids, bits of the shares, bytes of the table; the
table (zlib: the steps between the distinct ids in ascending order and their shares, ``<u4``); then per block ``<2I`` 32-bit words
and crc32; then the words of all blocks. Chunks without the mark are of ``codec``.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

from eventloom.llm import codec

BLOCK = 1024
_MARK, _HEAD = b"mix1", 24
_U = np.uint64
_HALF, _LEAST = _U(32), _U(1 << 32)
_SLOTS = 256  # as many as a byte has values
_WEIGHT = 8  # bits of a weight
_RATE = 5
_GROUP = 4096  # blocks that advance together; bounds the tables
# Two weights of 16 bits in one item, order 2 above order 1; together they stay below 2**16 - 1024, so order 0 keeps some.
_KEEP = np.int32(0x07FF07FF)
_GAIN = np.array([0, 1, 1 << 16, 1 << 16], np.int32) * np.int32(((1 << 16) - 1024) >> _RATE)
# By case: whether order 1 predicts (1), order 2 does (2), both the same (4).
_FRESH = np.array([0, 1, 1 << 16, (1 << 16) + 1, 0, 0, 0, 1 << 16], np.int32) * np.int32(3000)


class _Model:
    """What all blocks have seen so far; encoder and decoder drive it alike. Ids go by rank from 1; 0 is none."""

    def __init__(self, lanes: int, shares: np.ndarray, bits: int) -> None:
        self.bits, self.total = bits, _U(bits + _WEIGHT)
        self.share = np.concatenate(([0], shares)).astype(np.int32)
        self.below = np.cumsum(self.share, dtype=np.int32) - self.share
        kind = np.uint16 if len(shares) < 1 << 16 else np.int32
        self.first, self.second = np.zeros(lanes * _SLOTS, kind), np.zeros(lanes * _SLOTS, kind)
        self.weights = np.tile(_FRESH, lanes)
        self.case, self.base = np.arange(lanes) * len(_FRESH), np.arange(lanes) * _SLOTS
        self.slot, self.at1, self.at2 = np.zeros(lanes, np.uint8), self.base, self.base

    def predict(self) -> None:
        """What orders 1 and 2 predict, and the weights of the three orders: those of 1 and 2 times the sum of all shares."""
        self.p1, self.p2 = self.first.take(self.at1).astype(np.int32), self.second.take(self.at2).astype(np.int32)
        case = (self.p2 > 0).view(np.int8) * np.int8(2) + (self.p1 > 0) + (self.p1 == self.p2).view(np.int8) * np.int8(4)
        self.at = self.case + case
        self.weight = self.weights.take(self.at)
        w1, w2 = (self.weight >> 8) & 0xFF, (self.weight >> 24) & 0xFF
        self.w0 = (1 << _WEIGHT) - w1 - w2
        self.w1, self.w2 = w1 << self.bits, w2 << self.bits

    def interval(self, x: np.ndarray, hit1: np.ndarray, hit2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Odds of all ids below ``x``, and of ``x`` itself."""
        start, size = self.w0 * self.below.take(x), self.w0 * self.share.take(x)
        start += self.w1 * (self.p1 < x)
        start += self.w2 * (self.p2 < x)
        size += self.w1 * hit1
        size += self.w2 * hit2
        return start.astype(_U), size.astype(_U)

    def learn(self, x: np.ndarray, hit1: np.ndarray, hit2: np.ndarray) -> None:
        self.weight -= (self.weight >> _RATE) & _KEEP
        self.weight += _GAIN.take(hit2.view(np.int8) * np.int8(2) + hit1)
        self.weights[self.at] = self.weight
        self.first[self.at1] = self.second[self.at2] = x.astype(self.first.dtype)
        before, self.slot = self.slot, x.astype(np.uint8)
        self.at1, self.at2 = self.base + self.slot, self.base + (self.slot + before * np.uint8(37))


def _shares(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Shares of at least 1 that add up to a power of two, and its bits."""
    bits = min(len(counts).bit_length() + 4, 22)
    ends = np.cumsum(counts) * ((1 << bits) - len(counts)) // counts.sum()
    return np.diff(ends, prepend=0) + 1, bits


def _encoded(columns: np.ndarray, shares: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of a group of blocks in a row, and how many each has. ``columns`` are the ranks by place and block."""
    block, lanes = columns.shape
    model, lane = _Model(lanes, shares, bits), np.arange(lanes)
    low, span = np.zeros(lanes, _U), np.full(lanes, (1 << 64) - 1, _U)
    # Words as they settle, whose they are, and where the last one of each block stands: a carry goes there.
    out, who, at, end = np.zeros(columns.size, _U), np.zeros(columns.size, np.uint16), np.zeros(lanes, np.int64), 0

    def settle(short: np.ndarray) -> None:
        nonlocal out, who, end
        begin, end = end, end + len(short)
        if end > len(out):
            out, who = np.resize(out, 2 * end), np.resize(who, 2 * end)
        words = low.take(short)
        out[begin:end] = words >> _HALF
        who[begin:end] = short
        at[short] = np.arange(begin, end)
        low[short] = words << _HALF

    for x in columns:
        model.predict()
        hit1, hit2 = model.p1 == x, model.p2 == x
        start, size = model.interval(x, hit1, hit2)
        span >>= model.total
        start *= span
        span *= size
        low += start
        if (over := low < start).any():
            out[at[over]] += _U(1)
        short = (span < _LEAST).nonzero()[0]
        settle(short)
        span[short] = span.take(short) << _HALF
        model.learn(x, hit1, hit2)
    settle(lane)
    settle(lane)
    order, sizes = np.argsort(who[:end], kind="stable"), np.bincount(who[:end], minlength=lanes)
    words = out[order]
    # A word that a carry has filled hands it on to the one before; the first of a block never does.
    while len(full := (words >> _HALF).nonzero()[0]):
        words[full] &= _LEAST - _U(1)
        words[full - 1] += _U(1)
    return words.astype("<u4"), sizes


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """One chunk from unsigned ids below 2**20."""
    n = len(ids)
    if not n:
        return _MARK + struct.pack("<5I", 0, block, 0, 0, 0)
    counts = np.bincount(ids)
    distinct = np.flatnonzero(counts)
    shares, bits = _shares(counts[distinct])
    rank = np.zeros(len(counts), np.int32)
    rank[distinct] = np.arange(1, len(distinct) + 1)
    lanes = -(-n // block)
    padded = np.ones(lanes * block, np.int32)
    padded[:n] = rank[ids]
    rows = padded.reshape(lanes, block)
    groups = [_encoded(np.ascontiguousarray(rows[i : i + _GROUP].T), shares, bits) for i in range(0, lanes, _GROUP)]
    raw = ids.astype("<u4").tobytes()
    sums = [zlib.crc32(raw[4 * block * i : 4 * block * (i + 1)]) for i in range(lanes)]
    heads = np.array([np.concatenate([sizes for _, sizes in groups]), sums], "<u4").T.tobytes()
    table = zlib.compress(np.concatenate((np.diff(distinct, prepend=0), shares)).astype("<u4").tobytes())
    head = _MARK + struct.pack("<5I", n, block, len(distinct), bits, len(table))
    return b"".join((head, table, heads, *(words.tobytes() for words, _ in groups)))


def _decoded(words: np.ndarray, at: np.ndarray, block: int, shares: np.ndarray, bits: int) -> np.ndarray:
    """The ranks of a group of blocks by place and block; ``at`` is where the words of each begin."""
    lanes = len(at)
    model, by_share = _Model(lanes, shares, bits), np.repeat(np.arange(1, len(shares) + 1, dtype=np.int32), shares)
    code = (words.take(at, mode="clip") << _HALF) | words.take(at + 1, mode="clip")
    at = at + 2
    span = np.full(lanes, (1 << 64) - 1, _U)
    out = np.zeros((block, lanes), np.int32)
    most = _U((1 << int(model.total)) - 1)
    for step in range(block):
        model.predict()
        p1, p2, w0, w1, w2 = model.p1, model.p2, model.w0, model.w1, model.w2
        span >>= model.total
        goal = np.minimum(code // span, most).astype(np.int32)
        over1 = goal >= w0 * model.below.take(p1) + w2 * (p2 < p1)
        over2 = goal >= w0 * model.below.take(p2) + w1 * (p1 < p2)
        # What is left for order 0 names the id, or one before a prediction in whose interval the goal lies.
        rest = goal - w1 * over1 - w2 * over2
        x = by_share.take((rest / w0).astype(np.int32), mode="clip")
        np.maximum(x, p1 * over1, out=x)
        np.maximum(x, p2 * over2, out=x)
        hit1, hit2 = p1 == x, p2 == x
        start, size = model.interval(x, hit1, hit2)
        start *= span
        code -= start
        span *= size
        short = (span < _LEAST).nonzero()[0]
        place = at.take(short)
        code[short] = (code.take(short) << _HALF) | words.take(place, mode="clip")
        at[short] = place + 1
        span[short] = span.take(short) << _HALF
        model.learn(x, hit1, hit2)
        out[step] = x
    return out


def decode(chunk: bytes) -> np.ndarray:
    """The ids of a chunk as ``<u4``; raises ``ValueError`` if a block does not match its checksum."""
    if not chunk.startswith(_MARK):
        return codec.decode(chunk)
    n, block, kinds, bits, length = struct.unpack_from("<5I", chunk, len(_MARK))
    if not n:
        return np.zeros(0, "<u4")
    try:
        table = np.frombuffer(zlib.decompress(chunk[_HEAD : _HEAD + length]), "<u4")
    except zlib.error as e:
        raise ValueError(f"the table of ids is damaged: {e}") from e
    lanes = -(-n // block)
    heads = np.frombuffer(chunk, "<u4", 2 * lanes, _HEAD + length).reshape(lanes, 2)
    words = np.concatenate((np.frombuffer(chunk, "<u4", -1, _HEAD + length + 8 * lanes), np.zeros(2, "<u4"))).astype(_U)
    at = np.cumsum(heads[:, 0], dtype=np.int64) - heads[:, 0]
    shares, distinct = table[kinds:], np.concatenate(([0], np.cumsum(table[:kinds], dtype=np.int64))).astype("<u4")
    ranks = [_decoded(words, at[i : i + _GROUP], block, shares, bits).T for i in range(0, lanes, _GROUP)]
    ids = distinct.take(np.concatenate(ranks).reshape(-1)[:n])
    raw = ids.tobytes()
    for i, want in enumerate(heads[:, 1].tolist()):
        if zlib.crc32(raw[4 * block * i : 4 * block * (i + 1)]) != want:
            raise ValueError(f"block {i} does not match its checksum")
    return ids
