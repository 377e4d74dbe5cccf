"""Token ids as adaptive range-coded blocks.

Ids are cut into blocks that are coded independently, each from a fresh model, and carry the crc32 of their ids. Per id,
the first symbol says which prediction holds: that of order 2 (the id that last followed the two before it), that of
order 1 (the one before it), or neither; its odds adapt to how the predictions agree. An id that neither predicts is
spelled in 4-bit digits by adaptive order-0 odds. Two symbols in a row narrow the interval at once, by the product of their
odds. All blocks of a chunk advance together, one id at a time, so each step is a few array operations over all of them.

Chunk layout, little-endian: ``<4I`` ids, ids per block, digits, blocks; then per block ``<2I`` 16-bit words and crc32;
then the words of all blocks.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 2048
_BITS = 14
_TOTAL = 1 << _BITS
_FLOOR = 33
_SLOTS = 256
_U = np.uint64
_MASK = _U((1 << 48) - 1)
_PAIR, _LEAST = _U(2 * _BITS), _U(1 << 32)


def _odds(symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Even cumulative odds up to each symbol's end, and what they move towards after each symbol.

    No symbol ever gets less than 1.
    """
    place, s = np.arange(1, symbols + 1), np.arange(symbols)[:, None]
    even = (place * _TOTAL // symbols).astype(np.int16)
    return even, np.where(place <= s, place * _FLOOR, _TOTAL - (symbols - place) * _FLOOR).astype(np.int16)


_FLAG, _FLAG_AIM = _odds(3)
_DIGIT, _DIGIT_AIM = _odds(16)
_ONES, _TOP_BYTE = _U(0x0101010101010101), _U(56)


def _ends(rows: np.ndarray, place: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of each row's symbol; ``place`` is where its end stands in the flat rows."""
    start = rows.take(place - 1)
    start *= symbol != 0
    return start, rows.take(place) - start


def _below(rows: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """How many of each row's 16 ends do not pass its goal: eight comparisons are summed in one multiplication."""
    hits = (rows <= goal[:, None]).view(_U)
    return (((hits[:, 0] + hits[:, 1]) * _ONES) >> _TOP_BYTE).astype(np.int64)


class _Model:
    """What all blocks have seen so far; encoder and decoder drive it alike."""

    def __init__(self, lanes: int, digits: int) -> None:
        self.lane = np.arange(lanes)
        self.flags = np.tile(_FLAG, (lanes * 8, 1))
        self.digits = [np.tile(_DIGIT, (lanes * (16 if d else 1), 1)) for d in range(digits)]
        self.first, self.second = np.zeros(lanes * _SLOTS, np.int32), np.zeros(lanes * _SLOTS, np.int32)
        self.base = self.lane * _SLOTS
        self.last = self.before = np.zeros(lanes, np.int64)
        self.step = 0

    def predict(self) -> None:
        self.h1 = self.base + ((self.last * 40503 >> 4) & (_SLOTS - 1))
        self.h2 = self.base + (((self.last * 40503 ^ self.before * 48271) >> 3) & (_SLOTS - 1))
        self.p1, self.p2 = self.first[self.h1], self.second[self.h2]
        both = (self.p1 == self.p2) & (self.p1 > 0)
        self.context = self.lane * 8 + (self.p2 > 0) + 2 * (self.p1 > 0) + 4 * both
        self.rate = 3 if self.step < 24 else 4 if self.step < 200 else 5

    def learn(self, ids: np.ndarray) -> None:
        self.first[self.h1] = self.second[self.h2] = ids + 1
        self.before, self.last = self.last, ids
        self.step += 1

    def adapt(self, table: np.ndarray, index: np.ndarray, rows: np.ndarray, aim: np.ndarray, symbol: np.ndarray) -> None:
        """Move the odds of each block towards its symbol. ``rows`` are the table's rows at ``index``."""
        step = aim.take(symbol, 0)
        step -= rows
        step >>= self.rate
        step += rows
        row = np.dtype((np.void, table.shape[1] * 2))  # a whole row as one item
        np.put(table.view(row), index, step.view(row))


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """One chunk from unsigned ids below 2**20."""
    n = len(ids)
    if not n:
        return struct.pack("<4I", 0, block, 1, 0)
    lanes = -(-n // block)
    digits = max(1, -(-int(ids.max()).bit_length() // 4))
    padded = np.zeros(lanes * block, np.int64)
    padded[:n] = ids
    columns = np.ascontiguousarray(padded.reshape(lanes, block).T)
    model, lane = _Model(lanes, digits), np.arange(lanes)
    lane3, lane16 = lane * 3, lane * 16
    low, span = np.zeros(lanes, _U), np.full(lanes, (1 << 48) - 1, _U)
    width = block + 64
    out, at = np.zeros((lanes, width), np.uint32), np.zeros(lanes, np.int64)

    def put(low: np.ndarray, span: np.ndarray, start: np.ndarray, size: np.ndarray, who: np.ndarray) -> None:
        """Narrow the intervals of the blocks ``who`` in place; words that are settled go out."""
        span >>= _PAIR
        low += span * start.astype(_U)
        span *= size.astype(_U)
        if low.max(initial=_U(0)) > _MASK:
            carry = who[low > _MASK]
            out[carry, at[carry] - 1] += np.uint32(1)
            low &= _MASK
        short = np.flatnonzero(span < _LEAST)
        while len(short):
            x, place, wider = low[short], who[short], span[short] << _U(16)
            out[place, at[place]] = x >> _U(32)
            at[place] += 1
            low[short] = (x << _U(16)) & _MASK
            span[short] = wider
            short = short[wider < _LEAST]

    for x in columns:
        if at.max() + 8 + digits > width:
            out = np.pad(out, ((0, 0), (0, width // 2)))
            width = out.shape[1]
        model.predict()
        flag = np.where(model.p2 == x + 1, 0, np.where(model.p1 == x + 1, 1, 2))
        rows = model.flags.take(model.context, 0)
        start, size = (e.astype(np.int32) for e in _ends(rows, lane3 + flag, flag))
        model.adapt(model.flags, model.context, rows, _FLAG_AIM, flag)
        spelled = np.flatnonzero(flag == 2)
        y, before, outer = x[spelled], 0, size[spelled]
        start <<= _BITS
        size <<= _BITS
        for d in range(digits):
            table, digit = model.digits[d], (y >> (4 * (digits - 1 - d))) & 15
            index = spelled * 16 + before if d else spelled
            rows = table.take(index, 0)
            first, share = _ends(rows, lane16[: len(y)] + digit, digit)
            if not d:
                start[spelled] += outer * first
                size[spelled] = outer * share
                put(low, span, start, size, lane)
                l, s = low[spelled], span[spelled]
            elif d % 2 and d + 1 < digits:
                start, outer = first.astype(np.int32) << _BITS, share.astype(np.int32)
            elif d % 2:
                put(l, s, first.astype(np.int32) << _BITS, share.astype(np.int32) << _BITS, spelled)
            else:
                put(l, s, start + outer * first, outer * share, spelled)
            model.adapt(table, index, rows, _DIGIT_AIM, digit)
            before = digit
        low[spelled], span[spelled] = l, s
        model.learn(x)
    for shift in (32, 16, 0):
        if at.max() + 1 > width:
            out = np.pad(out, ((0, 0), (0, 8)))
            width = out.shape[1]
        out[lane, at] = (low >> _U(shift)) & _U(0xFFFF)
        at += 1
    while (over := out >> np.uint32(16)).any():
        out &= np.uint32(0xFFFF)
        out[:, :-1] += over[:, 1:]
    raw = ids.astype("<u4").tobytes()
    sums = [zlib.crc32(raw[4 * block * i : 4 * block * (i + 1)]) for i in range(lanes)]
    heads = np.array([at, sums], "<u4").T.tobytes()
    words = out[np.arange(width) < at[:, None]].astype("<u2").tobytes()
    return struct.pack("<4I", n, block, digits, lanes) + heads + words


def decode(chunk: bytes) -> np.ndarray:
    """The ids of a chunk as ``<u4``; raises ``ValueError`` if a block does not match its checksum."""
    n, block, digits, lanes = struct.unpack_from("<4I", chunk)
    if not n:
        return np.zeros(0, "<u4")
    heads = np.frombuffer(chunk, "<u4", 2 * lanes, 16).reshape(lanes, 2)
    words = np.concatenate((np.frombuffer(chunk, "<u2", -1, 16 + 8 * lanes), np.zeros(8, "<u2"))).astype(_U)
    sizes = heads[:, 0].astype(np.int64)
    at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    model, lane = _Model(lanes, digits), np.arange(lanes)
    lane3, lane16 = lane * 3, lane * 16
    code = (words[at] << _U(32)) | (words[at + 1] << _U(16)) | words[at + 2]
    at = at + 3
    span = np.full(lanes, (1 << 48) - 1, _U)
    top = len(words) - 1

    def take(code: np.ndarray, span: np.ndarray, start: np.ndarray, size: np.ndarray, part: np.ndarray, who: np.ndarray) -> None:
        code -= part * start.astype(_U)
        np.multiply(part, size.astype(_U), out=span)
        short = np.flatnonzero(span < _LEAST)
        while len(short):
            place, wider = who[short], span[short] << _U(16)
            code[short] = (code[short] << _U(16)) | words[np.minimum(at[place], top)]
            at[place] += 1
            span[short] = wider
            short = short[wider < _LEAST]

    def goals(code: np.ndarray, part: np.ndarray) -> np.ndarray:
        return np.minimum(code // part, _U((1 << 2 * _BITS) - 1)).astype(np.int32)

    out = np.zeros((block, lanes), np.int64)
    for step in range(block):
        model.predict()
        rows = model.flags.take(model.context, 0)
        part = span >> _PAIR
        goal = goals(code, part)
        outer = (goal >> _BITS).astype(np.int16)
        flag = (outer >= rows[:, 0]).astype(np.int64) + (outer >= rows[:, 1])
        start, size = (e.astype(np.int32) for e in _ends(rows, lane3 + flag, flag))
        model.adapt(model.flags, model.context, rows, _FLAG_AIM, flag)
        x = np.where(flag == 0, model.p2, model.p1).astype(np.int64) - 1
        spelled = np.flatnonzero(flag == 2)
        y, before, outer = np.zeros(len(spelled), np.int64), 0, size[spelled]
        start <<= _BITS
        size <<= _BITS
        inner = ((goal[spelled] - start[spelled]) // outer).astype(np.int16)
        for d in range(digits):
            table = model.digits[d]
            index = spelled * 16 + before if d else spelled
            rows = table.take(index, 0)
            if d % 2:
                part = s >> _PAIR
                goal = goals(c, part)
                inner = (goal >> _BITS).astype(np.int16)
            digit = _below(rows, inner)
            first, share = _ends(rows, lane16[: len(y)] + digit, digit)
            if not d:
                start[spelled] += outer * first
                size[spelled] = outer * share
                take(code, span, start, size, part, lane)
                c, s = code[spelled], span[spelled]
            elif d % 2 and d + 1 < digits:
                start, outer = first.astype(np.int32) << _BITS, share.astype(np.int32)
                inner = ((goal - start) // outer).astype(np.int16)
            elif d % 2:
                take(c, s, first.astype(np.int32) << _BITS, share.astype(np.int32) << _BITS, part, spelled)
            else:
                take(c, s, start + outer * first, outer * share, part, spelled)
            model.adapt(table, index, rows, _DIGIT_AIM, digit)
            y = y * 16 + digit
            before = digit
        code[spelled], span[spelled], x[spelled] = c, s, y
        model.learn(x)
        out[step] = x
    ids = np.ascontiguousarray(out.T).reshape(-1)[:n].astype("<u4")
    raw = ids.tobytes()
    for i, want in enumerate(heads[:, 1].tolist()):
        if zlib.crc32(raw[4 * block * i : 4 * block * (i + 1)]) != want:
            raise ValueError(f"block {i} does not match its checksum")
    return ids
