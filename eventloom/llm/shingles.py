"""Word shingles of texts as 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = tuple(np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text (A-Z in lower case, words parted by ASCII white space), and words per text."""
    raw = " ".join(texts) + " "
    codes = _LOWER[np.frombuffer(raw.encode("utf-8", "surrogatepass"), np.uint8)]
    inked = ~_SPACE[codes]
    edges = np.diff(inked.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    lengths = np.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], np.int64) + 1
    per_text = np.diff(np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths)))))
    if not len(starts):
        return np.zeros(0, np.uint64), per_text
    # Words of one length at a time: each letter is one step of a polynomial over 64-bit numbers.
    size = ends - starts
    out = mixed(size.astype(np.uint64) + _BASE)
    order = np.argsort(size, kind="stable")
    sorted_size, at = size[order], 0
    place, live = starts[order], order
    step = 0
    while at < len(order):
        at = int(np.searchsorted(sorted_size, step, side="right"))
        if at >= len(order):
            break
        live = order[at:]
        out[live] = (out[live] ^ codes[place[at:] + step]) * _BASE
        step += 1
        if step % 4 == 0:
            out[live] ^= out[live] >> np.uint64(29)
        if step > 64:
            # Few words are this long; each is folded by itself.
            for i in live.tolist():
                h = int(out[i])
                for c in codes[starts[i] + step : ends[i]].tolist():
                    h = ((h ^ c) * int(_BASE) & 0xFFFFFFFFFFFFFFFF) ^ (h >> 59)
                out[i] = np.uint64(h)
            break
    return mixed(out), per_text


def shingle_sets(texts: list[str], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words has one, without words none."""
    words, counts = word_hashes(texts)
    n = len(words)
    if not n:
        return [np.zeros(0, np.uint64) for _ in texts]
    rolled = np.zeros(n, np.uint64)
    for k in range(min(width, n)):
        part = mixed(words + np.uint64((k + 1) * int(_BASE) & 0xFFFFFFFFFFFFFFFF))
        rolled[: n - k] += part[k:]
    rolled = mixed(rolled)
    out, at = [], 0
    for c in counts.tolist():
        if c >= width:
            out.append(np.unique(rolled[at : at + c - width + 1]))
        elif c:
            short = np.uint64(c)
            for w in words[at : at + c]:
                short = mixed(np.array([short]) * _BASE + w)[0]
            out.append(np.array([short], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out
