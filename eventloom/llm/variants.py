"""Spelling variants: words one edit apart, by k-d trees over letter counts.

An edit adds a letter, takes one away or swaps one for another, so the letter counts of two such words differ by at
most one letter more and one letter less. A range search in a k-d tree leaves out every box that lies further away.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventloom.llm.common import in_pieces, stored

# Code points are counted modulo this; the letters a to z and U+00C0 to U+00FF all get a place of their own.
PLACES = 160
# Words of a cell, words of a leaf, and words of the sample that places the cells: they decide speed only.
CELL, LEAF, SAMPLE = 4096, 24, 50_000
# Words that a task counts before it hands them on.
COUNTED = 500_000
_PAIRS = 1 << 22


def drop_letter(doc_id: int | None, every: int = 31) -> Callable[[str], str]:
    """Repeatable misspelling: of one word in ``every`` of a document, one letter is left out."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def change(word: str) -> str:
        h = zlib.crc32(word.encode(), start)
        if h % every:
            return word
        at = h % len(word)
        return word[:at] + word[at + 1 :]

    return change


def word_counts(docs: DataFrame, least: int = 7, change: Callable[[int | None], Callable[[str], str]] | None = None) -> DataFrame:
    """``word, n``: how often each word of at least ``least`` letters stands in all texts.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case. ``change`` gets a doc_id and gives a function
    applied to the document's words. Null texts have no words; repeated rows count each.
    """
    # A run that is shorter only gets shorter when a letter is left out.
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in in_pieces(batches):
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = runs.findall(raw.lower().decode()) if raw else ()
                if change is None:
                    counts.update(found)
                elif found:
                    changed = change(doc_id)
                    for word, n in Counter(found).items():
                        counts[changed(word)] += n
            if len(counts) > COUNTED:
                yield flush()
        yield flush()

    counted = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.char_length("word") >= least)


# --- trees ---------------------------------------------------------------------------------------


@dataclass
class Box:
    """A node: rows with ``count[place] <= value`` lie to the left. ``lo`` and ``hi`` bound that count in this node."""

    rows: np.ndarray
    name: int = 0
    place: int = -1
    value: int = 0
    lo: int = 0
    hi: int = 255
    left: Box | None = None
    right: Box | None = None


def letters(words: np.ndarray) -> np.ndarray:
    """Letter counts (at most 255 each) of words of one length, given as an array of that string type."""
    codes = words.view(np.uint32).reshape(len(words), -1) % PLACES
    flat = np.bincount((np.arange(len(words))[:, None] * PLACES + codes).ravel(), minlength=len(words) * PLACES)
    return np.minimum(flat, 255).astype(np.uint8).reshape(len(words), PLACES)


def grow(counts: np.ndarray, leaf: float) -> tuple[Box, list[Box]]:
    """A k-d tree over letter counts, and its leaves. Each node is split where its halves are most alike."""
    leaves: list[Box] = []

    def split(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Box:
        box = Box(rows)
        if len(rows) > leaf:
            own = counts[rows]
            below = np.stack([(own <= v).sum(axis=0) for v in range(4)])
            uneven = np.abs(2 * below - len(rows))
            value, place = np.unravel_index(np.argmin(uneven), uneven.shape)
            if 0 < below[value, place] < len(rows):
                box.place, box.value, box.lo, box.hi = int(place), int(value), int(lo[place]), int(hi[place])
                to_left = own[:, place] <= value
                edge = hi.copy()
                edge[place] = value
                box.left = split(rows[to_left], lo, edge)
                edge = lo.copy()
                edge[place] = value + 1
                box.right = split(rows[~to_left], edge, hi)
                return box
        box.name = len(leaves)
        leaves.append(box)
        return box

    return split(np.arange(len(counts)), np.zeros(PLACES, np.int16), np.full(PLACES, 255, np.int16)), leaves


def within(box: Box, counts: np.ndarray, more: int, less: int) -> Iterator[tuple[Box, np.ndarray]]:
    """Leaves, each with the rows of ``counts`` that it may answer: those that reach its box by ``more`` added and ``less`` missing letters."""
    todo = [(box, np.arange(len(counts)), np.zeros(len(counts), np.int16), np.zeros(len(counts), np.int16))]
    while todo:
        box, rows, up, down = todo.pop()
        if box.left is None:
            yield box, rows
            continue
        here = counts[rows, box.place].astype(np.int16)
        further = up + np.maximum(0, box.value + 1 - np.maximum(here, box.lo))
        keep = further <= more
        if keep.any():
            todo.append((box.right, rows[keep], further[keep], down[keep]))
        further = down + np.maximum(0, np.minimum(here, box.hi) - box.value)
        keep = further <= less
        if keep.any():
            todo.append((box.left, rows[keep], up[keep], further[keep]))


# --- comparison ----------------------------------------------------------------------------------


def _marks(counts: np.ndarray) -> np.ndarray:
    """One bit per letter with an odd count, folded into 64."""
    odd = np.zeros((len(counts), 192), np.uint8)
    odd[:, :PLACES] = counts & 1
    return np.bitwise_xor.reduce(np.packbits(odd, axis=1).view(np.uint64).reshape(len(counts), 3), axis=1)


def near_pairs(asked: np.ndarray, words: np.ndarray, longer: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``asked`` and of ``words`` that are one edit apart; ``words`` are ``longer`` (0 or 1) letters longer."""
    counts, own = letters(words), letters(asked)
    tree, _ = grow(counts, LEAF)
    marks, own_marks = _marks(counts), _marks(own)
    a = asked.view(np.uint32).reshape(len(asked), -1)
    b = words.view(np.uint32).reshape(len(words), -1)
    width = a.shape[1]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held: list[tuple[np.ndarray, np.ndarray]] = []
    total = 0

    def verify() -> None:
        i, j = (np.concatenate(x) for x in zip(*held))
        held.clear()
        step = max(1, _PAIRS // width)
        for s in range(0, len(i), step):
            x, y = i[s : s + step], j[s : s + step]
            if longer:
                same, moved = a[x] == b[y][:, :width], a[x] == b[y][:, 1:]
                head = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
                tail = np.where(moved.all(axis=1), width, np.argmin(moved[:, ::-1], axis=1))
                good = head + tail >= width
            else:
                good = (a[x] != b[y]).sum(axis=1) == 1
            found.append((x[good], y[good]))

    for leaf, rows in within(tree, own, 1, 1 - longer):
        for s in range(0, len(rows), _PAIRS // LEAF):
            part = rows[s : s + _PAIRS // LEAF]
            for t in range(0, len(leaf.rows), LEAF):
                those = leaf.rows[t : t + LEAF]
                x, y = np.nonzero(np.bitwise_count(own_marks[part][:, None] ^ marks[those]) <= 2 - longer)
                held.append((part[x], those[y]))
                total += len(x)
            if total > _PAIRS:
                verify()
                total = 0
    if held:
        verify()
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (none, none)


_PARTIAL = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _best(rows: np.ndarray, others: np.ndarray, own: np.ndarray, words: np.ndarray, n: np.ndarray) -> list[pa.Array]:
    """Of each word in ``rows`` of ``own``: number of ``others``, and the most frequent of them (ties: the first in order)."""
    place = np.empty(len(words), np.int64)
    place[np.argsort(words, kind="stable")] = np.arange(len(words))
    order = np.lexsort((place[others], -n[others], rows))
    rows, others = rows[order], others[order]
    edges = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, np.int64)
    first = others[edges]
    return [
        pa.array(own[rows[edges]].tolist(), pa.string()), pa.array(np.diff(np.append(edges, len(rows))), pa.int64()),
        pa.array(n[first], pa.int64()), pa.array(words[first].tolist(), pa.string()),
    ]


def _compared(table: pa.Table) -> pa.Table:
    """The words of one cell against those that may be near one of them."""
    roles = table["role"].to_numpy()
    words, n = np.array(table["word"].to_pylist()), table["n"].to_numpy()
    point = roles == 0
    batches = []
    if point.any():
        mine, mine_n = words[point].astype(f"<U{max(map(len, words[point]))}"), n[point]
        for role, longer in ((1, 0), (2, 1)):
            ask = roles == role
            if not ask.any():
                continue
            asked, asked_n = words[ask].astype(f"<U{mine.dtype.itemsize // 4 - longer}"), n[ask]
            i, j = near_pairs(np.ascontiguousarray(asked), np.ascontiguousarray(mine), longer)
            batches.append(pa.RecordBatch.from_arrays(_best(i, j, asked, mine, mine_n), schema=_PARTIAL))
            if longer:
                batches.append(pa.RecordBatch.from_arrays(_best(j, i, mine, asked, asked_n), schema=_PARTIAL))
    return pa.Table.from_batches(batches, schema=_PARTIAL)


# --- cells ---------------------------------------------------------------------------------------


def _cells(words: DataFrame) -> dict[int, Box]:
    """For each length a tree whose leaves hold about ``CELL`` words, grown from a sample of about ``SAMPLE`` words."""
    total = words.count()
    every = max(1, total // SAMPLE)
    sample = words.filter(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word").toArrow().column(0).to_pylist()
    by_length: dict[int, list[str]] = {}
    for w in sample:
        by_length.setdefault(len(w), []).append(w)
    trees = {}
    for length, own in by_length.items():
        if len(own) * every > CELL:
            trees[length], leaves = grow(letters(np.array(own, f"<U{length}")), max(1, CELL / every))
            for leaf in leaves:
                leaf.rows = np.zeros(0, np.int64)
    return trees


def _routed(words: DataFrame, trees: dict[int, Box]) -> DataFrame:
    """``length, cell, role, word, n``: each word in its cell (role 0), in the cells of its length (1) and of the next (2) that it may be near."""
    whole = Box(np.zeros(0, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, n = np.array(batch.column("word").to_pylist(), dtype=object), batch.column("n").to_numpy()
            sizes = np.array([len(w) for w in own])
            for length in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == length)
                counts = letters(np.array(own[at].tolist(), f"<U{length}"))
                for role, more, less in ((0, 0, 0), (1, 1, 1), (2, 1, 0)):
                    to = length + (role == 2)
                    for leaf, rows in within(trees.get(to, whole), counts, more, less):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), to, np.int32)), pa.array(np.full(len(rows), leaf.name, np.int32)),
                             pa.array(np.full(len(rows), role, np.int32)), pa.array(own[at[rows]].tolist(), pa.string()), pa.array(n[at[rows]])],
                            ["length", "cell", "role", "word", "n"],
                        )

    return words.mapInArrow(run, "length int, cell int, role int, word string, n long")


def _near(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of the words that have a near one.

    A cell with many words, or with many that ask it, is cut into parts of bounded size that meet in a grid.
    """
    routed = stored(_routed(words, _cells(words)), "cells")
    weight = F.ceil(F.sum(F.when(F.col("role") == 0, F.greatest("length", F.lit(16)))) / (32 * CELL)).cast("int")
    asking = F.ceil(F.sum(F.when(F.col("role") > 0, F.greatest("length", F.lit(16)))) / (256 * CELL)).cast("int")
    sizes = routed.groupBy("length", "cell").agg(weight.alias("rows"), asking.alias("columns")).filter("rows > 0 and columns > 0")
    own = lambda parts: F.array(F.pmod(F.xxhash64("word"), F.col(parts)).cast("int"))
    every = lambda parts: F.sequence(F.lit(0), F.col(parts) - 1)
    point = F.col("role") == 0
    dealt = routed.join(sizes, ["length", "cell"])
    dealt = dealt.withColumn("row", F.explode(F.when(point, own("rows")).otherwise(every("rows"))))
    dealt = dealt.withColumn("column", F.explode(F.when(point, every("columns")).otherwise(own("columns"))))
    parts = dealt.select("length", "cell", "row", "column", "role", "word", "n").groupBy("length", "cell", "row", "column").applyInArrow(
        _compared, "word string, near long, best_n long, best string"
    )
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return parts.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best")
    )


def spelling_groups(words: DataFrame, least: int = 2, factor: int = 10) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word (``word, n``) that occurs ``least`` times or more.

    Words are near if one code point inserted, deleted or replaced turns one into the other. A word's ``form`` is its
    most frequent near word (ties: the smallest by code points), if that is at least ``factor`` times as frequent;
    ``root`` follows forms to the last and is the word itself if it has no form.

    1. Words of each length fall into the cells of a k-d tree over their letter counts. A word asks the cells of its own
       length and of the next that its counts can reach with one letter more and, for its own length, one less.
    2. A cell grows its own tree. The boxes in reach are searched, and the order of letters decides.
    3. The answers for a word are added up; forms are followed by doubling, at most five times for 64-bit counts, as
       each is ``factor`` times as frequent as the last.

    ``words`` are distinct. Null and empty words, and words without a count, take no part. No rows give no rows.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more, so that forms do not run in circles")
    kept = stored(words.filter((F.col("n") >= least) & (F.char_length("word") > 0)).select("word", F.col("n").cast("long").alias("n")), "words")
    near = stored(kept.join(_near(kept), "word", "left"), "near")
    has = F.col("best_n") >= F.col("n") * factor
    forms = near.filter(has).select("word", F.col("best").alias("root"))
    while True:
        forms = stored(forms, "forms")
        ahead = forms.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = forms.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = stored(step, "forms")
        forms = step.select("word", "root")
        if step.filter("moved").isEmpty():
            break
    return near.join(forms, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best")).alias("form"),
        F.when(has, F.col("best_n")).alias("form_n"), F.coalesce("root", "word").alias("root"),
    )
