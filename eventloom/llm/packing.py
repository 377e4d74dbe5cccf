"""Packing documents into token sequences: first-fit decreasing over a tournament tree, in random groups."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventloom.llm.common import in_pieces, texts
from eventloom.llm.tokens import PieceEncoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class BinTree:
    """Tournament tree over bins: each node knows the largest room below it, so the first bin that fits is one descent."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Put an item in the first bin with room for it."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            node += room[node] < size
        room[node] -= size
        found = node - self.leaves
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return found


def pack(sizes: list[int], capacity: int = 2048, least: int = 8) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(item, start, length)`` pieces that hold every item whole.

    Items longer than a sequence fill sequences of their own first. What is left is packed first-fit decreasing.
    Then the emptiest sequences are cut up to fill gaps of at least ``least`` tokens in the others, and the one left
    over is cut at powers of two, which need no padding. An item of size 0 has no piece.
    """
    out, rest = [], []
    for i, size in enumerate(sizes):
        whole = size // capacity * capacity
        out += [[(i, at, capacity)] for at in range(0, whole, capacity)]
        if size > whole:
            rest.append((size - whole, i, whole))
    if not rest:
        return out
    rest.sort(key=lambda x: (-x[0], x[1]))
    tree, bins = BinTree(len(rest), capacity), []
    for size, i, at in rest:
        b = tree.place(size)
        if b == len(bins):
            bins.append([])
        bins[b].append((i, at, size))
    loads = [sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: -loads[b])
    bins, loads = [bins[b] for b in order], [loads[b] for b in order]
    taker, giver = 0, len(bins) - 1
    while taker < giver:
        gap = capacity - loads[taker]
        if gap < least:
            taker += 1
            continue
        item, at, size = bins[giver].pop()
        part = min(gap, size)
        bins[taker].append((item, at, part))
        loads[taker] += part
        loads[giver] -= part
        if size > part:
            bins[giver].append((item, at + part, size - part))
        elif not bins[giver]:
            giver -= 1
    out += bins[:giver]
    last, left = bins[giver], loads[giver]
    while left:
        want, sequence = 1 << (left.bit_length() - 1), []
        left -= want
        while want:
            item, at, size = last.pop()
            part = min(want, size)
            sequence.append((item, at, part))
            want -= part
            if size > part:
                last.append((item, at + part, size - part))
        out.append(sequence)
    return out


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048, group_docs: int = 2048,
    group_tokens: int = 4_000_000, rows: int | None = None,
) -> DataFrame:
    """Pieces of all documents in sequences: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is the ids of its text (null: empty) by the file ``tokenizer`` and then ``end_id``. Documents are dealt
    by a hash of id and text into groups of about ``group_docs``; each group is packed by itself, at most
    ``group_tokens`` ids at a time, so memory does not depend on how long texts are or how often a row repeats.
    ``sequence_id`` is the group's number times 2**32 plus the place in the group. Reruns agree.

    Repeated rows are packed each. A null id stays null. No rows give no rows. Other columns are ignored.
    """
    groups = max(1, -(-(docs.count() if rows is None else rows) // group_docs))
    dealt = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int").alias("_g"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = PieceEncoder(tokenizer), np.array([end_id], "<u4").tobytes()
        group, done, held, ids, names = None, 0, 0, [], []

        def flush() -> pa.RecordBatch:
            nonlocal done, held
            table = [[] for _ in range(7)]
            for sequence in pack([len(x) // 4 for x in ids], capacity):
                offset = 0
                for item, at, size in sequence:
                    raw = ids[item]
                    row = (names[item], at, size, zlib.crc32(raw[4 * at : 4 * (at + size)]), len(raw) // 4, (group << 32) + done, offset)
                    for column, value in zip(table, row):
                        column.append(value)
                    offset += size
                done += 1
            ids.clear()
            names.clear()
            held = 0
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in table],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

        for batch in in_pieces(batches):
            for g, name, text in zip(batch.column("_g").to_pylist(), batch.column("doc_id").to_pylist(), texts(batch)):
                if g != group or held >= group_tokens:
                    if ids:
                        yield flush()
                    done = 0 if g != group else done
                    group = g
                ids.append(encoder.ids(text) + end)
                names.append(name)
                held += len(ids[-1]) // 4
        if ids:
            yield flush()

    return dealt.repartitionById(groups, "_g").sortWithinPartitions("_g", "doc_id", "text").mapInArrow(run, SCHEMA)
