"""Removal of byte strings that also stand in an earlier document, by a range-partitioned sparse suffix array.

Every window of ``width`` bytes is named by one suffix in it: the one whose leading token (``GRAM`` bytes) has the
smallest hash. Equal windows choose the same suffix, so only these suffixes, about one byte in seventeen, are looked at,
and only those whose token stands in two texts or more are sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventloom.llm.common import in_pieces, one_shuffle_at_a_time, stored
from eventloom.llm.shingles import mixed

GRAM = 16
# Bytes of text, of tokens and of suffixes that a task holds at a time; they decide the number of partitions.
TEXT_BYTES, SUFFIX_BYTES = 16_000_000, 12_000_000
# Tokens of the sample that fixes the splitters.
SAMPLE = 50_000
# Texts whose smallest id a task remembers.
REMEMBERED = 500_000
_U = np.uint64
_NO_ID = -(2**63)


# --- suffixes of a piece of text -----------------------------------------------------------------


def _piece(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column one after the other, and where each value starts (with the end)."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64) - offsets[0]


def _tokens(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place on."""
    h, n = data.astype(_U) + _U(1), 1
    while n < GRAM:
        h = h[:-n] * _U(pow(0x9E3779B97F4A7C15, n, 2**64)) + h[n:]
        n *= 2
    return mixed(h)


def _first_least(values: np.ndarray, span: int) -> np.ndarray:
    """Place of the smallest value in each run of ``span`` values; the first of equal ones."""
    at, n = np.arange(len(values), dtype=np.int32), 1
    while n < span:
        step = min(n, span - n)
        left = values[:-step] <= values[step:]
        values, at = np.where(left, values[:-step], values[step:]), np.where(left, at[:-step], at[step:])
        n += step
    return at


def suffixes(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Chosen suffixes of texts laid end to end: ``owner, place, first, last, token``.

    ``first`` and ``last`` are the starts of the first and last window that the suffix names; places count from the
    start of ``data``.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < width:
        return empty, empty, empty, empty, empty.astype(_U)
    hashes = _tokens(data)
    at = _first_least(hashes, width - GRAM + 1)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    inside = np.flatnonzero(owner[: len(at)] == owner[width - 1 : width - 1 + len(at)])
    chosen, own = at[inside].astype(np.int64), owner[inside]
    new = np.append(True, (chosen[1:] != chosen[:-1]) | (own[1:] != own[:-1]))[: len(chosen)]
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(chosen)) - 1
    return own[begin], chosen[begin], inside[begin], inside[end], hashes[chosen[begin]]


def _packets(to: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """The columns cut up by destination."""
    order = np.argsort(to, kind="stable")
    to = to[order]
    edges = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.zeros(0, np.int64)
    moved = [c[order] for c in columns]
    for x, y in zip(edges, np.append(edges[1:], len(to))):
        yield int(to[x]), [c[x:y].tobytes() for c in moved]


def _remainder(values: np.ndarray, n: int) -> np.ndarray:
    return (mixed(values.view(_U)) % _U(n)).astype(np.int64)


# --- texts ---------------------------------------------------------------------------------------


def _texts(docs: DataFrame, width: int, slots: int) -> DataFrame:
    """``slot, doc_id, tag, text`` of the texts that are long enough; ``tag`` is a 64-bit hash of the text."""
    raw = F.col("text").cast("binary")
    tag = F.xxhash64("text")
    return docs.filter(F.octet_length(raw) >= width).select(
        F.pmod(tag, F.lit(slots)).cast("int").alias("slot"), "doc_id", tag.alias("tag"), raw.alias("text")
    )


_ROW = "slot int, kind int, doc_id long, tag long, id long, size long, a binary, b binary, c binary"
_ROW_ARROW = pa.schema([
    ("slot", pa.int32()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("tag", pa.int64()), ("id", pa.int64()), ("size", pa.int64()),
    ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()),
])


def _travelling(rows: DataFrame, slots: int, all_rows: bool) -> DataFrame:
    """The rows that must meet their slot: kind 1 with the text in ``a``; and, with ``all_rows``, kind 2 without a text.

    A task sends a text only while its id is smaller than any it has met for that text. A larger id makes a copy (kind
    2), which needs nothing from its slot, so a text that a third of all rows hold does not pile up there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, int] = {}
        for batch in batches:
            ids = batch.column("doc_id").fill_null(_NO_ID).to_pylist()
            kinds = []
            for tag, i in zip(batch.column("tag").to_pylist(), ids):
                known = least.get(tag)
                kinds.append(1 if known is None or i < known or (all_rows and i == known) else 2)
                if known is None or i < known:
                    least[tag] = i
            if len(least) > REMEMBERED:
                least.clear()
            kind, ids = np.array(kinds, np.int32), np.array(ids, np.int64)
            if not all_rows:
                batch, ids, kind = batch.filter(pa.array(kind == 1)), ids[kind == 1], kind[kind == 1]
            copies = pa.array(kind == 2)
            text, none = batch.column("text"), pa.nulls(len(kind), pa.binary())
            slot = np.where(kind == 2, _remainder(ids, slots), batch.column("slot").to_numpy()).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(kind), batch.column("doc_id"), batch.column("tag"), pa.array(ids),
                 pa.compute.binary_length(text).cast(pa.int64()), pa.compute.if_else(copies, none, text), none, none],
                schema=_ROW_ARROW,
            )

    return rows.mapInArrow(run, _ROW)


def _slot_packets(packed: DataFrame) -> DataFrame:
    nothing = F.lit(None).cast("long")
    return packed.select(
        "slot", F.lit(0).alias("kind"), *(nothing.alias(c) for c in ("doc_id", "tag", "id", "size")), "a", "b", "c"
    )


def _met(texts: DataFrame, packed: DataFrame, slots: int) -> DataFrame:
    """Texts and what is known of them, one partition per slot: packets first, then texts by tag and id."""
    return texts.unionByName(_slot_packets(packed)).repartitionById(slots, "slot").sortWithinPartitions("kind", "tag", "id")


def _joined(parts: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(parts), kind)


# --- tokens that stand in several texts ----------------------------------------------------------


def _suspects(rows: DataFrame, width: int, buckets: int, slots: int) -> DataFrame:
    """``slot, a (tags), b (tokens), c, n``: chosen suffixes of a text whose token another text has as well.

    A task sends each token once, with a mark if it has seen it in several texts; those suffixes are settled at once.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            token, tag = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.lexsort((tag, token))
            token, tag = token[order], tag[order]
            fresh = np.append(True, (token[1:] != token[:-1]) | (tag[1:] != tag[:-1]))
            token, tag = token[fresh], tag[fresh]
            first = np.append(True, token[1:] != token[:-1])
            many = np.repeat(np.diff(np.append(np.flatnonzero(first), len(token))) > 1, np.diff(np.append(np.flatnonzero(first), len(token))))
            out = [(b, 0, *x) for b, x in _packets((token[first] % _U(buckets)).astype(np.int64), token[first], tag[first], many[first])]
            out += [(b, 1, *x) for b, x in _packets(_remainder(tag[many], buckets), token[many], tag[many], many[many])]
            b, kind, tokens, tags, marks = zip(*out)
            return pa.RecordBatch.from_arrays(
                [pa.array(b, pa.int32()), pa.array(kind, pa.int32()), pa.array(tokens, pa.binary()), pa.array(tags, pa.binary()), pa.array(marks, pa.binary())],
                ["bucket", "kind", "a", "b", "c"],
            )

        total = 0
        for batch in in_pieces(batches):
            tags = batch.column("tag").to_pylist()
            fresh = [t not in seen and not seen.add(t) for t in tags]
            if len(seen) > REMEMBERED:
                seen.clear()
            batch = batch.filter(pa.array(fresh))
            own, _, _, _, token = suffixes(*_piece(batch.column("text")), width)
            if len(own):
                held.append((token, batch.column("tag").to_numpy()[own]))
                total += len(own)
            if total > TEXT_BYTES // 8:
                yield flush()
                total = 0
        if held:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, tuple[list, list, list]] = {0: ([], [], []), 1: ([], [], [])}
        for batch in batches:
            for kind, a, b, c in zip(*(batch.column(x).to_pylist() for x in ("kind", "a", "b", "c"))):
                for into, value in zip(parts[kind], (a, b, c)):
                    into.append(value)
        found = [(_joined(parts[1][0], "<u8"), _joined(parts[1][1], "<i8"))]
        token, tag, many = _joined(parts[0][0], "<u8"), _joined(parts[0][1], "<i8"), _joined(parts[0][2], "?")
        if len(token):
            order = np.lexsort((tag, token))
            token, tag, many = token[order], tag[order], many[order]
            edges = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            sizes = np.diff(np.append(edges, len(token)))
            several = np.logical_or.reduceat(many, edges) | (np.minimum.reduceat(tag, edges) != np.maximum.reduceat(tag, edges))
            kept = np.repeat(several, sizes)
            found.append((token[kept], tag[kept]))
        token, tag = (np.concatenate(x) for x in zip(*found))
        out = [(s, *x) for s, x in _packets(_slot(tag, slots), tag, token)]
        if out:
            s, tags, tokens = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(s, pa.int32()), pa.array(tags, pa.binary()), pa.array(tokens, pa.binary()), pa.nulls(len(s), pa.binary()), pa.array([len(x) // 8 for x in tags], pa.int64())],
                ["slot", "a", "b", "c", "n"],
            )

    asked = rows.mapInArrow(emit, "bucket int, kind int, a binary, b binary, c binary")
    return asked.repartitionById(buckets, "bucket").mapInArrow(meet, "slot int, a binary, b binary, c binary, n long")


def _slot(tag: np.ndarray, slots: int) -> np.ndarray:
    return np.mod(tag, slots)


# --- sorting -------------------------------------------------------------------------------------


def record(width: int) -> np.dtype:
    """A suffix with the bytes of the windows that it names: ``width - GRAM`` before its place, ``width`` from it on, others 0."""
    return np.dtype([("near", "u1", 2 * width - GRAM), ("lo", "u1"), ("hi", "u1"), ("id", "<i8"), ("tag", "<i8"), ("place", "<i4")])


def _records(data: np.ndarray, starts: np.ndarray, ids: np.ndarray, tags: np.ndarray, found: tuple[np.ndarray, ...], width: int) -> np.ndarray:
    own, place, first, last, _ = found
    before, span = width - GRAM, 2 * width - GRAM
    out = np.zeros(len(own), record(width))
    padded = np.concatenate([np.zeros(before, np.uint8), data, np.zeros(width, np.uint8)])
    columns = np.arange(span)
    lo, hi = place - last, place - first
    real = (columns >= before - hi[:, None]) & (columns < before - lo[:, None] + width)
    out["near"] = padded[place[:, None] + columns] * real
    out["lo"], out["hi"], out["id"], out["tag"], out["place"] = lo, hi, ids[own], tags[own], place - starts[own]
    return out


def _words(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of big-endian 64-bit words, filled up with zeros."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    return wide.view(">u8").astype(_U)


def multikey_sort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, and the bytes that each sorted row shares with the one before (at most 8 per word).

    Multikey quicksort over words: rows are split by one word, and only runs that are still equal go on to the next.
    """
    n, k = words.shape
    order = np.argsort(words[:, 0], kind="stable")
    shared = np.zeros(n, np.int64)
    open_ = np.append(False, np.ones(max(n - 1, 0), bool))[:n]
    for depth in range(k):
        if depth:
            run = np.flatnonzero(open_ | np.append(open_[1:], False))
            if not len(run):
                break
            group = np.cumsum(~open_)[run]
            order[run] = order[run][np.lexsort((words[order[run], depth], group))]
        at = np.flatnonzero(open_)
        apart = words[order[at], depth] ^ words[order[at - 1], depth]
        for byte in range(8):
            shared[at] += apart < _U(1 << (8 * (7 - byte)))
        open_[at[apart != 0]] = False
    return order, shared


def _named(order: np.ndarray, shared: np.ndarray, depth: int) -> np.ndarray:
    """A number per row, equal for rows that agree in their first ``depth`` bytes."""
    name = np.empty(len(order), np.int64)
    name[order] = np.cumsum(shared < depth)
    return name


def found_before(rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of suffix records: which lie in windows that a smaller id has as well, and the first and last such window.

    Windows are given by how far they start before the suffix. The suffixes are sorted, and so are the texts before
    them read backwards; two windows that start ``o`` bytes before are equal if their suffixes agree in ``width - o``
    bytes and the bytes before them in ``o``.
    """
    before = width - GRAM
    least, most = np.full(len(rows), width), np.full(len(rows), -1)
    right, left = multikey_sort(_words(rows["near"][:, before:])), multikey_sort(_words(rows["near"][:, before - 1 :: -1]))
    for o in range(before + 1):
        at = np.flatnonzero((rows["lo"] <= o) & (rows["hi"] >= o))
        if len(at) < 2:
            continue
        key = _named(*right, width - o)[at] * (len(rows) + 1) + (_named(*left, o)[at] if o else 0)
        order = np.argsort(key, kind="stable")
        edges = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        ids = rows["id"][at][order]
        smallest = np.repeat(np.minimum.reduceat(ids, edges), np.diff(np.append(edges, len(ids))))
        hit = at[order][ids > smallest]
        least[hit], most[hit] = np.minimum(least[hit], o), o
    return np.flatnonzero(most >= 0), most[most >= 0], least[most >= 0]


def _single_windows(rows: np.ndarray, width: int) -> np.ndarray:
    """Each record once per window that it names, with the bytes of that window only."""
    count = rows["hi"].astype(np.int64) - rows["lo"] + 1
    out = np.repeat(rows, count)
    o = out["lo"] + (np.arange(len(out)) - np.repeat(np.cumsum(count) - count, count))
    columns = np.arange(2 * width - GRAM)
    start = (width - GRAM - o)[:, None]
    out["near"] *= (columns >= start) & (columns < start + width)
    out["lo"] = out["hi"] = o
    return out


def _row_hash(rows: np.ndarray) -> np.ndarray:
    words = _words(rows["near"])
    salt = mixed(np.arange(words.shape[1], dtype=_U) + _U(1))
    return mixed((mixed(words + salt) * (salt | _U(1))).sum(axis=1) + rows["lo"].astype(_U) * _U(257) + rows["hi"])


def _combined(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Split records into those that are still to be compared and those that equal a record of a smaller id."""
    hashes = _row_hash(rows)
    order = np.lexsort((rows["id"], hashes))
    rows, hashes = rows[order], hashes[order]
    same = np.append(False, hashes[1:] == hashes[:-1])
    near = rows["near"]
    at = np.flatnonzero(same)
    same[at] = (near[at] == near[at - 1]).all(axis=1) & (rows["lo"][at] == rows["lo"][at - 1]) & (rows["hi"][at] == rows["hi"][at - 1])
    group = np.flatnonzero(~same)
    first = np.repeat(rows["id"][group], np.diff(np.append(group, len(rows))))
    copy = rows["id"] > first
    return rows[~copy], rows[copy]


_RANGE = "range int, kind int, a binary, b binary, c binary"


def _sorted_out(met: DataFrame, width: int, slots: int, ranges: int, splitters: np.ndarray, hot: np.ndarray) -> DataFrame:
    """``slot, a (tags), b (starts), c (ends)``: byte ranges of texts to be removed.

    Suffixes are range-partitioned by the hash of their leading token. Equal tokens never lie on both sides of a
    splitter; a token that fills several ranges (``hot``) is dealt out by its single windows instead.
    """
    kind = record(width)
    span = kind.itemsize

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tags: list[bytes] = []
        tokens: list[bytes] = []
        known: np.ndarray | None = None
        last = None
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            rows, copies = _combined(np.concatenate(held))
            held.clear()
            gram = np.ascontiguousarray(rows["near"][:, width - GRAM : width])
            token = _tokens(gram.reshape(-1))[::GRAM] if len(rows) else np.zeros(0, _U)
            often = np.isin(token, hot)
            windows = _single_windows(rows[often], width)
            to = np.concatenate([np.searchsorted(splitters, token[~often], "right"), (_row_hash(windows) % _U(ranges)).astype(np.int64)])
            rows = np.concatenate([rows[~often], windows])
            out = [(r, 0, x[0], None, None) for r, x in _packets(to, rows)]
            start, end = copies["place"] - copies["hi"].astype(np.int64), copies["place"] - copies["lo"].astype(np.int64) + width
            out += [(r, 1, *x) for r, x in _packets(_remainder(copies["tag"].copy(), ranges), copies["tag"].copy(), start, end)]
            columns = zip(*out)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                ["range", "kind", "a", "b", "c"],
            )

        size = 0
        for batch in in_pieces(batches, column="a"):
            packets = batch.filter(pa.compute.equal(batch.column("kind"), 0))
            tags += packets.column("a").to_pylist()
            tokens += packets.column("b").to_pylist()
            texts = batch.filter(pa.compute.equal(batch.column("kind"), 1))
            if not texts.num_rows:
                continue
            if known is None:
                known = np.sort(mixed(_joined(tags, "<u8")) ^ _joined(tokens, "<u8"))
                tags, tokens = [], []
            tag = texts.column("tag").to_numpy()
            fresh = np.append(tag[:1] != last if last is not None else True, tag[1:] != tag[:-1])
            last = tag[-1]
            texts, tag = texts.filter(pa.array(fresh)), tag[fresh]
            if not texts.num_rows or not len(known):
                continue
            data, starts = _piece(texts.column("a"))
            found = suffixes(data, starts, width)
            key = mixed(tag.view(_U)[found[0]]) ^ found[4]
            at = np.searchsorted(known, key)
            at[at == len(known)] = 0
            hit = known[at] == key
            held.append(_records(data, starts, texts.column("id").to_numpy(), tag, tuple(x[hit] for x in found), width))
            size += len(held[-1])
            if size * span > 4 * SUFFIX_BYTES:
                yield flush()
                size = 0
        if size:
            yield flush()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bodies: list[bytes] = []
        tags: list[np.ndarray] = []
        starts: list[np.ndarray] = []
        ends: list[np.ndarray] = []
        for batch in batches:
            for kind_, a, b, c in zip(*(batch.column(x).to_pylist() for x in ("kind", "a", "b", "c"))):
                if kind_ == 0:
                    bodies.append(a)
                else:
                    for into, value in ((tags, a), (starts, b), (ends, c)):
                        into.append(np.frombuffer(value, "<i8"))
        rows = np.frombuffer(b"".join(bodies), kind)
        bodies.clear()
        if len(rows):
            hit, far, near = found_before(rows, width)
            tags.append(rows["tag"][hit])
            starts.append(rows["place"][hit] - far)
            ends.append(rows["place"][hit] - near + width)
        if tags:
            tag, start, end = np.concatenate(tags), np.concatenate(starts).astype(np.int64), np.concatenate(ends).astype(np.int64)
            out = [(s, *x) for s, x in _packets(_slot(tag, slots), tag, start.astype("<i4"), end.astype("<i4"))]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["slot", "a", "b", "c"]
                )

    return met.mapInArrow(emit, _RANGE).repartitionById(ranges, "range").mapInArrow(compare, "slot int, a binary, b binary, c binary")


def _merged(tag: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges sorted by tag and place, those that touch or overlap as one."""
    if not len(tag):
        return tag, start, end
    order = np.lexsort((start, tag))
    tag, start, end = tag[order], start[order].astype(np.int64), end[order].astype(np.int64)
    group = np.cumsum(np.append(True, tag[1:] != tag[:-1])) << 32
    reach = np.maximum.accumulate(group + end)
    new = np.append(True, (group + start)[1:] > reach[:-1])
    edges = np.flatnonzero(new)
    return tag[edges], start[edges], (np.append(reach[edges[1:] - 1], reach[-1]) - group[edges])


def _removed(met: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed: list[tuple[bytes, bytes, bytes]] = []
        ranges = None
        last = first = None
        for batch in in_pieces(batches, column="a"):
            packets = batch.filter(pa.compute.equal(batch.column("kind"), 0))
            packed += zip(*(packets.column(x).to_pylist() for x in ("a", "b", "c")))
            rows = batch.filter(pa.compute.greater(batch.column("kind"), 0))
            if not rows.num_rows:
                continue
            if ranges is None:
                a, b, c = zip(*packed) if packed else ((),) * 3
                ranges = _merged(_joined(a, "<i8"), _joined(b, "<i4"), _joined(c, "<i4"))
                packed = []
            tags = rows.column("tag").to_numpy()
            lo, hi = np.searchsorted(ranges[0], tags, "left"), np.searchsorted(ranges[0], tags, "right")
            spans, kept = [], []
            for kind, tag, i, size, text, x, y in zip(
                *(rows.column(c).to_pylist() for c in ("kind", "tag", "id", "size", "a")), lo, hi
            ):
                if kind == 1 and tag != last:
                    last, first = tag, i
                if kind == 2 or i > first:
                    spans.append([{"start": 0, "end": size}])
                    kept.append(b"")
                    continue
                own = list(zip(ranges[1][x:y].tolist(), ranges[2][x:y].tolist()))
                edges = [0, *(e for pair in own for e in pair), size]
                spans.append([{"start": s, "end": e} for s, e in own])
                kept.append(b"".join(text[edges[j] : edges[j + 1]] for j in range(0, len(edges), 2)))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("size"), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    return met.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def without_repeats(docs: DataFrame, width: int = 50) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: each text without the bytes that an earlier document has as well.

    A byte goes if it lies in a string of ``width`` UTF-8 bytes that also starts in a document with a smaller doc_id,
    whether or not it goes there. ``spans`` are the removed runs in bytes, in order and apart; ``kept`` are the other
    bytes. Strings are compared in full; texts are told apart by 64-bit hashes. ``docs`` must give the same rows each
    time it is read, as a stored table does: it is read four times.

    1. Every window chooses one suffix. Tokens that lead suffixes of at least two texts are found by a shuffle of
       token hashes; exact copies count as one text.
    2. Those suffixes, with the bytes around them, are range-partitioned by token at sampled splitters, equal ones of a
       task sent once. Each range is sorted by multikey quicksort, forwards from the suffix and backwards before it.
    3. The ranges found go back to their texts, which are cut.

    Null is the empty text. A null id is smaller than any other, and rows of the same id are not before one another.
    Texts shorter than ``width`` stay whole. Repeated rows give a row each, with equal results. No rows give no rows.
    Other columns are ignored.
    """
    if width <= GRAM:
        raise ValueError(f"width must be more than {GRAM}")
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = F.octet_length("text").cast("long")
    short = docs.filter(F.octet_length("text") < width).select(
        "doc_id", size.alias("n_bytes"), F.array().cast("array<struct<start: long, end: long>>").alias("spans"), F.col("text").cast("binary").alias("kept")
    )
    total = docs.agg(F.sum(size)).first()[0] or 0
    slots = max(2 * spark.sparkContext.defaultParallelism, -(-total // TEXT_BYTES))
    texts = _texts(docs, width, slots)
    with one_shuffle_at_a_time(spark):
        suspects = stored(_suspects(texts, width, slots, slots), "suspects")
        many = suspects.agg(F.sum("n")).first()[0] or 0
        ranges = max(2 * spark.sparkContext.defaultParallelism, -(-many * record(width).itemsize // SUFFIX_BYTES))
        splitters, hot = _splitters(suspects, many, ranges)
        met = _met(_travelling(texts, slots, False), suspects, slots)
        cut = stored(_sorted_out(met, width, slots, ranges, splitters, hot), "ranges")
    return short.unionByName(_removed(_met(_travelling(texts, slots, True), cut, slots), width))


def _splitters(suspects: DataFrame, many: int, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """``ranges - 1`` tokens that part a sample of about ``SAMPLE`` evenly, and those that fill a range or more alone."""
    every = max(1, many // SAMPLE)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                tag, token = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                yield pa.RecordBatch.from_arrays([pa.array(token[mixed(tag ^ mixed(token)) % _U(every) == 0].view(np.int64))], ["token"])

    sample = np.sort(suspects.mapInArrow(pick, "token long").toArrow().column(0).to_numpy().view(_U))
    if not len(sample):
        return np.zeros(0, _U), np.zeros(0, _U)
    splitters = sample[np.linspace(0, len(sample), ranges + 1).astype(int)[1:-1]]
    token, count = np.unique(sample, return_counts=True)
    return splitters, token[count * ranges > len(sample)] if ranges > 1 else token[:0]
