"""Repeated byte strings against brute force."""

import random

import numpy as np
import pytest

from eventloom.llm import suffixes
from tests.llm import cases


def brute(rows, width):
    """doc_id, n_bytes, spans, kept of each row."""
    texts = [(-(2**63) if r[0] is None else r[0], r[0], (r[1] or "").encode()) for r in rows]
    first = {}
    for i, _, t in texts:
        for s in range(len(t) - width + 1):
            w = t[s : s + width]
            first[w] = min(i, first.get(w, i))
    out = []
    for i, doc_id, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - width + 1):
            if first[t[s : s + width]] < i:
                gone[s : s + width] = True
        edges = np.flatnonzero(np.diff(gone.astype(int), prepend=0)).tolist()
        spans = tuple(zip(edges[::2], edges[1::2]))
        out.append((str(doc_id), len(t), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out)


def got(df):
    return sorted((str(r["doc_id"]), r["n_bytes"], tuple((s["start"], s["end"]) for s in r["spans"]), bytes(r["kept"])) for r in df.collect())


def planted(seed, n=120):
    """Texts that share passages at random places, with copies, periods, equal ids and lines that differ in a byte."""
    dice = random.Random(seed)
    word = lambda: "".join(dice.choice("abcdeé ") for _ in range(dice.randint(20, 120)))
    passages = [word() for _ in range(6)] + ["ab" * 40, "x" * 90]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(dice.randint(0, 5)):
            p = dice.choice(passages)
            cut = dice.randint(0, len(p) // 2)
            parts += [word(), p[cut : dice.randint(cut, len(p))]]
        text = "".join(parts)
        if dice.random() < 0.2 and rows:
            text = dice.choice(rows)[1] or ""
        if dice.random() < 0.2 and text:
            at = dice.randrange(len(text))
            text = text[:at] + "#" + text[at + 1 :]
        rows.append((dice.choice([i, i, i, dice.randint(0, n), None]) if i % 9 == 0 else i, text))
    return rows


@pytest.mark.parametrize("width", [50, 24])
def test_repeats_equal_brute_force(spark, width):
    rows = planted(width)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, kept string, slot int")
    assert got(suffixes.without_repeats(docs, width)) == brute(rows, width)


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in cases.rows()]
    assert got(suffixes.without_repeats(cases.documents(spark))) == brute(rows, 50)
    assert suffixes.without_repeats(cases.nothing(spark)).collect() == []


def test_hot_tokens_are_dealt_by_window(spark, monkeypatch):
    """One passage in every text and one token before ever new bytes; small ranges, so that tokens fill several."""
    dice = random.Random(3)
    word = lambda n: "".join(dice.choice("abcdefgh") for _ in range(n))
    passage, gram = word(80), word(16)
    rows = [(i, word(40) + passage + word(30) + gram + word(40) + (gram + "tail" * 12 if i % 3 else "")) for i in range(300)]
    monkeypatch.setattr(suffixes, "SUFFIX_BYTES", 20_000)
    monkeypatch.setattr(suffixes, "SAMPLE", 10**9)
    seen = []
    real = suffixes._splitters
    monkeypatch.setattr(suffixes, "_splitters", lambda *a: seen.append(real(*a)) or seen[-1])
    assert got(suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows, 50)
    assert len(seen[0][1]) > 0 and len(seen[0][0]) >= 15


def test_multikey_sort():
    dice = np.random.default_rng(1)
    rows = dice.integers(0, 2, (500, 19)).astype(np.uint8)
    rows[100:200] = rows[:100]
    order, shared = suffixes.multikey_sort(suffixes._words(rows))
    sorted_ = [rows[i].tobytes() for i in order]
    assert sorted_ == sorted(r.tobytes() for r in rows)
    for i in range(1, 500):
        same = next((k for k in range(19) if rows[order[i]][k] != rows[order[i - 1]][k]), 24)
        assert shared[i] == same
