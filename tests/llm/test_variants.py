"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from eventloom.llm import queries, variants
from tests.llm import cases


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, least=2, factor=10):
    words = {w: n for w, n in counts.items() if n >= least}
    forms, out = {}, {}
    for w, n in words.items():
        around = [v for v in words if near(w, v)]
        best = min(around, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= factor * n else None
        out[w] = (n, len(around), forms[w], words.get(forms[w]))
    last = lambda w: last(forms[w]) if forms[w] else w
    return {w: (*v, last(w)) for w, v in out.items()}


def got(df):
    rows = df.collect()
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(out) == len(rows)
    return out


def vocabulary(seed, size, alphabet="abcé"):
    """Many near words: few letters, lengths 1 to 9, and chains of ever more frequent forms."""
    dice = random.Random(seed)
    words = Counter()
    for _ in range(size):
        words["".join(dice.choice(alphabet) for _ in range(dice.randint(1, 9)))] += dice.choice([1, 2, 3, 30, 400, 5000])
    for i, w in enumerate(("zzzzzzz", "zzzzzz", "zzzzzy", "zzzzxy", "zzzwxy", "zzvwxy")):
        words[w] = 2 * 10**i
    return words


@pytest.mark.parametrize("cell", [4096, 40])
def test_equal_to_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(variants, "CELL", cell)
    monkeypatch.setattr(variants, "LEAF", 4)
    words = vocabulary(cell, 1500)
    df = spark.createDataFrame([(w, n, "x", 1) for w, n in words.items()], "word string, n long, root string, cell int").repartition(5)
    want = brute(words)
    assert want["zzzzzzz"][-1] == "zzvwxy"
    assert got(variants.spelling_groups(df)) == want


def test_one_letter_count_for_all_words(spark, monkeypatch):
    """Words of the same letters cannot be parted by their counts: a cell is cut into parts by hash."""
    monkeypatch.setattr(variants, "CELL", 8)
    dice = random.Random(2)
    words = {"".join(dice.sample("abcdef", 6)): 5 for _ in range(300)} | {"abcdeg": 99, "abcde": 60, "x" * 4000: 2, "x" * 4001: 30}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(variants.spelling_groups(df)) == brute(words)


def test_awkward_words(spark):
    rows = [(None, 5), ("", 9), ("ab", None), ("ab c", 4), ("ab  c", 40), ("😀aaaa", 2), ("😀aaa", 20), ("Ωaaa", 2)]
    df = spark.createDataFrame(rows, "word string, n long")
    assert got(variants.spelling_groups(df)) == brute({w: n for w, n in rows if w and n})
    assert variants.spelling_groups(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        variants.spelling_groups(df, factor=1)


def brute_counts(rows, typos=True):
    out = Counter()
    for r in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{w}".encode())
            if typos and h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                out[w] += 1
    return out


def test_word_counts(spark):
    rows = cases.rows()
    for change, typos in ((variants.drop_letter, True), (None, False)):
        counted = {r["word"]: r["n"] for r in variants.word_counts(cases.documents(spark), change=change).collect()}
        assert counted == brute_counts(rows, typos)
    assert variants.word_counts(cases.nothing(spark)).collect() == []


def test_query(spark, tmp_path):
    dice = random.Random(4)
    words = ["".join(dice.choice("aeinrst") for _ in range(dice.randint(6, 9))) for _ in range(80)]
    rows = [(i, " ".join(dice.choices(words, weights=range(1, 81), k=200)).title(), None, None, None, None, None) for i in range(60)]
    spark.createDataFrame(rows, cases.DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    want = brute(brute_counts(rows))
    assert got(queries.op11_spelling_variants(spark, str(tmp_path))) == want
    assert sum(v[2] is not None for v in want.values()) > 20


def test_boxes_in_reach():
    """The search opens every leaf that holds a word within one letter more and one less."""
    dice = np.random.default_rng(3)
    words = np.array(["".join(dice.choice(list("abcd"), 6)) for _ in range(400)])
    counts = variants.letters(words)
    tree, leaves = variants.grow(counts, 5)
    assert len(leaves) > 30
    reached = {(int(i), leaf.name) for leaf, rows in variants.within(tree, counts, 1, 1) for i in rows}
    home = {int(i): leaf.name for leaf in leaves for i in leaf.rows}
    gap = counts[:, None].astype(int) - counts[None]
    close = (np.maximum(gap, 0).sum(axis=2) <= 1) & (np.maximum(-gap, 0).sum(axis=2) <= 1)
    assert all((int(i), home[int(j)]) in reached for i, j in zip(*np.nonzero(close)))
    assert len(reached) < 0.9 * len(words) * len(leaves)
