"""The Merkle manifest against a plain recomputation."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eventloom.llm import manifest, queries
from tests.llm import cases

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n_chars = row[:5]
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return H(*parts)


def climb(nodes):
    """Root of a list of digests, and for each the runs on its way up as (before, behind)."""
    paths = [[] for _ in nodes]
    level, members = nodes, [[i] for i in range(len(nodes))]
    while len(level) > 1:
        up, grouped = [], []
        for s in range(0, len(level), 16):
            run = level[s : s + 16]
            for j in range(len(run)):
                for i in members[s + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(H(*run))
            grouped.append([i for m in members[s : s + 16] for i in m])
        level, members = up, grouped
    return level[0], paths


def brute(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = (own, *climb([leaf(r) for r in own]))
    root, tops = climb([trees[s][1] for s in sources])
    out = Counter()
    for s, top in zip(sources, tops):
        own, subroot, paths = trees[s]
        for r, path in zip(own, paths):
            start = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                start = leaf((r[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]), *r[2:]))
            whole = path + top
            for left, right in whole:
                start = H(left, start, right)
            out[(r[0], leaf(r), subroot, root, H(*(a + b for a, b in whole)), start, start == root)] += 1
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def got(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return Counter(map(tuple, queries.op13_merkle_manifest(spark, str(tmp_path)).select(*COLUMNS).collect()))


def test_awkward_rows(spark, tmp_path):
    assert got(spark, cases.documents(spark), tmp_path) == brute(cases.rows())


@pytest.mark.parametrize("digits", [1, 2])
def test_many_rounds(spark, tmp_path, monkeypatch, digits):
    """Sources of 1, 16, 17, 256, 257 and 700 rows, and 40 more sources, in blocks of 16 and 256 nodes."""
    monkeypatch.setattr(manifest, "DIGITS", digits)
    sizes = [1, 16, 17, 256, 257, 700, *([1] * 40)]
    rows = [(i * 1000 + j, f"Text {j}", "en", None if i == 3 else f"s{i}", j) for i, n in enumerate(sizes) for j in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert got(spark, docs, tmp_path) == brute(rows)


def test_copies_of_one_row_and_clashing_columns(spark, tmp_path):
    """One row repeated, over several blocks; columns named like those inside."""
    rows = [(7, "Same", "en", "s", 4)] * 5000 + [(8, "Other", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit("x") for c in ("tree", "node", "rank", "n", "block", "digest", "kids", "leaf", "root", "tampered", "_leaf", "_at", "_tie")})
    assert got(spark, docs, tmp_path) == brute(rows)


def test_roots_and_no_rows(spark):
    rows = cases.rows()
    want = defaultdict(list)
    for r in rows:
        want[r[3]].append(r)
    found = {r["source"]: (r["n_rows"], r["subroot"]) for r in manifest.roots(cases.documents(spark)).collect()}
    order = lambda own: [leaf(r) for r in sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]
    assert found == {s: (len(own), climb(order(own))[0]) for s, own in want.items()}
    assert manifest.proofs(cases.nothing(spark)).collect() == [] and manifest.roots(cases.nothing(spark)).collect() == []
