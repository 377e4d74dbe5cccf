"""The operators on small awkward tables, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm import codec, collisions, components, fingerprints, jaccard, licenses, mixing, mixture, packing, quality, shingles, token_counts, token_files, tokens, toxicity
from eventloom.session import scratch_path
from tests.llm import cases

LOWER = {c: c + 32 for c in range(65, 91)}
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return cases.documents(spark).cache()


@pytest.fixture(scope="module")
def rows():
    return cases.rows()


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


# tokens

@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_equal_the_library(path, rows):
    encoder, library = tokens.PieceEncoder(path, limit=50), Tokenizer.from_file(path)
    odd = ["áb", "ǅ", "don't I'LL 12½ ²3", "tab\tnew\r\n\x0b \x85\xa0x", "' 's 'S ''s", "€uro — dash", "ÀÉ ß ÿ ſ"]
    for text in [*(r[1] or "" for r in rows), *odd]:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text[:60]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_of_many_texts(path, rows, monkeypatch):
    odd = ["a\x1cb c", "\x85x\xa0y's'rez", "café İ", "x<|endoftext|> y", "\0 a", "a'LL don't  it's", "12 3\t4", "", "  ", "ſs Ab\x1f", "日本 go"]
    texts = [*(r[1] or "" for r in rows), *odd] * 2
    encoder, calls = tokens.PieceEncoder(path, limit=50), []
    want = [encoder.by_library(t) for t in texts]
    assert [x for i in range(0, len(texts), 7) for x in encoder.ids_of(texts[i : i + 7])] == want
    # One call to the coder for all new words of plain texts, none for known ones.
    encoder, plain = tokens.worker_encoder(path), [f"Some plain{i} words, {i} times" for i in range(50)]
    code = tokens.PieceEncoder.encode_pieces
    monkeypatch.setattr(tokens.PieceEncoder, "encode_pieces", lambda self, pieces: calls.append(len(pieces)) or code(self, pieces))
    assert tokens.worker_encoder(path) is encoder
    for _ in range(2):
        assert encoder.ids_of(plain) == [encoder.by_library(t) for t in plain]
        assert path == BYTES or len(calls) == 1


def test_word_pieces_are_cut_as_by_the_library():
    dice, encoder = random.Random(5), tokens.PieceEncoder(WORDS, limit=2000)
    alphabet = "aZéÿſŸ'’19½ \n\t\x1c\x85\xa0.,&-stmdrevlSLİ日\0"
    texts = ["".join(dice.choice(alphabet[: dice.choice((12, 34, 40))]) for _ in range(dice.randrange(30))) for _ in range(1500)]
    texts += ["x'", "'", "'r", "it's'll've", "'s" * 9, "12's.'t", "<|startoftext|>a", "a<|endoftext|>"]
    texts += [f"1{chr(c)}a{chr(c)}'S{chr(c)}.{chr(c)}" for c in range(0x182)]
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        assert encoder.ids_of(some) == [encoder.by_library(t) for t in some]
    assert encoder.ids_of([]) == []


def test_token_counts(docs, rows, spark):
    want = Counter()
    for r in rows:
        n = len(ids_of(BYTES, r[1]))
        want[(r[0], len((r[1] or "").encode()), n, n > 512)] += 1
    for common in (1, 100, 10**6):  # no pre-token, some, all but none in the broadcast table
        assert Counter(map(tuple, token_counts.count_tokens(docs, BYTES, common=common).collect())) == want
    assert token_counts.count_tokens(cases.nothing(spark), BYTES).collect() == []


# mixing

def brute_mix(rows, weights=(5, 2, 1), share=1.5):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    total = Counter()
    for r, n in zip(rows, size):
        total[r[3]] += n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(size)
    while True:
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > 2 * total[s]}
        if not over:
            return total, target | {s: level * weight[s] for s in free}, size
        for s in over:
            target[s] = 2.0 * total[s]
            left -= target[s]
        free -= over


def test_mixing(docs, rows, spark):
    total, target, size = brute_mix(rows)
    got = mixing.mix(docs).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((r[0], r[3], n) for r, n in zip(rows, size))
    taken = Counter()
    for r in got:
        assert r["source_size"] == total[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in total:
        assert abs(taken[s] - target[s]) <= 1
    finish = [r["finish"] for r in got if r["finish"] is not None]
    assert finish == sorted(finish)
    assert Counter(map(tuple, mixing.mix(docs.repartition(3)).collect())) == Counter(map(tuple, got))
    assert mixing.mix(cases.nothing(spark)).collect() == []


def test_mixed_documents(docs, rows, spark):
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    kept, taken = Counter(), Counter()
    longest = Counter()
    _, target, size = brute_mix(rows)
    for r in out.collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        taken[r["source"]] += n
        kept[(r["doc_id"], r["text"])] += 1
    for r, n in zip(rows, size):
        longest[r[3]] = max(longest[r[3]], n)
        assert kept[(r[0], r[1])] <= 2 * sum(x[:2] == r[:2] for x in rows)
    for s in target:
        assert abs(taken[s] - target[s]) <= longest[s] * 3 / 2 + 1
    assert mixing.mixed_documents(cases.nothing(spark)).collect() == []


# packing

@pytest.mark.parametrize("seed", range(6))
def test_pack_is_whole_and_tight(seed):
    dice = random.Random(seed)
    sizes = [dice.choice([0, 1, 7, 100, 2047, 2048, 2049, 9000, dice.randint(1, 3000)]) for _ in range(dice.randint(0, 300))]
    got, waste = defaultdict(list), 0
    for sequence in packing.pack(sizes):
        used = sum(p[2] for p in sequence)
        assert 0 < used <= 2048
        waste += 0 if used & (used - 1) == 0 else 2048 - used
        for item, start, n in sequence:
            got[item].append((start, n))
    for item, size in enumerate(sizes):
        at = 0
        for start, n in sorted(got[item]):
            assert start == at and n > 0
            at += n
        assert at == size
    assert waste <= 8 * (sum(sizes) // 2048 + 1)


def test_bin_tree_is_first_fit():
    dice, tree, rooms = random.Random(1), packing.BinTree(40, 10), [10] * 40
    for _ in range(40):
        n = dice.randint(1, 10)
        first = next(i for i, room in enumerate(rooms) if room >= n)
        rooms[first] -= n
        assert tree.place(n) == first


def check_packed(got, rows):
    want = Counter((r[0], tuple(ids_of(BYTES, r[1]) + [1])) for r in rows)
    pieces = defaultdict(list)
    for r in got:
        pieces[(r["doc_id"], r["doc_tokens"])].append((r["start"], r["length"], r["ids_crc32"]))
    for (name, ids), copies in want.items():
        raw = np.array(ids, "<u4").tobytes()
        mine = [p for p in pieces[(name, len(ids))] if zlib.crc32(raw[4 * p[0] : 4 * (p[0] + p[1])]) == p[2]]
        cover = np.zeros(len(ids), int)
        for start, n, _ in mine:
            cover[start : start + n] += 1
        assert (cover == copies).all()
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    assert sum(r["length"] for r in got) == sum(len(ids) * k for (_, ids), k in want.items())


def test_packing(docs, rows, spark):
    got = packing.pack_documents(docs, BYTES, group_docs=16).collect()
    check_packed(got, rows)
    assert Counter(map(tuple, packing.pack_documents(docs.repartition(2), BYTES, group_docs=16).collect())) == Counter(map(tuple, got))
    check_packed(packing.pack_documents(docs, BYTES, group_docs=16, group_tokens=3000).collect(), rows)
    assert packing.pack_documents(cases.nothing(spark), BYTES).collect() == []


# token files

def test_codec_round_trip():
    dice = np.random.default_rng(3)
    texts = [dice.integers(0, top, n) for top, n in ((2, 5000), (49408, 3000), (300, 1), (1 << 20, 2500), (16, 2048), (1, 9), (5, 0))]
    texts.append(np.tile(dice.integers(0, 40000, 50), 80))
    for ids in texts:
        for block in (64, 2048):
            assert (codec.decode(codec.encode(ids, block)) == ids).all()
    assert len(codec.encode(texts[-1])) < 4000 * 2 / 2


def test_codec_narrows_by_two_symbols_at_once(monkeypatch):
    carried, least = [], np.flatnonzero
    monkeypatch.setattr(codec.np, "flatnonzero", lambda x: carried.append(len(x)) or least(x))
    ids = np.random.default_rng(3).integers(0, 1 << 16, 64)
    chunk = codec.encode(ids, 64)
    assert len(carried) == 64 * 4  # who spells, and three intervals for a flag and four digits
    assert (codec.decode(chunk) == ids).all()
    for digits in range(1, 6):
        ids = np.random.default_rng(digits).geometric(16.0**-digits * 3, 3000) % 16**digits
        assert all((codec.decode(codec.encode(ids, block)) == ids).all() for block in (1, 64, 1000))


def test_codec_checks_blocks():
    raw = bytearray(codec.encode(np.arange(5000) % 700))
    raw[len(raw) // 2] ^= 64
    with pytest.raises(ValueError, match="checksum"):
        codec.decode(bytes(raw))


def test_mixture_round_trip():
    dice = np.random.default_rng(3)
    tops = ((2, 5000), (49408, 3000), (300, 1), (1 << 20, 2500), (16, 2048), (1, 9), (5, 0), (1 << 17, 200_000))
    texts = [dice.integers(0, top, n) for top, n in tops] + [np.tile(dice.integers(0, 40000, 50), 80)]
    for ids in texts:
        for block in (1, 64, 1024):
            assert (mixture.decode(mixture.encode(ids, block)) == ids).all()
    assert len(mixture.encode(texts[-1])) < 600
    ids = dice.zipf(1.3, 300_000) % 40_000
    chunk = mixture.encode(ids, 64)  # more blocks than advance together
    assert (mixture.decode(chunk) == ids).all()
    assert len(chunk) < len(codec.encode(ids, 64))
    assert (mixture.decode(codec.encode(ids, 64)) == ids).all()  # chunks of files that were written before


def test_mixture_adds_the_odds_of_all_orders(monkeypatch):
    calls, interval = [], mixture._Model.interval
    monkeypatch.setattr(mixture._Model, "interval", lambda self, *a: calls.append(0) or interval(self, *a))
    ids = np.tile([3, 1, 4, 1, 5, 9, 2, 6], 40)
    chunk = mixture.encode(ids, 64)
    assert len(calls) == 64  # all blocks at once, one interval an id
    assert (mixture.decode(chunk) == ids).all()
    model, every = mixture._Model(1, np.array([5, 9, 2]), 4), np.arange(1, 4, dtype=np.int32)
    for first, second in ((0, 0), (2, 0), (0, 3), (1, 2), (2, 1), (3, 3)):
        model.first[:], model.second[:] = first, second
        model.predict()
        start, size = interval(model, every, model.p1 == every, model.p2 == every)
        weights = model.w0[0], model.w1[0] >> 4, model.w2[0] >> 4
        want = [weights[0] * s + 16 * (weights[1] * (first == x) + weights[2] * (second == x)) for x, s in zip(every, (5, 9, 2))]
        assert size.tolist() == want and start.tolist() == [0, want[0], want[0] + want[1]]
        assert sum(weights) == 256 and sum(want) == 16 * (256 - weights[1] * (not first) - weights[2] * (not second))


def test_mixture_blocks_stand_alone():
    ids = np.arange(5000) * 7919 % 700
    chunk = mixture.encode(ids, 500)
    first = mixture.encode(np.concatenate((ids[:500], ids[500:][::-1])), 500)
    assert len(first) == len(chunk)
    table = 24 + int.from_bytes(chunk[20:24], "little")
    words = table + 80
    size = 4 * int.from_bytes(chunk[table : table + 4], "little")
    assert chunk[words : words + size] == first[words : words + size]  # what follows a block does not change it
    for at in (30, words + 3, len(chunk) - 50):
        raw = bytearray(chunk)
        raw[at] ^= 64
        with pytest.raises(ValueError, match="block|table"):
            mixture.decode(bytes(raw))


def test_token_files(docs, rows, spark):
    def written(frame, chunk):
        path = scratch_path(spark, "files")
        token_files.write_ids(frame, path, WORDS, chunk=chunk)
        return path

    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for r in order:
        ids = [*ids_of(WORDS, r[1]), 2]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    for chunk in (500, 4_000_000):
        path = written(docs, chunk)
        assert sorted(map(tuple, token_files.read_digests(spark, path).collect()), key=lambda r: r[1]) == want
    back = Counter((r["doc_id"], tuple(r["ids"])) for r in token_files.read_documents(spark, path).collect())
    assert back == Counter((r[0], (*ids_of(WORDS, r[1]), 2)) for r in rows)
    assert token_files.read_digests(spark, written(cases.nothing(spark), 500)).collect() == []


# licenses

def brute_license(text):
    low = (text or "").translate(LOWER)
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    places = sorted(
        (i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()
    )
    matches = []
    for block in licenses.blocks_of(text or ""):
        held = set(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", block.translate(LOWER)))
        for label, template in licenses.TEMPLATES:
            t = set(template.split())
            if len(held & t) >= -(-90 * len(t) // 100):
                matches.append((block, label, len(held & t) / len(t)))
    return len(words), places, sorted(matches)


def test_licenses(docs, rows, spark):
    extra = [(900 + i, "\n".join(t for _, t in licenses.TEMPLATES[: i + 1]) + "\n\nfoo bar", "en", "s", 0, 0, 0.0) for i in range(len(licenses.TEMPLATES))]
    extra += [(950, "Licensed under CC\nBY-NC 4.0.", "en", "s", 0, 0, 0.0), (951, "all rights are reserved", "en", "s", 0, 0, 0.0)]
    got = licenses.scan(docs.unionByName(spark.createDataFrame(extra, docs.schema))).collect()
    flat = Counter((r["doc_id"], r["n_words"], tuple(map(tuple, r["places"])), tuple(sorted(map(tuple, r["matches"])))) for r in got)
    want = Counter()
    for r in rows + extra:
        n, places, matches = brute_license(r[1])
        want[(r[0], n, tuple(places), tuple(matches))] += 1
    assert flat == want
    assert licenses.scan(cases.nothing(spark)).collect() == []


# shingles, components, jaccard

def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def test_shingles(rows):
    texts = [r[1] or "" for r in rows]
    sets = shingles.shingle_sets(texts)
    seen = {}
    for text, s in zip(texts, sets):
        want = brute_set(text)
        assert len(s) == len(want) and (np.diff(s.astype(object)) > 0).all()
        assert set(seen.setdefault(frozenset(want), tuple(s.tolist()))) == set(s.tolist())
        assert (shingles.shingle_sets([text])[0] == s).all()
    words, counts = shingles.word_hashes(["w" * 200, "w" * 201, "w" * 200 + "x"])
    assert counts.tolist() == [1, 1, 1] and len(set(words.tolist())) == 3


def brute_components(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    dice = random.Random(seed)
    edges = [(dice.randint(0, 80), dice.randint(0, 80)) for _ in range(45)] + [(i, i + 1) for i in range(200, 260)] + [(500, i) for i in range(501, 600)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in brute_components([e for e in edges if e[0] != e[1]]).items()}


def brute_jaccard(rows):
    sets = [brute_set(r[1]) for r in rows]
    edges = [(i, i) for i in range(len(rows))]
    for i, a in enumerate(sets):
        edges += [(i, j) for j in range(i) if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j])]
    root = brute_components(edges)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root[i]] = min(least.get(root[i], r[0]), r[0])
    return Counter((r[0], len(sets[i]), least.get(root[i])) for i, r in enumerate(rows))


def test_jaccard(docs, rows, spark):
    assert Counter(map(tuple, jaccard.jaccard_components(docs).collect())) == brute_jaccard(rows)
    assert jaccard.jaccard_components(cases.nothing(spark)).collect() == []


def test_jaccard_families_and_shared_passages(spark, monkeypatch):
    # Small groups and chunks, borderline pairs, a passage in every text, families of near copies that touch.
    for name, value in (("GROUP_SIZE", 3), ("GROUP_FROM", 4), ("ASK_SIZE", 2), ("BUCKET_TOKENS", 200), ("SAMPLE", 2)):
        monkeypatch.setattr(jaccard, name, value)
    dice = random.Random(9)
    passage = cases.sentence(dice, 30)
    rows = []
    for family in range(6):
        words = cases.sentence(dice, 60).split()
        for _ in range(12):
            copy = list(words)
            for _ in range(dice.randint(0, 3)):
                copy[dice.randrange(len(copy))] = "w%d" % dice.randint(0, 999)
            text = " ".join(copy)
            rows.append((len(rows) * 3 % 101 + 1000 * family, f"{text} {passage}" if dice.random() < 0.6 else text, None, None, None, None, None))
    rows += [(9000 + i, passage + " " + cases.sentence(dice, i % 9), None, None, None, None, None) for i in range(30)]
    got = Counter(map(tuple, jaccard.jaccard_components(spark.createDataFrame(rows, cases.DOCS)).collect()))
    assert got == brute_jaccard(rows)


@pytest.mark.parametrize("percent", [50, 75, 90, 100])
def test_least_shared_of_every_size_range(spark, percent):
    def up(a, b):
        return -(-a // b)

    def least(n, m):
        return up(percent * (n + m), 100 + percent) - max(up(percent * n, 100), up(percent * m, 100)) + 1

    asked, want = [], []
    for n in range(1, 80):
        for lo in range(up(percent * n, 100), 100 * n // percent + 1):
            for hi in range(lo, 100 * n // percent + 1):
                asked.append((n, lo, hi))
                want.append(min(least(n, m) for m in range(lo, hi + 1)))
    df = spark.createDataFrame(pd.DataFrame(asked, columns=["n", "lo", "hi"])).coalesce(1)
    assert df.select(jaccard._least_in_group(percent).alias("x")).toPandas()["x"].tolist() == want


def planted_passages(families):
    """Passages of 12 shingles: one set of 13 and six of 15 that link at 12/16 exactly, among sets of 14 and 16 that do not."""
    dice, texts = random.Random(3), []

    def words(k):
        return " ".join("x%d" % dice.randrange(10**9) for _ in range(k))

    for _ in range(families):
        passage = words(16)
        texts += [f"{passage} {words(1)}"] + [f"{passage} {words(3)}" for _ in range(6)]
        texts += [f"{passage.rsplit(' ', 1)[0]} {words(3)}" for _ in range(12)] + [f"{passage} {words(4)}" for _ in range(12)]
    return [(i, x, None, None, None, None, None) for i, x in enumerate(texts)]


def test_jaccard_borderline_link_in_mixed_group(spark, monkeypatch):
    for name, value in (("GROUP_SIZE", 8), ("GROUP_FROM", 4), ("SAMPLE", 1)):
        monkeypatch.setattr(jaccard, name, value)
    rows = planted_passages(30)
    got = Counter(map(tuple, jaccard.jaccard_components(spark.createDataFrame(rows, cases.DOCS)).collect()))
    assert got == brute_jaccard(rows)


def test_one_per_component(docs, rows):
    kept = jaccard.one_per_component(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = {c for _, _, c in brute_jaccard(rows) if c is not None}
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 2


def test_one_per_component_tells_texts_of_one_id_apart(spark):
    dice = random.Random(11)
    first, own, other = (cases.sentence(dice, 40) for _ in range(3))
    # Id 2 holds a copy of id 1 and a text of its own, id 3 two texts that link, id 4 equal rows, id 5 two blank texts.
    near = other.split()
    near[0] = "changed"
    texts = [(1, first), (2, first), (2, own), (3, other), (3, " ".join(near)), (4, "two words"), (4, "two words"), (5, ""), (5, " ")]
    docs = spark.createDataFrame([(i, x, None, None, None, None, None) for i, x in texts], cases.DOCS).repartition(3)
    kept = sorted((r["doc_id"], r["text"]) for r in jaccard.one_per_component(docs).collect())
    linked = [x for i, x in kept if i == 3]
    assert len(linked) == 1 and linked[0] in (other, " ".join(near))
    assert [r for r in kept if r[0] != 3] == sorted([(1, first), (2, own), (4, "two words"), (5, ""), (5, " ")])


# fingerprints

def test_fingerprints(docs, rows, spark):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    texts = [r[1] or "" for r in order]
    sets = fingerprints.digests(texts)
    want = Counter()
    for i, r in enumerate(order):
        after = texts[(i + 1) % len(texts)]
        n = len(texts[i]) // 4
        changed = texts[i][: len(texts[i]) - n] + after[:n]
        a, b, c = set(sets[i].tolist()), set(fingerprints.digests([changed])[0].tolist()), set(sets[(i + 1) % len(texts)].tolist())
        like = [1.0 if not x and not y else 1 - len(x ^ y) / (len(x) + len(y)) for x, y in ((a, b), (a, c))]
        want[(r[0], len(texts[i]), hashlib.sha256(changed.encode()).hexdigest(), *(round(v, 9) for v in like), len(a), len(a ^ b))] += 1
    for part_docs in (4_000, 7):
        got = fingerprints.compare_with_next(docs, part_docs).collect()
        flat = Counter((r[0], r[1], r[2], round(r["near_edited"], 9), round(r["near_next"], 9), r["n_paragraphs"], r["n_changed"]) for r in got)
        assert flat == want
    by_text = defaultdict(set)
    for r in got:
        by_text[next(t for i, t in zip(order, texts) if i[0] == r["doc_id"] and len(t) == r["n_chars"])].add(r["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())
    assert fingerprints.compare_with_next(cases.nothing(spark)).collect() == []


def test_likeness_comes_from_the_fingerprints(docs, rows):
    """``near_edited`` again from the row's two strings, or, where those were too small, from larger ones of both texts."""

    def none(i, cells):
        raise AssertionError("asked for more than the strings")

    by_id = defaultdict(list)
    for r in rows:
        by_id[(r[0], len(r[1] or ""))].append(r[1] or "")
    small = large = 0
    for r in fingerprints.compare_with_next(docs).collect():
        a, b = r["fingerprint"], r["edited_fingerprint"]
        if r["cells_edited"] == fingerprints.CELLS:
            (found,), _ = fingerprints.differences([(a, b)], none)
            small += 1
        else:
            with pytest.raises(AssertionError, match="asked for more"):
                fingerprints.differences([(a, b)], none)
            own = {fingerprints.sketches(fingerprints.digests([t]))[0]: t for t in by_id[(r["doc_id"], r["n_chars"])]}[a]
            ends = [t for _, t, *_ in rows if hashlib.sha256(fingerprints.edited(own, t or "").encode()).hexdigest() == r["edited_sha256"]]
            both = fingerprints.digests([own, fingerprints.edited(own, ends[0] or "")])
            enlarged = tuple(fingerprints.sketches(both, r["cells_edited"]))
            (found,), _ = fingerprints.differences([enlarged], none)
            large += 1
        assert fingerprints.likeness(a, b, found) == r["near_edited"]
    assert small and large


def test_peeling_finds_every_difference():
    dice = np.random.default_rng(2)
    sets = [np.unique(dice.integers(0, 2**63, n).astype(np.uint64)) for n in (0, 1, 5, 300, 4000)]
    pairs = [(a, np.union1d(a[::2], b[:k])) for a in sets for b in sets for k in (0, 3, 500)]
    for cells in (6, 24, 4998):
        prints = [tuple(fingerprints.sketches(list(p), cells)) for p in pairs]
        found, took = fingerprints.differences(prints, lambda i, _: pairs[i])
        for (a, b), (x, y), n in zip(pairs, found, took):
            assert set(x.tolist()) == set(a.tolist()) - set(b.tolist()) and set(y.tolist()) == set(b.tolist()) - set(a.tolist())
            assert n == cells or n >= 2 * cells
    assert fingerprints.differences([], None) == ([], [])


def test_fingerprints_where_one_id_has_most_rows(spark):
    """Rows of one id (or of none) follow each other by their text, whatever the number of parts."""
    texts = [f"line {i} of a text\nand a second one {i % 3}" for i in range(60)]
    data = [(7 if i % 10 else i, t) for i, t in enumerate(texts)] + [(None, t) for t in texts[:20]]
    df = spark.createDataFrame(data, "doc_id long, text string")
    order = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = Counter(hashlib.sha256(fingerprints.edited(t, order[(i + 1) % len(order)][1]).encode()).hexdigest() for i, (_, t) in enumerate(order))
    for kw in ({"part_docs": 4}, {"part_docs": 4, "max_parts": 3}, {}):
        assert Counter(r["edited_sha256"] for r in fingerprints.compare_with_next(df, **kw).collect()) == want


# classifiers

def labelled(spark, seed=4):
    dice = random.Random(seed)
    rows, labels = [], []
    for i in range(700):
        text = " ".join(cases.sentence(dice, dice.randint(4, 12)) for _ in range(dice.randint(1, 20)))
        toxic, good = dice.random() < 0.3, dice.random() < 0.7
        if not good:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if toxic:
            parts = text.split(". ")
            parts[dice.randrange(len(parts))] += " you " + dice.choice(["blockhead", "Nitwittery", "nitwitted", "oaf"])
            text = ". ".join(parts)
        rows.append((i, text, "en", "s", None, None, None))
        labels.append((i, int(good), int(toxic)))
    return spark.createDataFrame(rows, cases.DOCS), spark.createDataFrame(labels + [(None, 1, 1), (3, None, None), (5000, 1, 0)], "doc_id long, quality int, toxic int"), rows, labels


def accuracy(scored, labels, column, limit):
    want = {r[0]: r[column] for r in labels}
    held = [r for r in scored if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    return sum((r["score"] >= limit) == bool(want[r["doc_id"]]) for r in held) / len(held)


def test_toxicity(spark, docs):
    table, labels, rows, known = labelled(spark)
    model = toxicity.train(table, labels)
    scored = toxicity.score_documents(table, model).collect()
    assert accuracy(scored, known, 2, 0.3) > 0.95
    text = {r[0]: r[1] for r in rows}
    spans = [(text[r["doc_id"]][s["start"] : s["start"] + s["length"]], s["score"]) for r in scored for s in r["offending"]]
    assert spans and sum(bool(re.search("blockhead|nitwit|oaf", t.lower())) for t, _ in spans) / len(spans) > 0.95
    for r in scored:
        assert r["score"] == pytest.approx(1 - np.prod([1 - s["score"] for s in r["offending"]] or [1]), abs=0.3)
    odd = toxicity.score_documents(docs, model)
    assert odd.count() == len(cases.rows()) and odd.filter("score is null or score < 0 or score > 1").count() == 0
    kept = toxicity.clean_documents(table, labels)
    assert kept.columns == table.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in scored if r["score"] < 0.3}
    assert toxicity.clean_documents(cases.nothing(spark), labels).collect() == []


def test_noisy_or_gradient():
    # Two positive bags share a feature, each also has one of its own; a negative bag has those.
    words, sentences = np.array([0, 1, 0, 2, 1, 2]), np.array([0, 1, 2, 3, 4, 4])
    w, bias = toxicity.fit_bags(words, sentences, np.array([0, 0, 1, 1, 2]), np.array([1, 1, 0]), 3)
    assert w[0] + bias > 1 and max(w[1], w[2]) + bias < 0


def test_quality(spark, docs):
    table, labels, _, known = labelled(spark)
    scored = quality.score_documents(table, labels).collect()
    assert accuracy(scored, known, 1, quality.AT_THRESHOLD) > 0.95
    kept = quality.good_documents(table, labels)
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in scored if r["score"] >= quality.AT_THRESHOLD}
    odd = quality.score_documents(docs, labels)
    assert odd.count() == len(cases.rows()) and odd.filter("score is null or score < 0 or score > 1").count() == 0
    assert quality.score_documents(cases.nothing(spark), labels).collect() == []
    assert quality.good_documents(docs, labels.filter("quality = 1")).count() == len(cases.rows())


def test_pairwise_fit_ranks():
    dice = np.random.default_rng(0)
    x = dice.normal(size=(400, 4))
    strength = x @ np.array([2.0, -1.0, 0.0, 0.5])
    a, b = dice.integers(0, 400, (2, 3000))
    first = strength[a] > strength[b]
    w = quality.fit_pairs(np.where(first[:, None], x[a], x[b]), np.where(first[:, None], x[b], x[a]))
    assert np.corrcoef(x @ w, strength)[0, 1] > 0.99


# nearest neighbours

def test_nearest(spark):
    dice = np.random.default_rng(1)
    centres = dice.normal(size=(20, 16))
    x = (centres[dice.integers(0, 20, 3000)] + 0.4 * dice.normal(size=(3000, 16))).astype(np.float32)
    x[1000:2000] = x[100]
    rows = [(i, [float(v) for v in x[i]], 1) for i in range(3000)]
    rows += [(3000, None, 1), (3050, [0.0] * 16, 1), (3100, [float("nan")] * 16, 1), (3150, [None] * 16, 1), (3200, [1.0, 2.0], 1), (3201, [2.0, 1.0], 1), (None, [1.0] * 16, 1), rows[7], rows[100], (3250, [], 1), (3300, [float("inf")] * 16, 1)]
    got = defaultdict(list)
    for r in collisions.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    y = x.astype(float)
    size = np.linalg.norm(y, axis=1)
    hits = 0
    for q in range(0, 3000, 50):
        score = (y @ y[q]) / (size * size[q])
        score[q] = -2
        found = sorted(got[q])
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(abs(s - score[v]) < 1e-12 for _, v, s in found)
        assert found == sorted(found, key=lambda t: (-t[2], t[1]))
        limit = np.sort(score)[-5]
        hits += sum(s >= limit - 1e-12 for _, _, s in found)
    assert hits >= 0.9 * 300
    assert [v for _, v, _ in sorted(got[1500])] == [100, 1000, 1001, 1002, 1003]
    assert [(v, round(s, 6)) for _, v, s in got[3200]] == [(3201, 0.8)] and not set(got) & {3000, 3050, 3100, 3150, 3250, 3300}
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert collisions.nearest(empty).collect() == []
