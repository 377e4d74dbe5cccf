"""Latent semantic vectors against a full decomposition, and against lexical vectors on near-synonyms."""

import random

import numpy as np
import pytest

from eventloom.operators import embed, semantic

TOPICS = {
    "road": (("car", "automobile"), "engine wheel brake garage driver fuel road lane gear clutch".split()),
    "sea": (("ship", "vessel"), "harbour anchor deck sailor wave tide mast keel port crew".split()),
    "food": (("soup", "broth"), "onion carrot salt pepper spoon bowl kitchen simmer taste herb".split()),
    "sky": (("plane", "aircraft"), "wing pilot runway cloud airport altitude cabin turbine flight landing".split()),
}


def _texts(n=400, seed=3):
    """Texts of one topic each, naming it by one of its two synonyms; no text has both."""
    dice = random.Random(seed)
    out = []
    for _ in range(n):
        topic = dice.choice(sorted(TOPICS))
        names, context = TOPICS[topic]
        words = [dice.choice(names), *dice.choices(context, k=6), *dice.choices("the of and a in".split(), k=4)]
        dice.shuffle(words)
        out.append((topic, " ".join(words)))
    return out


def _frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(5)


def _vectors(df):
    return np.array([r["embedding"] for r in df.orderBy("id").collect()], dtype=float)


def test_synonyms_meet_that_lexical_vectors_keep_apart(spark):
    df = _frame(spark, [t for _, t in _texts()])
    words = [w for names, _ in TOPICS.values() for w in names]
    asked = _frame(spark, words)
    # As many directions as topics: further ones tell texts of one topic apart, by synonyms among others.
    model, plain = semantic.fit_semantic(df, "text", dim=len(TOPICS), slots=4096), embed.fit_lexical(df, "text", 4096)
    means = _vectors(semantic.apply_semantic(asked, "text", model)), _vectors(embed.apply_lexical(asked, "text", plain))
    near = {}
    for name, v in zip(("semantic", "lexical"), means):
        score = v @ v.T - 2 * np.eye(len(v))
        near[name] = sum(score[i].argmax() == (i ^ 1) and score[i].max() > 0.5 for i in range(len(words)))
    assert near == {"semantic": len(words), "lexical": 0}


def test_directions_equal_the_full_decomposition(spark):
    texts = [t for _, t in _texts(300)] + ["", None]
    df = _frame(spark, texts)
    model = semantic.fit_semantic(df, "text", dim=8, slots=256, extra=20, rounds=6)
    slots = embed._Slots(256)
    # Rarity as it is defined, from the texts.
    having = (slots.counts(texts) > 0).sum(axis=0)
    idf = np.log((len(texts) + 1) / (having + 1))
    assert np.allclose(model.idf, idf)
    counts = slots.counts(texts)
    rows = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    _, strength, right = np.linalg.svd(rows, full_matrices=False)
    assert np.allclose(model.strength, strength[:8], rtol=1e-3)
    assert np.allclose(np.abs(np.sum(model.basis[:, :3] * right[:3].T, axis=0)), 1, atol=1e-3)
    want = rows @ model.basis
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-12)
    assert np.allclose(_vectors(semantic.apply_semantic(df, "text", model)), want, atol=1e-5)


@pytest.mark.parametrize("texts", [[], ["", None], ["one"], ["same words"] * 5])
def test_few_texts(spark, tmp_path, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id long, text string, slot string")
    model = semantic.fit_semantic(df, "text", dim=4, slots=64, tasks=2)
    model.save(spark, str(tmp_path / "m"))
    again = semantic.SemanticModel.load(spark, str(tmp_path / "m"))
    assert np.allclose(again.basis, model.basis) and np.allclose(again.idf, model.idf) and np.allclose(again.strength, model.strength)
    rows = semantic.apply_semantic(df, "text", again).collect()
    assert len(rows) == len(texts) and all(len(r["embedding"]) == 4 and r["slot"] == "x" and np.isfinite(r["embedding"]).all() for r in rows)
