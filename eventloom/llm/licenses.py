"""License scans: phrases, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventloom.llm.common import in_pieces, texts

# Phrases whose words mark a license, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Label and wording of license notices.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
            " documentation files the software to deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
            " public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"
            " the following conditions are met"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "all rights reserved"),
)
_LOWER = {c: c + 32 for c in range(65, 91)}
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text: str) -> list[str]:
    """Words with A-Z in lower case: runs of digits, letters and all characters beyond ASCII."""
    return _WORD.findall(text.translate(_LOWER))


def blocks_of(text: str) -> list[str]:
    """The blocks of a text: its lines, and each paragraph of several lines as a whole."""
    out = []
    for paragraph in re.split(r"\n[ \t\r]*\n", text):
        lines = [x for x in paragraph.split("\n") if x]
        out += lines
        if len(lines) > 1:
            out.append(paragraph)
    return out


@dataclass(frozen=True)
class TemplateIndex:
    """Templates as token lists, rarest first, with an inverted index over their prefixes.

    ``counts`` are the numbers of blocks of the corpus that hold each template token. A block contains a template if at
    least ``need`` of its tokens stand in the block; then one of the template's first ``size - need + 1`` tokens does.
    """

    rank: dict[str, int]
    templates: list[tuple[str, list[str], int]]
    index: dict[str, list[tuple[int, int]]]

    @staticmethod
    def build(templates: tuple[tuple[str, str], ...], counts: dict[str, int], percent: int) -> TemplateIndex:
        tokens = {w for _, text in templates for w in text.split()}
        rank = {w: i for i, w in enumerate(sorted(tokens, key=lambda w: (counts.get(w, 0), w)))}
        rows, index = [], {}
        for t, (label, text) in enumerate(templates):
            listed = sorted(set(text.split()), key=rank.__getitem__)
            need = -(-percent * len(listed) // 100)
            rows.append((label, listed, need))
            for i, w in enumerate(listed[: len(listed) - need + 1]):
                index.setdefault(w, []).append((t, i))
        return TemplateIndex(rank, rows, index)

    def matches(self, block: set[str]) -> list[tuple[str, float]]:
        """Label and containment of every template that the block contains well enough."""
        held = sorted(block & self.rank.keys(), key=self.rank.__getitem__)
        tried, out = set(), []
        for j, w in enumerate(held):
            for t, i in self.index.get(w, ()):
                label, listed, need = self.templates[t]
                # Length filter on the block; positional filter on what both sides can still share from here on.
                if t in tried or len(held) < need or min(len(listed) - i, len(held) - j) < need:
                    continue
                tried.add(t)
                shared = sum(x in block for x in listed)
                if shared >= need:
                    out.append((label, shared / len(listed)))
        return out


def token_counts(docs: DataFrame, templates: tuple[tuple[str, str], ...]) -> dict[str, int]:
    """In how many blocks of all documents each template token stands: one row per template token."""
    wanted = frozenset(w for _, text in templates for w in text.split())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in in_pieces(batches):
            for text in texts(batch):
                for block in blocks_of(text.translate(_LOWER)):
                    counts.update(wanted.intersection(_WORD.findall(block)))
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["token", "n"])

    rows = docs.select("text").mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {r["token"]: r["n"] for r in rows}


def _places(words: list[str], phrases: dict[tuple[str, ...], str]) -> list[tuple[int, str]]:
    """Start and label of every place where a phrase's words stand in a row."""
    out = []
    for phrase, label in phrases.items():
        last, at = len(phrase) - 1, -1
        while True:
            try:
                at = words.index(phrase[-1], at + 1)
            except ValueError:
                break
            if at >= last and tuple(words[at - last : at + 1]) == phrase:
                out.append((at - last, label))
    return out


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: dict[str, str] = PHRASES, percent: int = 90) -> DataFrame:
    """Licenses of every whole text: ``doc_id, n_words, places, matches``.

    ``places`` are the phrase places ``(start, label)`` in words from 0, ascending; ``matches`` the blocks (lines and
    paragraphs) that contain at least ``percent`` percent of a template's distinct words, as ``(block, label,
    containment)`` with the block's text. Block counts of template words over the whole corpus give the global order,
    rarest first.

    Null and empty texts have no words. Repeated rows give a row each; a null id stays null. No rows give no rows.
    Other columns are ignored.
    """
    index = TemplateIndex.build(templates, token_counts(docs, templates), percent)
    listed = {tuple(p.split()): label for p, label in phrases.items()}
    ends = tuple(p[-1] for p in listed)
    place_type = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
    match_type = pa.list_(pa.struct([("block", pa.string()), ("label", pa.string()), ("containment", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = index.index.keys()
        for batch in in_pieces(batches, 1_000_000):
            counts, places, matches = [], [], []
            for text in texts(batch):
                low = text.translate(_LOWER)
                words = _WORD.findall(low)
                counts.append(len(words))
                at = sorted(_places(words, listed)) if any(e in low for e in ends) else []
                places.append([{"start": a, "label": b} for a, b in at])
                found = []
                if not rare.isdisjoint(words):
                    for raw in blocks_of(text):
                        block = set(_WORD.findall(raw.translate(_LOWER)))
                        if not rare.isdisjoint(block):
                            found += [{"block": raw, "label": x, "containment": c} for x, c in index.matches(block)]
                matches.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(places, place_type), pa.array(matches, match_type)],
                ["doc_id", "n_words", "places", "matches"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, places array<struct<start:long,label:string>>,"
        " matches array<struct<block:string,label:string,containment:double>>"
    )
