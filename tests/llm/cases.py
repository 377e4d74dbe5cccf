"""Small tables with the awkward rows: nulls, empty, blank and very long texts, copies, repeated rows, extra columns."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, score double"


def sentence(dice: random.Random, words: int) -> str:
    return " ".join("".join(dice.choice("aeioulmnrst") for _ in range(dice.randint(2, 8))) for _ in range(words)).capitalize() + "."


def rows(seed: int = 5, plain: int = 40) -> list[tuple]:
    dice = random.Random(seed)
    texts = [" ".join(sentence(dice, dice.randint(3, 14)) for _ in range(dice.randint(1, 12))) for _ in range(plain)]
    texts[3] = "\n".join(texts[3].split(". "))
    near = texts[7].split()
    near[len(near) // 2] = "changed"
    texts += [
        None, "", " \n\t ", "one", "two words", "five words stand right here", texts[5], texts[5], texts[5].upper(), " ".join(near),
        texts[9] + " " + sentence(dice, 3), "x" * 9_000, " ".join(sentence(dice, 12) for _ in range(900)), "naïve Straße Ünïcode 东京 İstanbul ſ ½ \x85 \x00 end",
        "<|endoftext|> it's we'll  two   spaces\n\n<|startoftext|>", "no-break space   wide", "same same same same same same same",
        "Released under the MIT License.\nAll rights reserved.", "See the MIT license, the Apache license and GNU General Public License; MIT  LICENSE!",
    ]
    out = [(i, t, "en", f"s{i % 4}" if i % 7 else None, None, None, None) for i, t in enumerate(texts)]
    out += [out[2], out[2], (None, texts[4], None, None, 1, 2, 3.0), (None, None, None, "s1", None, None, None)]
    return out


def documents(spark, seed: int = 5, plain: int = 40):
    return spark.createDataFrame(rows(seed, plain), DOCS).repartition(5)


def nothing(spark):
    return spark.createDataFrame([], DOCS)
