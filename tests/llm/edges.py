"""Rows that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

RNG = random.Random(3)
WORDS = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 8))) for _ in range(3000)]


def prose(n, seed=0):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


LONG = prose(60_000, 9)
TEXTS = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, prose(80, 1)),
    (5, prose(80, 1)),
    (5, prose(80, 1)),
    (None, prose(80, 2)),
    (None, None),
    (6, LONG),
    (7, "é" * 50_000),
    (8, "x"),
    (9, prose(30, 4) + " token = \"3f786850e387550fdab836ed7e6dc881de23001b\" " + prose(30, 5)),
    (10, "a b c " * 200),
    (11, "日本語 \U0001f642   ▁ \x00 <|endoftext|> " + prose(60, 6)),
    (12, prose(80, 1) + " one more"),
]
CLASHING = "n_words long, KEPT string, findings string, ids string, rate double, fp string, _row long, rank long, h string, key string, _digest string, _id long, _copy int, copy int, n_tokens long, p_clean double, in0 string, component string"


def documents(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, "en", "src0", len(t) if t is not None else None, 1, "k", "f", "i", 0.5, "p", 42, 3, "h", "k", "d", 43, 44, 45, 46, 0.25, "in", "c") for i, t in rows], f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
