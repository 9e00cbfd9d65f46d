"""Rows that every operator has to handle: nulls, empty and long texts, ties, repeated rows, columns with clashing names."""

import random

#: Names that the operators use inside themselves.
CLASHING = ["n_tokens", "words", "at", "key", "of", "node", "start", "rank", "range", "label", "row", "size", "shingles", "spans", "held_out", "component", "bucket"]


def texts() -> list[str | None]:
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(1, 8)))
    plain = [" ".join(word() for _ in range(rng.randint(15, 60))) for _ in range(30)]
    long = " ".join(word() for _ in range(30_000))
    near = plain[0].split()
    return [*plain, *plain[:4], " ".join([*near[:-1], "changed"]), None, "", "  \n\t", "12 !?", "x", "É Straße ÄÖ 中文字 😀 don't", "Released under the MIT License.", "y" * 5000, long, long]


def rows(spark, **more):
    """documents with clashing columns; the last rows repeat an id, or have none."""
    t = texts()
    lang = ["en", "de", None]
    data = [(i, x, lang[i % 3], [None, "a", "b", "c"][i % 4]) for i, x in enumerate(t)] + [(0, t[0], "en", None), (0, t[0], "en", None), (7, t[3], "de", "a"), (None, t[5], "en", "a"), (None, None, None, None)]
    df = spark.createDataFrame([(*r, *[1] * len(CLASHING)) for r in data], "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} int" for c in CLASHING))
    return df
