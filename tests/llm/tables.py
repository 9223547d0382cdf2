"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, lang: str = "en") -> str:
    stems = {"en": ["th", "er", "on", "ing", "at", "and"], "fr": ["é", "eau", "oi", "que", "ment", "le"]}[lang]
    rng = random.Random(seed)
    words = ["".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def documents() -> list[tuple]:
    base = prose(1, 80)
    near = base.replace(base.split()[40], "changed", 1)
    rows = [
        (1, base, "en", "a", 0),
        (2, near, "en", "a", 0),
        (3, prose(3, 60, "fr"), "fr", "b", 0),
        (4, None, "fr", None, None),
        (5, "", None, "b", 0),
        (6, " \t\n\x0b ", "en", "b", 5),
        (7, "12 34 !?", None, "b", 8),
        (8, "One", "en", "b", 3),
        (9, "one", "en", "b", 3),
        (10, base, "en", "a", 0),
        (10, base, "en", "a", 0),
        (None, base, "en", "a", 0),
        (None, None, None, None, None),
        (11, prose(5, 4000), "en", "a", 0),
        (12, "x" * 3000 + " " + "ß" * 200, "de", "a", 0),
        (13, "a b c d e f g h. " * 12, "en", "a", 0),
        (14, "日本語のテキスト、空白なし。" * 20, None, "c", 0),
        (15, "nul\x00byte   nbsp " + prose(6, 30), "en", "c", 0),
        (1, prose(7, 50), "en", "dup id", 0),
    ]
    rows += [(100 + i, prose(100 + i, 40 + i, "en" if i % 3 else "fr"), "en" if i % 3 else "fr", "s", 0) for i in range(30)]
    return rows


def docs_df(spark, rows=None):
    """The documents with extra columns named like ones that operators add."""
    df = spark.createDataFrame(documents() if rows is None else rows, DOCS)
    return df.selectExpr(
        "*", "'x' as row", "1 as id", "2 as node", "3 as n_words", "4 as score", "5 as kept", "6 as hits",
        "7 as n_tokens", "8 as posterior", "9 as rate", "10 as copies", "11 as held_out", "12 as _row", "13 as lang_pred",
    )


def benchmark_df(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as items")
