"""Small tables for the tests of these operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use for columns of their own.
        *[T.StructField(x, T.StringType()) for x in ("id", "band", "words", "h1", "owner", "root", "kept", "score", "removed", "n")],
    ]
)


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text) or (doc_id, text, lang, source); further columns are filled or null."""
    full = []
    for k, row in enumerate(rows):
        doc, text, lang, source = (*row, "en", "s")[:4] if len(row) < 4 else row
        extra = [None if k % 2 else "x"] * 10
        full.append((doc, text, lang, source, None if text is None else len(text), *extra))
    return spark.createDataFrame(full, SCHEMA)


def awkward(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty and blank texts, a very long text, ties, repeated rows."""
    rng = random.Random(7)
    text = " ".join(words(rng, 80))
    return frame(
        spark,
        [
            (1, text),
            (2, text),
            (2, text),
            (3, None),
            (4, ""),
            (5, " \n\t \n"),
            (6, " ".join(words(rng, 20_000))),
            (None, text),
            (None, None, None, None),
            (7, "one two three", None, None),
            (8, "x" * 5_000),
            (9, "línea única ▁ 日本語 😀\nlínea única ▁ 日本語 😀"),
        ],
    )


def near_copies(n_groups: int = 6, copies: int = 5, seed: int = 3) -> list[tuple[int, str]]:
    """Texts in groups: copies with few or many changed words, and texts of their own."""
    rng = random.Random(seed)
    rows: list[tuple[int, str]] = []
    for _ in range(n_groups):
        base = words(rng, rng.randint(40, 160))
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4, 12])):
                own[rng.randrange(len(own))] = words(rng, 1)[0]
            rows.append((len(rows), " ".join(own)))
        rows.append((len(rows), " ".join(words(rng, 50))))
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(order[i], text) for i, text in rows]
