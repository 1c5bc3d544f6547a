
import pytest


LONG = "lorem ipsum dolor sit amet " * 20_000
ROWS = [
    (1, "Licensed under the MIT License. All rights reserved, copyright 2020 by me.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, " \t\n ", "fr", None),
    (5, LONG, "en", "a"),
    (6, "same words here " * 10, "en", None),
    (6, "same words here " * 10, "en", None),
    (7, "same words here " * 10, "de", "b"),
    (None, "a row without an id, but with some words of its own", "en", "a"),
    (None, None, None, None),
    (8, "x" * 50_000, "en", "b"),
    (9, "CC-BY cc by  Cc/By\u00a0cc by \u00e9\u00c9 \U0001f600 #1 | <b>", "en", "a"),
]
# columns whose names the operators use themselves
CLASH = ["score", "copy", "measures", "kept", "licenses", "n_words", "fingerprint", "c0", "_lower", "base_failed", "n", "hash",
         "__class", "__lang", "__copies", "__position", "__n", "__band", "__nth", "_best", "_mix_n", "_band", "_key", "id", "a.b", "text.x"]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and very long texts, repeated rows, null ids, and clashing columns."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASH]).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


def own_columns_are_kept(rows):
    return all(r[c] == f"own {c}" for r in rows for c in CLASH)
