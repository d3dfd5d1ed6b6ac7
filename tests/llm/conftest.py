from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"


def prose(seed: int, n: int) -> str:
    """Words that hardly two seeds share."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns with names that operators use."""
    long = prose(1, 30_000)
    rows = [
        (1, None, "en", "a"),
        (1, None, "en", "a"),
        (2, "", None, "a"),
        (3, " \t\n\x0b ", "en", None),
        (4, "one", "en", "b"),
        (5, "one", "en", "b"),
        (5, "one", "en", "b"),
        (6, long, "de", "b"),
        (7, long, "de", None),
        (None, prose(2, 60), None, None),
        (None, prose(3, 60), "en", "c"),
        (8, "naïve Ünïcode \U0001f600 " + prose(4, 40), "fr", "c"),
        (9, prose(5, 25) + "\n" + prose(5, 25) + "\n\n", "fr", "c"),
    ]
    columns = "doc_id long, text string, lang string, source string"
    extra = {c: f"'{c}'" for c in ("_key", "_row", "key", "size", "n_words", "shard", "copies", "score", "node", "gone", "_salt", "toxic")}
    return spark.createDataFrame(rows, columns).selectExpr("*", *[f"{v} AS `{c}`" for c, v in extra.items()])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(4, 1, 1), (9, 1, 0), (8, 1, None), (None, 0, 1), (9, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark(spark):
    rows = [(1, prose(2, 20)), (2, None), (3, ""), (4, "One!"), (5, prose(2, 20)), (None, "x y z")]
    return spark.createDataFrame(rows, "item_id long, text string")
