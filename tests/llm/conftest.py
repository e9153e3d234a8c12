from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside; as columns of the input they must do no harm.
CLASHES = ("size", "_key", "_hash", "key", "tid", "part", "blob", "found", "_text", "row", "of", "bucket", "class", "copies", "_row", "score", "lang_pred", "text_hash", "times")


def _sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(words))


def _documents() -> list[tuple]:
    rng = random.Random(3)
    base = [_sentence(rng, 60 + 7 * i) for i in range(12)]
    rows = [(i, t, ("en", "de")[i % 2], ("a", "b", None)[i % 3], len(t)) for i, t in enumerate(base)]
    near = base[3].split()
    near[10] = "changed"
    rows += [
        (20, base[3], "de", "a", 1),
        (21, " ".join(near), "en", "b", 1),
        (22, base[4].replace(" ", "\n", 9), "en", "b", 1),
        (23, None, "en", "a", None),
        (24, "", None, None, 0),
        (25, " \t\n", "en", "b", 3),
        (26, "one two", "en", "a", 7),
        (27, "one two", "en", "a", 7),
        (28, "ñandú 中文 <|endoftext|> Ünï\x01x ٣ ²", "en", "b", 9),
        (29, " ".join(["same", "line", "here"] * 40), "en", "a", 9),
        (30, _sentence(rng, 9000), "en", "b", 9),
        (31, 'a token = "abcdef123" and AKIA' + "Z" * 16 + " " + "0a" * 12 + " password:short", "en", "a", 9),
        (26, "one two", "en", "a", 7),
        (None, "no id here but words", "en", "a", 9),
    ]
    return rows


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    """Nulls, empty and long texts, copies, near copies, repeated rows, a repeated and a null id."""
    return _documents()


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    docs = spark.createDataFrame(odd_rows, SCHEMA).repartition(3)
    return docs.selectExpr("*", *[f"'{c}' AS {c}" for c in CLASHES])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
