from __future__ import annotations

import random

import pytest

from ordermill.llm.shipping import ship

# Columns that clash with names used inside the operators; they must be ignored or kept, never mixed up.
CLASHING = ["fp", "used", "key", "range", "ahead", "score", "chunk", "label_", "_found", "component", "start"]


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def sentence(words: list[str], chooser: random.Random, length: int) -> str:
    text = " ".join(chooser.choice(words) for _ in range(length))
    return text[:1].upper() + text[1:] + "."


VOCABULARY = {
    "aa": ["alpha", "beta", "gamma", "delta", "omega", "sigma"],
    "bb": ["über", "straße", "grün", "schön", "haus", "wald"],
    "cc": ["rue", "été", "château", "père", "où", "garçon"],
}


def corpus(seed: int = 1, count: int = 60) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) of clear texts in three invented languages, odd rows at the end."""
    chooser = random.Random(seed)
    rows = []
    for number in range(count):
        lang = sorted(VOCABULARY)[number % 3]
        text = " ".join(sentence(VOCABULARY[lang], chooser, chooser.randint(4, 12)) for _ in range(chooser.randint(1, 6)))
        rows.append((number, text, lang, f"s{number % 4}", len(text)))
    odd = [None, "", "   \n\t ", "12345 !!! 678", "x", "word " * 8_000, "nowhitespace" * 1000, rows[0][1], rows[0][1]]
    rows += [(count + i, text, None, None, None) for i, text in enumerate(odd)]
    rows += [(3, rows[3][1], "aa", "s", 1), (3, "another text under a known id", "aa", "s", 1), (None, "no id at all", "aa", "s", 1)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """The corpus with clashing extra columns."""
    from pyspark.sql import functions as F

    made = spark.createDataFrame(corpus(), SCHEMA).repartition(3)
    return made.select("*", *[F.lit(f"own {name}").alias(name) for name in CLASHING])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
