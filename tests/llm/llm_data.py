"""Small tables with the cases that every operator has to stand."""

import random

WORDS = "alpha beta gamma delta omega kappa sigma theta lambda rho tau chi".split()


def prose(rng: random.Random, n: int, words=WORDS) -> str:
    return " ".join(rng.choice(words) for _ in range(n))


def odd_texts() -> list:
    """Null, empty, blank, one letter, several scripts, ties, and a long text."""
    return [
        None, "", " \n\t ", "a", "Ünïcode 漢字 😀 текст\nline two", "same text here", "same text here",
        "x" * 5_000, "word " * 20_000,
    ]


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, **more):
    rows = [
        (i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, len(t or ""))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENTS)
