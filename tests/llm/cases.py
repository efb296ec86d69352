"""Texts and tables that every operator has to take, and plain versions of what they compute."""

import re

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, leaks string, _text string, n long"


def words(text: str | None) -> list[bytes]:
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[^\x20\x09-\x0D]+", lower)


def shingles(text: str | None, width: int) -> frozenset:
    w = words(text)
    if len(w) >= width:
        return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    import random

    rng = random.Random(seed)
    return " ".join(f"{'bcdfgklmnprst'[i % 13]}{'aeiou'[i % 5]}{'lmnrst'[i % 6]}{i}" for i in (rng.randrange(vocabulary) for _ in range(n)))


def odd_rows() -> list[tuple]:
    """Nulls, empty and white texts, ties and repeats, a very long text, clashing columns."""
    base = prose(1, 120)
    texts = [
        None, "", " \n\t ", base, base, base.upper(), base + " end", prose(2, 60), "one", "one", "don't we'll 'tis",
        "Ünï çødé 中文 naïve <|endoftext|> x", "12 34.5 — “quotes”", prose(3, 30000), "\x85​﻿", "a" * 3000,
    ]
    rows = [(i, t, "en" if i % 2 else None, "s", 1, "x", "y", 2) for i, t in enumerate(texts)]
    return rows + [(None, base, None, None, None, None, None, None), rows[3], rows[7], (7, "other text of id seven", None, None, None, None, None, None)]


def odd_table(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS)


def empty_table(spark):
    return spark.createDataFrame([], COLUMNS)
