"""Small corpora for the tests of the corpus operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def vocabulary(size: int = 400, seed: int = 1) -> list[str]:
    draw = random.Random(seed)
    parts = ["the", "an", "ti", "on", "er", "wh", "ou", "le", "é", "ß", "ing", "st"]
    return ["".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(size)]


def sentence(draw: random.Random, words: list[str], length: int) -> str:
    return " ".join(draw.choice(words) for _ in range(length))


def odd_rows() -> list[tuple]:
    """NULLs in any column, empty and blank texts, ties, repeated rows, one very long text."""
    long = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
    return [
        (900, None, "en", "s0", None),
        (901, "", "en", None, 0),
        (902, " \t\n ", None, "s1", 4),
        (903, "One line only, repeated here and there in this corpus.", "en", "s1", None),
        (904, "One line only, repeated here and there in this corpus.", None, None, None),
        (904, "One line only, repeated here and there in this corpus.", None, None, None),
        (None, "A row without an id but with a text of its own, long enough to be matched by anything.", "en", "s2", 5),
        (None, None, None, None, None),
        (905, "12345 67890 !!! ???", "de", "s2", 1),
        (906, "日本語 の テキスト <|endoftext|> \U0001f600 x y z", "en", "s2", 1),
        (907, long, "en", "s0", len(long)),
    ]


def family(draw: random.Random, words: list[str], first: int, members: int, length: int, changes: int) -> list[tuple]:
    """Near copies of one text, each with up to ``changes`` words replaced."""
    base = [draw.choice(words) for _ in range(length)]
    rows = []
    for member in range(members):
        text = list(base)
        for _ in range(draw.randint(0, changes)):
            text[draw.randrange(length)] = f"new{draw.randrange(10**6)}"
        rows.append((first + member, " ".join(text), "en", f"s{member % 3}", None))
    return rows
