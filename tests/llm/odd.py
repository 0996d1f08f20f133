"""Documents that break things, and made-up sentences."""

from __future__ import annotations

import random

WORDS = "the of and stone river light paper green window garden letter number winter summer silver copper market village".split()


def sentence(seed: int, words: int = 30) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(60)) for _ in range(words))


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score string, removed int, copies string, target string, size int, n int, key string, ids string, label int"


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text), "x", 1, "y", "z", 2, 3, "k", "i", 9)


def odd_rows() -> list[tuple]:
    """Nulls in any column, empty and very long texts, ties, repeated rows, equal texts, and names that results have too."""
    long_text = "\n".join(sentence(k, 400) for k in range(60)) + " " + "ü" * 50_000 + " \U0001d4b3\x00\t▁ end"
    rows = [
        row(1, sentence(1)),
        row(2, sentence(1)),
        row(2, sentence(1)),
        row(3, None),
        row(4, ""),
        row(5, " \t\n\x0b\x0c\r "),
        row(6, "One two"),
        row(7, "ONE  two\n"),
        row(8, long_text, None),
        row(9, long_text + " more", None),
        row(None, sentence(2), "b"),
        row(None, sentence(2), "b"),
        row(None, None, None),
        row(10, "same line here\n" + sentence(3) + "\nsame line here", "b"),
        row(11, sentence(1) + "\n" + sentence(3) + "\n\n" + sentence(3).upper() + "  ", "b"),
        row(-5, "ab \U0001f600 ́ é   nbsp", ""),
    ]
    return rows + [row(100 + k, "same line here\n" + sentence(50 + k), "b") for k in range(14)] + [tuple([None] * len(rows[0]))]
