"""Small documents with the hard cases: nulls, blanks, ties, repeats, long texts, clashing columns."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, piece int, length long, size long, rank int, part int"
WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon "
         "phi chi psi omega it's don't 12 3.5 été ß").split()


def text(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * (seed % 5 + 1) + i * i) % len(WORDS)] + ("." if i % 9 == 8 else "") for i in range(n))


def documents():
    """(doc_id, text, source): repeats of a row, of a text and of an id, and a text of many words."""
    base = text(3, 400)
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n\t ", None), (4, "One  two", "a"), (5, base, "a"), (6, base, "b"),
            (7, base.upper().replace("É", "é"), "c"), (8, base + " tail", None), (9, text(8, 20_000), "a"), (5, base, "a"),
            (None, base, "b"), (None, None, None), (12, "x" * 5000, "c"), (13, "日本語 text 🙂 \x00 <|endoftext|> İ", "a"),
            (14, "a b c d e\na b c d e\n\na b c d e", "b"), (15, "solo", "a")]
    return rows + [(100 + i, text(i, 5 + i * 3), "abc"[i % 3]) for i in range(40)]


def frame(spark, rows):
    data = [(d, t, "en", s, None if t is None else len(t), 9, 9, 9, 9, 9) for d, t, s in rows]
    return spark.createDataFrame(data, SCHEMA)


def plain_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")
