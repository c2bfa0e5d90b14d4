"""Small frames with the awkward cases: nulls, empty and long texts, ties, repeated rows, extra columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, root long"


def frame(spark, rows, schema=DOCS):
    width = len(schema.split(","))
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)


def words(n, seed, alphabet="abcdefgh"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n))


def edited(text, changes, seed):
    """``text`` with some words replaced."""
    rng = random.Random(seed)
    out = text.split(" ")
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"new{rng.randint(0, 9999)}"
    return " ".join(out)


AWKWARD = [
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, "one two three", "en", "a"),
    (4, "one two three", "en", None),
    (5, "ONE two\tthree ", "en", "b"),
    (6, "short", "en", "b"),
    (7, words(30_000, 1), "en", "a"),
    (8, words(60, 2), None, "b"),
    (9, words(60, 2), None, "b"),
    (9, words(60, 2), None, "b"),
    (10, " \n\t ", "de", "c"),
    (11, "über straße \u0001 \u0002 😀 日本語 テキスト ende".encode("utf-16", "surrogatepass").decode("utf-16"), "de", "c"),
]
