"""Small documents with the cases that every operator must bear."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentences(seed, n):
    return " ".join(f"{'abcdefgh'[(seed * 7 + i) % 8].upper()}w{seed}x{i} goes to place{(seed * 31 + i * 17) % 97} again." for i in range(n))


def cases():
    """(doc_id, text): nulls, blanks, ties, repeats, copies, near copies, very long and odd texts."""
    base = sentences(1, 12)
    rows = [(1, base), (2, base), (3, base + " "), (4, base.replace(" ", "\n")), (5, None), (6, ""), (7, " \n\t "),
            (8, base.replace("place", "spot", 1)), (9, sentences(2, 30)), (10, "short text"), (11, "short  text"),
            (12, "x" * 5000), (13, "Été naïve 漢字 \U0001f600 " * 40), (14, sentences(3, 3000)),
            (15, "\n".join(["the same line of words here"] * 8)), (16, "THE SAME LINE OF WORDS HERE\nother words here too, really"),
            (17, "the same line of words here \n" + sentences(4, 6)), (18, "a b c d e f g h " * 30),
            (19, sentences(5, 10) + " " + sentences(2, 30)), (20, "###" + sentences(6, 5).replace(" ", " ### ")),
            (21, "<|endoftext|> in the middle <|startoftext|>"), (9, sentences(2, 30)), (None, sentences(7, 8)), (None, None)]
    return [(i, t, "en", "s", None) for i, t in rows]


@pytest.fixture(scope="session")
def docs(spark):
    extra = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(cases(), extra)
    clash = ["kept", "fp", "key", "words", "span", "norm", "runs", "length", "root", "node", "size", "head", "shared"]
    return df.selectExpr("*", *[f"'clash' AS {c}" for c in clash]).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def corpus():
    return "/root/testdata/sf0.001"
