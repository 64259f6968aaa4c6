"""Awkward documents that every operator is tried on."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, alphabet="abcdefghij"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n))


def awkward(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, and columns with clashing names."""
    rng = random.Random(5)
    base = prose(rng, 300)
    texts = [base, base, base.upper(), "", None, "  \n\t", "é", "漢字 ☃ \U0001f600", prose(rng, 20_000), base[:-40] + " changed words here", "x", "a b", 'token = "AbCdEf0123456789abcd"']
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]
    rows += [rows[0], (0, "another text of the same id", "en", None, 27), (None, base, "de", "s", 1), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    clashing = df.select("doc_id", "text", "lang", "source", "n_chars", df.text.alias("TEXT"), df.doc_id.alias("Doc_ID"), df.lang.alias("size"))
    return rows, clashing


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
