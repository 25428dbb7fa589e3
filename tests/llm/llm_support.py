import random

import pytest

WORDS = "the of and river stone light under over between quiet morning paper window garden number simple winter summer forest little great house water table music story people".split()


def prose(seed: int, words: int) -> str:
    """Lines of random words, the same for the same seed."""
    draw = random.Random(seed)
    out = [draw.choice(WORDS) + draw.choice(["", "", "s", "ly", "é"]) for _ in range(words)]
    return "".join(w + ("\n" if k % 12 == 11 else " ") for k, w in enumerate(out)).strip()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, a very long text, odd characters, ties, repeated rows, clashing columns."""
    texts = [
        (1, "Hello, world! It's 2024."), (2, None), (3, ""), (4, "  \n\t \n"), (5, prose(1, 60_000)), (6, "naïve 日本語 🙂 <|endoftext|> ½²\u0085x\x1cy"), (7, prose(2, 40)), (7, prose(2, 40)),
        (8, prose(2, 40)), (None, "no id here"), (None, None), (9, "one"), (10, "a b c d"), (11, "a\x00b " * 30), (12, "x" * 200_000), (13, "the same line\n" * 50),
    ]
    rows = [(k, t, None, None, 5, -1, "mine", b"mine", True) for k, t in texts]
    schema = "doc_id long, text string, lang string, source string, n_words int, score int, ids string, hit_words binary, kept boolean"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


def by_id(df):
    """Rows by id, those without one and repeated ones in lists."""
    out: dict = {}
    for row in df.collect():
        out.setdefault(row.doc_id, []).append(row)
    return out
