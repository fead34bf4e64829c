"""Documents with all that may go wrong in them."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()


def prose(seed: int, words: int = 60, line: int = 12) -> str:
    rng = random.Random(seed)
    found = [rng.choice(WORDS) + str(rng.randrange(1000)) for _ in range(words)]
    return "\n".join(" ".join(found[i : i + line]) for i in range(0, words, line))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, one very long text, ties, repeated rows."""
    long = prose(1, 30_000)
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", None, 0),
        (3, " \n\t\n ", None, "a", 5),
        (None, prose(2), "en", "b", 1),
        (None, prose(2), "en", "b", 1),
        (4, prose(3), None, "b", 1),
        (4, prose(3), None, "b", 1),
        (5, prose(3), "en", "c", 1),
        (6, long, "en", "a", len(long)),
        (7, "x", "en", "é", 1),
        (8, "word " * 40, "fr", "a", 1),
        (9, "!!! ??? 12 34", "fr", "a", 1),
    ]
    return rows + [(100 + i, prose(100 + i, 20 + 7 * i), "en" if i % 2 else "fr", f"s{i % 5}", 1) for i in range(25)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def folder(spark, odd, none, tmp_path_factory):
    """Folders of documents: the odd ones, none, and the odd ones with more columns whose names the
    operators use themselves."""
    root = tmp_path_factory.mktemp("docs")
    more = odd.selectExpr("*", "1 as _key", "2 as key", "3 as row", "4 as size", "5 as length", "6 as piece", "7 as n_lines", "8 as lang_pred", "9 as shard", "10 as k1", "11 as quality", "12 as _src", "13 as taken")
    for name, frame in (("odd", odd), ("none", none), ("more", more)):
        frame.write.parquet(f"{root}/{name}/documents.parquet")
    return str(root)
