import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SMALL = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def _workers(spark):
    from tarmac.session import importable
    importable(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empties, a long text, copies, repeated rows and clashing column names."""
    words = " ".join(f"w{i % 997}x{i}" for i in range(60_000))
    base = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf today"
    rows = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", None, None, 3), (4, words, "en", "b", 1),
            (5, base, "en", "a", 1), (6, base, "en", "b", 1), (6, base, "en", "b", 1), (7, base.upper(), "en", None, 1),
            (8, base + " yes", "en", "a", 1), (9, "one two", "en", "a", 1), (10, "one  two", "en", "a", 1),
            (11, "x" * 30_000, "en", "c", 1), (None, "no id here at all", "en", "c", 1), (12, "naïve café ☃ 漢字", "fr", "c", 1),
            (13, "</s>[INST] <|endoftext|> <|im_end|>", "en", "c", 1)]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("_id", "id", "n", "uid", "src", "part", "bucket", "comp", "ids", "_c", "copies", "score", "doc", "block"):
        df = df.withColumn(c, df["source"])
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
