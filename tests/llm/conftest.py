import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

SF_DIR = "/root/testdata/sf0.001"

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, clashing extra columns."""
    long = " ".join(f"word{i % 977} Alpha{i % 31}" for i in range(60_000))
    line = "The quick brown fox jumps over the lazy dog and runs away from the angry farmer today."
    rows = [
        (1, line, "en", "a", 10),
        (1, line, "en", "a", 10),
        (2, line, "en", None, None),
        (None, line, None, "a", 10),
        (None, None, None, None, None),
        (3, None, "de", "b", 0),
        (4, "", "de", "b", 0),
        (5, " \n\t ", None, "b", 3),
        (6, long, "en", "c", len(long)),
        (7, long + " end", "en", "c", len(long)),
        (8, "Der schnelle braune Fuchs springt über den faulen Hund.", "de", "", 55),
        (9, "12 34 56.78 9,000", None, "", 1),
        (-10, "x", "en", "b", 1),
    ]
    extra = "size long, score double, shard int, hash string, fp long, lang_pred string, taken long, __note string"
    schema = ", ".join([DOC, extra])
    return spark.createDataFrame([(*r, 1, 0.5, 2, "h", 3, "xx", 4, "n") for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
