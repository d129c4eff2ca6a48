import pytest

from tests.conftest import SF_DIR

TEXTS = [
    None, "", " \n\t ", "one", "One two three", "x" * 20000, "été ñandú 日本語 🙂", "a b c d e f g h i j k\na b c d e f g h i j k",
    "Call +1 (555) 123-4567 or write to bob@mail.example.com from 10.0.0.255, card 4111 1111 1111 1111.",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else None, f"src{i % 2}" if i % 3 else None, len(t or ""), 1.0, 2, "s", "f")
            for i, t in enumerate(TEXTS)]
    rows += [rows[7], rows[7], (None, "no id here at all, just words", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, "
                                       "shard int, pii string, fingerprint string").repartition(3)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
