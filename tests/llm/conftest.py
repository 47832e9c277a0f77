import pytest

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"

ODD_TEXTS = [
    None, "", " \t\n", "a", "Ab cd", "x" * 50_000, "word " * 30_000, "\n\n\n", "İ̧ Σς 漢字 😀 \x1c\x85",
    "<|endoftext|>don't <|ENDOFTEXT|>", "0123 ¹² !!! </s>",
]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, a null id and a shared id, and clashing names."""
    rows = [(i, t, "en", "s", i) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[4], rows[4], (None, "Ab cd", None, None, None), (3, "another text with the same id", "de", None, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, row_hash bigint")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
