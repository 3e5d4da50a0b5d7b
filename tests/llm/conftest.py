import pytest
from llm_rows import CLASHING, words

from watchledger.llm.common import DOCUMENT_COLUMNS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A function from (doc_id, text, lang, source) rows to a document table."""

    def build(rows, partitions=3):
        full = [(*r, *[None] * (4 - len(r)))[:4] for r in rows]
        return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in full], SCHEMA).repartition(partitions)

    return build


@pytest.fixture(scope="session")
def hostile(documents):
    """Nulls, blanks, ties, repeated rows, a long text, odd characters."""
    long = words(1, 30_000)
    return [
        (1, None, "en", "a"), (2, "", None, "a"), (3, " \n\t ", "en", None), (None, words(5, 40), "en", "b"), (None, words(5, 40), None, None),
        (4, long, "de", "a"), (5, words(2, 300), "en", "a"), (6, words(2, 300), "en", "b"), (7, words(2, 300).upper(), None, "b"), (8, words(2, 299) + " end", "en", "c"),
        (9, words(3, 60), "en", "c"), (9, words(3, 60), "en", "c"), (10, "Ünïcode text \U0001f600 'quoted' <|endoftext|>  twice", "fr", "é"), (11, "one", "en", "a"),
        (12, "12345 67890", None, "z"), (13, words(4, 4), "en", "a"),
    ]


@pytest.fixture(scope="session")
def clashing(spark):
    """The same table with further columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    def add(df):
        return df.select(*DOCUMENT_COLUMNS, *[F.lit(f"own {c}").alias(c) for c in CLASHING])

    return add
