import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text, lang, source) as a `documents` table, with extra columns on demand."""
    def make(rows, extra=None):
        rows = [(*r, len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(rows, DOCUMENTS)
        for name in extra or ():
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit("x"))
        return df

    return make


@pytest.fixture(scope="session")
def odd_documents(documents):
    """Nulls in every column, empty and very long texts, repeated rows, a key with two texts."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    return documents([
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "src1"),
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "src1"),
        (1, "another text under the same key with quite enough words to be kept here", "en", "src2"),
        (2, "", "en", "src1"), (3, None, None, None), (None, "a text without a key but with more than ten words in it today", "de", None),
        (None, None, None, "src1"), (4, " \n\t ", "fr", "src3"), (5, long, "en", "src1"), (6, long, "en", "src1"),
        (7, "\n\nx\n", "es", ""), (8, "été " * 50, "fr", "src3"),
    ])
