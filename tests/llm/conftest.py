import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents of texts, with ids from 0; a (id, text) pair sets an id."""

    def make(texts, extra=""):
        rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
        rows = [(i, t, "en", "s1", len(t or "")) for i, t in rows]
        df = spark.createDataFrame(rows, DOCS)
        for name in extra.split():
            df = df.selectExpr("*", f"'x' as {name}")
        return df

    return make


@pytest.fixture(scope="session")
def given(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet").cache()


@pytest.fixture(scope="session")
def given_rows(given):
    return [(r["doc_id"], r["text"], r["lang"]) for r in given.collect()]
