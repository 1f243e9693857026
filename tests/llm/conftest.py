import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts: rows (id, text), or texts alone."""

    def make(texts, first=0):
        rows = [t if isinstance(t, tuple) else (first + i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], SCHEMA)

    return make
