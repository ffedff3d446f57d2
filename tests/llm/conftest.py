"""Shared small tables for the operators' tests."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text) pairs to a documents table, with columns that clash with results."""

    def build(rows, extra=True):
        df = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], DOCS).repartition(3)
        if extra:
            for name in ("n_bytes", "kept", "n_tokens", "score", "component_id", "spans", "bin_id", "digest", "doc", "key", "label_",
                         "_row", "_doc", "_digest", "_spans", "id", "hash", "text_"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return build


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sf_docs(spark):
    """The smallest given documents, as a frame and as rows."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
