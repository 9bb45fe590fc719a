import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) pairs, with columns whose names clash with results and helpers."""

    def make(rows, lang="en"):
        full = [(i, t, lang, "src", None, 5, "x", "y", 1) for i, t in rows]
        schema = DOCS + ", id long, score string, n_lines string, part int"
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def schema_of(text):
    return T._parse_datatype_string(text)
