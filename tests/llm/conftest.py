import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use for columns of their own
        T.StructField("n", T.StringType()),
        T.StructField("k", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("pos", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text[, lang, source]) with clashing extra columns."""

    def make(rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, *("en", "src0")[len(row) - 2 :]) if len(row) < 4 else row
            full.append((doc_id, text, lang, source, len(text or ""), "x", "x", "x", "x", "x"))
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def small_dir():
    from pathlib import Path

    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("no test tables on this machine")
    return str(path)
