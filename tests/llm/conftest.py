import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

LONG = "lorem ipsum dolor sit amet consectetur " * 9_000


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """(doc_id, text[, lang]) rows as a documents table."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and very long texts, repeated rows, no words, null identifiers."""
    return make_docs([(1, None), (2, ""), (3, LONG, "la"), (4, "one two three four", "en"), (4, "one two three four", "en"),
                      (5, "?!. ...", None), (None, "one two three four", "en"), (6, " \t\n ", "en"), (7, "x" * 50_000, "en"),
                      (8, "Ünïcödé 한국어 😀 text", "xx"), (None, None)])


@pytest.fixture
def save(spark, tmp_path):
    """Write tables into a folder that queries can read."""
    def put(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)
    return put
