import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


@pytest.fixture()
def stored(spark, tmp):
    """Writes rows as a Parquet table and reads it: operators take stable tables."""
    def store(rows, schema, name="t", files=2):
        path = f"{tmp}/{name}"
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
        return spark.read.schema(schema).parquet(path)
    return store


@pytest.fixture()
def docs(stored):
    """(doc_id, text) pairs as a table of documents with clashing extra columns."""
    def make(pairs, name="docs", lang="en"):
        extra = T.StructType(DOCUMENT.fields + [
            T.StructField(c, T.StringType()) for c in ("row", "digest", "masked", "cuts", "first")])
        return stored([(i, t, lang, "s", None, "a", "b", "c", "d", "e") for i, t in pairs],
                      extra, name)
    return make


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    from paddock.llm._common import ready
    ready(spark)
