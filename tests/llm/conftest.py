import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("lang", StringType()), StructField("source", StringType()),
                   StructField("n_chars", LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from texts or (doc_id, text) pairs; more columns by name."""
    def make(items, parts=3, **extra):
        from pyspark.sql import functions as F

        pairs = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(items)]
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs]
        df = spark.createDataFrame(rows, DOCS).repartition(parts)
        for name, value in extra.items():
            df = df.withColumn(name, F.lit(value))
        return df
    return make


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").cache()


ODD = [(1, None), (2, ""), (3, " "), (4, "\n\n"), (5, "One line.\nTwo lines."), (5, "One line.\nTwo lines."),
       (None, "no id"), (None, None), (7, "x " * 30_000 + "end"), (8, "y" * 50_000),
       (9, "  lead\tand \x1c tail \n"), (10, "<|endoftext|> it's naïve ½ 你好 😀"), (11, "One line.\nTwo lines.")]


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty and long texts, repeated rows and ids, unusual characters."""
    return ODD
