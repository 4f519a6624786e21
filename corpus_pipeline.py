"""A corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import lines, packing, quality, simhash, templates
from riskspark.llm.queries import BYTE_BPE
from riskspark.llm.tokens import public_path
from riskspark.session import work_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the lines that ten documents or more share; n_chars follows the text."""
    kept = lines.drop_lines(docs)
    return kept.select(*[F.char_length("text").cast(docs.schema[c].dataType).alias(c)
                         if c == "n_chars" else c for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return templates.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
                                       by_window=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 1024 tokens."""
    return packing.pack_documents(docs, public_path(BYTE_BPE))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good), ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate), ("best-fit packing", pack)]

#: No SQL for the classifier, the fingerprints and the packing: tests check the rows instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages; each one's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
