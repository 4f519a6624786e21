"""Token ids of whole corpora in coded files, and back.

A store is a folder of Parquet files. Each row is one coded block of whole documents
(``idcoder``) next to the documents' ids and lengths. Files are numbered and hold ascending,
disjoint ranges of document ids; blocks are numbered in their file, so the rows in the order of
(file, block) are the corpus in ascending document order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StructField,
                               StructType)

from riskspark.llm.arrow import parts, to_batch
from riskspark.llm.idcoder import LANE_IDS, LANES, decode_block, encode_block
from riskspark.llm.tokens import ENCODE_BYTES, ENCODE_ROWS, encoder

END_ID = 2
#: A block is closed once it holds so many ids.
BLOCK_IDS = LANES * LANE_IDS
#: Copies of one row (equal id and text) are dealt to so many places.
SPREAD = 1 << 20


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID,
              doc_id: str = "doc_id", block_ids: int = BLOCK_IDS) -> None:
    """Tokenise whole texts, end each with ``end_id`` and write them in ascending id order.

    A null or empty text is the end id alone. Null ids come first; documents with equal ids
    follow each other in any order, each with an entry of its own, however many share an id. An
    empty table writes a store without blocks. Other columns are not read.
    """
    kind = docs.schema[doc_id].dataType
    schema = StructType([
        StructField("file", IntegerType()), StructField("block", IntegerType()),
        StructField("n_ids", LongType()), StructField("earlier", LongType()),
        StructField("doc_ids", ArrayType(kind)),
        StructField("lengths", ArrayType(LongType())), StructField("payload", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        file, encode, block = TaskContext.get().partitionId(), encoder(tokenizer), 0
        vocabulary = max(encode.size, end_id + 1)
        kind_of_id = np.uint16 if vocabulary <= 1 << 16 else np.uint32
        end = np.array([end_id], kind_of_id)
        owners, streams, lengths, waiting, earlier = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(streams)
            return to_batch({"file": [file], "block": [block], "n_ids": [len(ids)],
                             "earlier": [earlier], "doc_ids": [owners], "lengths": [lengths],
                             "payload": [encode_block(ids, vocabulary)]}, schema)

        for batch in parts(batches, ENCODE_ROWS, ENCODE_BYTES):
            every, ends = encode.encode_ragged(batch.column(1))
            every = every.astype(kind_of_id, copy=False)
            for owner, a, b in zip(batch.column(0).to_pylist(), ends[:-1].tolist(),
                                   ends[1:].tolist(), strict=True):
                owners.append(owner)
                streams += [every[a:b], end]
                lengths.append(b - a + 1)
                waiting += b - a + 1
                if waiting >= block_ids:
                    yield close()
                    earlier += waiting
                    owners, streams, lengths, waiting, block = [], [], [], 0, block + 1
        if owners:
            yield close()

    # Rows of one id are told apart by their text and a number, so that many of them spread.
    mark, spread = F.xxhash64("text"), F.monotonically_increasing_id() % SPREAD
    (docs.select(doc_id, "text", mark.alias("_mark"), spread.alias("_spread"))
     .repartitionByRange(doc_id, "_mark", "_spread")
     .sortWithinPartitions(doc_id, "_mark", "_spread").select(doc_id, "text")
     .mapInArrow(run, schema).write.parquet(path))


def read_ids(spark: SparkSession, path: str, doc_id: str = "doc_id",
             with_ids: bool = False) -> DataFrame:
    """Decode a store: a row for each written row with its ``start`` among all ids of the corpus.

    Blocks hold how many ids precede them in their file, so only the files are added up, and
    nothing is shuffled once the blocks are decoded.

    Returns the id, ``start``, ``n_tokens``, ``ids_crc32`` and, if asked, ``ids`` (little-endian
    unsigned 32-bit). A damaged block raises an error.
    """
    blocks = spark.read.parquet(path)
    # Where a file begins: one row for each task that wrote, added up before the blocks are read.
    totals = blocks.groupBy("file").agg(F.sum("n_ids").alias("_ids"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = totals.select("file", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_begin"))
    placed = (blocks.join(F.broadcast(files), "file")
              .select((F.col("_begin") + F.col("earlier")).alias("start"), "doc_ids", "lengths", "payload"))
    kind = blocks.schema["doc_ids"].dataType.elementType
    fields = [StructField(doc_id, kind), StructField("start", LongType()),
              StructField("n_tokens", LongType()), StructField("ids_crc32", LongType())]
    schema = StructType(fields + [StructField("ids", BinaryType())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 1):
            row = batch.to_pylist()[0]
            ids = decode_block(row["payload"]).astype("<u4")
            lengths = np.array(row["lengths"], np.int64)
            if int(lengths.sum()) != len(ids):
                raise ValueError("the lengths do not add up to the block")
            places = np.cumsum(lengths) - lengths
            cut = [ids[a:a + n].tobytes() for a, n in zip(places, lengths, strict=True)]
            yield to_batch({
                doc_id: row["doc_ids"], "start": places + row["start"], "n_tokens": lengths,
                "ids_crc32": [zlib.crc32(c) for c in cut], "ids": cut}, schema)

    return placed.mapInArrow(run, schema)
