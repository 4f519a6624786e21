"""Line dedup: exact reference counts, fronted by sharded cuckoo filters.

A line's key is the 128-bit hash of the line without white space at its ends and with A-Z in
lower case. The count table holds for every key the number of documents that have it. Keys of
at least ``min_docs`` documents are active; each shard of the filters knows the active keys of
its part of the key space. Documents can be added and taken away again: the counts change, and
keys that cross the threshold enter or leave the filter of their shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskspark.llm.arrow import free_name, parts, rows_of, texts, to_batch, with_fields
from riskspark.llm.cuckoo import CuckooFilter, buckets_for
from riskspark.session import shared_dir, work_path

MIN_DOCS = 10
MIN_CHARS = 1
SPACE = b" \t\n\v\f\r"
#: (document, key) pairs that one shard should hold on average.
PAIRS_PER_SHARD = 100_000
LEAST_SHARDS = 64
#: A key with more than this part of all pairs is hot; so there are fewer hot keys than this.
HOT_KEYS = 1024
KEY = StructType([StructField("k1", LongType()), StructField("k2", LongType())])
STATE = "shard int, buckets int, slots binary, keys binary"


def line_digest(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The 16 bytes of a line's key, or None if the key is shorter than ``min_chars``."""
    key = line.strip(SPACE).lower()  # bytes.lower changes A-Z only
    if len(key) < min_chars or (len(key) < 4 * min_chars
                                and len(key.decode("utf-8")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def line_pairs(docs: DataFrame, doc_id: str = "doc_id", min_chars: int = MIN_CHARS) -> DataFrame:
    """One row for each document and key in it: the document's id, k1, k2."""
    schema = StructType([docs.schema[doc_id], *KEY.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            digests, counts = [], []
            for text in texts(batch):
                found = {line_digest(x, min_chars) for x in text.encode().split(b"\n")} - {None}
                digests += sorted(found)
                counts.append(len(found))
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            owner = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            yield to_batch({doc_id: batch.column(0).take(owner),
                            "k1": pa.array(halves[:, 0]), "k2": pa.array(halves[:, 1])}, schema)

    return docs.select(doc_id, "text").mapInArrow(run, schema)


def key_counts(pairs: DataFrame) -> DataFrame:
    """The exact table: k1, k2 and the number of documents; summed before the shuffle."""
    return pairs.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("docs"))


def _shard(shards: int):
    return F.pmod(F.col("k1"), F.lit(shards)).cast("int")


def _packed(k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    keys = np.empty(len(k1), [("k1", "<i8"), ("k2", "<i8")])
    keys["k1"], keys["k2"] = k1, k2
    return np.sort(keys, order=["k1", "k2"])


def _state(shard: int, made: CuckooFilter, keys: np.ndarray) -> pa.Table:
    return pa.table({
        "shard": pa.array([shard], pa.int32()), "buckets": pa.array([len(made.table)], pa.int32()),
        "slots": pa.array([made.table.tobytes()], pa.binary()),
        "keys": pa.array([keys.tobytes()], pa.binary())})


def _spread_bits(k1: np.ndarray) -> np.ndarray:
    """The filters' bucket bits; the low bits of k1 are the same all over a shard."""
    return k1.astype(np.int64).view(np.uint64) >> np.uint64(20)


def _read(state: pa.Table) -> tuple[CuckooFilter, np.ndarray]:
    row = state.slice(0, 1).to_pylist()[0]
    return (CuckooFilter(row["buckets"], row["slots"]),
            np.frombuffer(row["keys"], [("k1", "<i8"), ("k2", "<i8")]))


def build_filters(counts: DataFrame, shards: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row for each shard with active keys: its filter, and the keys themselves, sorted."""
    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        k1, k2 = (table.column(c).to_numpy() for c in ("k1", "k2"))
        return _state(key[0].as_py(), CuckooFilter.of(_spread_bits(k1), k2), _packed(k1, k2))

    return (counts.where(F.col("docs") >= min_docs).withColumn("shard", _shard(shards))
            .select("shard", "k1", "k2").groupBy("shard").applyInArrow(build, STATE))


def update_filters(filters: DataFrame, old: DataFrame, new: DataFrame, shards: int,
                   min_docs: int = MIN_DOCS) -> DataFrame:
    """Insert the keys that became active and delete those that no longer are."""
    turned = (old.select("k1", "k2", F.col("docs").alias("was"))
              .join(new.select("k1", "k2", F.col("docs").alias("now")), ["k1", "k2"], "full")
              .select("k1", "k2", (F.coalesce("was", F.lit(0)) >= min_docs).alias("was"),
                      (F.coalesce("now", F.lit(0)) >= min_docs).alias("now"))
              .where("was != now").withColumn("shard", _shard(shards)))

    def change(key: tuple[pa.Scalar, ...], state: pa.Table, keys: pa.Table) -> pa.Table:
        k1, k2 = (keys.column(c).to_numpy() for c in ("k1", "k2"))
        comes = keys.column("now").to_numpy().astype(bool)
        if state.num_rows:
            made, exact = _read(state)
        else:
            made, exact = CuckooFilter(buckets_for(0)), _packed(k1[:0], k2[:0])
        gone = _packed(k1[~comes], k2[~comes])
        made.delete(_spread_bits(k1[~comes]), k2[~comes])
        exact = np.setdiff1d(exact, gone)
        both = np.sort(np.concatenate([exact, _packed(k1[comes], k2[comes])]), order=["k1", "k2"])
        if not made.insert(_spread_bits(k1[comes]), k2[comes]):  # full: the exact keys refill it
            made = CuckooFilter.of(_spread_bits(both["k1"]), both["k2"])
        return _state(key[0].as_py(), made, both)

    return (filters.groupBy("shard").cogroup(turned.groupBy("shard")).applyInArrow(change, STATE))


def active_pairs(pairs: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """The pairs whose key is active: the shard's filter first, then its exact keys."""
    doc_id = pairs.columns[0]
    schema = pairs.select(doc_id, "k1", "k2").schema

    def probe(key: tuple[pa.Scalar, ...], mine: pa.Table, state: pa.Table) -> pa.Table:
        mine = mine.select([doc_id, "k1", "k2"])
        if not state.num_rows or not mine.num_rows:
            return mine.slice(0, 0)
        made, exact = _read(state)
        k1, k2 = (mine.column(c).to_numpy() for c in ("k1", "k2"))
        maybe = np.flatnonzero(made.contains(_spread_bits(k1), k2))
        asked = np.empty(len(maybe), exact.dtype)
        asked["k1"], asked["k2"] = k1[maybe], k2[maybe]
        return mine.take(pa.array(maybe[np.isin(asked, exact)]))

    return (pairs.withColumn("shard", _shard(shards)).groupBy("shard")
            .cogroup(filters.groupBy("shard")).applyInArrow(probe, schema))


class LineIndex:
    """Counts and filters over the documents added so far, kept as tables in the shared folder."""

    def __init__(self, spark: SparkSession, shards: int, min_docs: int = MIN_DOCS,
                 min_chars: int = MIN_CHARS) -> None:
        self.spark, self.shards = spark, shards
        self.min_docs, self.min_chars = min_docs, min_chars
        self._keep(spark.createDataFrame([], "k1 bigint, k2 bigint, docs bigint"),
                   spark.createDataFrame([], STATE))

    def _keep(self, counts: DataFrame, filters: DataFrame) -> None:
        path = work_path(self.spark, "lines")
        counts.write.parquet(f"{path}/counts")
        filters.write.parquet(f"{path}/filters")
        self.counts = self.spark.read.parquet(f"{path}/counts")
        self.filters = self.spark.read.parquet(f"{path}/filters")

    def change(self, docs: DataFrame, sign: int) -> None:
        """Add (1) or take away (-1) documents. Taking away needs the texts as added."""
        delta = key_counts(line_pairs(docs, docs.columns[0], self.min_chars))
        new = (self.counts.unionByName(delta.withColumn("docs", F.col("docs") * sign))
               .groupBy("k1", "k2").agg(F.sum("docs").alias("docs")).where("docs > 0"))
        path = work_path(self.spark, "lines-new")
        new.write.parquet(path)
        new = self.spark.read.parquet(path)
        self._keep(new, update_filters(self.filters, self.counts, new, self.shards, self.min_docs))

    def add(self, docs: DataFrame) -> None:
        self.change(docs, 1)

    def remove(self, docs: DataFrame) -> None:
        self.change(docs, -1)

    def clean(self, docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
        """``docs`` without the lines whose keys are active now; as ``drop_lines`` returns them.

        The documents need not be among those added. Each distinct key is looked up once, so a
        frequent line is no group; a text then joins the active ones of its keys.
        """
        tag = free_name(docs, "_tag")
        tagged = docs.withColumn(tag, _tag(doc_id))
        pairs = line_pairs(tagged, tag, self.min_chars).distinct()
        asked = pairs.groupBy("k1", "k2").agg(F.lit(0).alias("_of")).select("_of", "k1", "k2")
        active = active_pairs(asked, self.filters, self.shards).select("k1", "k2")
        return _without(tagged, tag, pairs.join(active, ["k1", "k2"]), set(), self.min_chars)


def _tag(doc_id: str):
    """Tells rows apart that differ in id or text, so neither copies nor rows of one id are a group.

    Where two rows should ever share one, each gets the other's active keys as well, which drop
    no line that is not to be dropped anyway.
    """
    return F.xxhash64(F.col(doc_id), F.coalesce("text", F.lit("")))


def _without(tagged: DataFrame, tag: str, found: DataFrame, hot_bytes: set[bytes],
             min_chars: int) -> DataFrame:
    """The documents without the lines of the found keys (tag, k1, k2) and of the hot ones."""
    keys, own = free_name(tagged, "_keys"), free_name(tagged, "_text_tag")
    by_text = (found.groupBy(F.col(tag).alias(own))
               .agg(F.collect_set(F.struct("k1", "k2")).alias(keys)))
    joined = tagged.join(by_text, F.col(tag) == F.col(own), "left")
    plain = [c for c in tagged.columns if c not in ("n_lines", "n_dropped", tag)]
    schema = with_fields(tagged.drop(tag).schema, ("n_lines", LongType()), ("n_dropped", LongType()))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            kept, before, lost = [], [], []
            for text, mine in zip(texts(batch), batch.column(keys).to_pylist(), strict=True):
                gone = hot_bytes.union(np.array([k["k1"], k["k2"]], "<i8").tobytes()
                                       for k in mine) if mine else hot_bytes
                lines = text.encode().split(b"\n")
                left = ([x for x in lines if line_digest(x, min_chars) not in gone]
                        if gone else lines)
                kept.append(b"\n".join(left).decode())
                before.append(len(lines))
                lost.append(len(lines) - len(left))
            columns = {c: batch.column(c) for c in plain}
            yield to_batch(columns | {"text": kept, "n_lines": before, "n_dropped": lost}, schema)

    return joined.select(*plain, keys).mapInArrow(clean, schema)


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
               doc_id: str = "doc_id") -> DataFrame:
    """Take every line whose key is in ``min_docs`` documents or more out of all documents.

    Returns the columns of ``docs`` with the new text, then ``n_lines`` (before) and
    ``n_dropped``. A document is a row; rows with equal ids count one by one. Null and empty
    texts are one empty line; keys shorter than ``min_chars`` code points are never dropped; a
    text that loses every line becomes empty. Input columns n_lines and n_dropped are replaced.

    Hot keys never meet in one task: fewer than ``HOT_KEYS`` keys can each hold 1/HOT_KEYS of
    all pairs, so these few go to every task as they are; all other pairs are dealt to shards.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    tag = free_name(docs, "_tag")
    tagged = docs.withColumn(tag, _tag(doc_id))
    pairs = line_pairs(tagged, tag, min_chars).checkpoint()
    counts = key_counts(pairs)
    total = rows_of(pairs)
    shards = LEAST_SHARDS + total // PAIRS_PER_SHARD
    active = counts.where(F.col("docs") >= min_docs).checkpoint()
    hot_floor = total // HOT_KEYS + 1
    hot = {(r.k1, r.k2) for r in active.where(F.col("docs") >= hot_floor).collect()}
    hot_bytes = {np.array(k, "<i8").tobytes() for k in hot}
    rare = pairs.where(~_is_hot(hot)) if hot else pairs
    found = active_pairs(rare, build_filters(active.where(F.col("docs") < hot_floor), shards,
                                             min_docs), shards)
    return _without(tagged, tag, found, hot_bytes, min_chars)


def _is_hot(hot: set[tuple[int, int]]):
    return F.struct("k1", "k2").isin([F.struct(F.lit(a).cast("bigint").alias("k1"),
                                               F.lit(b).cast("bigint").alias("k2"))
                                      for a, b in sorted(hot)])
