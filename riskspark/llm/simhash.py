"""Near-duplicates by SimHash fingerprints and multi-index hashing.

A 64-bit fingerprint is cut into three segments. Of two fingerprints that differ in four bits or
fewer, one differs by at most one bit in the first or second segment, or not at all in the
third (else five bits would differ). So a fingerprint is entered in three tables by its
segments, asks them for its own segments and the two first also for the Hamming ball of radius
one around them, and complete distances decide. A ball only needs the values with one bit
cleared: of two values one bit apart, one has that bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskspark.llm.arrow import free_name, parts, text_key, texts, to_batch
from riskspark.llm.components import components
from riskspark.session import shared_dir

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SPACE = b" \t\n\v\f\r"
#: First bit and width of the segments, and the radius of the ball that is asked for.
SEGMENTS = ((0, 22, 1), (22, 21, 1), (43, 21, 0))
#: Rows of a bucket that are compared in one task; larger buckets are cut into such blocks.
BLOCK_ROWS = 8192
#: Rows that one group of small buckets holds on average.
GROUP_ROWS = 20_000
#: Buckets up to this size are compared pair by pair, all at once.
SMALL = 24


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint; 0 for a text without words. Bytes.lower changes A-Z only."""
    words = text.encode().lower().split()  # bytes.split knows exactly the six ASCII spaces
    if not words:
        return 0
    joined, width = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(width + 1) - 1
    starts = (ends - width).tolist()
    last = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, last, strict=False)],
                      np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[at:at + 4096].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(0, dtype=np.int64)
    set_ = (ones * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id") -> DataFrame:
    """The id and ``fp``, the fingerprint as a signed 64-bit number, of every row."""
    schema = StructType([docs.schema[doc_id], StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            own = np.array([fingerprint(t, shingle) for t in texts(batch)], np.uint64)
            yield to_batch({doc_id: batch.column(0), "fp": own.view(np.int64)}, schema)

    return docs.select(doc_id, "text").mapInArrow(run, schema)


def hex_text(fp: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _segment(fp: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))


def table_rows(distinct: DataFrame) -> DataFrame:
    """Entries (``probe`` 0) and questions (1) of each fingerprint: segment number, value."""
    def row(number: int, value: Column, probe: int) -> Column:
        return F.struct(F.lit(number).alias("segment"), value.alias("value"), F.lit(probe).alias("probe"))

    def ball(number: int, value: Column, width: int) -> Column:
        bits = F.filter(F.sequence(F.lit(0), F.lit(width - 1)), lambda b: F.getbit(value, b) == 1)
        one = F.lit(1).cast("bigint")
        return F.transform(bits, lambda b: row(
            number, value.bitwiseXOR(F.call_function("shiftleft", one, b)), 1))

    rows = []
    for number, (first, width, radius) in enumerate(SEGMENTS):
        value = _segment(F.col("fp"), first, width)
        rows.append(F.array(row(number, value, 0)))
        if radius:
            rows.append(ball(number, value, width))
    return (distinct.select("fp", F.explode(F.concat(*rows)).alias("r"))
            .select("fp", "r.segment", "r.value", "r.probe"))


def spanning_links(fps: np.ndarray, bucket: np.ndarray, max_bits: int) -> np.ndarray:
    """Links (pairs of at most ``max_bits``) that connect what such pairs connect in a bucket.

    Rows of a bucket are adjacent. Small buckets are compared pair by pair. In larger ones a
    row fetches all rows near it that were not fetched before, and those go on the same way, so
    a tight cluster of n rows costs about n comparisons and n - 1 links, not n squared.
    """
    out = []
    start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, int)
    sizes = np.diff(np.r_[start, len(bucket)])
    size_of = np.repeat(sizes, sizes)
    small = np.flatnonzero(size_of <= SMALL)
    own, of = fps[small], bucket[small]
    for gap in range(1, int(sizes[sizes <= SMALL].max(initial=1))):
        near = ((of[gap:] == of[:-gap])
                & (np.bitwise_count(own[gap:] ^ own[:-gap]) <= max_bits))
        at = np.flatnonzero(near)
        out.append(np.stack([own[at], own[at + gap]], 1))
    for at, size in zip(start[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        left = fps[at:at + size]
        while len(left):
            todo, left = [left[0]], left[1:]
            while todo and len(left):
                pivot = todo.pop()
                near = np.bitwise_count(left ^ pivot) <= max_bits
                if near.any():
                    reached = left[near]
                    out.append(np.stack([np.full(len(reached), pivot), reached], 1))
                    todo.extend(reached)
                    left = left[~near]
    return np.concatenate(out) if out else np.zeros((0, 2), np.uint64)


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints that connect all that are near.

    Buckets without an entry or with one row are dropped after counting. Small buckets share
    groups; a bucket beyond ``BLOCK_ROWS`` is cut into blocks and each pair of blocks is a
    group, so no task holds more than two blocks of it and no pair is left out.
    """
    if max_bits > 4:
        raise ValueError("the segments find pairs of up to four differing bits")
    rows = table_rows(distinct)
    sizes = (rows.groupBy("segment", "value")
             .agg(F.count(F.lit(1)).alias("rows"), F.min("probe").alias("least"))
             .where("rows > 1 AND least = 0")
             .select("segment", "value",
                     F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("blocks"))
             .checkpoint())
    live = rows.join(sizes, ["segment", "value"]).select("fp", "segment", "value", "blocks")
    live = live.checkpoint()
    groups = 64 + live.count() // GROUP_ROWS
    small = (live.where("blocks = 1")
             .select("fp", "segment", "value", F.lit(0).alias("low"), F.lit(0).alias("high"),
                     F.pmod(F.xxhash64("segment", "value"), F.lit(groups)).alias("group")))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    large = (live.where("blocks > 1").withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .where("other != block")
             .select("fp", "segment", "value", F.least("block", "other").alias("low"),
                     F.greatest("block", "other").alias("high"))
             .withColumn("group", F.xxhash64("segment", "value", "low", "high")))

    def connect(table: pa.Table) -> pa.Table:
        fps, segment, value = (table.column(c).to_numpy() for c in ("fp", "segment", "value"))
        order = np.lexsort((value, segment))
        bucket = value[order].astype(np.int64) * len(SEGMENTS) + segment[order]
        found = spanning_links(fps[order].astype(np.int64).view(np.uint64), bucket, max_bits)
        found = np.unique(np.sort(found, 1), axis=0).view(np.int64)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return (small.unionByName(large).groupBy("low", "high", "group")
            .applyInArrow(connect, "a bigint, b bigint").distinct())


def _rooted(own: DataFrame, key: Column, max_bits: int) -> DataFrame:
    """``fp``, ``least`` (the least key) and ``root`` of its component, of every fingerprint."""
    distinct = own.groupBy("fp").agg(F.min(key).alias("least")).checkpoint()
    roots = components(links(distinct.select("fp"), max_bits), "a", "b")
    return (distinct.join(roots, distinct["fp"] == roots["node"], "left")
            .select("fp", "least", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    doc_id: str = "doc_id") -> DataFrame:
    """The id, ``fingerprint`` and ``component_id`` of every row.

    Documents are linked if their fingerprints differ in ``max_bits`` bits or fewer, directly
    or by way of others; ``component_id`` is the smallest id reached. A null text has no words
    and fingerprint zero, like an empty one. Null ids are in no competition for the smallest;
    a component of null ids alone has a null id. Rows that repeat an id are rows of their own.
    Other columns are not read; no rows give no rows.
    """
    shared_dir(docs.sparkSession)
    own = fingerprints(docs, shingle, doc_id).checkpoint()
    rooted = _rooted(own, F.col(doc_id), max_bits)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id")).checkpoint()
    members = rooted.join(named, "root").select("fp", "component_id").checkpoint()
    return own.join(members, "fp").select(doc_id, hex_text(F.col("fp")).alias("fingerprint"),
                                          "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
             doc_id: str = "doc_id") -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id, then by text.

    Rows that share an id are rows of their own, and so are rows without one, which come last.
    Of rows equal in id and text any one stays.
    """
    shared_dir(docs.sparkSession)
    key = F.struct(F.col(doc_id).isNull().alias("nameless"), F.col(doc_id).alias("id"),
                   text_key(F.col("text")).alias("text"))
    own = fingerprints(docs.select(key.alias("_key"), "text"), shingle, "_key").checkpoint()
    kept = (_rooted(own, F.col("_key"), max_bits).groupBy("root").agg(F.min("least").alias("_key"))
            .select("_key").checkpoint())
    # One key for both steps, so that whole rows are shuffled by it once.
    name = free_name(docs, "_key")
    once = docs.withColumn(name, key).dropDuplicates([name])
    return once.join(kept.withColumnRenamed("_key", name), name, "left_semi").drop(name)
