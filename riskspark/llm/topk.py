"""Exact top-k search by integer inner product: every posting of every term is accumulated.

Vectors are quantised to whole numbers; a component is a term, its nonzero weights in a slice of
candidates are the term's postings. Query rows scatter ``query weight x posting weight`` into a
dense array of scores, term by term; each slice then yields its best candidates of every query,
and the best of those are the answer. Queries meet candidates block by block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.arrow import rows_of

TOP = 20
SCALE = 64
#: Candidates of a slice and queries of a block, on average.
SLICE_ROWS = 8192
BLOCK_QUERIES = 1024
#: Query rows whose scores are accumulated at a time, and candidates at a time.
ROWS_AT_ONCE, CANDIDATES_AT_ONCE = 32, 2048


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as a double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    """Neither null nor holding a null, NaN or infinite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Rows of whole numbers; shorter vectors lack the last terms."""
    flat = vectors.combine_chunks()
    lengths = np.diff(flat.offsets.to_numpy())
    values = flat.flatten().to_numpy()
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def _score_type(queries: np.ndarray, candidates: np.ndarray):
    """The fastest type in which every partial sum is exact."""
    most = (float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0))
            * max(1, queries.shape[1]))
    if most >= 2 ** 63:
        raise ValueError("the scores do not fit 64 bits")
    return np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores of some query rows against all candidate rows, term at a time."""
    kind = _score_type(queries, candidates)
    scores = np.zeros((len(queries), len(candidates)), kind)
    queries = queries.astype(kind)
    scratch = np.empty((len(queries), CANDIDATES_AT_ONCE), kind)
    for at in range(0, len(candidates), CANDIDATES_AT_ONCE):
        weights = np.ascontiguousarray(candidates[at:at + CANDIDATES_AT_ONCE].T).astype(kind)
        block = scores[:, at:at + weights.shape[1]]
        room = scratch[:, :weights.shape[1]]
        for term in range(min(queries.shape[1], len(weights))):
            postings = np.flatnonzero(weights[term])
            asking = np.flatnonzero(queries[:, term])
            if not len(postings) or not len(asking):
                continue
            if len(postings) * 4 < weights.shape[1]:  # a short list: scatter its places only
                block[np.ix_(asking, postings)] += np.outer(queries[asking, term],
                                                            weights[term, postings])
            else:  # nearly every candidate: the list is the whole row
                np.multiply(queries[:, term, None], weights[term], out=room)
                block += room
    return scores


def _best(scores: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` highest scores; of equal ones the first places."""
    if len(scores) <= top:
        return np.argsort(-scores, kind="stable")
    floor = np.partition(scores, len(scores) - top)[len(scores) - top]
    places = np.flatnonzero(scores >= floor)
    return places[np.argsort(-scores[places], kind="stable")[:top]]


def _search(top: int):
    def run(mine: pa.Table, asked: pa.Table) -> pa.Table:
        empty = {"query_id": [], "vec_id": [], "score": []}
        schema = pa.schema([(c, pa.int64()) for c in empty])
        if not mine.num_rows or not asked.num_rows:
            return pa.table(empty, schema)
        ids = mine.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, candidates = ids[order], _matrix(mine.column("_vector"))[order]
        wanted, queries = asked.column("vec_id").to_numpy(), _matrix(asked.column("_vector"))
        width = max(candidates.shape[1], queries.shape[1])
        candidates = np.pad(candidates, ((0, 0), (0, width - candidates.shape[1])))
        queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in range(0, len(queries), ROWS_AT_ONCE):
            scores = accumulate(queries[at:at + ROWS_AT_ONCE], candidates)
            for query, row in zip(wanted[at:at + ROWS_AT_ONCE], scores, strict=True):
                others = np.flatnonzero(ids != query) if query in ids[
                    np.searchsorted(ids, query):np.searchsorted(ids, query) + 1] else None
                own = row if others is None else row[others]
                best = _best(own, top)
                places = best if others is None else others[best]
                found.append((np.full(len(places), query), ids[places],
                              row[places].astype(np.int64)))
        return pa.table([np.concatenate(x) for x in zip(*found, strict=True)], schema=schema)

    return run


def exact_top(vectors: DataFrame, is_query: Column, top: int = TOP, scale: int = SCALE,
              vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``top`` candidates with the highest integer inner product for every query.

    Candidates are all rows but those with the query's own id. Ties go to the smaller id. Rows
    without an id, and vectors that are null or hold null or non-finite components, take no
    part; missing last components count as 0. Of query rows with one id the smallest vector
    asks; candidate rows that repeat an id count one by one. Fewer candidates give fewer rows.
    """
    ready = (vectors.where(usable(F.col(vector)) & F.col(vec_id).isNotNull())
             .select(F.col(vec_id).cast("bigint").alias("vec_id"),
                     quantised(F.col(vector), scale).alias("_vector")))
    asking = (vectors.where(usable(F.col(vector)) & F.col(vec_id).isNotNull() & is_query)
              .groupBy(F.col(vec_id).cast("bigint").alias("vec_id"))
              .agg(F.min(quantised(F.col(vector), scale)).alias("_vector")))
    slices = 1 + rows_of(vectors) // SLICE_ROWS
    blocks = 1 + rows_of(asking) // BLOCK_QUERIES
    # A candidate is copied to each block of queries, a query to each slice of candidates.
    candidates = (ready.withColumn("_slice", F.pmod(F.xxhash64("vec_id", "_vector"), F.lit(slices)))
                  .withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    queries = (asking.withColumn("_block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
               .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
               .withColumn("_slice", F.col("_slice").cast("bigint")))
    found = (candidates.groupBy("_slice", "_block").cogroup(queries.groupBy("_slice", "_block"))
             .applyInArrow(_search(top), "query_id bigint, vec_id bigint, score bigint"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))
