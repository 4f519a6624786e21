"""Centroid clustering on whole numbers, with an incremental distance matrix.

Each vector keeps its exact dot products with all centroids in a written table. When centroids
move, only their components that changed are multiplied again and added to the products; the
squared distance is |v|^2 - 2 v.c + |c|^2, so the nearest centroid follows from the products.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.topk import quantised, usable
from riskspark.session import work_path

CLUSTERS = 16
ROUNDS = 3
SCALE = 64
WIDTH = 64
#: Components beyond this have squared distances beyond 64 bits.
MOST = 1 << 27
STATE = "vec_id bigint, v array<bigint>, dots array<bigint>"


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """Lists of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _lists(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1)))


def product(vectors: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The exact matrix product; in floating point where no partial sum can be inexact."""
    most = (int(np.abs(vectors).max(initial=0)) * int(np.abs(columns).max(initial=0))
            * max(1, vectors.shape[1]))
    if most < 1 << 53:
        return (vectors.astype(np.float64) @ columns.astype(np.float64)).astype(np.int64)
    return vectors @ columns


def moved(dots: np.ndarray, vectors: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Dot products after the centroids changed by ``change``, from its nonzero components."""
    out = dots.copy()
    for cluster, own in enumerate(change):
        touched = np.flatnonzero(own)
        if len(touched):
            out[:, cluster] += product(vectors[:, touched], own[touched, None])[:, 0]
    return out


def nearest(vectors: np.ndarray, dots: np.ndarray, centroids: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smallest of several) and its squared distance."""
    gaps = (centroids * centroids).sum(axis=1) - 2 * dots
    cluster = gaps.argmin(axis=1)
    own = (vectors * vectors).sum(axis=1)
    return cluster, own + gaps[np.arange(len(vectors)), cluster]


def _written(df: DataFrame) -> DataFrame:
    path = work_path(df.sparkSession, "centroids")
    df.write.parquet(path)
    return df.sparkSession.read.schema(STATE).parquet(path)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """New centroids: exact floors of the means; tasks send one sum for each component."""
    clusters, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((clusters, width), np.int64), np.zeros(clusters, np.int64)
        for batch in batches:
            vectors = _rows(batch.column(0), width)
            cluster, _ = nearest(vectors, _rows(batch.column(1), clusters), centroids)
            order = np.argsort(cluster, kind="stable")
            present, first = np.unique(cluster[order], return_index=True)
            if len(present):
                totals[present] += np.add.reduceat(vectors[order], first, axis=0)
                counts += np.bincount(cluster, minlength=clusters)
        places = np.flatnonzero(np.repeat(counts > 0, width))
        yield pa.record_batch({
            "cluster": pa.array(places // width, pa.int32()),
            "component": pa.array(places % width, pa.int32()),
            "total": pa.array(totals.reshape(-1)[places]), "n": pa.array(counts[places // width])})

    sums = (state.select("v", "dots")
            .mapInArrow(run, "cluster int, component int, total bigint, n bigint")
            .groupBy("cluster", "component")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")))
    out = centroids.copy()
    for row in sums.collect():  # clusters x components numbers at most
        out[row["cluster"], row["component"]] = int(row["total"]) // row["n"]
    return out


def centroid_clusters(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS,
                      scale: int = SCALE, width: int = WIDTH, vec_id: str = "vec_id",
                      vector: str = "embedding") -> DataFrame:
    """Cluster vectors around centroids; see the module.

    The first centroids are the ``clusters`` vectors with the smallest SHA-256 of ``1:<vec_id>``
    (of rows with one id, those with the smallest components). A centroid without vectors stays.

    Returns vec_id, cluster, distance (squared), cluster_inertia and inertia (sums of distance
    over the cluster and over all), centroid_sha256 (of the final components, joined by commas).
    One row for each row that takes part: vectors that are null, of another length, or hold null
    or non-finite components are left out. Rows that repeat an id count one by one; a null id
    counts as an empty one. Fewer vectors than clusters make fewer clusters; an empty table
    gives no rows. Components beyond 2**27 after scaling are an error, as their distances do not
    fit 64 bits. Other columns are not read.
    """
    fit = (vectors.where(usable(F.col(vector)) & (F.size(vector) == width))
           .select(F.col(vec_id).cast("bigint").alias("vec_id"),
                   quantised(F.col(vector), scale).alias("v")))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    seeds = fit.orderBy(digest, "v").limit(clusters).collect()
    if not seeds:
        return vectors.sparkSession.createDataFrame(
            [], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, "
                "inertia bigint, centroid_sha256 string")
    centroids = np.array([row.v for row in seeds], np.int64)
    clusters = len(centroids)

    def begin(batches: Iterator[pa.RecordBatch], first=centroids) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _rows(batch.column(1), width)
            if len(own) and max(-int(own.min()), int(own.max())) > MOST:
                raise ValueError("the distances do not fit 64 bits")
            yield pa.record_batch([batch.column(0), batch.column(1), _lists(product(own, first.T))],
                                  ["vec_id", "v", "dots"])

    if np.abs(centroids.astype(float)).max() > MOST:
        raise ValueError("the distances do not fit 64 bits")
    state = _written(fit.mapInArrow(begin, STATE))
    for _ in range(rounds):
        new = _means(state, centroids)
        change = new - centroids

        def update(batches: Iterator[pa.RecordBatch], change=change) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dots = moved(_rows(batch.column(2), clusters), _rows(batch.column(1), width), change)
                yield pa.record_batch([batch.column(0), batch.column(1), _lists(dots)],
                                      ["vec_id", "v", "dots"])

        centroids = new
        if change.any():
            state = _written(state.mapInArrow(update, STATE))

    def assign(batches: Iterator[pa.RecordBatch], last=centroids) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = nearest(_rows(batch.column(1), width),
                                        _rows(batch.column(2), clusters), last)
            yield pa.record_batch([batch.column(0), pa.array(cluster, pa.int32()),
                                   pa.array(distance)], ["vec_id", "cluster", "distance"])

    assigned = state.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint")
    sums = {row.cluster: int(row.total) for row in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest()
               for row in centroids]
    place = F.col("cluster") + 1
    return assigned.select(
        "vec_id", "cluster", "distance",
        F.element_at(F.array(*[F.lit(sums.get(i, 0)).cast("bigint") for i in range(clusters)]), place)
        .alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("bigint").alias("inertia"),
        F.element_at(F.array(*map(F.lit, digests)), place).alias("centroid_sha256"))
