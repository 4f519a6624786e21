import zlib

import numpy as np
from pyspark.sql import functions as F

from riskspark.llm import quality


def test_held_out_scores(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.fit_and_score(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    mine = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in mine]) > 0.95


def test_held_out_labels_do_not_matter(documents, spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    a, b = (sorted(quality.fit_and_score(documents, x).collect()) for x in (labels, turned))
    assert np.allclose([r.score for r in a], [r.score for r in b], atol=1e-6)


def test_isotonic_rises():
    x = np.arange(7.0)
    at, value = quality.isotonic(x, np.array([0, 1, 0, 0, 1, 1, 0.0]), np.ones(7))
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    width = len(quality.STATISTICS)
    model = quality.Classifier(np.zeros(width), np.ones(width), rng.normal(0, 1 / 3, (width, 8192)),
                               rng.uniform(0, 2 * np.pi, 8192), np.zeros(8193), np.zeros(0), np.zeros(1))
    rows = rng.normal(0, 1, (20, width))
    waves = model.expand(rows)[:, :-1]
    kernel = np.exp(-((rows[:, None] - rows) ** 2).sum(2) / 18)
    assert np.abs(waves @ waves.T - kernel).max() < 0.06


def test_odd_rows(make_docs, odd, spark):
    docs = make_docs(odd, score="x", stats=1, label=2)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in quality.fit_and_score(docs, none).collect()} == {0.5}
    few = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (5, 1, 0), (7, 0, 0), (8, None, 0), (None, 1, 1),
                                 (9, 1, 0), (10, 0, 0), (11, 1, 0), (99, 1, 0)], none.schema)
    rows = quality.fit_and_score(docs, few).collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 for r in rows)
    kept = quality.keep_good(docs, few)
    assert kept.columns == docs.columns
    assert quality.fit_and_score(make_docs([]), few).collect() == []


def test_fit_equals_a_direct_solve(spark):
    """Ridge weights and calibration against plain ones on the collected rows."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    stats = quality.statistics_table(docs).checkpoint()
    model = quality.fit(stats, labels)
    texts = {r.doc_id: np.array(r.stats) for r in stats.collect()}
    fits = {True: [], False: []}
    calibrating = {r.doc_id: r.calibrates for r in quality.fit_table(stats, labels).collect()}
    for r in labels.collect():
        if r.quality is not None and zlib.crc32(str(r.doc_id).encode()) % 5 and r.doc_id in texts:
            fits[calibrating[r.doc_id]].append((texts[r.doc_id], float(r.quality)))
    x, y = map(np.array, zip(*fits[False], strict=True))
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, x.std(0), atol=1e-6)
    # Ridge as least squares over the rows with the root of the penalty beneath them.
    waves = model.expand(x)
    root = np.sqrt(quality.RIDGE * len(x) + 1e-9) * np.eye(waves.shape[1])[:-1]
    direct = np.linalg.lstsq(np.vstack([waves, root]), np.append(y, np.zeros(len(root))), rcond=None)[0]
    assert np.allclose(model.raw(x), waves @ direct, atol=1e-5)
    # The largest mean that starts at or before a place, of the smallest that end at or after it.
    x, y = map(np.array, zip(*fits[True], strict=True))
    at = np.floor((model.raw(x) + 1) / 3 * quality.BINS).clip(0, quality.BINS - 1)
    bins = np.unique(at)
    n = np.array([(at == b).sum() for b in bins])
    good = np.array([y[at == b].sum() for b in bins])
    rising = [max(min(good[j:k + 1].sum() / n[j:k + 1].sum() for k in range(i, len(bins)))
                  for j in range(i + 1)) for i in range(len(bins))]
    assert np.allclose(np.unique(np.round(model.values, 9)), np.unique(np.round(rising, 9)))


def test_hot_id_stays_bounded(spark):
    """A third of the texts and of the labels on one id: no product of the two."""
    rows = [(1, f"text number {i} of the hot id") for i in range(1000)]
    rows += [(i, f"Document {i}. It has two sentences.") for i in range(2, 2002)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(1, i % 2) for i in range(400)] + [(i, i % 2) for i in range(2, 802)],
                                   "doc_id bigint, quality int")
    stats = quality.statistics_table(docs).checkpoint()
    whole = quality.fit_table(stats, labels)
    ids = {i for i in range(2, 802) if zlib.crc32(str(i).encode()) % 5}
    got = [r.doc_id for r in whole.collect()]
    assert zlib.crc32(b"1") % 5 and {*got} == ids | {1} and got.count(1) <= 1000
    assert {r.label for r in whole.where("doc_id = 1").collect()} == {0.5}
    thin = quality.fit_table(stats, labels, fit_rows=200)
    assert 0 < thin.count() < 300
    assert len(quality.fit_and_score(docs, labels).collect()) == len(rows)
