"""Quality scores: random Fourier features of document statistics, ridge, isotonic calibration.

Each text becomes a row of statistics (shares of letters, capitals, signs, repeats and so on).
Random cosine features of the standardised statistics approximate a Gaussian kernel. Every
partition of the labelled rows sums its normal equations; the sum of those gives ridge weights.
Other labelled rows calibrate the raw scores by an isotonic step function.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, StructField,
                               StructType)

from riskspark.llm.arrow import parts, texts, to_batch, with_fields
from riskspark.session import shared_dir

#: The fit reads at most about this many labelled rows, taken by hash of the id.
FIT_ROWS = 200_000
FEATURES = 256
#: About the root of the number of statistics, the usual distance of standardised rows.
BANDWIDTH = 5.0
RIDGE = 1e-4
SEED = 42
KEEP_FROM = 0.3
FOLDS = 5
BINS = 4096
FIT_PARTITIONS = 16

STATISTICS = ("log_bytes", "upper", "lower", "digit", "space", "signs", "other_bytes", "stops",
              "sign_kinds", "sign_pairs", "log_word", "long_words", "short_words", "distinct_words",
              "top_word", "word_repeats", "sign_words", "capital_words", "shouted_words", "log_lines",
              "line_repeats", "stop_lines", "byte_entropy", "echoes")
_UPPER = np.zeros(256, bool); _UPPER[65:91] = True
_LOWER = np.zeros(256, bool); _LOWER[97:123] = True
_DIGIT = np.zeros(256, bool); _DIGIT[48:58] = True
_SPACE = np.zeros(256, bool); _SPACE[[9, 10, 11, 12, 13, 32]] = True
_OTHER = np.zeros(256, bool); _OTHER[128:] = True
_SIGN = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _OTHER)
_STOPS = [ord(c) for c in ".,;:"]
_SIGN_PAIR = re.compile(rb"[!-+\-/<-@\[-`{-~]{2,}")
_SHOUTED = re.compile(r"[^\W\d_a-z]{2,}")


def statistics(text: str) -> list[float]:
    """The numbers that stand for a text; an empty text has zeros."""
    raw = text.encode()
    n = len(raw)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts / n
    words = text.split()
    w = max(1, len(words))
    tally: dict[str, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = text.split("\n")
    signs = share[_SIGN]
    seen = share[share > 0]
    letters = max(1, int(counts[_UPPER].sum() + counts[_LOWER].sum()))
    return [
        np.log1p(n), float(counts[_UPPER].sum()) / letters, float(share[_LOWER].sum()),
        float(share[_DIGIT].sum()), float(share[_SPACE].sum()), float(signs.sum()),
        float(share[_OTHER].sum()), float(share[_STOPS].sum()), float((signs > 0.004).sum()) / 8,
        sum(map(len, _SIGN_PAIR.findall(raw))) / n, float(np.log1p(lengths.mean())) if len(words) else 0.0,
        float((lengths > 14).sum()) / w, float((lengths < 3).sum()) / w, len(tally) / w,
        max(tally.values(), default=0) / w, 1 - len(tally) / w if w > 50 else 0.0,
        sum(c for t, c in tally.items() if not any(map(str.isalnum, t[:1] + t[-1:]))) / w,
        sum(c for t, c in tally.items() if t[:1].isupper()) / w,
        sum(c for t, c in tally.items() if t.isupper() and len(t) > 1) / w,
        float(np.log1p(len(lines))), 1 - len(set(lines)) / len(lines),
        sum(x.rstrip().endswith((".", "!", "?", "…")) for x in lines) / len(lines),
        float(-(seen * np.log2(seen)).sum()), sum(map(eq, words, words[1:])) / w]


@dataclass
class Classifier:
    """Standardisation, random features, ridge weights and the steps of the calibration."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    values: np.ndarray

    def expand(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(rows), 1))])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.expand(rows) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.edges):
            return np.full(len(rows), self.values[0])
        return np.interp(self.raw(rows), self.edges, self.values)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that a fit must not learn from: crc32 of the id's text leaves 0 by five."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % FOLDS == 0, F.lit(False))


def statistics_table(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The id and ``stats`` of every row."""
    schema = StructType([docs.schema[doc_id], StructField("stats", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            yield to_batch({doc_id: batch.column(0), "stats": list(map(statistics, texts(batch)))},
                           schema)

    return docs.select(doc_id, "text").mapInArrow(run, schema)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over x in order: block centres and their rising means."""
    blocks: list[list[float]] = []  # mean, weight, sum of weight * x
    for a, b, w in zip(x, y, weight, strict=True):
        blocks.append([float(b), float(w), float(a * w)])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, x2 = blocks.pop()
            m1, w1, x1 = blocks.pop()
            blocks.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, x1 + x2])
    return (np.array([b[2] / b[1] for b in blocks]), np.array([b[0] for b in blocks]))


def _matrix(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    column = batch.column("stats")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def _summed(rows: DataFrame, of) -> np.ndarray | None:
    """The sum over partitions of one array each; only FIT_PARTITIONS of them come back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(_matrix(batch), batch.column("label").to_numpy())
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [np.ascontiguousarray(total).tobytes()]})

    few = rows.coalesce(FIT_PARTITIONS)
    parts_ = [np.frombuffer(r.sums) for r in few.mapInArrow(run, "sums binary").collect()]
    return sum(parts_) if parts_ else None


def fit_labels(labels: DataFrame, doc_id: str = "doc_id", label: str = "quality",
               fit_rows: int = FIT_ROWS, seed: int = SEED) -> DataFrame:
    """About ``fit_rows`` labelled ids at most that a fit may learn from, with their mean ``label``."""
    named = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id))
             .groupBy(doc_id).agg(F.avg(F.col(label).cast("double")).alias("label")))
    part = min(1.0, fit_rows / max(1, named.count()))
    turn = F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << 30))
    return (named.where(turn < int(part * (1 << 30)))
            .select(doc_id, "label"))


def fit_table(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality",
              fit_rows: int = FIT_ROWS, seed: int = SEED) -> DataFrame:
    """What a fit reads: ``doc_id, stats, label, calibrates``, about ``fit_rows`` rows at most.

    An id has one label, the mean of its labels; its rows with equal statistics count once. The
    labels, one for each of about ``fit_rows`` ids, go to every task. If ids repeat, their rows
    are thinned out by a hash of id and statistics, and dealt out by the same.
    """
    chosen = F.broadcast(fit_labels(labels, doc_id, label, fit_rows, seed))
    calibrates = F.pmod(F.xxhash64(doc_id, F.lit(seed + 1)), F.lit(4)) == 0
    rows = (stats.join(chosen, doc_id)
            .select(doc_id, "stats", "label", calibrates.alias("calibrates"))
            .dropDuplicates([doc_id, "stats"])
            .repartition(FIT_PARTITIONS, F.xxhash64(doc_id, "stats")).checkpoint())
    part = min(1.0, fit_rows / max(1, rows.count()))
    turn = F.pmod(F.xxhash64(doc_id, "stats", F.lit(seed + 2)), F.lit(1 << 30))
    return rows.where(turn < int(part * (1 << 30)))


def fit(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality",
        fit_rows: int = FIT_ROWS, features: int = FEATURES, ridge: float = RIDGE,
        seed: int = SEED) -> Classifier:
    """Learn from the labelled rows that are not held out, ``fit_rows`` of them by hash at most.

    A quarter of the rows calibrates, the others fit. Null labels, ids and rows without a match
    do not count; repeated labels are averaged (see ``fit_table``). Without rows every score is
    0.5, and with one class alone the scores are that class.
    """
    width = len(STATISTICS)
    rng = np.random.default_rng(seed)
    blank = Classifier(np.zeros(width), np.ones(width), np.zeros((width, features)),
                       np.zeros(features), np.zeros(features + 1), np.zeros(0), np.array([0.5]))
    rows = fit_table(stats, labels, doc_id, label, fit_rows, seed)
    fits, calibrates = rows.where("NOT calibrates"), rows.where("calibrates")
    sums = _summed(fits, lambda x, y: np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)]))
    if sums is None:
        return blank
    mean = sums[1:width + 1] / sums[0]
    deviation = np.sqrt(np.maximum(sums[width + 1:] / sums[0] - mean ** 2, 0))
    model = Classifier(mean, np.where(deviation > 1e-9, deviation, 1.0),
                       rng.normal(0, 1 / BANDWIDTH, (width, features)),
                       rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1),
                       np.zeros(0), np.array([0.5]))

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        waves = model.expand(x)
        return np.hstack([waves.T @ waves, (waves.T @ y)[:, None]])

    sums = _summed(fits, normal).reshape(features + 1, features + 2)
    gram, right = sums[:, :-1], sums[:, -1]
    penalty = np.eye(features + 1) * ridge * max(1.0, float(gram[-1, -1]))
    penalty[-1, -1] = 0
    model.weights = np.linalg.solve(gram + penalty + np.eye(features + 1) * 1e-9, right)

    def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.clip(((model.raw(x) + 1) / 3 * BINS).astype(np.int64), 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, BINS)])

    sums = _summed(calibrates, binned)
    if sums is not None:
        filled = np.flatnonzero(sums[:BINS])
        centres = (filled + 0.5) / BINS * 3 - 1
        model.edges, values = isotonic(centres, sums[BINS:][filled] / sums[:BINS][filled],
                                       sums[:BINS][filled])
        model.values = np.clip(values, 0, 1)
    return model


def score(docs: DataFrame, model: Classifier, keep_from: float = KEEP_FROM) -> DataFrame:
    """All columns, then ``score`` (0 to 1) and ``predicted`` (1 from ``keep_from`` on).

    Null and empty texts are scored by their statistics, all zero. Columns of these names are
    replaced.
    """
    schema = with_fields(docs.schema, ("score", DoubleType()), ("predicted", IntegerType()))
    plain = [c for c in docs.columns if c not in ("score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            if not batch.num_rows:
                continue
            scores = model.scores(np.array(list(map(statistics, texts(batch)))))
            yield to_batch({c: batch.column(c) for c in plain}
                           | {"score": scores, "predicted": (scores >= keep_from).astype(np.int32)},
                           schema)

    return docs.select(*plain).mapInArrow(run, schema)


def score_table(stats: DataFrame, model: Classifier, doc_id: str = "doc_id",
                keep_from: float = KEEP_FROM) -> DataFrame:
    """Scores from a table of statistics: the id, held_out, score, predicted."""
    schema = StructType([stats.schema[doc_id], StructField("held_out", BooleanType()),
                         StructField("score", DoubleType()), StructField("predicted", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = model.scores(_matrix(batch))
            yield to_batch({doc_id: batch.column(doc_id), "held_out": batch.column("held_out"),
                            "score": scores, "predicted": (scores >= keep_from).astype(np.int32)},
                           schema)

    return stats.withColumn("held_out", held_out(doc_id)).mapInArrow(run, schema)


def fit_and_score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
                  label: str = "quality") -> DataFrame:
    """Fit on the labelled documents and score all: the id, held_out, score, predicted."""
    shared_dir(docs.sparkSession)
    stats = statistics_table(docs, doc_id).checkpoint()
    return score_table(stats, fit(stats, labels, doc_id, label), doc_id)


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality",
              keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents predicted good, with all their columns. The texts are read twice, not moved.

    Only the ids of the rows that the fit reads, about ``FIT_ROWS`` at most, go to every task.
    """
    shared_dir(docs.sparkSession)
    wanted = F.broadcast(fit_labels(labels, doc_id, label).select(doc_id).distinct())
    stats = statistics_table(docs.join(wanted, doc_id, "left_semi"), doc_id).checkpoint()
    scored = score(docs, fit(stats, labels, doc_id, label), keep_from)
    return scored.where("predicted = 1").select(*docs.columns)
