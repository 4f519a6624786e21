"""Column expressions for features, scores and serving times.

All of them are built-in Spark functions, so they run in generated JVM code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskspark.spec import BANDS, COOLDOWN_SECONDS, OVERFIT_GAP, UNDERFIT_R2


def _c(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ---- scores -------------------------------------------------------------------------------

def link(score: str | Column, kind: str = "identity") -> Column:
    """``identity`` keeps a score, ``sigmoid`` maps it to 1 / (1 + e^-x); e^-x may saturate."""
    score = _c(score)
    if kind == "identity":
        return score
    if kind == "sigmoid":
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))
    raise ValueError(f"unknown link {kind!r}")


def linear_score(columns: Sequence[str | Column], weights: Sequence[float],
                 intercept: float) -> Column:
    """Dot product over columns plus intercept, as one arithmetic expression."""
    if len(columns) != len(weights):
        raise ValueError(f"{len(columns)} columns but {len(weights)} weights")
    total = F.lit(0.0)
    for column, weight in zip(columns, weights):
        total = total + _c(column).cast("double") * F.lit(float(weight))
    return total + F.lit(float(intercept))


def dot(left: str | Column, right: str | Column) -> Column:
    """Dot product of two arrays of double."""
    return F.aggregate(F.zip_with(_c(left), _c(right), lambda x, w: x * w),
                       F.lit(0.0), lambda acc, x: acc + x)


def _band_case(score: Column, position: int, bands: Sequence[tuple]) -> Column:
    result = F.when(score.isNull(), F.lit(None).cast("string"))
    for row, following in zip(bands, bands[1:]):
        result = result.when(score < following[0], row[position])
    return result.otherwise(bands[-1][position])


def risk_band(score: str | Column, bands: Sequence[tuple] = BANDS) -> Column:
    """Band of a score. Null has no band; NaN falls into the last one."""
    return _band_case(_c(score), 1, bands)


def risk_advice(score: str | Column, bands: Sequence[tuple] = BANDS) -> Column:
    """Advice text of a score's band."""
    return _band_case(_c(score), 2, bands)


def fit_status(train_r2: str | Column, test_r2: str | Column) -> Column:
    """``overfit`` for a large gap, else ``underfit`` for a low test R2, else ``good``."""
    train_r2, test_r2 = _c(train_r2), _c(test_r2)
    return (F.when(train_r2 - test_r2 > OVERFIT_GAP, "overfit")
            .when(test_r2 < UNDERFIT_R2, "underfit")
            .otherwise("good"))


def overfit_gap(train_r2: str | Column, test_r2: str | Column) -> Column:
    """The gap of an overfitted model, else null."""
    gap = _c(train_r2) - _c(test_r2)
    return F.when(gap > OVERFIT_GAP, gap)


def percent(score: str | Column) -> Column:
    """Score as a percentage, never above 100."""
    return F.least(_c(score) * 100, F.lit(100.0))


def factor_bar(value: str | Column, top: float = 10.0) -> Column:
    """Length of a factor bar in percent of the top of its scale."""
    return _c(value) / F.lit(top) * 100


def fixed_text(value: str | Column, places: int) -> Column:
    """Number as text with a fixed number of decimals and no thousands separator."""
    return F.format_string(f"%.{places}f", _c(value).cast("double"))


# ---- features of one row ------------------------------------------------------------------

def feature_array(features: Sequence[str]) -> Column:
    return F.array(*[F.col(f).cast("double") for f in features])


def row_mean(features: Sequence[str]) -> Column:
    total = F.lit(0.0)
    for f in features:
        total = total + F.col(f).cast("double")
    return total / F.lit(len(features))


def row_max(features: Sequence[str]) -> Column:
    values = [F.col(f).cast("double") for f in features]
    return F.greatest(*values) if len(values) > 1 else values[0]


def row_min(features: Sequence[str]) -> Column:
    values = [F.col(f).cast("double") for f in features]
    return F.least(*values) if len(values) > 1 else values[0]


def _name_at(features: Sequence[str], value: Column) -> Column:
    names = F.array(*[F.lit(f) for f in features])
    return F.try_element_at(names, F.nullif(F.array_position(feature_array(features), value),
                                            F.lit(0)).cast("int"))


def arg_max(features: Sequence[str]) -> Column:
    """Name of the largest feature; the first in order wins a tie."""
    return _name_at(features, row_max(features))


def arg_min(features: Sequence[str]) -> Column:
    """Name of the smallest feature; the first in order wins a tie."""
    return _name_at(features, row_min(features))


def top_factors(features: Sequence[str], k: int = 5) -> Column:
    """The ``k`` largest features, best first, ties in feature order.

    Array of ``struct(rank_value, pos, feature, value)``, sorted inside the row in generated code.
    """
    entries = F.array(*[
        F.struct((-F.col(f).cast("double")).alias("rank_value"), F.lit(i).alias("pos"),
                 F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"))
        for i, f in enumerate(features)])
    return F.slice(F.sort_array(entries), 1, k)


def reuse_key(features: Sequence[str], prefix: str = "predict:") -> Column:
    """Canonical text of the ordered feature vector; equal vectors have equal keys."""
    return F.concat(F.lit(prefix), F.to_json(feature_array(features)))


def merge_maps(base: str | Column, overrides: str | Column) -> Column:
    """Entries of ``base`` replaced or extended by those of ``overrides``."""
    return F.map_zip_with(_c(base), _c(overrides), lambda _k, old, new: F.coalesce(new, old))


def map_default(mapping: str | Column, key: str, default) -> Column:
    """Value of a key, or the default when the key (or its value) is missing."""
    return F.coalesce(F.try_element_at(_c(mapping), F.lit(key)), F.lit(default))


# ---- repeatable pseudo-random numbers -------------------------------------------------------

def hash_number(key: str | Column, salt: str | int | None = None, start: int = 1) -> Column:
    """32 bits of the md5 of ``salt:key`` as a bigint; the same on every engine and partitioning."""
    text = _c(key).cast("string")
    if salt is not None:
        text = F.concat_ws(":", F.lit(str(salt)), text)
    return F.conv(F.substring(F.md5(text), start, 8), 16, 10).cast("bigint")


def split_name(key: str | Column, test_size: float, seed: int) -> Column:
    """``train`` or ``test`` by the leading 32 hash bits of the key."""
    limit = f"{int((1.0 - test_size) * 2**32):08x}"
    digest = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), _c(key).cast("string"))), 1, 8)
    return F.when(digest < limit, "train").otherwise("test")


def fold_number(key: str | Column, folds: int) -> Column:
    """Fold 0..folds-1 from hash bits that the split does not use."""
    return (hash_number(key, start=9) % folds).cast("int")


# ---- times --------------------------------------------------------------------------------

def micros(ts: str | Column) -> Column:
    """Event time as microseconds; takes timestamps with and without time zone."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def timestamp_text(ts: str | Column) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


def remaining_seconds(now_us: str | Column, since_us: str | Column,
                      wait: int = COOLDOWN_SECONDS) -> Column:
    """Whole seconds of a wait that are left, 0 when it is over or never began."""
    left = (F.lit(float(wait)) - (_c(now_us) - _c(since_us)) / F.lit(1e6)).cast("int")
    return F.coalesce(F.greatest(left, F.lit(0)), F.lit(0))


def short_text(value: str | Column, length: int = 200) -> Column:
    return F.substring(_c(value), 1, length)


def of_size(values: Column, size: int, name: str) -> Column:
    """An array of exactly ``size`` elements; a null stays null, any other size is an error."""
    found = F.concat(F.lit(f"{name} holds "), F.size(values).cast("string"),
                     F.lit(f" values where {size} are named"))
    return F.when(values.isNull() | (F.size(values) == size), values).otherwise(F.raise_error(found))
