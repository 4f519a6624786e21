"""Projection, vector assembly and request validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskspark.functions import columns as C
from riskspark.spec import DEFAULT_VALUE, JobSpec

PLAIN_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns; unknown names are ignored."""
    return df.drop(*names)


def remaining_columns(df: DataFrame, dropped: Sequence[str]) -> list[str]:
    """Column names that are left after a drop, in table order."""
    return [c for c in df.columns if c not in set(dropped)]


def select_features(df: DataFrame, spec: JobSpec, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, then features and target in model order."""
    missing = [c for c in (*keep, *spec.kept) if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*keep, *spec.kept)


def assemble(df: DataFrame, features: Sequence[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """Feature vector column. A null or NaN is an error unless ``skip`` or ``keep`` is asked for."""
    return VectorAssembler(inputCols=list(features), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def vector_from_array(df: DataFrame, column: str, out: str = "features") -> DataFrame:
    """Vector column from an array column."""
    return df.withColumn(out, array_to_vector(F.col(column).cast("array<double>")))


def expand_vector(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Replace a vector column by one named column per element; another size is an error."""
    kept = [c for c in df.columns if c != column and c not in names]
    values = df.withColumn("_values", C.of_size(vector_to_array(column), len(names), column))
    return values.select(*kept, *[F.col("_values")[i].alias(n) for i, n in enumerate(names)])


def validate(df: DataFrame, features: Sequence[str], low: float | None = None,
             high: float | None = None) -> DataFrame:
    """Check that every feature is present, numeric and (optionally) within ``low..high``.

    Either bound may be left open. Text must be a plain decimal number, with or without an
    exponent: what a cast takes beside that (``5d``, ``Infinity``) is no number.

    Adds ``reason`` (all reasons as one text, empty for a good row) and ``ok``. A feature that the
    table lacks is missing in every row; columns beyond the features are left alone.
    """
    checks = []
    for f in features:
        raw = F.col(f) if f in df.columns else F.lit(None).cast("string")
        number = raw.try_cast("double")
        bad = number.isNull() | F.isnan(number)
        if f not in df.columns or isinstance(df.schema[f].dataType, StringType):
            bad = bad | ~F.trim(raw).rlike(PLAIN_NUMBER)
        check = F.when(raw.isNull(), f"missing: {f}").when(bad, f"not a number: {f}")
        outside = [number < low] * (low is not None) + [number > high] * (high is not None)
        for side in outside:
            check = check.when(side, f"out of range: {f}")
        checks.append(check)
    # concat_ws skips nulls and stays in generated code.
    return (df.withColumn("reason", F.concat_ws("; ", *checks))
            .withColumn("ok", F.col("reason") == ""))


def features_from_map(df: DataFrame, mapping: str, features: Sequence[str],
                      default: float = DEFAULT_VALUE) -> DataFrame:
    """One column per feature from a map column; a missing feature gets the default."""
    return df.withColumns({f: C.map_default(mapping, f, float(default)) for f in features})


def accepted(validated: DataFrame, features: Sequence[str]) -> DataFrame:
    """Good rows, with the features as doubles. A feature that the table lacks leaves no row."""
    return (validated.where("ok").drop("ok", "reason")
            .withColumns({f: (F.col(f) if f in validated.columns else F.lit(None)).cast("double")
                          for f in features}))


def rejected(validated: DataFrame) -> DataFrame:
    """Bad rows with all their reasons as one text."""
    return validated.where("not ok").drop("ok")
