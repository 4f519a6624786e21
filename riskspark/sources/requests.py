"""Score requests: JSON rows in, response rows out, the feature catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions import columns as C
from riskspark.spec import JobSpec

CORRUPT = "_corrupt_record"


def request_schema(features: Sequence[str]) -> T.StructType:
    """Every feature as text, so that validation can name the bad ones; plus the corrupt text."""
    return T.StructType([*[T.StructField(f, T.StringType()) for f in features],
                         T.StructField(CORRUPT, T.StringType())])


def parse_requests(df: DataFrame, json_col: str, features: Sequence[str]) -> DataFrame:
    """Decode a JSON column into one column per feature.

    Missing fields become null, further fields are ignored, text that is no JSON object is
    kept in ``corrupt``.
    """
    parsed = F.from_json(json_col, request_schema(features),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return (df.withColumn("_request", parsed)
            .withColumns({f: F.col("_request")[f] for f in features})
            .withColumn("corrupt", F.col("_request")[CORRUPT]).drop("_request"))


def requests_to_df(df: DataFrame, values: str, features: Sequence[str]) -> DataFrame:
    """One column per feature from an ordered array of values; another size is an error."""
    sized = C.of_size(F.col(values), len(features), values)
    return df.select(*[c for c in df.columns if c != values],
                     *[sized[i].cast("double").alias(f) for i, f in enumerate(features)])


def response_json(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Response rows as JSON text, for a text or message sink."""
    return df.select(*ids, F.to_json(F.struct("prediction", "features_used", "status"))
                     .alias("response"))


def catalogue(df: DataFrame, spec: JobSpec, order: Sequence[str]) -> DataFrame:
    """What a model of this job expects, with the first row of a table as the sample input.

    Rows ``(pos, name, role, sample)``: features in model order, then target and dropped
    columns (position null).
    """
    names = [*spec.kept, *[c for c in spec.dropped if c in df.columns]]
    first = df.orderBy(*order).limit(1)
    entries = F.array(*[
        F.struct(F.lit(i if i < len(spec.features) else None).cast("int").alias("pos"),
                 F.lit(n).alias("name"),
                 F.lit("feature" if n in spec.features else
                       "target" if n == spec.target else "dropped").alias("role"),
                 F.col(n).cast("double").alias("sample"))
        for i, n in enumerate(names)])
    return first.select(F.lit(len(spec.features)).alias("feature_count"), F.inline(entries))
