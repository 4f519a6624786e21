"""Small helpers for operators that work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType


def parts(batches: Iterable[pa.RecordBatch], rows: int = 512,
          size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into short ones, so that long texts never pile up in memory.

    A part has ``rows`` rows and ``size`` bytes of text at most, or one row.
    """
    for batch in batches:
        upto = np.zeros(batch.num_rows + 1, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                upto[1:] += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        upto = upto.cumsum()
        at = 0
        while at < batch.num_rows:
            fit = int(np.searchsorted(upto, upto[at] + size, "right")) - 1
            end = min(at + rows, max(at + 1, fit), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; a null is the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def with_fields(schema: StructType, *fields: tuple) -> StructType:
    """The schema without the named fields, then the named fields."""
    names = {f[0] for f in fields}
    return StructType([f for f in schema.fields if f.name not in names]
                      + [StructField(n, t, True) for n, t in fields])


def to_batch(columns: dict, schema: StructType) -> pa.RecordBatch:
    """A batch of the schema from arrays, lists or Arrow columns by name."""
    target = to_arrow_schema(schema)
    made = [columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
            for f in target]
    return pa.RecordBatch.from_arrays(
        [a if a.type == f.type else a.cast(f.type) for a, f in zip(made, target, strict=True)], schema=target)


def text_key(text: Column) -> Column:
    """32 bytes that tell texts apart; a null is the empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def same(left: Column, right: Column) -> Column:
    """Equality for join keys under which nulls meet nulls."""
    return left.eqNullSafe(right)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column has it (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def rows_of(df: DataFrame) -> int:
    """Number of rows (Parquet answers from its footers)."""
    return df.select(F.lit(1)).count()
