"""Interpretation of scored rows: summary, top factors, feature groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions import columns as C
from riskspark.operators.reshape import to_long
from riskspark.spec import DEFAULT_ICON, JobSpec


def feature_dimension(spark: SparkSession, spec: JobSpec) -> DataFrame:
    """One row per catalogued feature; its size is fixed by the job specification."""
    rows = [(i, *entry) for i, entry in enumerate(spec.catalogue)]
    return spark.createDataFrame(rows, "pos int, feature string, icon string, grp string, "
                                       "min_value int, max_value int, help string")


def row_summary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add mean, extremes and the names of the extreme features, row by row."""
    return df.withColumns({
        "avg_value": C.row_mean(features),
        "max_value": C.row_max(features),
        "min_value": C.row_min(features),
        "max_feature": C.arg_max(features),
        "min_feature": C.arg_min(features),
    })


def with_metadata(long: DataFrame, spec: JobSpec) -> DataFrame:
    """Add icon and group of ``feature``; an unknown feature keeps a default icon."""
    dim = feature_dimension(long.sparkSession, spec).select("feature", "icon", "grp")
    return (long.join(F.broadcast(dim), "feature", "left")
            .withColumn("icon", F.coalesce("icon", F.lit(DEFAULT_ICON))))


def top_factors(df: DataFrame, ids: Sequence[str], spec: JobSpec, k: int = 5) -> DataFrame:
    """The ``k`` strongest features per row as rows ``(ids, rank, feature, value, bar, icon, grp)``.

    Ranking happens inside the row, so nothing is shuffled, and a feature's icon and group are
    literals looked up by its place, so nothing is joined.
    """
    known = {name: (icon, grp) for name, icon, grp, *_ in spec.catalogue}
    icons = F.array(*[F.lit(known.get(f, (DEFAULT_ICON, None))[0]) for f in spec.features])
    groups = F.array(*[F.lit(known.get(f, (DEFAULT_ICON, None))[1]).cast("string") for f in spec.features])
    ranked = df.select(*ids, F.posexplode(C.top_factors(spec.features, k)).alias("i", "f"))
    place = F.col("f.pos") + 1
    return ranked.select(*ids, (F.col("i") + 1).alias("rank"), "f.feature", "f.value",
                         C.factor_bar("f.value").alias("bar"),
                         F.element_at(icons, place).alias("icon"), F.element_at(groups, place).alias("grp"))


def group_features(df: DataFrame, ids: Sequence[str], spec: JobSpec, group: str) -> DataFrame:
    """The features of one group, in catalogue order, as rows ``(ids, pos, feature, value)``."""
    wanted = [name for name, _, grp, *_ in spec.catalogue if grp == group]
    dim = feature_dimension(df.sparkSession, spec).select("pos", "feature", "grp")
    return (to_long(df, ids, wanted).drop("pos")
            .join(F.broadcast(dim), "feature")
            .select(*ids, "pos", "feature", "grp", "value"))
