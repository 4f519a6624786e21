"""Interpretation of rows and what-if scenarios."""

from pyspark.sql import functions as F

from checks.register import check
from checks.tables import FX, FX_FEATURES, FX_SQL, RX_SQL, fx, rx
from riskspark.functions import columns as C
from riskspark.operators import explain, reshape, scenario
from riskspark.spec import FEATURE_CATALOGUE, REGIONAL

RX_LONG_SQL = (f"{RX_SQL},\nlong AS (SELECT id, unnest(["
               + ", ".join(f"{{'pos': {i}, 'feature': '{f}', 'value': CAST(\"{f}\" AS DOUBLE)}}"
                           for i, f in enumerate(REGIONAL.features))
               + "], recursive := true) FROM rx)")
DIM_SQL = ("dim AS (SELECT * FROM (VALUES "
           + ", ".join(f"({i}, '{n}', '{icon}', '{g}')"
                       for i, (n, icon, g, *_) in enumerate(FEATURE_CATALOGUE))
           + ") t(pos, feature, icon, grp))")
ALL = ", ".join(f'"{f}"' for f in REGIONAL.features)


@check(f"""WITH {RX_LONG_SQL} SELECT id, round(sum(value) / 17, 6) AS avg_value,
  max(value) AS max_value, min(value) AS min_value,
  arg_max(feature, value * 100 - pos) AS max_feature,
  arg_min(feature, value * 100 + pos) AS min_feature FROM long GROUP BY id""")
def row_summary(spark, sf_dir):
    out = explain.row_summary(rx(spark, sf_dir), REGIONAL.features)
    return out.select("id", F.round("avg_value", 6).alias("avg_value"), "max_value", "min_value",
                      "max_feature", "min_feature")


@check(f"""WITH {RX_LONG_SQL} SELECT avg_text, count(*) AS n FROM (
  SELECT printf('%.1f', sum(value) / 17) AS avg_text FROM long GROUP BY id) GROUP BY 1""")
def average_text_report(spark, sf_dir):
    text = C.fixed_text(C.row_mean(REGIONAL.features), 1)
    return rx(spark, sf_dir).groupBy(text.alias("avg_text")).agg(F.count("*").alias("n"))


@check(f"""WITH {RX_LONG_SQL}, {DIM_SQL}, ranked AS (SELECT *, row_number()
    OVER (PARTITION BY id ORDER BY value DESC, pos) AS rank FROM long)
SELECT id, CAST(rank AS INTEGER) AS rank, feature, value, value / 10 * 100 AS bar, icon, grp
FROM ranked JOIN dim USING (feature) WHERE rank <= 5""")
def top_factors(spark, sf_dir):
    return explain.top_factors(rx(spark, sf_dir), ["id"], REGIONAL)


@check(f"""WITH {RX_LONG_SQL}, {DIM_SQL} SELECT id, dim.pos, feature, grp, value
           FROM long JOIN dim USING (feature) WHERE grp = 'Infrastructure'""")
def group_features(spark, sf_dir):
    return explain.group_features(rx(spark, sf_dir), ["id"], REGIONAL, "Infrastructure")


@check(f"""WITH {FX_SQL}, long AS (UNPIVOT (SELECT id, l_quantity, l_tax, y FROM fx)
             ON l_quantity, l_tax, y INTO NAME feature VALUE value)
SELECT feature, CASE feature WHEN 'l_quantity' THEN 'q' WHEN 'l_tax' THEN 't' ELSE '•' END AS icon,
  CASE feature WHEN 'l_quantity' THEN 'Order' WHEN 'l_tax' THEN 'Terms' END AS grp,
  count(*) AS n, round(sum(value), 2) AS total FROM long GROUP BY feature""")
def feature_metadata(spark, sf_dir):
    long = reshape.to_long(fx(spark, sf_dir), ["id"], ["l_quantity", "l_tax", "y"])
    return (explain.with_metadata(long, FX).groupBy("feature", "icon", "grp")
            .agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")))


@check(f"""WITH {FX_SQL} SELECT id, scenario,
  CASE scenario WHEN 'one piece' THEN 1.0 ELSE l_quantity END AS l_quantity, l_extendedprice,
  CASE scenario WHEN 'full price' THEN 0.0 ELSE l_discount END AS l_discount,
  CASE scenario WHEN 'full price' THEN 0.08 ELSE l_tax END AS l_tax
FROM fx, (VALUES ('full price'), ('one piece'), ('nothing')) s(scenario)""")
def expand_scenarios(spark, sf_dir):
    out = scenario.expand_scenarios(fx(spark, sf_dir), ["id"], FX)
    return out.withColumns({c: F.col(c).cast("double") for c in FX_FEATURES})


def _overrides() -> str:
    cases = []
    for f in REGIONAL.features:
        whens = "".join(f" WHEN '{s}' THEN {o[f]}" for s, o in REGIONAL.scenarios.items() if f in o)
        cases.append(f'CASE scenario{whens} ELSE "{f}" END')
    return " + ".join(cases)


@check(f"""WITH {RX_SQL} SELECT scenario, count(*) AS n, CAST(sum({_overrides()}) AS BIGINT) AS total
FROM rx, (VALUES ('Low Risk Area'), ('Urban Flood Zone'), ('Coastal High Risk'),
          ('Rural Monsoon Zone')) s(scenario) GROUP BY scenario""")
def scenario_report(spark, sf_dir):
    out = scenario.expand_scenarios(rx(spark, sf_dir), ["id"], REGIONAL)
    total = sum((F.col(f) for f in REGIONAL.features[1:]), F.col(REGIONAL.features[0]))
    return out.groupBy("scenario").agg(F.count("*").alias("n"),
                                       F.sum(total).cast("bigint").alias("total"))


@check(f"""WITH {RX_SQL} SELECT 'predict:[' || concat_ws(',', {', '.join(
    f"CAST({c} AS VARCHAR) || '.0'" for c in ALL.split(', '))}) || ']' AS key, id FROM rx""")
def reuse_key(spark, sf_dir):
    return rx(spark, sf_dir).select(C.reuse_key(REGIONAL.features).alias("key"), "id")
