"""Windowed aggregation of field rows.

The reference runs one repartition + store per function. Here the rule join
tags each row with its function(s), and a single ``groupBy(window, fn, series)``
computes every function in one shuffle. Spark's partial aggregation combines
map-side, so a hot series costs one buffer row per map task, not one per record.
The same function serves batch and streaming; streaming only adds the watermark.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lines as L
from ..sources.rules import RuleTable

GRACE = "10 seconds"  # fixed grace for late records


def listed(lines: DataFrame, rules: RuleTable, value_col: str = "value") -> DataFrame:
    """Records whose measurement has a rule: what no rule wants is left out before its fields
    are parsed."""
    m = rules.measurements(lines.sparkSession).select(F.col("measurement").alias("_rm"))
    return lines.join(m, L.measurement_of(F.col(value_col)) == F.col("_rm"), "left_semi")


def join_rules(fields: DataFrame, rules: RuleTable) -> DataFrame:
    """Inner join on (measurement, field); one output row per matching function."""
    r = rules.df(fields.sparkSession).select(
        F.col("fn"), F.col("measurement").alias("_rm"), F.col("field").alias("_rf"), "remove_tags"
    )
    cond = (F.col("measurement") == F.col("_rm")) & (F.col("field") == F.col("_rf"))
    return fields.join(r, cond, "inner").drop("_rm", "_rf")


def prepare(fields: DataFrame, rules: RuleTable) -> DataFrame:
    """Rule match, tag removal (P7), numeric coercion (P8, non-numeric rows dropped), series key."""
    j = join_rules(fields, rules)
    return (
        j.withColumns(
            {
                "tags": L.remove_tags("tags", "remove_tags"),
                "dvalue": L.to_double("value"),
            }
        )
        .filter(F.col("dvalue").isNotNull())
        .withColumn("series", L.series_key("measurement", "tags", "field"))
    )


def aggregates(value: str) -> list[Column]:
    """The four aggregates that ``picked`` chooses from."""
    return [F.avg(value).alias("_avg"), F.sum(value).alias("_sum"), F.min(value).alias("_min"), F.max(value).alias("_max")]


def picked() -> Column:
    """The aggregate named by ``fn`` (null for another name; rule loading refuses those)."""
    return _pick(F.col("fn"), F.col("_avg"), F.col("_sum"), F.col("_min"), F.col("_max"))


def _pick(fn: Column, avg_c, sum_c, min_c, max_c) -> Column:
    return (
        F.when(fn == "avg", avg_c)
        .when(fn == "sum", sum_c)
        .when(fn == "min", min_c)
        .when(fn == "max", max_c)
    )


def aggregate(
    fields: DataFrame,
    rules: RuleTable,
    window: str = "30 seconds",
    time_col: str = "event_ts",
    watermark: str | None = None,
) -> DataFrame:
    """A5: all configured functions in one pass.

    Output: ``fn, series, window_end_ns, value, key, line`` where ``line`` is the
    aggregate LP record (P11) and ``key`` the series key.
    """
    src = fields.withWatermark(time_col, watermark) if watermark else fields
    p = prepare(src, rules)
    g = p.groupBy(F.window(time_col, window).alias("window"), "fn", "series").agg(*aggregates("dvalue"))
    value = picked()
    end_ns = L.window_end_ns("window")
    return g.select(
        "fn",
        "series",
        end_ns.alias("window_end_ns"),
        value.alias("value"),
        F.col("series").alias("key"),
        L.render_aggregate(F.col("series"), F.col("fn"), value, end_ns).alias("line"),
    )


def union_all(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)
