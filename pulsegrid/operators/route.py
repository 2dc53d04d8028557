"""Router (P3-P5, J1): one LP input, three non-exclusive outputs.

* database: whole records whose measurement is listed (field list ignored, D4);
* onoff / aggregator: field rows matching (measurement, field or all fields),
  re-keyed to the internal form ``meas#field`` -> ``tags#value#ts``.

Records of measurements without a rule are left out first; the others are parsed once,
and all branches come out of one broadcast join against the rule table, so the router is
a map-only job (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lines as L
from ..sources.rules import RuleTable
from .aggregate import listed


def _rules(spark: SparkSession, rules: RuleTable, branches) -> DataFrame:
    return rules.df(spark).filter(F.col("branch").isin(list(branches)))


def semi_rules(fields: DataFrame, rules: DataFrame) -> DataFrame:
    """Keep field rows whose (measurement, field) has a rule; a null rule field is a wildcard.

    Equi key on measurement with a residual condition, so it stays a hash join.
    """
    r = rules.select(F.col("measurement").alias("_rm"), F.col("rule_field").alias("_rf"))
    cond = (F.col("measurement") == F.col("_rm")) & (F.col("_rf").isNull() | (F.col("field") == F.col("_rf")))
    return fields.join(r, cond, "left_semi")


def route_database(df: DataFrame, rules: RuleTable, value_col: str = "value") -> DataFrame:
    """Whole records whose measurement (up to first ``,`` or space) is listed."""
    r = _rules(df.sparkSession, rules, ["database"]).select(F.col("measurement").alias("_rm"))
    return df.join(r, L.measurement_of(F.col(value_col)) == F.col("_rm"), "left_semi")


def route_fields(df: DataFrame, rules: RuleTable, branch: str, value_col: str = "value") -> DataFrame:
    """Field rows for the ``onoff`` or ``aggregator`` branch, in internal wire form."""
    own = RuleTable(tuple(r for r in rules.rows if r[0] == branch), rules.schema)
    fields = L.explode_fields(listed(df, own, value_col), value_col)
    kept = semi_rules(fields, own.df(df.sparkSession))
    return L.encode_internal(kept)


def route(df: DataFrame, rules: RuleTable, topics: dict | None = None, value_col: str = "value", key_col: str | None = None) -> DataFrame:
    """P5: all branches at once -> ``branch, topic, key, value`` (+ passthrough columns).

    ``topics`` maps branch -> output topic (defaults to the branch name).
    """
    return routed(parsed(listed(df, rules, value_col), value_col, key_col), rules, topics)


def parsed(df: DataFrame, value_col: str = "value", key_col: str | None = None) -> DataFrame:
    """The field rows that ``routed`` takes, malformed ones with their ``error``."""
    return L.explode_fields(df.withColumnRenamed(key_col, "_src_key") if key_col else df, value_col, keep_bad=True)


def routed(x: DataFrame, rules: RuleTable, topics: dict | None = None) -> DataFrame:
    """``route`` of records that are parsed already."""
    topics = topics or {}
    r = rules.df(x.sparkSession).select(
        "branch", F.col("measurement").alias("_rm"), F.col("rule_field").alias("_rf")
    )
    whole = F.col("branch") == "database"
    cond = (F.col("measurement") == F.col("_rm")) & (
        (whole & (F.col("field_pos") == 0))
        | (~whole & F.col("error").isNull() & (F.col("_rf").isNull() | (F.col("field") == F.col("_rf"))))
    )
    j = x.join(r, cond, "inner")
    topic = F.col("branch")
    for b, t in topics.items():
        topic = F.when(F.col("branch") == b, F.lit(t)).otherwise(topic)
    wire = L.encode_internal(j)
    orig_key = F.col("_src_key") if "_src_key" in x.columns else F.lit(None).cast("string")
    made = ("line", "measurement", "tags", "field", "value", "ts_ns", "field_pos", "error")
    passthrough = [c for c in x.columns if c not in (*made, "_src_key", "branch", "topic", "key", "wire")]
    return wire.select(
        "branch",
        topic.alias("topic"),
        F.when(whole, orig_key).otherwise(F.col("key")).alias("key"),
        F.when(whole, F.col("line")).otherwise(F.col("wire")).alias("value"),
        *passthrough,
    )
