"""Monitoring snapshots (P27-P30, S7, S8): landed JSON documents -> LP records.

A monitoring dict is ``{measurement, tags, fields, time}``. JSON is read as
VARIANT so a value keeps its JSON type (int / float / bool / string), which
decides the LP encoding. Everything is a Column expression over one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import typed as TY
from ..functions.lines import _c, kv, parse_long

WEEK_S = 7 * 24 * 60 * 60

# The four Spark-status shapes (measurement, excluded keys, tag keys).
SPARK_KINDS = {
    "stats": ("spark_streaming_stats", ["startTime"], []),
    "batches": ("spark_streaming_batch", ["batchId", "batchTime"], ["status"]),
    "executors": ("spark_active_executors", ["id", "hostPort", "executorLogs"], ["isActive", "isBlacklisted"]),
    "allexecutors": ("spark_all_executors", ["id", "hostPort", "executorLogs"], ["isActive", "isBlacklisted"]),
}


# --------------------------------------------------------------------------- P30
def to_nanos(ts, now_s) -> Column:
    """Epoch time in s, ms, µs or ns -> ns, choosing the unit whose ±7 days window
    around ``now_s`` contains the value; null when none does (D15)."""
    t = _c(ts).cast("bigint")
    now = _c(now_s) if isinstance(now_s, Column) else F.lit(now_s)
    lo = (now - F.lit(WEEK_S)).cast("bigint")
    hi = (now + F.lit(WEEK_S)).cast("bigint")
    out = None
    for f in (1_000_000_000, 1_000_000, 1_000, 1):
        div = 1_000_000_000 // f
        cond = (t >= lo * F.lit(div)) & (t < hi * F.lit(div))
        out = F.when(cond, t * F.lit(f)) if out is None else out.when(cond, t * F.lit(f))
    return out


# --------------------------------------------------------------------------- value typing
def py_float_text(d) -> Column:
    """Python ``str(float)``: plain in [1e-4, 1e16), else ``1.5e-05`` / ``1e+16`` style."""
    d = _c(d)
    a = F.abs(d)
    s = a.cast("string")
    mant = F.regexp_replace(F.substring_index(s, "E", 1), r"\.0$", "")
    exp = F.substring_index(s, "E", -1).cast("int")
    exp_txt = F.concat(F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")), F.lpad(F.abs(exp).cast("string"), 2, "0"))
    sci = F.concat(F.when(d < 0, F.lit("-")).otherwise(F.lit("")), mant, F.lit("e"), exp_txt)
    return (
        F.when(F.isnan(d), F.lit("nan"))
        .when(d == float("inf"), F.lit("inf"))
        .when(d == float("-inf"), F.lit("-inf"))
        .when((a == 0) | ((a >= 1e-4) & (a < 1e16)), TY.plain_double(d))
        .otherwise(sci)
    )


def variant_value(x: Column) -> Column:
    """VARIANT -> typed value struct (kind long/double/boolean/string; other JSON -> null)."""
    t = F.schema_of_variant(x)
    kind = (
        F.when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit("long"))
        .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), F.lit("double"))
        .when(t == "BOOLEAN", F.lit("boolean"))
        .when(t == "STRING", F.lit("string"))
    )
    return F.when(
        kind.isNotNull(),
        F.struct(
            kind.alias("kind"),
            F.when(kind == "long", F.try_variant_get(x, "$", "bigint")).alias("l"),
            F.when(kind == "double", F.try_variant_get(x, "$", "double")).alias("d"),
            F.when(kind == "boolean", F.try_variant_get(x, "$", "boolean")).alias("b"),
            F.when(kind == "string", F.try_variant_get(x, "$", "string")).alias("s"),
        ),
    )


def py_value_text(v: Column) -> Column:
    """LP text of a typed value as the Python sender writes it."""
    return (
        F.when(v["kind"] == "long", F.concat(v["l"].cast("string"), F.lit("i")))
        .when(v["kind"] == "double", py_float_text(v["d"]))
        .when(v["kind"] == "boolean", F.when(v["b"], F.lit("true")).otherwise(F.lit("false")))
        .when(v["kind"] == "string", F.concat(F.lit('"'), v["s"], F.lit('"')))
    )


def py_str(x: Column) -> Column:
    """Python ``str()`` of a JSON scalar (booleans as ``True``/``False``)."""
    t = F.schema_of_variant(x)
    return F.when(t == "BOOLEAN", F.when(F.try_variant_get(x, "$", "boolean"), F.lit("True")).otherwise(F.lit("False"))).otherwise(
        F.try_variant_get(x, "$", "string")
    )


def py_int(x: Column) -> Column:
    """Python ``int()`` of a JSON scalar: numbers truncate, booleans 1/0, strings must be integers."""
    t = F.schema_of_variant(x)
    return (
        F.when(t == "STRING", parse_long(F.trim(F.try_variant_get(x, "$", "string"))))
        .when(t == "BOOLEAN", F.try_variant_get(x, "$", "boolean").cast("bigint"))
        .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT", "BIGINT", "INT", "SMALLINT", "TINYINT"),
              F.try_variant_get(x, "$", "bigint"))
    )


def _long_value(l: Column) -> Column:
    return F.struct(F.lit("long").alias("kind"), l.alias("l"), F.lit(None).cast("double").alias("d"),
                    F.lit(None).cast("boolean").alias("b"), F.lit(None).cast("string").alias("s"))


# --------------------------------------------------------------------------- P27
def parse_measurement_dict(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Monitoring dict JSON -> ``measurement, tags, fields, time`` (typed fields)."""
    v = F.try_parse_json(F.col(value_col))
    fields = F.try_variant_get(v, "$.fields", "map<string,variant>")
    return df.withColumns(
        {
            "measurement": F.try_variant_get(v, "$.measurement", "string"),
            "tags": F.try_variant_get(v, "$.tags", "map<string,string>"),
            "fields": F.map_filter(F.transform_values(fields, lambda k, x: variant_value(x)), lambda k, x: x.isNotNull()),
            "time": F.try_variant_get(v, "$.time", "bigint"),
        }
    )


def measurements_to_lines(df: DataFrame, now_s) -> DataFrame:
    """Dict columns -> LP ``line``; measurement and fields are required, tags
    and fields are written sorted by key, ``time`` goes through ``to_nanos``."""
    tags = F.array_join(
        F.transform(F.array_sort(F.map_entries(F.coalesce("tags", F.create_map().cast("map<string,string>")))),
                    lambda e: F.concat(F.lit(","), e["key"], F.lit("="), e["value"])),
        "",
    )
    fields = F.array_join(
        F.transform(F.array_sort(F.map_entries("fields")), lambda e: F.concat(e["key"], F.lit("="), py_value_text(e["value"]))),
        ",",
    )
    ns = to_nanos(F.col("time"), now_s)
    error = (
        F.when(F.col("measurement").isNull() | F.col("fields").isNull(), F.lit("measurement or fields missing"))
        .when(F.col("time").isNotNull() & ns.isNull(), F.lit("cannot infer the time unit"))
    )
    ts = F.when(F.col("time").isNull(), F.lit("")).otherwise(F.concat(F.lit(" "), ns.cast("string")))
    line = F.concat(F.col("measurement"), tags, F.lit(" "), fields, ts)
    return df.withColumns({"line": F.when(error.isNull(), line), "error": error})


# --------------------------------------------------------------------------- P28
def agent_points(df: DataFrame, value_col: str = "value", name_col: str = "name", endpoint_col: str = "endpoint",
                 time_col: str = "sampled_ns") -> DataFrame:
    """Agent metrics ``{component: {Type, key: "number"}}`` -> one dict per component:
    measurement ``flume_<Type>``, tags hostname/endpoint/component, numeric fields
    (D16: values are typed by parsing, never evaluated; non-numbers are dropped)."""
    comps = F.try_variant_get(F.try_parse_json(F.col(value_col)), "$", "map<string,map<string,string>>")
    d = df.select("*", F.explode(comps).alias("component", "_m"))
    m = F.col("_m")
    def num(s):
        return F.when(parse_long(s).isNotNull(), _long_value(parse_long(s))).when(
            s.try_cast("double").isNotNull(),
            F.struct(F.lit("double").alias("kind"), F.lit(None).cast("bigint").alias("l"), s.try_cast("double").alias("d"),
                     F.lit(None).cast("boolean").alias("b"), F.lit(None).cast("string").alias("s")),
        )
    fields = F.map_filter(F.transform_values(F.map_filter(m, lambda k, v: k != "Type"), lambda k, v: num(v)), lambda k, v: v.isNotNull())
    tags = F.map_from_arrays(
        F.array(F.lit("hostname"), F.lit("endpoint"), F.lit("component")),
        F.array(F.col(name_col), F.col(endpoint_col), F.col("component")),
    )
    return d.withColumns(
        {
            "measurement": F.when(m["Type"].isNotNull(), F.concat(F.lit("flume_"), m["Type"])),
            "tags": tags,
            "fields": fields,
            "time": F.col(time_col),
        }
    ).drop("_m")


# --------------------------------------------------------------------------- P29
def spark_points(df: DataFrame, kind: str, value_col: str = "value", app_col: str = "app_id",
                 time_col: str = "sampled_ns") -> DataFrame:
    """Spark-status JSON object -> dict for one of ``stats``, ``batches``,
    ``executors``, ``allexecutors`` (all rows of one kind)."""
    out = spark_points_mixed(df.withColumn("_kind", F.lit(kind)), "_kind", value_col, app_col, time_col)
    return out.drop("_kind")


def _kind_map(values: dict, dtype: str) -> Column:
    parts = []
    for k, v in values.items():
        parts.append(F.lit(k))
        parts.append(F.array(*[F.lit(x) for x in v]).cast(dtype) if isinstance(v, list) else F.lit(v))
    return F.create_map(*parts)


def spark_points_mixed(df: DataFrame, kind_col: str = "kind", value_col: str = "value", app_col: str = "app_id",
                       time_col: str = "sampled_ns") -> DataFrame:
    """Spark-status JSON objects of mixed kinds (``kind_col`` per row) -> dicts, in one
    projection, so one scan serves all four shapes: excluded keys dropped first
    (D12), tag keys become tags, nested objects are flattened one level (executor
    kinds), other values ``int()``. A value that is not an integer, or an unknown
    kind, makes the row an error (``error`` column)."""
    kind = F.col(kind_col)
    # per-row parameters and the parsed object are columns, so lambdas refer to attributes
    d = df.withColumns(
        {
            "_obj": F.try_variant_get(F.try_parse_json(F.col(value_col)), "$", "map<string,variant>"),
            "_meas": F.element_at(_kind_map({k: v[0] for k, v in SPARK_KINDS.items()}, "string"), kind),
            "_ex": F.element_at(_kind_map({k: v[1] for k, v in SPARK_KINDS.items()}, "array<string>"), kind),
            "_tk": F.element_at(_kind_map({k: v[2] for k, v in SPARK_KINDS.items()}, "array<string>"), kind),
            "_exec": kind.isin("executors", "allexecutors"),
        }
    )
    obj, ex, tk, is_exec = F.col("_obj"), F.col("_ex"), F.col("_tk"), F.col("_exec")
    kept = F.filter(F.map_entries(obj), lambda e: ~F.coalesce(F.array_contains(ex, e["key"]), F.lit(False)))
    is_obj = lambda e: is_exec & F.schema_of_variant(e["value"]).startswith("OBJECT")
    is_tag = lambda e: F.coalesce(F.array_contains(tk, e["key"]), F.lit(False))
    tag_e = F.filter(kept, is_tag)
    plain = F.filter(kept, lambda e: ~is_tag(e) & ~is_obj(e))
    nested = F.flatten(
        F.transform(
            F.filter(kept, lambda e: ~is_tag(e) & is_obj(e)),
            lambda e: F.map_entries(F.try_variant_get(e["value"], "$", "map<string,variant>")),
        )
    )
    ints = F.transform(F.concat(plain, nested), lambda e: F.struct(e["key"].alias("k"), py_int(e["value"]).alias("v")))
    d = d.withColumn("_ints", TY.last_wins_map(ints, "bigint"))
    bad = F.exists(F.map_values("_ints"), lambda v: v.isNull())
    fields = F.transform_values("_ints", lambda k, v: _long_value(v))
    base = F.array(
        F.struct(F.lit("id").alias("k"), F.col(app_col).alias("v")),
        F.struct(F.lit("hostPort").alias("k"), F.when(is_exec, F.try_variant_get(obj["hostPort"], "$", "string")).alias("v")),
    )
    more = F.transform(tag_e, lambda e: F.struct(e["key"].alias("k"), py_str(e["value"]).alias("v")))
    tags = TY.last_wins_map(F.filter(F.concat(base, more), lambda e: e["v"].isNotNull()), "string")
    time = F.when(kind == "batches", F.try_variant_get(obj["batchId"], "$", "bigint") * F.lit(1_000_000)).otherwise(F.col(time_col))
    return d.withColumns(
        {
            "measurement": F.col("_meas"),
            "tags": tags,
            "fields": F.when(~bad, fields),
            "time": time,
            "error": F.when(F.col("_meas").isNull(), F.lit("unknown kind"))
            .when(obj.isNull(), F.lit("not a JSON object"))
            .when(bad, F.lit("value is not an integer")),
        }
    ).drop("_obj", "_ints", "_meas", "_ex", "_tk", "_exec")
