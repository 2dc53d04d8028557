"""Header events (M4) and their conversions: S5, P19, P21-P23, P31-P34, J3, A6.

A header event is ``headers MAP<STRING,STRING>`` plus ``body BINARY``. Every
operator is a narrow projection/explode or a broadcast join against a rule
table, except ``aggregate_events`` which is one partial+final aggregation.
Malformed input gets an ``error`` reason instead of being dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lines as L
from ..functions.lines import _c, java_double, parse_long
from ..sources.rules import RuleTable
from .aggregate import aggregates, picked

# Header keys and prefixes, the 2018-01-01 lower bound for
# nanosecond timestamps, and the JSON event size cap.
NAME_KEY = "name"
VALUE_KEY = "value_value"
TIMESTAMP_KEY = "timestamp"
TAG_PREFIX = "tag_"
VALUE_PREFIX = "value_"
MIN_TIMESTAMP_NS = 1514764800000000000
MAX_EVENT_BYTES = 65536


# --------------------------------------------------------------------------- S5 / P19
def parse_json_events(df: DataFrame, value_col: str = "value", delimiter: str = "\n", max_size: int = MAX_EVENT_BYTES) -> DataFrame:
    """Split delimited payloads into JSON events and read their ``headers`` object.

    Header values become strings with the outer quotes stripped (numbers keep
    their text, nested objects stay JSON text); the body is ignored. Events
    larger than ``max_size`` bytes or without a ``headers`` object get an error.
    """
    passthrough = [c for c in df.columns if c != value_col]
    pieces = F.split(F.col(value_col), "\\" + delimiter if delimiter in "\\^$.|?*+()[]{}" else delimiter)
    d = df.select(*passthrough, F.posexplode(pieces).alias("event_pos", "event")).filter(F.col("event") != "")
    parsed = F.from_json("event", "headers MAP<STRING,STRING>")
    d = d.withColumn("_p", parsed)
    error = (
        F.when(F.octet_length("event") > F.lit(max_size), F.lit("event over the size limit"))
        .when(F.col("_p").isNull() | F.col("_p.headers").isNull(), F.lit("no headers object"))
    )
    return d.select(
        *passthrough,
        "event_pos",
        F.when(error.isNull(), F.col("_p.headers")).alias("headers"),
        F.lit(b"").cast("binary").alias("body"),
        error.alias("error"),
        "event",
    )


# --------------------------------------------------------------------------- P22
def encode_value(v) -> Column:
    """LP value text of a header value: long -> ``<v>i``, double -> as is, else quoted."""
    v = _c(v)
    return (
        F.when(parse_long(v).isNotNull(), F.concat(v, F.lit("i")))
        .when(java_double(v).isNotNull(), v)
        .otherwise(F.concat(F.lit('"'), v, F.lit('"')))
    )


# --------------------------------------------------------------------------- P21
def events_to_lines(df: DataFrame, headers_col: str = "headers") -> DataFrame:
    """Header event -> LP record. ``name`` and at least one ``value_*`` key are required;
    ``timestamp``, when present, must be a long >= 2018-01-01 in ns. Tags and
    values are written sorted by key. Adds ``line`` and ``error``."""
    h = F.col(headers_col)
    keys = F.array_sort(F.map_keys(h))
    tag_keys = F.filter(keys, lambda k: k.startswith(TAG_PREFIX))
    val_keys = F.filter(keys, lambda k: k.startswith(VALUE_PREFIX))
    ts_txt = h[TIMESTAMP_KEY]
    ts = parse_long(ts_txt)
    error = (
        F.when(h.isNull(), F.lit("no headers"))
        .when(h[NAME_KEY].isNull(), F.lit("no name header"))
        .when(ts_txt.isNotNull() & ts.isNull(), F.lit("timestamp is not a long"))
        .when(ts < F.lit(MIN_TIMESTAMP_NS), F.lit("timestamp below the nanosecond range"))
        .when(F.size(val_keys) == 0, F.lit("no value fields"))
    )
    tags = F.array_join(
        F.transform(tag_keys, lambda k: F.concat(F.lit(","), F.substr(k, F.lit(len(TAG_PREFIX) + 1), F.length(k)), F.lit("="), h[k])),
        "",
    )
    vals = F.array_join(
        F.transform(
            val_keys,
            lambda k: F.concat(F.substr(k, F.lit(len(VALUE_PREFIX) + 1), F.length(k)), F.lit("="), encode_value(h[k])),
        ),
        ",",
    )
    ts_part = F.when(ts.isNull() | (ts == 0), F.lit("")).otherwise(F.concat(F.lit(" "), ts_txt))
    line = F.concat(h[NAME_KEY], tags, F.lit(" "), vals, ts_part)
    return df.withColumns({"line": F.when(error.isNull(), line), "error": error})


# --------------------------------------------------------------------------- P23 / P34
def pass_body(df: DataFrame, body_col: str = "body") -> DataFrame:
    """Pass the event body through as text; a null or empty body is an error (D14 fixed)."""
    b = F.col(body_col)
    error = F.when(b.isNull() | (F.octet_length(b) == 0), F.lit("empty body"))
    return df.withColumns({"payload": F.when(error.isNull(), F.decode(b, "UTF-8")), "error": error})


def drop_empty(df: DataFrame, col: str = "value") -> DataFrame:
    """Drop null or zero-length payloads."""
    return df.filter(F.col(col).isNotNull() & (F.octet_length(F.col(col)) > 0))


# --------------------------------------------------------------------------- P32
def metric_key(headers, remove=None) -> Column:
    """``name|tag_a:v,tag_b:v`` over header keys containing ``tag_``, sorted by key;
    ``|`` is removed from the name, ``:`` from keys, ``:`` and ``,`` from values."""
    h = _c(headers)
    if remove is not None:
        rm = _c(remove)
        h = F.map_filter(h, lambda k, v: ~F.coalesce(F.array_contains(rm, k), F.lit(False)))
    tag_keys = F.array_sort(F.filter(F.map_keys(h), lambda k: k.contains(TAG_PREFIX)))
    parts = F.transform(
        tag_keys,
        lambda k: F.concat(F.regexp_replace(k, ":", ""), F.lit(":"), F.regexp_replace(h[k], "[:,]", "")),
    )
    name = F.regexp_replace(h[NAME_KEY], r"\|", "")
    return F.when(F.size(parts) > 0, F.concat(name, F.lit("|"), F.array_join(parts, ","))).otherwise(name)


# --------------------------------------------------------------------------- P31 / J3
def event_points(df: DataFrame, rules: RuleTable, default: RuleTable | None = None, headers_col: str = "headers",
                 keep_unmatched: bool = False) -> DataFrame:
    """Header event -> points ``(fn, metric_key, value)``, one per configured function.

    J3: a metric's own rules apply; only a metric without any rule falls back
    to the ``default`` rule. Name and ``value_value`` are mandatory and the
    value must be a number (D9: otherwise an error row, not a crash).
    """
    h = F.col(headers_col)
    d = df.withColumns({"_name": h[NAME_KEY], "_dval": java_double(h[VALUE_KEY])})
    error = (
        F.when(F.col("_name").isNull(), F.lit("event has no name header"))
        .when(h[VALUE_KEY].isNull(), F.lit("event has no value header"))
        .when(F.col("_dval").isNull(), F.lit("value header is not numeric"))
    )
    if "error" in df.columns:
        error = F.coalesce(F.col("error"), error)
    d = d.withColumn("error", error)
    # a metric's first function (rules are known here): exactly one output row per input
    # event has ``event_first``, so event counts need no second pass
    first: dict[str, str] = {}
    for metric, fn_name, _ in rules.rows:
        first[metric] = min(fn_name, first.get(metric, fn_name))
    ranked = RuleTable(tuple((m, f, t, f == first[m]) for m, f, t in rules.rows),
                       T.StructType([*rules.schema.fields, T.StructField("rule_first", T.BooleanType(), False)]))
    r = ranked.df(df.sparkSession).select(F.col("metric").alias("_metric"), "fn", "remove_tags", F.col("rule_first").alias("_first"))
    j = d.join(r, F.col("_name") == F.col("_metric"), "left")
    if default is not None and len(default) > 0:
        _, dfn, drm = default.rows[0]
        fn = F.coalesce(F.col("fn"), F.lit(dfn))
        rm = F.when(F.col("fn").isNull(), F.array(*[F.lit(t) for t in drm]).cast("array<string>")).otherwise(F.col("remove_tags"))
    else:
        fn, rm = F.col("fn"), F.col("remove_tags")
    j = j.withColumns({"fn": fn, "remove_tags": rm, "event_first": F.coalesce(F.col("_first"), F.lit(True))})
    if not keep_unmatched:
        j = j.filter(F.col("fn").isNotNull() | F.col("error").isNotNull())
    return j.select(
        *[c for c in df.columns if c != "error"],
        F.when(F.col("error").isNull(), F.col("fn")).alias("fn"),
        F.when(F.col("error").isNull(), metric_key(h, F.col("remove_tags"))).alias("metric_key"),
        F.when(F.col("error").isNull(), F.col("_dval")).alias("value"),
        "error",
        *(["event_first"] if keep_unmatched else []),
    )


# --------------------------------------------------------------------------- A6
def aggregate_events(points: DataFrame, window: str = "30 seconds", time_col: str = "event_ts", watermark: str | None = None) -> DataFrame:
    """avg/sum/min/max per (window, fn, metric_key), one shuffle for all functions."""
    src = points.withWatermark(time_col, watermark) if watermark else points
    src = src.filter(F.col("error").isNull()) if "error" in src.columns else src
    g = src.groupBy(F.window(time_col, window).alias("window"), "fn", "metric_key").agg(*aggregates("value"))
    return g.select("fn", "metric_key", L.window_end_ns("window").alias("window_end_ns"), picked().alias("value"))


# --------------------------------------------------------------------------- P33
def points_to_json(df: DataFrame) -> DataFrame:
    """Aggregated point -> JSON event text ``{"headers":{name,value_<fn>,type_value,timestamp,tags..},"body":""}``.

    ``timestamp`` is the window end (D2 fixed); tag values are quoted (D3 fixed).
    """
    mk = F.col("metric_key")
    name = F.substring_index(mk, "|", 1)
    tag_part = F.when(mk.contains("|"), F.substr(mk, F.length(name) + 2, F.length(mk)))
    pieces = F.transform(F.split(tag_part, ","), lambda p: F.split(p, ":"))
    tag_entries = F.transform(pieces, lambda p: L.kv(p[0], F.try_element_at(p, F.lit(2))))
    fixed = F.array(
        L.kv("name", F.concat(name, F.lit("_aggr"))),
        L.kv(F.concat(F.lit("value_"), F.col("fn")), F.col("value").cast("string")),
        L.kv("type_value", F.lit("double")),
        L.kv("timestamp", F.col("window_end_ns").cast("string")),
    )
    entries = F.when(tag_part.isNull(), fixed).otherwise(F.concat(fixed, tag_entries))
    js = F.to_json(F.struct(F.map_from_entries(entries).alias("headers"), F.lit("").alias("body")))
    return df.withColumn("json", js)
