"""Query catalogue: one Spark query per operator, plus the DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)``, reads the driver tables through
``fixtures`` and returns a DataFrame (nothing is collected). The oracles
compute the expected answer directly from ``events`` (never by parsing the
LP text), so parsing is really tested. Doubles that come out of arithmetic
are rounded to 4 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lines as L
from ..operators import aggregate as A
from ..operators import change as C
from ..operators import route as R
from ..sources import rules as RU
from . import configs
from . import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ----------------------------------------------------------------------------- SQL fragments
EV = """ev AS (
  SELECT event_id, event_type, user_id, user_id % 4 AS shard, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         epoch_ns(ts) AS ts_ns, ts
  FROM events)"""

TAGS = "'user=u' || CAST(user_id AS VARCHAR) || ',shard=s' || CAST(shard AS VARCHAR)"
LINE = (
    "event_type || ',' || " + TAGS + " || ' value=' || CAST(value AS VARCHAR) || ',k=' || CAST(k AS VARCHAR)"
    " || 'i,bad=' || CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END || ' ' || CAST(ts_ns AS VARCHAR)"
)

FIELDS = (
    EV
    + """,
f AS (
  SELECT event_id AS src_offset, shard AS src_partition, event_type AS measurement, user_id, shard, """
    + TAGS
    + """ AS tags,
         'value' AS field, CAST(value AS VARCHAR) AS value, value AS dvalue, ts_ns, ts FROM ev
  UNION ALL
  SELECT event_id, shard, event_type, user_id, shard, """
    + TAGS
    + """, 'k', CAST(k AS VARCHAR) || 'i', CAST(k AS DOUBLE), ts_ns, ts FROM ev
  UNION ALL
  SELECT event_id, shard, event_type, user_id, shard, """
    + TAGS
    + """, 'bad', CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END, NULL, ts_ns, ts FROM ev)"""
)

SERIES = "measurement || ',' || tags || '#' || field"


def _agg_rules_sql(fns) -> str:
    """The aggregator rule set as a VALUES table with keep flags for the two tags."""
    rows = []
    for fn, meas, field, remove in RU.agg_rules(configs.AGGREGATOR).rows:
        if fn in fns:
            rows.append(
                f"('{fn}', '{meas}', '{field}', {str('user' not in remove).upper()}, {str('shard' not in remove).upper()})"
            )
    return "r(fn, rm, rf, keep_user, keep_shard) AS (VALUES " + ", ".join(rows) + ")"


def _agg_sql(fns, lines: bool = False) -> str:
    hour = 3_600_000_000_000
    base = (
        "WITH "
        + FIELDS
        + ", "
        + _agg_rules_sql(fns)
        + """,
j AS (
  SELECT r.fn, f.measurement || CASE
           WHEN keep_user AND keep_shard THEN ',user=u' || CAST(user_id AS VARCHAR) || ',shard=s' || CAST(shard AS VARCHAR)
           WHEN keep_user THEN ',user=u' || CAST(user_id AS VARCHAR)
           WHEN keep_shard THEN ',shard=s' || CAST(shard AS VARCHAR)
           ELSE '' END || '#' || f.field AS series,
         f.dvalue, (f.ts_ns // """
        + str(hour)
        + " + 1) * "
        + str(hour)
        + """ AS window_end_ns
  FROM f JOIN r ON f.measurement = r.rm AND f.field = r.rf
  WHERE f.dvalue IS NOT NULL),
g AS (
  SELECT fn, series, window_end_ns,
         CASE fn WHEN 'avg' THEN avg(dvalue) WHEN 'sum' THEN sum(dvalue)
                 WHEN 'min' THEN min(dvalue) ELSE max(dvalue) END AS value
  FROM j GROUP BY fn, series, window_end_ns)
"""
    )
    if lines:
        return base + "SELECT fn, series AS key, replace(series, '#', ' ') || '_' || fn AS head, " + R4("value") + " AS value, window_end_ns FROM g"
    return base + "SELECT fn, series, window_end_ns, " + R4("value") + " AS value FROM g"


# ----------------------------------------------------------------------------- helpers
def _fields(spark, sf_dir) -> DataFrame:
    return L.explode_fields(fx.lines(spark, sf_dir))


def _agg(spark, sf_dir, fns) -> DataFrame:
    rules = RU.agg_rules(configs.AGGREGATOR)
    rules = RU.RuleTable(tuple(r for r in rules.rows if r[0] in fns), rules.schema)
    window = f"{RU.agg_window_seconds(configs.AGGREGATOR)} seconds"
    return A.aggregate(L.explode_fields(A.listed(fx.lines(spark, sf_dir), rules)), rules, window=window)


def round4(c) -> "F.Column":
    """4-decimal rounding that is stable under last-bit summation noise: round to 9
    decimals first, then HALF_UP to 4 in DECIMAL (same recipe as ``R4`` in SQL)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(F.round(c, 9).cast("decimal(38,9)"), 4).cast("double")


def R4(x: str) -> str:
    return f"CAST(round(CAST(round({x}, 9) AS DECIMAL(38,9)), 4) AS DOUBLE)"


def _round_value(df: DataFrame) -> DataFrame:
    return df.select("fn", "series", "window_end_ns", round4("value").alias("value"))


# ----------------------------------------------------------------------------- S1 P1 P2
@register(
    "explode_fields",
    "WITH " + FIELDS + " SELECT src_offset, measurement, tags, field, value, ts_ns FROM f",
)
def q_explode_fields(spark, sf_dir):
    return _fields(spark, sf_dir).select("src_offset", "measurement", "tags", "field", "value", "ts_ns")


@register(
    "internal_roundtrip",
    "WITH "
    + FIELDS
    + """ SELECT src_offset, measurement || '#' || field AS key,
  tags || '#' || value || '#' || CAST(ts_ns AS VARCHAR) AS wire, measurement, tags, field, value, ts_ns FROM f""",
)
def q_internal_roundtrip(spark, sf_dir):
    enc = L.encode_internal(_fields(spark, sf_dir)).select("src_offset", "key", "wire")
    return L.decode_internal(enc).select("src_offset", "key", "wire", "measurement", "tags", "field", "value", "ts_ns")


# ----------------------------------------------------------------------------- P3 P4 P5 J1
@register(
    "route_database",
    "WITH " + EV + " SELECT event_id AS src_offset, " + LINE + " AS value FROM ev WHERE event_type IN ('click', 'purchase')",
)
def q_route_database(spark, sf_dir):
    rules = RU.router_rules(configs.ROUTER)
    return R.route_database(fx.lines(spark, sf_dir), rules).select("src_offset", "value")


_ONOFF_SQL = (
    "WITH "
    + FIELDS
    + """ SELECT src_offset, measurement || '#' || field AS key,
  tags || '#' || value || '#' || CAST(ts_ns AS VARCHAR) AS value FROM f
  WHERE (measurement = 'view' AND field = 'value') OR measurement = 'error'"""
)
_AGGR_SQL = (
    "WITH "
    + FIELDS
    + """ SELECT src_offset, measurement || '#' || field AS key,
  tags || '#' || value || '#' || CAST(ts_ns AS VARCHAR) AS value FROM f
  WHERE (measurement = 'click' AND field IN ('value', 'k')) OR (measurement = 'purchase' AND field = 'value')"""
)


@register("route_onoff", _ONOFF_SQL)
def q_route_onoff(spark, sf_dir):
    rules = RU.router_rules(configs.ROUTER)
    return R.route_fields(fx.lines(spark, sf_dir), rules, "onoff").select("src_offset", "key", F.col("wire").alias("value"))


@register("route_aggregator", _AGGR_SQL)
def q_route_aggregator(spark, sf_dir):
    rules = RU.router_rules(configs.ROUTER)
    return R.route_fields(fx.lines(spark, sf_dir), rules, "aggregator").select(
        "src_offset", "key", F.col("wire").alias("value")
    )


_TOPICS = {"database": "db-out", "onoff": "onoff-out", "aggregator": "aggr-out"}


@register(
    "route_all",
    "WITH "
    + FIELDS
    + """,
db AS (SELECT 'database' AS branch, 'db-out' AS topic, CAST(NULL AS VARCHAR) AS key, """
    + LINE
    + """ AS value, event_id AS src_offset
       FROM ev WHERE event_type IN ('click', 'purchase')),
oo AS (SELECT 'onoff' AS branch, 'onoff-out' AS topic, measurement || '#' || field AS key,
         tags || '#' || value || '#' || CAST(ts_ns AS VARCHAR) AS value, src_offset FROM f
       WHERE (measurement = 'view' AND field = 'value') OR measurement = 'error'),
ag AS (SELECT 'aggregator', 'aggr-out', measurement || '#' || field,
         tags || '#' || value || '#' || CAST(ts_ns AS VARCHAR), src_offset FROM f
       WHERE (measurement = 'click' AND field IN ('value', 'k')) OR (measurement = 'purchase' AND field = 'value'))
SELECT * FROM db UNION ALL SELECT * FROM oo UNION ALL SELECT * FROM ag""",
)
def q_route_all(spark, sf_dir):
    rules = RU.router_rules(configs.ROUTER)
    return R.route(fx.lines(spark, sf_dir), rules, _TOPICS).select("branch", "topic", "key", "value", "src_offset")


# ----------------------------------------------------------------------------- P6 P7 J2
_ALL_FNS = ("avg", "sum", "min", "max")
_MATCH_BASE = "WITH " + FIELDS + ", " + _agg_rules_sql(_ALL_FNS)


@register(
    "match_rules",
    _MATCH_BASE + " SELECT r.fn, f.measurement, f.field, f.src_offset, f.value FROM f JOIN r ON f.measurement = r.rm AND f.field = r.rf",
)
def q_match_rules(spark, sf_dir):
    j = A.join_rules(_fields(spark, sf_dir), RU.agg_rules(configs.AGGREGATOR))
    return j.select("fn", "measurement", "field", "src_offset", "value")


@register(
    "remove_tags",
    _MATCH_BASE
    + """ SELECT r.fn, f.measurement, f.field, CASE
           WHEN keep_user AND keep_shard THEN f.tags
           WHEN keep_user THEN 'user=u' || CAST(user_id AS VARCHAR)
           WHEN keep_shard THEN 'shard=s' || CAST(shard AS VARCHAR)
           ELSE '' END AS tags, f.src_offset
  FROM f JOIN r ON f.measurement = r.rm AND f.field = r.rf""",
)
def q_remove_tags(spark, sf_dir):
    j = A.join_rules(_fields(spark, sf_dir), RU.agg_rules(configs.AGGREGATOR))
    return j.select("fn", "measurement", "field", L.remove_tags("tags", "remove_tags").alias("tags"), "src_offset")


# ----------------------------------------------------------------------------- P8 P9 P10
@register(
    "numeric_coercion",
    "WITH " + FIELDS + " SELECT src_offset, measurement, field, dvalue FROM f WHERE dvalue IS NOT NULL",
)
def q_numeric_coercion(spark, sf_dir):
    f = _fields(spark, sf_dir).select("src_offset", "measurement", "field", L.to_double("value").alias("dvalue"))
    return f.filter(F.col("dvalue").isNotNull())


@register("series_keys", "WITH " + FIELDS + " SELECT src_offset, field, " + SERIES + " AS series FROM f")
def q_series_keys(spark, sf_dir):
    return _fields(spark, sf_dir).select("src_offset", "field", L.series_key("measurement", "tags", "field").alias("series"))


@register(
    "render_lines",
    "WITH " + FIELDS + " SELECT src_offset, field, measurement || ',' || tags || ' ' || field || '=' || value || ' ' || CAST(ts_ns AS VARCHAR) AS line FROM f",
)
def q_render_lines(spark, sf_dir):
    f = _fields(spark, sf_dir)
    return f.select("src_offset", "field", L.render_line("measurement", "tags", "field", "value", "ts_ns").alias("line"))


# ----------------------------------------------------------------------------- A1-A5 P11 T1 U1
for _fn in _ALL_FNS:

    def _make(fn):
        def q(spark, sf_dir):
            return _round_value(_agg(spark, sf_dir, (fn,)))

        q.__name__ = f"q_agg_{fn}"
        return q

    register(f"agg_{_fn}", _agg_sql((_fn,)))(_make(_fn))


@register("agg_multi", _agg_sql(_ALL_FNS))
def q_agg_multi(spark, sf_dir):
    return _round_value(_agg(spark, sf_dir, _ALL_FNS))


@register("agg_lines", _agg_sql(_ALL_FNS, lines=True))
def q_agg_lines(spark, sf_dir):
    """P11 for all functions; the parts are read back from the rendered line."""
    part = lambda i: F.regexp_extract("line", r"^(.*)=([^= ]+) (-?[0-9]+)$", i)
    return _agg(spark, sf_dir, _ALL_FNS).select("fn", "key", part(1).alias("head"), round4(part(2).cast("double")).alias("value"),
                                                part(3).cast("bigint").alias("window_end_ns"))


# ----------------------------------------------------------------------------- W1 W2 W3
@register(
    "changes",
    "WITH "
    + FIELDS
    + """, s AS (SELECT *, """
    + SERIES
    + """ AS series FROM f),
l AS (SELECT *, lag(value) OVER (PARTITION BY series ORDER BY src_partition, src_offset) AS prev FROM s)
SELECT series, src_offset, value,
  measurement || ',' || tags || ' ' || field || '=' || value || ' ' || CAST(ts_ns AS VARCHAR) AS line
FROM l WHERE prev IS NULL OR prev <> value""",
)
def q_changes(spark, sf_dir):
    return C.changes(_fields(spark, sf_dir)).select("series", "src_offset", "value", "line")


@register(
    "latest",
    "WITH "
    + FIELDS
    + ", s AS (SELECT *, "
    + SERIES
    + """ AS series FROM f)
SELECT series, arg_max(value, src_offset) AS value, max(src_offset) AS src_offset, count(*) AS n_rows
FROM s GROUP BY series""",
)
def q_latest(spark, sf_dir):
    return C.latest(_fields(spark, sf_dir)).select("series", "value", "src_offset", "n_rows")


_DAY = 86_400_000_000_000


@register(
    "refresh_daily",
    "WITH "
    + FIELDS
    + ", s AS (SELECT *, "
    + SERIES
    + f""" AS series FROM f),
b AS (SELECT series, (ts_ns // {_DAY} + 1) * {_DAY} AS tick,
        arg_max(measurement || ',' || tags || ' ' || field || '=' || value, src_offset) AS body,
        arg_max(value, src_offset) AS value
      FROM s GROUP BY series, tick),
lt AS (SELECT max(tick) AS last_tick FROM b),
g AS (SELECT series, unnest(range(min(tick), (SELECT last_tick FROM lt) + {_DAY}, {_DAY})) AS tick_ns FROM b GROUP BY series)
SELECT g.series, g.tick_ns, b.value, b.body || ' ' || CAST(g.tick_ns AS VARCHAR) AS line
FROM g ASOF JOIN b ON g.series = b.series AND g.tick_ns >= b.tick""",
)
def q_refresh_daily(spark, sf_dir):
    return C.refresh(_fields(spark, sf_dir), 86400).select("series", "tick_ns", "value", "line")


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: LP records -> field rows -> rule join -> hourly avg/sum/min/max lines."""
    rules = RU.agg_rules(configs.AGGREGATOR)
    window = f"{RU.agg_window_seconds(configs.AGGREGATOR)} seconds"
    return A.aggregate(_fields(spark, sf_dir), rules, window=window)


# ----------------------------------------------------------------------------- P12-P17 P20
from ..functions import typed as TY  # noqa: E402

_SORTED_HEAD = "event_type || ',shard=s' || CAST(shard AS VARCHAR) || ',user=u' || CAST(user_id AS VARCHAR)"
_BAD_TXT = "CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END"


def _points(spark, sf_dir) -> DataFrame:
    return fx.lines(spark, sf_dir).select("src_offset", TY.parse_line("value").alias("p"))


@register(
    "typed_parse",
    "WITH "
    + FIELDS
    + """ SELECT src_offset, measurement, 'u' || CAST(user_id AS VARCHAR) AS tag_user, 's' || CAST(shard AS VARCHAR) AS tag_shard,
  field, CASE field WHEN 'value' THEN 'double' WHEN 'k' THEN 'long' ELSE 'boolean' END AS kind,
  CASE WHEN field = 'k' THEN CAST(dvalue AS BIGINT) END AS l,
  CASE WHEN field = 'value' THEN dvalue END AS d,
  CASE WHEN field = 'bad' THEN value = 'true' END AS b,
  CAST(NULL AS VARCHAR) AS s, ts_ns FROM f""",
)
def q_typed_parse(spark, sf_dir):
    p = _points(spark, sf_dir)
    e = p.select("src_offset", "p", F.explode(F.map_entries("p.fields")).alias("e"))
    return e.select(
        "src_offset",
        F.col("p.measurement").alias("measurement"),
        F.col("p.tags")["user"].alias("tag_user"),
        F.col("p.tags")["shard"].alias("tag_shard"),
        F.col("e.key").alias("field"),
        "e.value.kind",
        "e.value.l",
        "e.value.d",
        "e.value.b",
        "e.value.s",
        F.col("p.ts_ns").alias("ts_ns"),
    )


@register(
    "typed_render",
    "WITH " + EV + " SELECT event_id AS src_offset, " + _SORTED_HEAD + " || ' bad=' || " + _BAD_TXT
    + " || ',k=' || CAST(k AS VARCHAR) || 'i,value=' || CAST(value AS VARCHAR) || ' ' || CAST(ts_ns AS VARCHAR) AS line FROM ev",
)
def q_typed_render(spark, sf_dir):
    return _points(spark, sf_dir).select("src_offset", TY.format_line("p").alias("line"))


@register(
    "drop_non_numeric",
    "WITH " + EV + " SELECT event_id AS src_offset, " + _SORTED_HEAD
    + " || ' k=' || CAST(k AS VARCHAR) || 'i,value=' || CAST(value AS VARCHAR) || ' ' || CAST(ts_ns AS VARCHAR) AS line FROM ev",
)
def q_drop_non_numeric(spark, sf_dir):
    return _points(spark, sf_dir).select("src_offset", TY.format_line(TY.drop_non_numeric("p")).alias("line"))


@register(
    "split_fields",
    "WITH " + EV + """, s AS (
  SELECT event_id, 'value' AS field, 'value=' || CAST(value AS VARCHAR) AS fv, """ + _SORTED_HEAD + """ AS head, ts_ns FROM ev
  UNION ALL SELECT event_id, 'k', 'k=' || CAST(k AS VARCHAR) || 'i', """ + _SORTED_HEAD + """, ts_ns FROM ev
  UNION ALL SELECT event_id, 'bad', 'bad=' || """ + _BAD_TXT + """, """ + _SORTED_HEAD + """, ts_ns FROM ev)
SELECT event_id AS src_offset, field, head || ' ' || fv || ' ' || CAST(ts_ns AS VARCHAR) AS line FROM s""",
)
def q_split_fields(spark, sf_dir):
    p = _points(spark, sf_dir).select("src_offset", F.explode(TY.split_fields("p")).alias("q"))
    return p.select(
        "src_offset", F.map_keys("q.fields")[0].alias("field"), TY.format_line("q").alias("line")
    )


@register(
    "triples",
    "WITH " + EV + """ SELECT event_id AS src_offset, """ + _SORTED_HEAD + """ || '|value' AS key, value, 'avg' AS fn FROM ev
UNION ALL SELECT event_id, """ + _SORTED_HEAD + """ || '|k', CAST(k AS DOUBLE), 'avg' FROM ev""",
)
def q_triples(spark, sf_dir):
    t = _points(spark, sf_dir).select("src_offset", F.explode(TY.triples("p", "avg")).alias("t"))
    return t.select("src_offset", "t.key", "t.value", "t.fn")


@register(
    "edit_point",
    "WITH " + EV + " SELECT event_id AS src_offset, event_type || ',dc=eu,shard=s' || CAST(shard AS VARCHAR) || ',user=u' || CAST(user_id AS VARCHAR)"
    + " || ' bad=' || " + _BAD_TXT + " || ',k=' || CAST(k AS VARCHAR) || 'i,n=1i,value=' || CAST(value AS VARCHAR)"
    + " || ' ' || CAST(ts_ns // 1000000 AS VARCHAR) AS line FROM ev",
)
def q_edit_point(spark, sf_dir):
    p = _points(spark, sf_dir)
    q = TY.with_tag("p", "dc", "eu")
    q = TY.with_field(q, "n", 1)
    q = TY.with_time(q, TY.int_div(F.col("p.ts_ns"), 1_000_000), "ms")
    return p.select("src_offset", TY.format_line(q, precision="ms").alias("line"))


NOW_NS = 1_704_067_200_000_000_000  # fixed "now" for ingest-time and unit-inference queries


@register(
    "ingest_tag",
    "WITH " + EV + " SELECT event_id AS src_offset, event_type || ',' || " + TAGS + f" || ',timestamp={NOW_NS}"
    + " value=' || CAST(value AS VARCHAR) || ',k=' || CAST(k AS VARCHAR) || 'i,bad=' || " + _BAD_TXT
    + " || ' ' || CAST(ts_ns AS VARCHAR) AS value FROM ev",
)
def q_ingest_tag(spark, sf_dir):
    d = fx.lines(spark, sf_dir)
    return d.select("src_offset", L.tag_ingest_time("value", F.lit(NOW_NS)).alias("value"))


# ----------------------------------------------------------------------------- S5 S6 P18 P19 P21-P23 P31-P34 J3 A6
from ..operators import collectd as CD  # noqa: E402
from ..operators import events as EVT  # noqa: E402

HE = (
    EV
    + """,
he AS (SELECT event_id AS src_offset, event_type, user_id, shard, value, k, ts_ns, ts,
         CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS name,
         'u' || CAST(user_id AS VARCHAR) AS tag_user, 's' || CAST(shard AS VARCHAR) AS tag_shard,
         CAST(value AS VARCHAR) AS value_value, CAST(k AS VARCHAR) AS value_k,
         CAST(ts_ns AS VARCHAR) AS "timestamp", 'double' AS type_value
       FROM ev)"""
)


def _header_events(spark, sf_dir) -> DataFrame:
    return fx.header_events(spark, sf_dir)


@register(
    "json_headers",
    "WITH " + HE + """ SELECT src_offset, name, tag_user, tag_shard, value_value, value_k, "timestamp", type_value,
  CAST(NULL AS VARCHAR) AS error FROM he""",
)
def q_json_headers(spark, sf_dir):
    e = EVT.parse_json_events(fx.json_event_payloads(spark, sf_dir))
    h = F.col("headers")
    return e.select(
        "src_offset",
        *[h[k].alias(k) for k in ("name", "tag_user", "tag_shard", "value_value", "value_k", "timestamp", "type_value")],
        "error",
    )


@register(
    "events_to_lines",
    "WITH " + HE + """ SELECT src_offset,
  CASE WHEN name IS NULL THEN NULL ELSE name || ',shard=' || tag_shard || ',user=' || tag_user || ' k=' || value_k
       || 'i,value=' || value_value || ' ' || "timestamp" END AS line,
  CASE WHEN name IS NULL THEN 'no name header' END AS error FROM he""",
)
def q_events_to_lines(spark, sf_dir):
    return EVT.events_to_lines(_header_events(spark, sf_dir)).select("src_offset", "line", "error")


@register(
    "value_encoding",
    "WITH " + HE + """, kv AS (
  SELECT src_offset, 'name' AS key, '"' || name || '"' AS encoded FROM he WHERE name IS NOT NULL
  UNION ALL SELECT src_offset, 'tag_user', '"' || tag_user || '"' FROM he
  UNION ALL SELECT src_offset, 'tag_shard', '"' || tag_shard || '"' FROM he
  UNION ALL SELECT src_offset, 'value_value', value_value FROM he
  UNION ALL SELECT src_offset, 'value_k', value_k || 'i' FROM he
  UNION ALL SELECT src_offset, 'timestamp', "timestamp" || 'i' FROM he
  UNION ALL SELECT src_offset, 'type_value', '"double"' FROM he)
SELECT * FROM kv""",
)
def q_value_encoding(spark, sf_dir):
    h = _header_events(spark, sf_dir).select("src_offset", F.explode("headers").alias("key", "v"))
    return h.select("src_offset", "key", EVT.encode_value("v").alias("encoded"))


@register(
    "pass_body",
    "WITH " + HE + """ SELECT src_offset,
  CASE WHEN name IS NULL THEN NULL ELSE """ + LINE + """ END AS payload,
  CASE WHEN name IS NULL THEN 'empty body' END AS error FROM he""",
)
def q_pass_body(spark, sf_dir):
    return EVT.pass_body(_header_events(spark, sf_dir)).select("src_offset", "payload", "error")


_CD_TS = "CAST(CAST(trunc((epoch_us(ts) / 1e6) * 1e9) AS BIGINT) AS VARCHAR)"


@register(
    "collectd",
    "WITH " + EV + """, c AS (
  SELECT event_id AS src_offset, 0 AS value_pos, event_type || '_value' AS name, 'u' || CAST(user_id AS VARCHAR) AS tag_host,
    's' || CAST(shard AS VARCHAR) AS tag_instance, 'evt' AS tag_type, """ + _CD_TS + """ AS "timestamp",
    CAST(value AS VARCHAR) AS value_value, 'double' AS type_value, CAST(NULL AS VARCHAR) AS error FROM ev
  UNION ALL
  SELECT event_id, 1,
    CASE WHEN event_type = 'error' THEN NULL ELSE event_type || '_k' END,
    CASE WHEN event_type = 'error' THEN NULL ELSE 'u' || CAST(user_id AS VARCHAR) END,
    CASE WHEN event_type = 'error' THEN NULL ELSE 's' || CAST(shard AS VARCHAR) END,
    CASE WHEN event_type = 'error' THEN NULL ELSE 'evt' END,
    CASE WHEN event_type = 'error' THEN NULL ELSE """ + _CD_TS + """ END,
    CASE WHEN event_type = 'error' THEN NULL ELSE CAST(k AS VARCHAR) END,
    CASE WHEN event_type = 'error' THEN NULL ELSE 'long' END,
    CASE WHEN event_type = 'error' THEN 'unsupported value type: histogram' END FROM ev)
SELECT * FROM c""",
)
def q_collectd(spark, sf_dir):
    e = CD.explode_collectd(fx.collectd_docs(spark, sf_dir))
    h = F.col("headers")
    return e.select(
        "src_offset",
        "value_pos",
        *[h[k].alias(k) for k in ("name", "tag_host", "tag_instance", "tag_type", "timestamp", "value_value", "type_value")],
        "error",
    )


@register(
    "metric_key",
    "WITH " + HE + " SELECT src_offset, name || '|tag_shard:' || tag_shard || ',tag_user:' || tag_user AS metric_key FROM he",
)
def q_metric_key(spark, sf_dir):
    return _header_events(spark, sf_dir).select("src_offset", EVT.metric_key("headers").alias("metric_key"))


def _metric_rules_sql(cfg) -> str:
    rules, default = RU.metric_rules(cfg)
    rows = [
        f"('{m}', '{fn}', {str('tag_user' not in rm).upper()}, {str('tag_shard' not in rm).upper()})"
        for m, fn, rm in rules.rows
    ]
    return "r(metric, fn, keep_user, keep_shard) AS (VALUES " + ", ".join(rows) + ")"


def _points_sql(cfg) -> str:
    _, default = RU.metric_rules(cfg)
    if len(default):
        _, dfn, drm = default.rows[0]
        d_fn, d_ku, d_ks = f"'{dfn}'", str("tag_user" not in drm).upper(), str("tag_shard" not in drm).upper()
        join = "LEFT JOIN"
    else:
        d_fn, d_ku, d_ks, join = "NULL", "TRUE", "TRUE", "JOIN"
    return (
        "WITH " + HE + ", " + _metric_rules_sql(cfg) + f""",
p AS (
  SELECT he.*, COALESCE(r.fn, {d_fn}) AS fn,
    CASE WHEN r.fn IS NULL THEN {d_ku} ELSE r.keep_user END AS ku,
    CASE WHEN r.fn IS NULL THEN {d_ks} ELSE r.keep_shard END AS ks
  FROM he {join} r ON he.name = r.metric),
q AS (
  SELECT src_offset, ts, ts_ns,
    CASE WHEN name IS NULL THEN NULL ELSE fn END AS fn,
    CASE WHEN name IS NULL THEN NULL ELSE name || CASE
      WHEN ku AND ks THEN '|tag_shard:' || tag_shard || ',tag_user:' || tag_user
      WHEN ks THEN '|tag_shard:' || tag_shard
      WHEN ku THEN '|tag_user:' || tag_user ELSE '' END END AS metric_key,
    CASE WHEN name IS NULL THEN NULL ELSE value END AS value,
    CASE WHEN name IS NULL THEN 'event has no name header' END AS error
  FROM p WHERE fn IS NOT NULL OR name IS NULL)"""
    )


def _event_points(spark, sf_dir, cfg) -> DataFrame:
    rules, default = RU.metric_rules(cfg)
    return EVT.event_points(_header_events(spark, sf_dir), rules, default)


@register("event_points", _points_sql(configs.HEADER_AGGREGATOR) + " SELECT src_offset, fn, metric_key, value, error FROM q")
def q_event_points(spark, sf_dir):
    return _event_points(spark, sf_dir, configs.HEADER_AGGREGATOR).select("src_offset", "fn", "metric_key", "value", "error")


_HOUR = 3_600_000_000_000
_AGG_EVENTS_TAIL = f""",
g AS (SELECT fn, metric_key, (ts_ns // {_HOUR} + 1) * {_HOUR} AS window_end_ns,
        CASE fn WHEN 'avg' THEN avg(value) WHEN 'sum' THEN sum(value) WHEN 'min' THEN min(value) ELSE max(value) END AS value
      FROM q WHERE error IS NULL GROUP BY fn, metric_key, window_end_ns)"""


@register(
    "agg_events",
    _points_sql(configs.HEADER_AGGREGATOR) + _AGG_EVENTS_TAIL + " SELECT fn, metric_key, window_end_ns, " + R4("value") + " AS value FROM g",
)
def q_agg_events(spark, sf_dir):
    window = f"{RU.header_window_seconds(configs.HEADER_AGGREGATOR)} seconds"
    a = EVT.aggregate_events(_event_points(spark, sf_dir, configs.HEADER_AGGREGATOR), window=window)
    return a.select("fn", "metric_key", "window_end_ns", round4("value").alias("value"))


@register(
    "points_json",
    _points_sql(configs.HEADER_AGGREGATOR)
    + _AGG_EVENTS_TAIL
    + """ SELECT fn, metric_key, window_end_ns, split_part(metric_key, '|', 1) || '_aggr' AS name, """ + R4("value") + """ AS value,
  '{"headers":{"name":"' || split_part(metric_key, '|', 1) || '_aggr","value_' || fn || '":"V","type_value":"double","timestamp":"'
  || CAST(window_end_ns AS VARCHAR) || '"'
  || CASE WHEN metric_key LIKE '%|%' THEN ',"' || replace(replace(split_part(metric_key, '|', 2), ':', '":"'), ',', '","') || '"' ELSE '' END
  || '},"body":""}' AS shape FROM g""",
)
def q_points_json(spark, sf_dir):
    """P33 on the full rule set; the value is read back from the JSON and compared apart, as
    engines write the same double differently."""
    window = f"{RU.header_window_seconds(configs.HEADER_AGGREGATOR)} seconds"
    a = EVT.aggregate_events(_event_points(spark, sf_dir, configs.HEADER_AGGREGATOR), window=window)
    j = EVT.points_to_json(a).withColumn("h", F.from_json(F.get_json_object("json", "$.headers"), "map<string,string>"))
    read = F.col("h")[F.concat(F.lit("value_"), F.col("fn"))]
    return j.select("fn", "metric_key", "window_end_ns", F.col("h")["name"].alias("name"), round4(read.cast("double")).alias("value"),
                    F.regexp_replace("json", r'("value_[a-z]+":)"[^"]*"', '$1"V"').alias("shape"))


# ----------------------------------------------------------------------------- P24-P26
from ..operators import notify as NT  # noqa: E402
from ..operators import snapshots as SN  # noqa: E402
from ..operators import stats as ST  # noqa: E402


@register("notify_valid", "WITH " + EV + " SELECT event_id AS src_offset, event_type = 'error' AS valid FROM ev")
def q_notify_valid(spark, sf_dir):
    return NT.valid_notification(fx.notifications(spark, sf_dir)).select("src_offset", "valid")


@register(
    "notify_text",
    "WITH " + EV + """ SELECT event_id AS src_offset,
  CASE WHEN event_type = 'error' THEN CAST(json_object('text', concat_ws(chr(10), 'error from u' || CAST(user_id AS VARCHAR),
      CASE WHEN k >= 50 THEN 'https://mon.example/e/' || CAST(event_id AS VARCHAR) END,
      CASE WHEN value > 100 THEN 'value=' || CAST(value AS VARCHAR) END)) AS VARCHAR) END AS text,
  CASE WHEN event_type <> 'error' THEN 'not a JSON object with description' END AS error FROM ev""",
)
def q_notify_text(spark, sf_dir):
    return NT.notification_text(fx.notifications(spark, sf_dir)).select("src_offset", "text", "error")


@register(
    "email_rows",
    "WITH " + EV + """, m AS (SELECT event_id AS src_offset, event_type, event_type || ' u' || CAST(user_id AS VARCHAR) AS subject,
  'value=' || CAST(value AS VARCHAR) AS body, 'u' || CAST(user_id AS VARCHAR) || '@example.org' AS u, 's' || CAST(shard AS VARCHAR) || '@example.org' AS s FROM ev)
SELECT src_offset, subject, body, u AS address, CAST(NULL AS VARCHAR) AS error FROM m WHERE event_type NOT IN ('click', 'view', 'signup', 'error')
UNION ALL SELECT src_offset, subject, body, s, NULL FROM m WHERE event_type NOT IN ('view', 'signup', 'error')
UNION ALL SELECT src_offset, CASE WHEN event_type <> 'error' THEN subject END, CASE WHEN event_type = 'view' THEN body END, NULL, 'mail lacks a required key'
  FROM m WHERE event_type IN ('view', 'signup', 'error')""",
)
def q_email_rows(spark, sf_dir):
    return NT.email_messages(fx.emails(spark, sf_dir)).select("src_offset", "subject", "body", "address", "error")


# ----------------------------------------------------------------------------- P27-P30 S7 S8
NOW_S = 1_705_276_800  # fixed "now" (2024-01-15) for time-unit inference
_W = 7 * 24 * 60 * 60
_IN_REACH = f"ts_ns >= {(NOW_S - _W) * 10**9} AND ts_ns < {(NOW_S + _W) * 10**9}"


def _unit_sql(t: str, now: str) -> str:
    lo, hi = f"CAST({now} - {_W} AS BIGINT)", f"CAST({now} + {_W} AS BIGINT)"
    return f"""CASE
    WHEN {t} >= {lo} AND {t} < {hi} THEN {t} * 1000000000
    WHEN {t} >= {lo} * 1000 AND {t} < {hi} * 1000 THEN {t} * 1000000
    WHEN {t} >= {lo} * 1000000 AND {t} < {hi} * 1000000 THEN {t} * 1000
    WHEN {t} >= {lo} * 1000000000 AND {t} < {hi} * 1000000000 THEN {t} END"""


_RAW_TS = """CASE event_type WHEN 'view' THEN epoch_us(ts) // 1000000 WHEN 'click' THEN epoch_us(ts) // 1000
  WHEN 'signup' THEN epoch_us(ts) WHEN 'purchase' THEN ts_ns ELSE (epoch_us(ts) // 1000) * 10 END"""


@register(
    "ts_units",
    "WITH " + EV + ", r AS (SELECT event_id AS src_offset, event_type, " + _RAW_TS + " AS raw_ts FROM ev) "
    "SELECT src_offset, event_type, raw_ts, " + _unit_sql("raw_ts", str(NOW_S)) + " AS ts_ns FROM r",
)
def q_ts_units(spark, sf_dir):
    r = fx.raw_timestamps(spark, sf_dir)
    return r.select("src_offset", "event_type", "raw_ts", SN.to_nanos("raw_ts", NOW_S).alias("ts_ns"))


@register(
    "dict_lines",
    "WITH " + EV + ", d AS (SELECT *, epoch_us(ts) // 1000 AS t, " + _unit_sql("(epoch_us(ts) // 1000)", str(NOW_S)) + """ AS ns FROM ev)
SELECT event_id AS src_offset,
  CASE WHEN ns IS NOT NULL THEN event_type || ',shard=s' || CAST(shard AS VARCHAR) || ',user=u' || CAST(user_id AS VARCHAR)
    || ' bad=' || CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END || ',k=' || CAST(k AS VARCHAR)
    || 'i,note="' || event_type || '",value=' || CAST(value AS VARCHAR) || ' ' || CAST(ns AS VARCHAR) END AS line,
  CASE WHEN ns IS NULL THEN 'cannot infer the time unit' END AS error FROM d""",
)
def q_dict_lines(spark, sf_dir):
    d = SN.parse_measurement_dict(fx.measurement_dicts(spark, sf_dir))
    return SN.measurements_to_lines(d, NOW_S).select("src_offset", "line", "error")


@register(
    "agent_points",
    "WITH " + EV + """, q AS (SELECT event_id AS src_offset, 'SOURCE.src_' || event_type AS component,
  'flume_SOURCE,component=SOURCE.src_' || event_type || ',endpoint=host' || CAST(shard AS VARCHAR) || ':5653,hostname=agent'
  || CAST(shard AS VARCHAR) || ' EventReceivedCount=' || CAST(k AS VARCHAR) || 'i,OpenConnectionCount=' || CAST(user_id AS VARCHAR)
  || 'i ' || CAST(ts_ns AS VARCHAR) AS line FROM ev
UNION ALL SELECT event_id, 'CHANNEL.ch_s' || CAST(shard AS VARCHAR),
  'flume_CHANNEL,component=CHANNEL.ch_s' || CAST(shard AS VARCHAR) || ',endpoint=host' || CAST(shard AS VARCHAR) || ':5653,hostname=agent'
  || CAST(shard AS VARCHAR) || ' ChannelFillPercentage=' || CAST(value AS VARCHAR) || ' ' || CAST(ts_ns AS VARCHAR) FROM ev)
SELECT src_offset, component, CASE WHEN """ + _IN_REACH + """ THEN line END AS line,
  CASE WHEN NOT (""" + _IN_REACH + """) THEN 'cannot infer the time unit' END AS error FROM q JOIN ev ON src_offset = event_id""",
)
def q_agent_points(spark, sf_dir):
    a = SN.agent_points(fx.agent_snapshots(spark, sf_dir))
    return SN.measurements_to_lines(a, NOW_S).select("src_offset", "component", "line", "error")


@register(
    "spark_points",
    "WITH " + EV + """, x AS (
  SELECT event_id AS src_offset, 'spark_streaming_stats' AS measurement,
    'spark_streaming_stats,id=app-' || CAST(shard AS VARCHAR) || ' avgInputRate=' || CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR)
    || 'i,batchDuration=30000i,numReceivers=' || CAST(shard AS VARCHAR) || 'i,numTotalCompletedBatches=' || CAST(k AS VARCHAR)
    || 'i ' || CAST(ts_ns AS VARCHAR) AS line, CAST(NULL AS VARCHAR) AS error FROM ev WHERE event_type = 'signup'
  UNION ALL
  SELECT event_id, 'spark_streaming_batch', 'spark_streaming_batch,id=app-' || CAST(shard AS VARCHAR) || ',status=COMPLETED inputSize='
    || CAST(k AS VARCHAR) || 'i,processingTime=' || CAST(user_id AS VARCHAR) || 'i ' || CAST((epoch_us(ts) // 1000) * 1000000 AS VARCHAR), NULL
    FROM ev WHERE event_type = 'purchase'
  UNION ALL
  SELECT event_id, CASE WHEN event_type = 'click' THEN 'spark_all_executors' ELSE 'spark_active_executors' END,
    CASE WHEN event_type = 'error' THEN NULL ELSE
    CASE WHEN event_type = 'click' THEN 'spark_all_executors' ELSE 'spark_active_executors' END
    || ',hostPort=host' || CAST(shard AS VARCHAR) || ':4040,id=app-' || CAST(shard AS VARCHAR) || ',isActive='
    || CASE WHEN event_type = 'click' THEN 'False' ELSE 'True' END || ' memoryUsed=' || CAST(user_id * 1000 AS VARCHAR)
    || 'i,rddBlocks=' || CAST(k AS VARCHAR) || 'i,totalCores=' || CAST(shard + 1 AS VARCHAR) || 'i,totalOnHeapStorageMemory=1000i,usedOnHeapStorageMemory='
    || CAST(k * 10 AS VARCHAR) || 'i ' || CAST(ts_ns AS VARCHAR) END,
    CASE WHEN event_type = 'error' THEN 'value is not an integer' END
    FROM ev WHERE event_type IN ('view', 'error', 'click'))
SELECT src_offset, measurement, CASE WHEN """ + _IN_REACH + """ THEN line END AS line,
  CASE WHEN error IS NOT NULL THEN error WHEN NOT (""" + _IN_REACH + """) THEN 'cannot infer the time unit' END AS error
FROM x JOIN ev ON src_offset = event_id""",
)
def q_spark_points(spark, sf_dir):
    """All four Spark-status shapes from one scan (kind per row)."""
    p = SN.spark_points_mixed(fx.spark_snapshots_mixed(spark, sf_dir), "kind")
    lines = SN.measurements_to_lines(p.withColumnRenamed("error", "_perr"), NOW_S)
    return lines.select("src_offset", "measurement", "line", F.coalesce(F.col("_perr"), F.col("error")).alias("error"))


# ----------------------------------------------------------------------------- A7 A8
@register(
    "latency_summary",
    "WITH " + EV + """, l AS (SELECT k AS latency, octet_length(encode(""" + LINE + """)) AS bytes, ts FROM ev),
s AS (SELECT list_sort(list(latency)) AS arr, count(*) AS n, sum(latency) AS lat_sum, max(latency) AS max_latency,
        sum(bytes) AS bytes, epoch_ms(max(ts)) - epoch_ms(min(ts)) AS el FROM l)
SELECT n AS count, """ + R4("1000.0 * n / el") + """ AS records_per_s, """ + R4("1000.0 * bytes / el / (1024.0 * 1024.0)") + """ AS mb_per_s,
  """ + R4("lat_sum / n") + """ AS avg_latency, max_latency,
  arr[CAST(floor(0.5 * n) AS BIGINT) + 1] AS p50, arr[CAST(floor(0.95 * n) AS BIGINT) + 1] AS p95,
  arr[CAST(floor(0.99 * n) AS BIGINT) + 1] AS p99, arr[CAST(floor(0.999 * n) AS BIGINT) + 1] AS p999 FROM s""",
)
def q_latency_summary(spark, sf_dir):
    s = ST.latency_summary(fx.delivery_log(spark, sf_dir))
    return s.select(
        "count", round4("records_per_s").alias("records_per_s"), round4("mb_per_s").alias("mb_per_s"),
        round4("avg_latency").alias("avg_latency"), "max_latency", "p50", "p95", "p99", "p999",
    )


@register(
    "latency_windows",
    "WITH " + EV + """, l AS (SELECT k AS latency, octet_length(encode(""" + LINE + f""")) AS bytes, ts_ns FROM ev)
SELECT (ts_ns // {_HOUR} + 1) * {_HOUR} AS window_end_ns, count(*) AS count, {R4("count(*) / 3600.0")} AS records_per_s,
  {R4("sum(bytes) / 3600.0 / 1024.0")} AS kb_per_s, {R4("avg(latency)")} AS avg_latency, max(latency) AS max_latency
FROM l GROUP BY 1""",
)
def q_latency_windows(spark, sf_dir):
    w = ST.latency_windows(fx.delivery_log(spark, sf_dir), "1 hour")
    return w.select(
        "window_end_ns", "count", round4("records_per_s").alias("records_per_s"), round4(F.col("mb_per_s") * 1024).alias("kb_per_s"),
        round4("avg_latency").alias("avg_latency"), "max_latency",
    )


@register(
    "stage_counts",
    _points_sql(configs.HEADER_AGGREGATOR)
    + _AGG_EVENTS_TAIL
    + """ SELECT 'received' AS stage, count(*) AS n FROM he
UNION ALL SELECT 'imported', count(*) FROM q WHERE error IS NULL
UNION ALL SELECT 'to_send', count(*) FROM g""",
)
def q_stage_counts(spark, sf_dir):
    """Received / imported / to-send counts of the header aggregator, from one scan."""
    rules, default = RU.metric_rules(configs.HEADER_AGGREGATOR)
    pts = EVT.event_points(_header_events(spark, sf_dir), rules, default, keep_unmatched=True)
    return ST.event_stage_counts(pts, RU.header_window_seconds(configs.HEADER_AGGREGATOR))


# ----------------------------------------------------------------------------- T1-T4 (Structured Streaming)
from ..session import scratch_path  # noqa: E402
from ..streaming import jobs as SJ  # noqa: E402
from ..streaming import ledger as LG  # noqa: E402

_GRACE_NS = 10_000_000_000


@register(
    "agg_stream_closed",
    _agg_sql(_ALL_FNS).replace(
        "SELECT fn, series, window_end_ns, " + R4("value") + " AS value FROM g",
        "SELECT fn, series, window_end_ns, " + R4("value") + " AS value FROM g "
        f"WHERE window_end_ns <= (SELECT (max(epoch_us(ts)) // 1000) * 1000000 FROM events) - {_GRACE_NS}",
    ),
)
def q_agg_stream_closed(spark, sf_dir):
    """The aggregator as a stream over the events file: closed windows only."""
    window = f"{RU.agg_window_seconds(configs.AGGREGATOR)} seconds"
    s = fx.lines_from(fx.events_stream(spark, sf_dir))
    out = SJ.run_to_table(SJ.stream_aggregate(s, RU.agg_rules(configs.AGGREGATOR), window=window), "agg_stream")
    return _round_value(out)


class _Stopped(Exception):
    """What stops a stream between a batch's output and its commit."""


def _in_slices(spark, sf_dir, name: str, by: str, start, slices: int = 3) -> None:
    """Lands ``events`` in slices of the column ``by``, one after another, and runs the job
    ``start(events stream, checkpoint, done)`` to the end of the input after each, on one
    checkpoint. In the second slice (or the only one) the job is stopped once its first batch has left its
    output but is not committed; started again, it replays that batch."""
    ev = fx.table(spark, sf_dir, "events")
    path, checkpoint = scratch_path(spark, f"{name}-in"), scratch_path(spark, f"{name}-ckpt")
    x = fx.ntz_micros(by) if by == "ts" else F.col(by)
    # once for all slices: as subqueries they would read the table twice for each of them
    lo, hi = (F.lit(v).cast("double") for v in ev.select(F.min(x).cast("double"), F.max(x).cast("double")).first())
    place = F.floor((x.cast("double") - lo) / F.greatest(hi - lo, F.lit(1.0)) * slices)
    cut = ev.withColumn("slice", F.least(place, F.lit(slices - 1)))

    def stop(batch_id: int) -> None:
        raise _Stopped(f"after batch {batch_id}")

    for i in range(slices):
        cut.filter(F.col("slice") == i).drop("slice").write.mode("append").parquet(path)
        for done in (stop, None) if i == min(1, slices - 1) else (None,):
            q = start(fx.events_from(spark.readStream.schema(ev.schema).parquet(path)), checkpoint, done)
            try:
                q.awaitTermination()
            except Exception as e:
                if done is None or _Stopped.__name__ not in str(e):
                    raise


@register("changes_stream", ORACLE["changes"])
def q_changes_stream(spark, sf_dir):
    """T4: the change detector as a stream in arrival order, stopped and restarted on the way;
    same answer as the batch form."""
    root = scratch_path(spark, "changes_stream")
    out = LG.Ledger(spark, f"{root}/out")
    _in_slices(spark, sf_dir, "changes_stream", "event_id", lambda s, ckpt, done: LG.start_changes(
        L.explode_fields(fx.lines_from(s)), out, f"{root}/state", "changes_stream", ckpt, compact=2, done=done))
    return out.read("series STRING, src_offset BIGINT, value STRING, line STRING").drop("batch")


@register("agg_stream_restarted", ORACLE["agg_stream_closed"])
def q_agg_stream_restarted(spark, sf_dir):
    """The aggregator stopped between output and commit and restarted on one checkpoint:
    no closed window is missing and none is there twice."""
    out = LG.Ledger(spark, scratch_path(spark, "agg_restarted"))
    window, rules = f"{RU.agg_window_seconds(configs.AGGREGATOR)} seconds", RU.agg_rules(configs.AGGREGATOR)
    plan = lambda s: SJ.stream_aggregate(fx.lines_from(s), rules, window=window)
    _in_slices(spark, sf_dir, "agg_restarted", "ts", lambda s, ckpt, done: LG.start_to_ledger(plan(s), out, "agg_restarted", ckpt, done=done))
    schema = plan(fx.events(spark, sf_dir)).schema
    return _round_value(out.read(schema).drop("batch"))


@register(
    "refresh_stream",
    f"WITH grid AS ({ORACLE['refresh_daily']}) SELECT * FROM grid WHERE tick_ns <= "
    f"(((SELECT max(epoch_us(ts)) FROM events) * 1000 - {_GRACE_NS}) // {_DAY}) * {_DAY}",
)
def q_refresh_stream(spark, sf_dir):
    """T5: the refresh grid as a stream on event time, stopped and restarted on the way: every
    tick that the records and the grace have passed, once."""
    root = scratch_path(spark, "refresh_stream")
    out = LG.Ledger(spark, f"{root}/out")
    _in_slices(spark, sf_dir, "refresh_stream", "ts", lambda s, ckpt, done: LG.start_refresh(
        L.explode_fields(fx.lines_from(s)), 86400, out, f"{root}/state", "refresh_stream", _GRACE_NS // 1_000_000_000, checkpoint=ckpt, done=done))
    return out.read("series STRING, tick_ns BIGINT, value STRING, line STRING").drop("batch")


_AGG_BATCH_SQL = _points_sql(configs.HEADER_AGGREGATOR) + """,
g AS (SELECT fn, metric_key, CASE fn WHEN 'avg' THEN avg(value) WHEN 'sum' THEN sum(value) WHEN 'min' THEN min(value) ELSE max(value) END AS value
      FROM q WHERE error IS NULL GROUP BY fn, metric_key)
SELECT fn, metric_key, """ + R4("value") + """ AS value, 2 AS attempts, 1 AS stamps FROM g"""


@register("agg_events_replayed", _AGG_BATCH_SQL)
def q_agg_events_replayed(spark, sf_dir):
    """The header-event aggregator on processing time, its batch stopped before the commit
    and replayed: both attempts give the same rows with the same batch time."""
    rules, default = RU.metric_rules(configs.HEADER_AGGREGATOR)
    tries = LG.Ledger(spark, scratch_path(spark, "agg_replayed"))

    def start(s, ckpt, done):
        def write(df, batch_id):
            tries.write(df, len(tries.ids()))
            if done:
                done(batch_id)

        return SJ.start_event_aggregate_per_batch(fx.header_events_from(s), rules, default, "1 second", write, "agg_replayed", ckpt, {"availableNow": True})

    _in_slices(spark, sf_dir, "agg_replayed", "ts", start, slices=1)
    got = tries.read("fn STRING, metric_key STRING, window_end_ns BIGINT, value DOUBLE").withColumn("value", round4("value"))
    return got.groupBy("fn", "metric_key", "value").agg(F.count("*").cast("int").alias("attempts"), F.count_distinct("window_end_ns").cast("int").alias("stamps"))


# ----------------------------------------------------------------------------- D5: malformed input goes to its own output
@register(
    "parse_errors",
    "WITH " + EV + """ SELECT event_id AS src_offset, 'malformed field' AS error,
  replace(""" + LINE + """, ' ' || CAST(ts_ns AS VARCHAR), ',oops ' || CAST(ts_ns AS VARCHAR)) AS line
FROM ev WHERE event_type = 'error'
UNION ALL SELECT event_id, 'too few tokens', event_type || ',' || """ + TAGS + """ FROM ev WHERE event_type = 'signup' AND k >= 90""",
)
def q_parse_errors(spark, sf_dir):
    x = L.explode_fields(fx.dirty_lines(spark, sf_dir), keep_bad=True)
    return L.bad_rows(x).select("src_offset", "error", "line")


# ----------------------------------------------------------------------------- S1 S2 P34 U1 K4 L1 P7 T2
from ..sinks import writers as W  # noqa: E402
from ..sources import streams as S  # noqa: E402


def _landed(df: DataFrame, name: str) -> str:
    """Records of the tables written as the landed files that a scan reads."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


@register("scan_lines", "WITH " + EV + " SELECT event_id AS src_offset, shard AS src_partition, " + LINE + " AS value, ts_ns FROM ev")
def q_scan_lines(spark, sf_dir):
    """The LP scan over landed records."""
    got = S.read_lines(spark, "parquet", path=_landed(fx.lines(spark, sf_dir), "lines"), stream=False)
    return got.select("src_offset", "src_partition", "value", (F.unix_micros("event_ts") * 1000).alias("ts_ns"))


@register("scan_internal", "WITH " + FIELDS + " SELECT src_offset, measurement, tags, field, value, ts_ns FROM f")
def q_scan_internal(spark, sf_dir):
    """The scan of internal records, decoded to field rows."""
    wire = L.encode_internal(_fields(spark, sf_dir)).select("key", F.col("wire").alias("value"), "event_ts", "src_partition", "src_offset")
    got = S.read_internal(spark, "parquet", path=_landed(wire, "internal"), stream=False)
    return got.select("src_offset", "measurement", "tags", "field", "value", "ts_ns")


@register("drop_empty", "WITH " + EV + " SELECT event_id AS src_offset FROM ev WHERE event_type <> 'error'")
def q_drop_empty(spark, sf_dir):
    return EVT.drop_empty(fx.header_events(spark, sf_dir), "body").select("src_offset")


@register("route_union", f"SELECT * FROM ({_ONOFF_SQL}) UNION ALL SELECT * FROM ({_AGGR_SQL})")
def q_route_union(spark, sf_dir):
    """The two field branches put together."""
    return A.union_all(q_route_onoff(spark, sf_dir), q_route_aggregator(spark, sf_dir))


@register(
    "delivery_plan",
    "WITH " + EV + ", n AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY event_id) - 1 AS i FROM ev)"
    " SELECT event_id AS src_offset, shard AS src_partition, [8089, 8090, 8091][i % 3 + 1] AS port, i // 500 AS batch FROM n",
)
def q_delivery_plan(spark, sf_dir):
    return W.delivery_plan(fx.lines(spark, sf_dir), "8089,8090,8091", 500).select("src_offset", "src_partition", "port", "batch")


@register(
    "typed_drop_tags",
    "WITH " + EV + " SELECT event_id AS src_offset, event_type || ',shard=s' || CAST(shard AS VARCHAR)"
    + " || ' bad=' || " + _BAD_TXT + " || ',k=' || CAST(k AS VARCHAR) || 'i,value=' || CAST(value AS VARCHAR) || ' ' || CAST(ts_ns AS VARCHAR) AS line FROM ev",
)
def q_typed_drop_tags(spark, sf_dir):
    return _points(spark, sf_dir).select("src_offset", TY.format_line(TY.drop_tags("p", ["user", "absent"])).alias("line"))


@register("agg_late_dropped", ORACLE["agg_stream_closed"])
def q_agg_late_dropped(spark, sf_dir):
    """Every record comes once more after the watermark has passed the closed windows: the
    second coming of a record in a closed window changes nothing. The last windows, which are
    still open then, are left out as in ``agg_stream_closed``."""
    ev = fx.table(spark, sf_dir, "events")
    path = _landed(ev, "late")
    first = len(spark.read.parquet(path).inputFiles())
    # Spark holds late records against the watermark of the batch before: a batch of
    # records that no rule wants lets it pass
    ev.withColumn("event_type", F.lit("heartbeat")).write.mode("append").parquet(path)
    cut = ev.agg((F.max("ts") - F.expr("INTERVAL '1' DAY")).alias("cut"))
    ev.join(F.broadcast(cut), F.col("ts") < F.col("cut")).drop("cut").write.mode("append").parquet(path)  # one row
    s = fx.events_from(spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", first).parquet(path))
    window = f"{RU.agg_window_seconds(configs.AGGREGATOR)} seconds"
    return _round_value(SJ.run_to_table(SJ.stream_aggregate(fx.lines_from(s), RU.agg_rules(configs.AGGREGATOR), window=window), "agg_late"))


# ----------------------------------------------------------------------------- K5 K6 K7 S4 T7: whole tables through the components
import zlib  # noqa: E402

from ..sinks import delivery as D  # noqa: E402
from ..streaming import tee as TEE  # noqa: E402
from ..streaming.progress import Totals  # noqa: E402
from ..workers import ship_by_value  # noqa: E402

ship_by_value(__name__)


class Endpoint:
    """Stands for what takes deliveries, here and in no other process: at the first attempt it
    refuses a third of all requests."""

    def __init__(self, attempt: int):
        self.attempt = attempt

    def post(self, url: str, body: bytes, content_type: str = "text/plain") -> int:
        return 503 if self.attempt == 0 and zlib.crc32(body) % 3 == 0 else 200

    def send(self, sender: str, to: list, subject: str, body: str) -> None:
        if not to or not subject:
            raise ValueError("no mail")

    def close(self) -> None:
        pass


def _times(spark, root: str, batch_id: int = 0) -> DataFrame:
    return D.accepted(spark, root, batch_id).groupBy("src_partition", "src_offset").agg(F.count("*").alias("times"))


@register("http_delivery", "WITH " + EV + " SELECT event_id AS src_offset, shard AS src_partition, 1 AS times FROM ev")
def q_http_delivery(spark, sf_dir):
    """K5/L1: LP records in POSTs of up to 500; refused ones are replayed until every record
    is accepted, each once."""
    root, rows = scratch_path(spark, "http_delivery"), fx.lines(spark, sf_dir)
    for attempt in range(2):
        try:
            W.write_http(rows, "http://sink", 500, sender_factory=lambda attempt=attempt: Endpoint(attempt), ledger=root)
        except D.Refused:
            if attempt:
                raise
    return _times(spark, root).select("src_offset", "src_partition", "times")


@register("mail_delivery", "WITH " + EV + " SELECT event_id AS src_offset, 1 AS times FROM ev WHERE event_type NOT IN ('view', 'signup', 'error')")
def q_mail_delivery(spark, sf_dir):
    """K7: the mails of the table, their batch replayed as after a crash before its commit."""
    root = scratch_path(spark, "mail_delivery")
    mails = NT.email_messages(fx.emails(spark, sf_dir), each=False).withColumn("src_partition", F.lit(0))
    for attempt in range(2):
        W.write_email(mails, {"from": "me"}, sender_factory=lambda: Endpoint(1), ledger=root)
    return _times(spark, root).select("src_offset", "times")


@register("webhook_delivery", "WITH " + EV + " SELECT event_id AS src_offset, 1 AS times FROM ev WHERE event_type = 'error'")
def q_webhook_delivery(spark, sf_dir):
    """K6: the notifications of the table, their batch replayed as after a crash before its commit."""
    root = scratch_path(spark, "webhook_delivery")
    texts = NT.notification_text(fx.notifications(spark, sf_dir)).filter("error is null").withColumn("src_partition", F.lit(0))
    for attempt in range(2):
        W.write_webhook(texts, "http://hook", sender_factory=lambda: Endpoint(1), ledger=root)
    return _times(spark, root).select("src_offset", "times")


@register(
    "scan_events",
    "WITH " + EV + " SELECT event_id AS src_offset, CASE WHEN event_type <> 'error' THEN event_type END AS name, 's' || CAST(shard AS VARCHAR) AS shard,"
    " CASE WHEN event_type = 'error' THEN '' ELSE " + LINE + " END AS body FROM ev",
)
def q_scan_events(spark, sf_dir):
    """The scan of header events with byte bodies over landed records."""
    got = S.read_events(spark, "parquet", path=_landed(fx.header_events(spark, sf_dir), "events"), stream=False)
    return got.select("src_offset", F.try_element_at("headers", F.lit("name")).alias("name"), F.col("headers")["tag_shard"].alias("shard"), F.decode("body", "UTF-8").alias("body"))


@register(
    "router_counters",
    "WITH " + EV + """, c AS (SELECT count(*) AS receivedRecords,
  count(*) FILTER (WHERE event_type = 'error' OR (event_type = 'signup' AND k >= 90)) AS filteredRecords,
  count(*) FILTER (WHERE event_type IN ('click', 'purchase')) AS sentDatabaseRecords,
  count(*) FILTER (WHERE event_type = 'view') + 3 * count(*) FILTER (WHERE event_type = 'error') AS sentOnOffRecords,
  2 * count(*) FILTER (WHERE event_type = 'click') + count(*) FILTER (WHERE event_type = 'purchase') AS sentAggregatorRecords FROM ev)
SELECT unnest(['receivedRecords', 'filteredRecords', 'sentDatabaseRecords', 'sentOnOffRecords', 'sentAggregatorRecords', 'writtenErrors', 'writtenRecords']) AS counter,
  unnest([receivedRecords, filteredRecords, sentDatabaseRecords, sentOnOffRecords, sentAggregatorRecords, filteredRecords,
    sentDatabaseRecords + sentOnOffRecords + sentAggregatorRecords]) AS n FROM c""",
)
def q_router_counters(spark, sf_dir):
    """The router over records of which some are malformed: what each micro-batch received,
    filtered and sent by branch, and the rows in its outputs, all from one scan."""
    from . import apps

    rules, root = RU.router_rules(configs.ROUTER), scratch_path(spark, "router_counters")
    dirty = fx.dirty_lines(spark, sf_dir)
    totals, out = Totals(sender=lambda line: None), LG.Ledger(spark, f"{root}/out")
    # a file for each core in a micro-batch: what a task keeps does not grow with the table
    files = spark.readStream.schema(dirty.schema).option("maxFilesPerTrigger", spark.sparkContext.defaultParallelism)
    lines = files.parquet(_landed(dirty, "dirty"))
    counters = {name: F.count_if(F.col("branch") == branch) for branch, name in apps.BRANCH_COUNTERS.items()}
    send = lambda df, i: out.write(df.select("branch", "key", "value"), i)
    q = TEE.start_tee(R.parsed(lines), "line", lambda x: R.routed(x, rules, _TOPICS), send, "router_counters", f"{root}/ckpt", f"{root}/errors", totals, counters, {"availableNow": True})
    q.awaitTermination()
    counted = spark.createDataFrame([(k, v) for k, v in totals.values.items()], "counter STRING, n BIGINT")  # five counters
    bad = spark.read.schema(TEE.BAD).json(f"{root}/errors").agg(F.lit("writtenErrors").alias("counter"), F.count("*").alias("n"))
    written = out.read("branch STRING, key STRING, value STRING").agg(F.lit("writtenRecords").alias("counter"), F.count("*").alias("n"))
    return counted.unionByName(bad).unionByName(written)
