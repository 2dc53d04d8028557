"""Typed points (M3): measurement, tag map, typed field map, time in ns.

``fields`` is ``MAP<STRING, STRUCT<kind STRING, l BIGINT, d DOUBLE, b BOOLEAN, s STRING>>``
with ``kind`` one of long / double / boolean / string. All functions are
Column expressions (higher-order functions over arrays and maps), so the
per-record work stays inside the JVM.

Tag and field order is undefined in the reference (hash maps); here tags and
fields render sorted by key, which makes output deterministic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lines import LONG_RE, _c, java_double, java_split

VALUE_TYPE = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("l", T.LongType()),
        T.StructField("d", T.DoubleType()),
        T.StructField("b", T.BooleanType()),
        T.StructField("s", T.StringType()),
    ]
)
FIELDS_TYPE = T.MapType(T.StringType(), VALUE_TYPE)
VALUE_DDL = "struct<kind:string,l:bigint,d:double,b:boolean,s:string>"

# Time units accepted by ``with_time`` / ``format_line`` and their size in ns.
UNIT_NS = {"ns": 1, "us": 1_000, "ms": 1_000_000, "s": 1_000_000_000}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` bound to a lambda variable, so that it is evaluated once
    per row however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def last_wins_map(entries: Column, value_type: str) -> Column:
    """ARRAY<STRUCT<k, v>> -> MAP keeping the last entry of every key (Java ``Map.put``).

    Entries with different keys, the common case, become a map at once; only a record that
    repeats a key is folded entry by entry.
    """
    zero = F.create_map().cast(f"map<string,{value_type}>")

    def build(e: Column) -> Column:
        keys = F.transform(e, lambda x: x["k"])
        folded = F.aggregate(
            e,
            zero,
            lambda acc, x: F.map_concat(F.map_filter(acc, lambda k, _: k != x["k"]), F.create_map(x["k"], x["v"])),
        )
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.map_from_entries(e)).otherwise(folded)

    return let(entries, build)


def typed_value(text) -> Column:
    """Field text -> typed value: ``<long>i`` -> long, Java double grammar -> double,
    ``true``/``false`` (any case) -> boolean, otherwise string with ``"`` removed."""
    v = _c(text)
    return _typed_from(v, _long_candidate(v), java_double(v))


def _long_candidate(v: Column) -> Column:
    pre = F.substr(v, F.lit(1), F.length(v) - 1)
    return F.when(v.endswith("i") & pre.rlike(LONG_RE), pre.try_cast("bigint"))


def _typed_from(v: Column, as_long: Column, as_double: Column) -> Column:
    low = F.lower(v)
    kind = (
        F.when(as_long.isNotNull(), F.lit("long"))
        .when(as_double.isNotNull(), F.lit("double"))
        .when(low.isin("true", "false"), F.lit("boolean"))
        .otherwise(F.lit("string"))
    )
    return F.struct(
        kind.alias("kind"),
        as_long.alias("l"),
        F.when(as_long.isNull(), as_double).alias("d"),
        F.when(kind == "boolean", low == "true").alias("b"),
        F.when(kind == "string", F.regexp_replace(v, '"', "")).alias("s"),
    )


def parse_line(value) -> Column:
    """LP text -> typed point struct (measurement, tags, fields, ts_ns).

    Malformed tag or field pieces are skipped (the reference logs and skips them);
    a record with fewer than two tokens gives null.
    """
    return let(F.split(F.rtrim(_c(value)), " "), lambda toks: F.when(F.size(toks) >= 2, _point(toks)))


def _point(toks: Column) -> Column:
    """The typed point of a record's tokens, two at least."""
    last = F.element_at(toks, -1)
    time = F.when(last.rlike(LONG_RE), last.try_cast("bigint"))
    return let(time, lambda ts: let(java_split(F.element_at(toks, 1), ","), lambda head: _assembled(toks, head, ts)))


def _assembled(toks: Column, head: Column, ts: Column) -> Column:
    nb = F.size(toks) - 1 - F.when(ts.isNotNull(), 1).otherwise(0)
    tag_pieces = F.transform(F.slice(head, 2, F.greatest(F.size(head) - 1, F.lit(0))), lambda t: java_split(t, "="))
    tag_entries = F.transform(
        F.filter(tag_pieces, lambda p: F.size(p) == 2),
        lambda p: F.struct(p[0].alias("k"), p[1].alias("v")),
    )
    body = F.array_join(F.slice(toks, 2, F.greatest(nb, F.lit(0))), " ")
    field_pieces = F.transform(java_split(body, ","), lambda f: java_split(f, "="))
    # in passes: what one computes is bound by the next and not computed again (a lambda has
    # no common-subexpression reuse); only what is no long is read as a double
    longs = F.transform(
        F.filter(field_pieces, lambda p: F.size(p) == 2),
        lambda p: F.struct(p[0].alias("k"), p[1].alias("v"), _long_candidate(p[1]).alias("l")),
    )
    cand = F.transform(longs, lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v"), e["l"].alias("l"), F.when(e["l"].isNull(), java_double(e["v"])).alias("d")))
    field_entries = F.transform(cand, lambda e: F.struct(e["k"].alias("k"), _typed_from(e["v"], e["l"], e["d"]).alias("v")))
    return F.struct(
        F.element_at(head, 1).alias("measurement"),
        last_wins_map(tag_entries, "string").alias("tags"),
        last_wins_map(field_entries, VALUE_DDL).alias("fields"),
        ts.alias("ts_ns"),
    )


# --------------------------------------------------------------------------- P13
def escape_key(s) -> Column:
    return F.regexp_replace(_c(s), r"([ ,=])", r"\\$1")


def escape_string(s) -> Column:
    return F.regexp_replace(_c(s), r'([\\"])', r"\\$1")


def plain_double(d) -> Column:
    """Double in plain notation with at least one fraction digit (no exponent, no grouping),
    from the shortest round-trip digits: ``1.0E10`` -> ``10000000000.0``, ``1.0E-4`` -> ``0.0001``."""
    d = _c(d)
    s = F.abs(d).cast("string")
    mant = F.substring_index(s, "E", 1)
    exp = F.substring_index(s, "E", -1).cast("int")
    digits = F.regexp_replace(mant, r"\.", "")
    int_len = exp + 1
    big_int = F.rpad(digits, F.greatest(int_len, F.length(digits)), "0")
    big = F.concat(
        F.substr(big_int, F.lit(1), int_len),
        F.lit("."),
        F.coalesce(F.nullif(F.regexp_replace(F.substr(big_int, int_len + 1, F.length(big_int)), "0+$", ""), F.lit("")), F.lit("0")),
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), F.regexp_replace(digits, "0+$", ""))
    body = F.when(~s.contains("E"), s).when(exp >= 0, big).otherwise(small)
    sign = F.when(d < 0, F.lit("-")).otherwise(F.lit(""))
    return (
        F.when(F.isnan(d), F.lit("NaN"))
        .when(d == float("inf"), F.lit("∞"))
        .when(d == float("-inf"), F.lit("-∞"))
        .otherwise(F.concat(sign, body))
    )


def render_value(v: Column) -> Column:
    return (
        F.when(v["kind"] == "long", F.concat(v["l"].cast("string"), F.lit("i")))
        .when(v["kind"] == "double", plain_double(v["d"]))
        .when(v["kind"] == "boolean", v["b"].cast("string"))
        .when(v["kind"] == "string", F.concat(F.lit('"'), escape_string(v["s"]), F.lit('"')))
    )


def format_line(point, precision: str = "ns") -> Column:
    """Typed point -> LP text with escaping, ``i`` suffix, plain doubles,
    null fields skipped and the time converted to ``precision`` (truncating)."""
    p = _c(point)
    tags = F.array_sort(F.map_entries(p["tags"]))
    fields = F.filter(F.array_sort(F.map_entries(p["fields"])), lambda e: render_value(e["value"]).isNotNull())
    tag_txt = F.array_join(
        F.transform(tags, lambda e: F.concat(F.lit(","), escape_key(e["key"]), F.lit("="), escape_key(e["value"]))), ""
    )
    field_txt = F.array_join(
        F.transform(fields, lambda e: F.concat(escape_key(e["key"]), F.lit("="), render_value(e["value"]))), ","
    )
    ts = p["ts_ns"]
    ts_txt = F.when(ts.isNull(), F.lit("")).otherwise(F.concat(F.lit(" "), _convert(ts, precision).cast("string")))
    return F.concat(escape_key(p["measurement"]), tag_txt, F.lit(" "), field_txt, ts_txt)


def _convert(ts_ns: Column, unit: str) -> Column:
    f = UNIT_NS[unit]
    if f == 1:
        return ts_ns
    # TimeUnit.convert truncates toward zero, as integral division does
    return int_div(ts_ns, f)


def int_div(c: Column, f: int) -> Column:
    """Exact integral division of a BIGINT, truncating toward zero (decimal, not double, maths)."""
    return (c.cast("decimal(20,0)") / F.lit(f)).cast("bigint")


# --------------------------------------------------------------------------- P14 - P17
def is_numeric(v: Column) -> Column:
    return v["kind"].isin("long", "double")


def drop_non_numeric(point) -> Column:
    p = _c(point)
    return p.withField("fields", F.map_filter(p["fields"], lambda k, v: is_numeric(v)))


def with_tag(point, key: str, value) -> Column:
    p = _c(point)
    v = value if isinstance(value, Column) else F.lit(value)
    kept = F.map_filter(p["tags"], lambda k, _: k != F.lit(key))
    return p.withField("tags", F.map_concat(kept, F.create_map(F.lit(key), v)))


def drop_tags(point, names) -> Column:
    """P7 on a typed point: the tags named (a list, or an array column) are removed."""
    p = _c(point)
    remove = names if isinstance(names, Column) else F.array(*[F.lit(n) for n in names]).cast("array<string>")
    return p.withField("tags", F.map_filter(p["tags"], lambda k, _: ~F.coalesce(F.array_contains(remove, k), F.lit(False))))


def with_field(point, key: str, value) -> Column:
    """Add or replace a field; ``value`` is a Column of any LP value text or a Python scalar."""
    p = _c(point)
    if isinstance(value, bool):
        tv = typed_value(F.lit(str(value).lower()))
    elif isinstance(value, int):
        tv = typed_value(F.lit(f"{value}i"))
    elif isinstance(value, float):
        tv = typed_value(F.lit(repr(value)))
    elif isinstance(value, str):
        tv = F.struct(F.lit("string").alias("kind"), F.lit(None).cast("bigint").alias("l"),
                      F.lit(None).cast("double").alias("d"), F.lit(None).cast("boolean").alias("b"),
                      F.lit(value).alias("s"))
    else:
        tv = typed_value(value)
    kept = F.map_filter(p["fields"], lambda k, _: k != F.lit(key))
    return p.withField("fields", F.map_concat(kept, F.create_map(F.lit(key), tv)))


def with_time(point, t, unit: str = "ns") -> Column:
    p = _c(point)
    return p.withField("ts_ns", _c(t).cast("bigint") * F.lit(UNIT_NS[unit]).cast("bigint"))


def split_fields(point) -> Column:
    """ARRAY of points with one field each (use with ``explode``)."""
    p = _c(point)
    return F.transform(
        F.map_entries(p["fields"]),
        lambda e: p.withField("fields", F.map_from_entries(F.array(e))),
    )


def triples(point, fn: str) -> Column:
    """ARRAY<STRUCT<key, value DOUBLE, fn>>; key ``meas,k=v..|field``; non-numeric dropped."""
    p = _c(point)
    head = F.concat(
        p["measurement"],
        F.array_join(F.transform(F.array_sort(F.map_entries(p["tags"])), lambda e: F.concat(F.lit(","), e["key"], F.lit("="), e["value"])), ""),
    )
    num = F.filter(F.array_sort(F.map_entries(p["fields"])), lambda e: is_numeric(e["value"]))
    return F.transform(
        num,
        lambda e: F.struct(
            F.concat(head, F.lit("|"), e["key"]).alias("key"),
            F.coalesce(e["value"]["d"], e["value"]["l"].cast("double")).alias("value"),
            F.lit(fn).alias("fn"),
        ),
    )
