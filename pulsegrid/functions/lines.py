"""Line-protocol (LP) text as Column expressions and narrow DataFrame steps.

LP record: ``<measurement>[,<tags>] <f1>=<v1>[,<fN>=<vN>] [<timestamp>]``.
Everything here is a built-in Spark expression, so it stays inside whole-stage
codegen and works the same on batch and streaming DataFrames (no shuffle).

Splitting rules kept from the reference: tokens on a single space, fields on
``,`` and ``=`` without quote awareness, a trailing token is a timestamp iff it
parses as a long, other tokens after the first are re-joined with spaces (so
spaces inside values survive), and trailing empty pieces of a split are dropped,
as Java's ``String.split`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separator of the internal record (key ``meas#field``,
# value ``tags#fieldValue#timestamp``) and the long grammar of a timestamp token.
KEY_SEP = "#"
LONG_RE = r"^[+-]?[0-9]+$"

FIELD_COLUMNS = ["measurement", "tags", "field", "value", "ts_ns"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def kv(key, value) -> Column:
    """A ``STRUCT<key, value>`` map entry; ``key`` may be a str literal."""
    k = F.lit(key) if isinstance(key, str) else key
    return F.struct(k.alias("key"), _c(value).alias("value"))


def java_split(s, sep: str) -> Column:
    """``split`` on one literal character, dropping trailing empty strings."""
    esc = "\\" + sep if sep in "\\^$.|?*+()[]{}" else sep
    return F.split(F.rtrim(_c(s), F.lit(sep)), esc)


def parse_long(s) -> Column:
    """Java ``Long.parseLong``: optional sign and digits, 64-bit range, else null."""
    s = _c(s)
    return F.when(s.rlike(LONG_RE), s.try_cast("bigint"))


# --------------------------------------------------------------------------- P1
def explode_fields(df: DataFrame, value_col: str = "value", keep_bad: bool = False) -> DataFrame:
    """One row per LP field (M2): measurement, tags, field, value, ts_ns.

    Other input columns pass through (event_ts, src_partition, src_offset ...).
    With ``keep_bad`` the result also has ``error`` (null when good) and ``line``
    (the raw record), so malformed input lands in a separate output instead of
    being lost; without it only good rows are returned.
    """
    passthrough = [c for c in df.columns if c != value_col]
    d = df.select(*passthrough, F.col(value_col).alias("line"))
    d = d.withColumns({"_toks": F.split(F.rtrim("line"), " ")})
    d = d.withColumns({"_n": F.size("_toks"), "_last": F.element_at("_toks", -1)})
    d = d.withColumns(
        {
            "ts_ns": F.when(F.col("_n") >= 2, parse_long("_last")),
            "_head": F.rtrim(F.element_at("_toks", 1), F.lit(",")),
        }
    )
    d = d.withColumns(
        {
            "_nb": F.col("_n") - 1 - F.when(F.col("ts_ns").isNotNull(), 1).otherwise(0),
            "measurement": F.substring_index("_head", ",", 1),
        }
    )
    d = d.withColumns(
        {
            "tags": F.when(
                F.col("_head").contains(","),
                F.expr("substr(_head, length(measurement) + 2)"),
            ).otherwise(F.lit("")),
            "_fields": F.when(
                F.col("_n") >= 2,
                java_split(F.array_join(F.slice("_toks", 2, F.greatest(F.col("_nb"), F.lit(0))), " "), ","),
            ),
        }
    )
    d = d.select(*passthrough, "line", "measurement", "tags", "ts_ns", F.posexplode_outer("_fields").alias("_pos", "_f"))
    fr = F.rtrim("_f", F.lit("="))
    n_eq = F.length(fr) - F.length(F.replace(fr, F.lit("="), F.lit("")))
    error = (
        F.when(F.col("line").isNull(), F.lit("null record"))
        .when(F.col("_f").isNull(), F.lit("too few tokens"))
        .when(n_eq != 1, F.lit("malformed field"))
    )
    d = d.select(
        *passthrough,
        "line",
        "measurement",
        "tags",
        F.substring_index(fr, "=", 1).alias("field"),
        F.substring_index(fr, "=", -1).alias("value"),
        "ts_ns",
        F.coalesce(F.col("_pos"), F.lit(0)).alias("field_pos"),
        error.alias("error"),
    )
    if keep_bad:
        return d
    return d.filter(F.col("error").isNull()).drop("error", "line")


def bad_rows(df: DataFrame) -> DataFrame:
    """The malformed part of an ``explode_fields(..., keep_bad=True)`` result."""
    return df.filter(F.col("error").isNotNull())


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("error").isNull())


def measurement_of(line) -> Column:
    """Measurement token of a whole record: up to the first ``,`` or space (D4 fixed)."""
    return F.regexp_extract(_c(line), r"^[^, ]*", 0)


# --------------------------------------------------------------------------- P2
def encode_internal(df: DataFrame) -> DataFrame:
    """Field rows -> internal wire pair ``key = meas#field``, ``wire = tags#value#ts``."""
    ts = F.coalesce(F.col("ts_ns").cast("string"), F.lit(""))
    return df.withColumns(
        {
            "key": F.trim(F.concat_ws(KEY_SEP, "measurement", "field")),
            "wire": F.trim(F.concat_ws(KEY_SEP, "tags", "value", ts)),
        }
    )


def decode_internal(df: DataFrame, key_col: str = "key", value_col: str = "wire", keep_bad: bool = False) -> DataFrame:
    """Internal wire pair -> field rows. Key must have 2 parts, value 2 or 3 (D6: else bad)."""
    kp = java_split(F.trim(F.col(key_col)), KEY_SEP)
    vp = java_split(F.trim(F.col(value_col)), KEY_SEP)
    d = df.withColumns({"_kp": kp, "_vp": vp})
    ts_text = F.when(F.size("_vp") == 3, F.element_at("_vp", 3))
    error = (
        F.when(F.col(key_col).isNull() | F.col(value_col).isNull(), F.lit("null record"))
        .when(F.size("_kp") != 2, F.lit("bad key"))
        .when((F.size("_vp") < 2) | (F.size("_vp") > 3), F.lit("bad value"))
        .when(ts_text.isNotNull() & parse_long(ts_text).isNull(), F.lit("bad timestamp"))
    )
    d = d.withColumns(
        {
            "measurement": F.try_element_at("_kp", F.lit(1)),
            "field": F.try_element_at("_kp", F.lit(2)),
            "tags": F.try_element_at("_vp", F.lit(1)),
            "value": F.try_element_at("_vp", F.lit(2)),
            "ts_ns": parse_long(ts_text),
            "error": error,
        }
    ).drop("_kp", "_vp")
    if keep_bad:
        return d
    return d.filter(F.col("error").isNull()).drop("error")


# --------------------------------------------------------------------------- P7
def remove_tags(tags, names) -> Column:
    """Drop tags whose name is in ``names`` (ARRAY<STRING> column), keep the order of the rest."""
    names = _c(names)
    kept = F.filter(
        F.split(_c(tags), ","),
        lambda t: ~F.coalesce(F.array_contains(names, F.substring_index(t, "=", 1)), F.lit(False)),
    )
    return F.array_join(kept, ",")


# --------------------------------------------------------------------------- P8
# Words that Java's Double.parseDouble takes (Spark's cast knows more spellings),
# and how any other text ends that it may take: after a digit, in a digit, a point, one of its
# type letters or white space.
_JAVA_WORDS = r"^[+-]?(Infinity|NaN)$"
_MAYBE_DOUBLE = r"(?s)[0-9](.*[0-9.dDfF\x00-\x20])?\z"


def java_double(value) -> Column:
    """Java ``Double.parseDouble`` grammar -> DOUBLE or null. Text that can't be a number is
    not cast: inside Spark each such cast is an exception, the dearest step of a record."""
    v = _c(value)
    t = F.trim(v)
    return F.when(t.rlike(_MAYBE_DOUBLE) | t.rlike(_JAVA_WORDS), v.try_cast("double"))


def to_double(value) -> Column:
    """Numeric coercion of a field value: Java double grammar, else drop one last
    character and parse a long (``100i`` -> 100.0, ``5%`` -> 5.0); otherwise null."""
    v = _c(value)
    prefix = F.regexp_extract(v, r"^([+-]?[0-9]+)(?s:.)$", 1)
    as_long = F.when(prefix != "", prefix.try_cast("bigint").cast("double"))
    return F.coalesce(java_double(v), as_long)


# --------------------------------------------------------------------------- P9 / P10 / P11
def series_key(measurement, tags, field) -> Column:
    """``meas,tags#field``, or ``meas#field`` when there are no tags."""
    m, t, f = _c(measurement), F.trim(_c(tags)), _c(field)
    return F.when(t == "", F.concat(m, F.lit(KEY_SEP), f)).otherwise(F.concat(m, F.lit(","), t, F.lit(KEY_SEP), f))


def series_head(measurement, tags) -> Column:
    """``meas,tags`` or ``meas`` (D7: no dangling comma)."""
    m, t = _c(measurement), _c(tags)
    return F.when(F.coalesce(t, F.lit("")) == "", m).otherwise(F.concat(m, F.lit(","), t))


def render_line(measurement, tags, field, value, ts_ns=None) -> Column:
    """One-field LP line ``meas[,tags] field=value[ ts]``."""
    body = F.concat(series_head(measurement, tags), F.lit(" "), _c(field), F.lit("="), _c(value))
    if ts_ns is None:
        return body
    ts = _c(ts_ns)
    return F.when(ts.isNull(), body).otherwise(F.concat(body, F.lit(" "), ts.cast("string")))


def render_aggregate(series, fn, value, end_ns) -> Column:
    """Aggregate line ``<meas,tags> <field>_<fn>=<value> <windowEndNs>``."""
    return F.concat(
        F.regexp_replace(_c(series), KEY_SEP, " "),
        F.lit("_"),
        _c(fn),
        F.lit("="),
        _c(value).cast("string"),
        F.lit(" "),
        _c(end_ns).cast("string"),
    )


def window_end_ns(window_col="window") -> Column:
    return F.unix_micros(_c(window_col).getField("end")) * F.lit(1000)


def event_ts_from_ns(ts_ns) -> Column:
    """TIMESTAMP from epoch nanoseconds (Spark keeps microseconds)."""
    return F.timestamp_micros(F.floor(_c(ts_ns) / 1000).cast("bigint"))


def tag_ingest_time(line, now_ns, tag: str = "timestamp") -> Column:
    """P20: append ``,<tag>=<now ns>`` to the first token of a record."""
    l = F.regexp_replace(_c(line), " +$", "")
    pos = F.locate(" ", l)
    rest = F.when(pos > 0, F.substr(l, pos, F.length(l))).otherwise(F.lit(""))
    return F.concat(F.substring_index(l, " ", 1), F.lit(f",{tag}="), _c(now_ns).cast("string"), rest)
