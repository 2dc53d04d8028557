"""Change detection over bounded tables (W1-W3): batch forms of the on/off detector.

Arrival order is ``(src_partition, src_offset)``, inside a record ``field_pos`` where the
fields have it (the place of the field, so that a field named twice has an order). A series is the series key
``meas,tags#field``; values compare as **strings** (``1i`` then ``1.0`` is a change).

Skew: a single series may hold a large share of all rows, so no step puts a
whole series into one task. ``changes`` cuts each series into offset chunks of
at most ``chunk_rows`` offsets; ``lag`` runs inside a chunk, and only the first
row of each chunk is checked against the last row of the previous chunk, found
by a second ``lag`` over the chunk boundary rows alone (two rows per chunk).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lines as L
from ..session import checkpoint_root

ORDER = ("src_partition", "src_offset")
CHUNK_ROWS = 1 << 20
#: Ticks laid out at once for one row of the refresh grid.
RUN = 10_000
#: Reduced rows of the grid that one task lays out.
GRID_ROWS = 1 << 17


def with_series(fields: DataFrame) -> DataFrame:
    if "series" in fields.columns:
        return fields
    return fields.withColumn("series", L.series_key("measurement", "tags", "field"))


def _place(df: DataFrame) -> Column:
    """The place of a field inside its record."""
    return F.col("field_pos") if "field_pos" in df.columns else F.lit(0)


def changes(fields: DataFrame, chunk_rows: int = CHUNK_ROWS, previous: DataFrame | None = None) -> DataFrame:
    """Rows that are the first of their series or differ from the previous value.

    One shuffle: ``lag`` runs per (series, partition, offset chunk). Only the
    first row of a chunk needs the row before it, which is the last row of the
    previous chunk; so the chunk boundary rows (first and last, at most two per
    chunk) get a second ``lag`` per series, over a table of ``2 x chunks`` rows. With
    ``previous`` (series, value), the values before these rows, the first row of a series is
    compared with its value there.

    Output keeps the input columns plus ``series``, ``key`` (``meas#field``) and
    ``line`` (the one-field LP record that the detector forwards).
    """
    x = with_series(fields).withColumn("_chunk", F.expr(f"src_offset div {int(chunk_rows)}"))
    x = x.withColumn("_place", _place(fields))
    w = Window.partitionBy("series", "src_partition", "_chunk").orderBy("src_offset", "_place")
    x = x.withColumns(
        {
            "_prev": F.lag("value").over(w),
            "_first": F.lag("src_offset").over(w).isNull(),
            "_last": F.lead("src_offset").over(w).isNull(),
        }
    )
    inner = x.filter(~F.col("_first") & ~F.col("value").eqNullSafe(F.col("_prev")))
    edges = x.filter(F.col("_first") | F.col("_last"))
    we = Window.partitionBy("series").orderBy("src_partition", "_chunk", "src_offset", "_place")
    firsts = edges.withColumn("_new", F.lag("src_offset").over(we).isNull()).withColumn("_prev", F.lag("value").over(we)).filter("_first")
    if previous is not None:
        known = previous.select("series", F.col("value").alias("_known"))
        firsts = firsts.join(known, "series", "left").withColumn("_prev", F.when(F.col("_new"), F.col("_known")).otherwise(F.col("_prev"))).drop("_known")
    firsts = firsts.drop("_new").filter(F.col("_prev").isNull() | ~F.col("value").eqNullSafe(F.col("_prev")))
    out = inner.unionByName(firsts)
    return out.drop("_chunk", "_prev", "_first", "_last", "_place").withColumns(
        {
            "key": F.concat_ws(L.KEY_SEP, "measurement", "field"),
            "line": L.render_line("measurement", "tags", "field", "value", "ts_ns"),
        }
    )


def latest(fields: DataFrame) -> DataFrame:
    """Latest value per series in arrival order (partial aggregation, skew-safe)."""
    x = with_series(fields)
    order = F.struct(*[F.col(c) for c in ORDER], _place(x).alias("field_pos"))
    row = F.struct("measurement", "tags", "field", "value", "ts_ns", *[F.col(c) for c in ORDER])
    g = x.groupBy("series").agg(F.max_by(row, order).alias("r"), F.count(F.lit(1)).alias("n_rows"))
    return g.select("series", "r.*", "n_rows")


def refresh(fields: DataFrame, period_s: int, time_col: str = "event_ts", until_ns: int | None = None) -> DataFrame:
    """Refresh grid. At every tick ``t`` (multiples of the period, epoch aligned)
    each series seen before ``t`` is emitted with its latest value, stamped ``t``,
    up to ``until_ns`` (default: the last tick that has data).

    The time is that of the record (``event_ts``); a column of nanoseconds such as
    ``ts_ns`` is taken as it is (also where there is no ``event_ts``), rows without it by
    their record time; a row without any time has no place in the grid. Rows are first
    reduced to the last value per (series, tick) with a partial aggregate. Each of those
    rows then covers its own tick up to the series' next one (``lead`` over one row per
    series and tick), which forward-fills the grid without a join, a union or a
    whole-series buffer; a long gap is laid out in runs of ``RUN`` ticks. Without
    ``until_ns`` the reduced rows are checkpointed, so that finding the last tick reads
    them and not the input again.
    """
    p_ns = int(period_s) * 1_000_000_000
    b = ticks(fields, p_ns, time_col)
    if until_ns is None:
        checkpoint_root(fields.sparkSession)
        b = b.checkpoint()
        last, rows = b.select(F.max("tick_ns"), F.count(F.lit(1))).first()
        return grid(b, p_ns, F.lit(last).cast("bigint"), rows)
    return grid(b, p_ns, F.lit(int(until_ns)))


def ticks(fields: DataFrame, p_ns: int, time_col: str = "event_ts") -> DataFrame:
    """The last row of each series before each tick: (series, tick_ns, ord, r), the number ``n``
    of rows behind it and the ``latest`` time of them."""
    x = with_series(fields)
    at = F.unix_micros("event_ts") * 1000 if "event_ts" in x.columns else F.lit(None).cast("bigint")
    ns = at if time_col == "event_ts" and "event_ts" in x.columns else F.coalesce(F.col("ts_ns" if time_col == "event_ts" else time_col), at)
    tick = F.col("_ns") - F.pmod(F.col("_ns"), F.lit(p_ns)) + F.lit(p_ns)
    order = F.struct(F.col("src_partition").cast("int").alias("src_partition"), F.col("src_offset").cast("bigint").alias("src_offset"), _place(x).cast("int").alias("field_pos"))
    return x.withColumn("_ns", ns).filter(F.col("_ns").isNotNull()).withColumn("tick_ns", tick.cast("bigint")).groupBy("series", "tick_ns").agg(
        F.max(order).alias("ord"), F.max_by(F.struct("measurement", "tags", "field", "value"), order).alias("r"), F.count("*").alias("n"), F.max("_ns").alias("latest"))


def last_of_ticks(rows: DataFrame) -> DataFrame:
    """Of reduced rows (series, tick_ns, ord, r) the last of each series and tick; ``ord`` null
    stands before any other."""
    order = F.struct(F.col("ord").isNotNull().alias("row"), F.col("ord"))
    return rows.groupBy("series", "tick_ns").agg(F.max_by(F.struct("ord", "r"), order).alias("x")).select("series", "tick_ns", "x.ord", "x.r")


def grid(b: DataFrame, p_ns: int, last_tick: Column, rows: int | None = None) -> DataFrame:
    """Reduced rows (series, tick_ns, r) laid out to the series' next one, up to ``last_tick``.
    With their number ``rows`` the series are dealt out so that a task's share does not grow."""
    if rows is not None:
        b = b.repartition(max(b.sparkSession.sparkContext.defaultParallelism, -(-rows // GRID_ROWS)), "series")
    w = Window.partitionBy("series").orderBy("tick_ns")
    nxt = F.coalesce(F.lead("tick_ns").over(w), last_tick + F.lit(p_ns))
    g = b.withColumn("_next", nxt).filter(F.col("tick_ns") < F.col("_next"))
    step, run = F.lit(p_ns).cast("bigint"), F.lit(p_ns * RUN).cast("bigint")
    g = g.withColumn("_run", F.explode(F.sequence(F.col("tick_ns"), F.col("_next") - step, run)))
    out = g.select(
        "series",
        F.explode(F.sequence(F.col("_run"), F.least(F.col("_run") + run, F.col("_next")) - step, step)).alias("tick_ns"),
        "r.*",
    )
    return out.withColumn("line", L.render_line("measurement", "tags", "field", "value", "tick_ns"))
