"""Counters and delivery summaries.

``latency_summary`` reproduces the load tool's end-of-run report on a delivery
log table (one row per record: time, latency, bytes): count, records/s, MB/s,
average and maximum latency and the p50/p95/p99/p99.9 order statistics with
the index ``floor(p*n)`` of the sorted latencies. No sort and no window: latencies are
counted per distinct value (partial aggregation), and a rank is found by radix selection.
The range that holds it is cut into ``FAN`` parts, whose counts (at most ``FAN`` numbers a
percentile) tell the part that holds it, until a part is one value: ``log(range) / log(FAN)``
rounds, each an aggregate of the counts in that range alone. However the values are spread,
no task holds more than a share of them. One scan of the log.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root

# The reported percentiles.
PERCENTILES = (("p50", 0.5), ("p95", 0.95), ("p99", 0.99), ("p999", 0.999))
#: Parts into which a range is cut in a round.
FAN = 1024


def count_stages(**stages: DataFrame) -> DataFrame:
    """``(stage, n)`` rows, one count per named DataFrame (received / imported / to send)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n") for name, df in stages.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def order_statistics(counts: DataFrame, ranks: dict[str, int], low: int, high: int) -> dict[str, int]:
    """The values at places ``ranks`` (from 0) of the sorted multiset ``counts`` (lat, c), whose
    least and greatest value are ``low`` and ``high``."""
    # ranges under way: least value, number of values, and the ranks inside them
    open_ranges = {(low, high - low + 1): dict(ranks)}
    found: dict[str, int] = {}
    while open_ranges:
        ranges = list(open_ranges.items())
        digit = F.lit(None).cast("struct<i: int, part: bigint>")
        for i, ((lo, width), _) in enumerate(ranges):
            step = -(-width // FAN)
            # a difference may pass 63 bits
            part = F.expr(f"(cast(lat as decimal(20,0)) - cast('{lo}' as decimal(20,0))) div cast('{step}' as decimal(20,0))")
            digit = F.when(F.col("lat").between(lo, lo + width - 1), F.struct(F.lit(i).alias("i"), part.cast("bigint").alias("part"))).otherwise(digit)
        sums = counts.withColumn("d", digit).filter("d is not null").groupBy("d").agg(F.sum("c").alias("c"))
        of: dict[int, list[tuple[int, int]]] = {}
        for r in sums.collect():  # FAN rows a range at most, as many ranges as percentiles at most
            of.setdefault(r.d.i, []).append((r.d.part, r.c))
        open_ranges = {}
        for i, ((lo, width), inside) in enumerate(ranges):
            step = -(-width // FAN)
            for name, rank in inside.items():
                for part, c in sorted(of[i]):
                    if rank < c:
                        break
                    rank -= c
                if step == 1:
                    found[name] = lo + part
                else:
                    at = lo + part * step
                    open_ranges.setdefault((at, min(step, lo + width - at)), {})[name] = rank
    return found


def event_stage_counts(points: DataFrame, window_s: int, time_col: str = "event_ts") -> DataFrame:
    """A7 over header-event points (``event_points(..., keep_unmatched=True)``) in one
    aggregate: received events, imported points and aggregates to send (distinct
    window/function/metric groups), as ``(stage, n)`` rows."""
    w_us = int(window_s) * 1_000_000
    valid = F.col("error").isNull() & F.col("fn").isNotNull()
    end_us = (F.expr(f"unix_micros({time_col}) div {w_us}") + 1) * F.lit(w_us)
    agg = points.agg(
        F.count(F.when(F.col("event_first"), F.lit(1))).alias("received"),
        F.count(F.when(valid, F.lit(1))).alias("imported"),
        F.count_distinct(F.when(valid, F.struct(end_us.alias("e"), F.col("fn"), F.col("metric_key")))).alias("to_send"),
    )
    stages = F.array(*[F.struct(F.lit(n).alias("stage"), F.col(n).cast("bigint").alias("n")) for n in ("received", "imported", "to_send")])
    return agg.select(F.explode(stages).alias("s")).select("s.stage", "s.n")


def latency_summary(log: DataFrame, latency_col: str = "latency_ms", bytes_col: str = "bytes", time_col: str = "event_ts",
                    materialize: bool = True) -> DataFrame:
    """One-row report over the whole log, from a single scan."""
    lat = F.col(latency_col).cast("bigint")
    counts = log.filter(lat.isNotNull()).groupBy(lat.alias("lat")).agg(
        F.count(F.lit(1)).alias("c"),
        F.sum(F.col(bytes_col).cast("decimal(38,0)")).alias("sb"),
        F.min(time_col).alias("t0"),
        F.max(time_col).alias("t1"),
    )
    if materialize:
        # one row per distinct latency: written once to the shared checkpoint folder,
        # so the rounds below read it instead of scanning the log again
        checkpoint_root(log.sparkSession)
        counts = counts.checkpoint()
    n, low, high = counts.agg(F.sum("c"), F.min("lat"), F.max("lat")).first()
    ranks = {name: math.floor(p * n) for name, p in PERCENTILES} if n else {}
    at = order_statistics(counts, ranks, low, high) if n else {}
    rep = counts.agg(
        F.sum("c").alias("count"),
        F.sum((F.col("lat").cast("decimal(19,0)") * F.col("c").cast("decimal(18,0)")).cast("decimal(38,0)")).alias("_lat_sum"),
        F.max("lat").alias("max_latency"),
        F.sum("sb").alias("_bytes"),
        (F.unix_millis(F.max("t1")) - F.unix_millis(F.min("t0"))).alias("_elapsed_ms"),
    ).withColumns({name: F.lit(at.get(name)).cast("bigint") for name, _ in PERCENTILES})
    el = F.col("_elapsed_ms")
    return rep.select(
        "count",
        F.when(el > 0, F.lit(1000.0) * F.col("count") / el).alias("records_per_s"),
        F.when(el > 0, F.lit(1000.0) * F.col("_bytes").cast("double") / el / F.lit(1024.0 * 1024.0)).alias("mb_per_s"),
        (F.col("_lat_sum").cast("double") / F.col("count")).alias("avg_latency"),
        "max_latency",
        *[name for name, _ in PERCENTILES],
    )


def latency_windows(log: DataFrame, interval: str = "5 seconds", latency_col: str = "latency_ms", bytes_col: str = "bytes",
                    time_col: str = "event_ts") -> DataFrame:
    """A8 per reporting window: count, records/s, MB/s, average and maximum latency."""
    secs = F.unix_seconds(F.col("window.end")) - F.unix_seconds(F.col("window.start"))
    g = log.groupBy(F.window(time_col, interval).alias("window")).agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(F.col(latency_col)).alias("avg_latency"),
        F.max(F.col(latency_col)).alias("max_latency"),
        F.sum(F.col(bytes_col)).alias("_bytes"),
    )
    return g.select(
        (F.unix_micros(F.col("window.end")) * 1000).alias("window_end_ns"),
        "count",
        (F.col("count") / secs).alias("records_per_s"),
        (F.col("_bytes") / secs / F.lit(1024.0 * 1024.0)).alias("mb_per_s"),
        "avg_latency",
        "max_latency",
    )
