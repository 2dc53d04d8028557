"""Streaming jobs: the router, the windowed aggregator, the change detector and
the header-event aggregator as Structured Streaming queries (T1-T3, T6, T8).

The transforms are the batch operators; streaming adds the watermark (grace),
append output and a checkpoint in the shared checkpoint folder. Jobs survive
executor loss and restarts through the checkpoint (offsets + state store).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lines as L
from ..operators import aggregate as A
from ..operators import events as EVT
from ..operators import route as R
from ..session import app_checkpoint, scratch_path, use_rocksdb
from ..sources.rules import RuleTable
from .detector import detect_changes

GRACE = A.GRACE


def stream_aggregate(lines: DataFrame, rules: RuleTable, window: str = "30 seconds", grace: str = GRACE,
                     time_col: str = "event_ts") -> DataFrame:
    """LP records -> closed-window aggregate lines, emitted once after window + grace."""
    return A.aggregate(L.explode_fields(A.listed(lines, rules)), rules, window=window, time_col=time_col, watermark=grace)


def stream_router(lines: DataFrame, rules: RuleTable, topics: dict | None = None) -> DataFrame:
    """Router as one map-only stream with a per-row ``topic`` column (K2); the
    database branch keeps the source record key."""
    return R.route(lines, rules, topics, key_col="key" if "key" in lines.columns else None)


def stream_detector(internal: DataFrame, refresh_s: int | None = None) -> DataFrame:
    """On/off detector over internal records (``key``, ``wire`` columns) (T4/T5)."""
    return detect_changes(L.decode_internal(internal), refresh_s=refresh_s)


def stream_event_aggregate(events: DataFrame, rules: RuleTable, default: RuleTable | None, window: str = "30 seconds",
                           grace: str = GRACE) -> DataFrame:
    """A6 on event time: header events -> per-window aggregates with a watermark."""
    return EVT.aggregate_events(EVT.event_points(events, rules, default), window=window, watermark=grace)


def aggregate_micro_batch(points: DataFrame, batch_time_ns: int) -> DataFrame:
    """A6/T6 on one micro-batch (window = slide = batch interval), stamped with the batch time (D2 fixed)."""
    ok = points.filter(F.col("error").isNull()) if "error" in points.columns else points
    g = ok.groupBy("fn", "metric_key").agg(*A.aggregates("value"))
    return g.select("fn", "metric_key", F.lit(int(batch_time_ns)).alias("window_end_ns"), A.picked().alias("value"))


def batch_time_ns(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """When Spark planned a micro-batch, from the query's own offset log, which it writes before
    the batch runs: a replayed batch has the time of its first attempt."""
    log = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{int(batch_id)}")
    at = F.get_json_object("value", "$.batchTimestampMs").cast("bigint")
    return log.filter(F.col("value").startswith('{"batchWatermarkMs"')).select(at).first()[0] * 1_000_000


def start_event_aggregate_per_batch(events: DataFrame, rules: RuleTable, default: RuleTable | None, interval: str,
                                    write_batch, name: str = "header_aggregator", checkpoint: str | None = None, trigger: dict | None = None):
    """The header-event aggregator on processing time. Every trigger interval the
    micro-batch's points are aggregated, stamped with the batch's time in the query's log, so
    that a replayed batch gives the same rows, and handed to ``write_batch(df, batch_id)``
    (e.g. ``points_to_json`` + ``write_udp``)."""
    pts = EVT.event_points(events, rules, default)
    ckpt = checkpoint or app_checkpoint(events.sparkSession, name, "aggregate")

    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(aggregate_micro_batch(batch, batch_time_ns(batch.sparkSession, ckpt, batch_id)), batch_id)

    return (
        pts.writeStream.queryName(name).foreachBatch(each).option("checkpointLocation", ckpt)
        .trigger(**(trigger or {"processingTime": interval})).start()
    )


def start(df: DataFrame, name: str, sink: str = "parquet", path: str | None = None, trigger: dict | None = None,
          checkpoint: str | None = None, mode: str = "append", options: dict | None = None):
    """Start a query with its checkpoint under ``spark.checkpoint.dir``."""
    spark = df.sparkSession
    use_rocksdb(spark)
    ckpt = checkpoint or app_checkpoint(spark, name, "query")
    w = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", ckpt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w = w.trigger(**(trigger or {"availableNow": True}))
    if sink in ("parquet", "json", "text", "csv"):
        return w.format(sink).start(path)
    return w.format(sink).start()


def run_to_table(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over all available input (availableNow) into a parquet folder in the
    shared checkpoint root and return the result as a batch DataFrame."""
    spark: SparkSession = df.sparkSession
    out = scratch_path(spark, f"{name}-out")
    # a run of its own: it ends with its input, so nothing is taken up again
    q = start(df, name, sink="parquet", path=out, checkpoint=scratch_path(spark, f"{name}-ckpt"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(df.schema).parquet(out)
