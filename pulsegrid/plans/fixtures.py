"""Input views derived by Spark from the driver tables.

Every registered query starts from one of these, so its work grows with the
tables. Nothing here collects or synthesizes data on the driver.

The canonical LP view (``lines``) is built from ``events``::

    {event_type},user=u{user_id},shard=s{user_id mod 4} value={value},k={k}i,bad={true|false} {epoch ns}

with ``event_ts`` the event time, ``src_partition`` the shard and
``src_offset`` the ``event_id`` (arrival order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lines import kv

#: Stored bytes of a table behind one input partition.
PART_BYTES = 2 << 20
#: Most partitions that are made; a table that needs more has as many splits of its own.
MOST_PARTS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """At least one input partition per core, and one for every ``PART_BYTES`` that are
    stored: a row group is read by one task however many splits its file has, so that both a
    small table and large row groups would leave all rows to a few tasks. A table stored
    in enough splits is left alone (no extra shuffle)."""
    stored = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    least = max(df.sparkSession.sparkContext.defaultParallelism, min(MOST_PARTS, -(-stored // PART_BYTES)))
    if df._jdf.queryExecution().toRdd().getNumPartitions() < least:
        # by one column, so that the scan still reads only what a query needs, and by a
        # hash: deterministic on retry without the local sort of round-robin
        return df.repartition(least, "ts" if "ts" in df.columns else df.columns[0])
    return df


def ntz_micros(col: str | Column) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ column read as UTC wall time,
    independent of the session time zone (no cast through the session zone)."""
    c = F.col(col) if isinstance(col, str) else col
    utc = F.make_timestamp(
        F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c), F.date_part(F.lit("SECOND"), c), F.lit("UTC")
    )
    return F.unix_micros(utc)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with derived epoch columns and the integer ``k`` from ``props``."""
    return events_from(table(spark, sf_dir, "events"))


def events_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The ``events`` table as a file stream (same derived columns as ``events``)."""
    schema = table(spark, sf_dir, "events").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return events_from(r.parquet(sf_dir))


def events_from(ev: DataFrame) -> DataFrame:
    us = ntz_micros("ts")
    return ev.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        (us * 1000).alias("ts_ns"),
        us.alias("ts_us"),
        F.timestamp_micros(us).alias("event_ts"),
    )


def lp_text() -> Column:
    """The canonical LP record of one ``events`` row (columns of ``events()``)."""
    shard = F.pmod("user_id", F.lit(4))
    return F.concat(
        F.col("event_type"),
        F.lit(",user=u"),
        F.col("user_id").cast("string"),
        F.lit(",shard=s"),
        shard.cast("string"),
        F.lit(" value="),
        F.col("value").cast("string"),
        F.lit(",k="),
        F.col("k").cast("string"),
        F.lit("i,bad="),
        (F.col("event_type") == "error").cast("string"),
        F.lit(" "),
        F.col("ts_ns").cast("string"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LP records: ``value STRING, event_ts TIMESTAMP, src_partition INT, src_offset BIGINT``."""
    return lines_from(events(spark, sf_dir))


def lines_from(ev: DataFrame) -> DataFrame:
    return ev.select(
        lp_text().alias("value"),
        "event_ts",
        F.pmod("user_id", F.lit(4)).cast("int").alias("src_partition"),
        F.col("event_id").alias("src_offset"),
    )


def header_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header events (M4) from ``events``: ``src_offset, headers MAP<STRING,STRING>, body BINARY, event_ts``.

    Keys: name, tag_user, tag_shard, value_value, value_k, timestamp (ns) and
    type_value; the body carries the LP record. ``error`` events are the broken
    ones: they have no ``name`` header and an empty body.
    """
    return header_events_from(events(spark, sf_dir))


def header_events_from(ev: DataFrame) -> DataFrame:
    is_err = F.col("event_type") == "error"
    entries = F.array(
        kv("name", F.when(~is_err, F.col("event_type"))),
        kv("tag_user", F.concat(F.lit("u"), F.col("user_id").cast("string"))),
        kv("tag_shard", F.concat(F.lit("s"), F.pmod("user_id", F.lit(4)).cast("string"))),
        kv("value_value", F.col("value").cast("string")),
        kv("value_k", F.col("k").cast("string")),
        kv("timestamp", F.col("ts_ns").cast("string")),
        kv("type_value", F.lit("double")),
    )
    headers = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    body = F.when(is_err, F.lit("")).otherwise(lp_text())
    return ev.select(
        F.col("event_id").alias("src_offset"),
        headers.alias("headers"),
        F.encode(body, "UTF-8").alias("body"),
        "event_ts",
    )


def json_event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datagram payloads of the JSON event source: ``{"headers":{..},"body":""}`` plus the delimiter."""
    h = header_events(spark, sf_dir)
    js = F.to_json(F.struct(F.col("headers").alias("headers"), F.lit("").alias("body")))
    return h.select("src_offset", F.concat(js, F.lit("\n")).alias("value"), "event_ts")


def collectd_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """collectd JSON documents (one array with one object per event).

    values = [value (gauge), k (derive)]; ``error`` events report an unknown
    second data-source type, so that value is bad and the first one still good.
    """
    ev = events(spark, sf_dir)
    second_type = F.when(F.col("event_type") == "error", F.lit("histogram")).otherwise(F.lit("derive"))
    doc = F.struct(
        F.array(F.col("value"), F.col("k").cast("double")).alias("values"),
        F.array(F.lit("gauge"), second_type).alias("dstypes"),
        F.array(F.lit("value"), F.lit("k")).alias("dsnames"),
        (F.col("ts_us") / F.lit(1e6)).alias("time"),
        F.lit(10.0).alias("interval"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("host"),
        F.col("event_type").alias("plugin"),
        F.concat(F.lit("s"), F.pmod("user_id", F.lit(4)).cast("string")).alias("plugin_instance"),
        F.lit("evt").alias("type"),
        F.lit("").alias("type_instance"),
    )
    return ev.select(F.col("event_id").alias("src_offset"), F.to_json(F.array(doc)).alias("value"), "event_ts")


def _u() -> Column:
    return F.concat(F.lit("u"), F.col("user_id").cast("string"))


def _s() -> Column:
    return F.concat(F.lit("s"), F.pmod("user_id", F.lit(4)).cast("string"))


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notification JSON per event: ``error`` events carry a description (client_url
    when k >= 50, details when value > 100); the others lack it and are invalid."""
    ev = events(spark, sf_dir)
    is_err = F.col("event_type") == "error"
    desc = F.struct(
        F.concat(F.lit("error from "), _u()).alias("description"),
        F.when(F.col("k") >= 50, F.concat(F.lit("https://mon.example/e/"), F.col("event_id").cast("string"))).alias("client_url"),
        F.when(F.col("value") > 100, F.concat(F.lit("value="), F.col("value").cast("string"))).alias("details"),
    )
    other = F.struct(F.col("event_type").alias("summary"), _u().alias("user"))
    js = F.when(is_err, F.to_json(desc)).otherwise(F.to_json(other))
    return ev.select(F.col("event_id").alias("src_offset"), js.alias("value"), "event_ts")


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-mail JSON per event: signup messages lack ``body``, view messages ``to_addresses``,
    error messages are no JSON; click messages have one recipient, the others two."""
    ev = events(spark, sf_dir)
    kind = F.col("event_type")
    to = F.when(kind == "click", F.concat(_s(), F.lit("@example.org"))).when(kind != "view", F.concat(_u(), F.lit("@example.org,"), _s(), F.lit("@example.org")))
    body = F.when(kind != "signup", F.concat(F.lit("value="), F.col("value").cast("string")))
    js = F.to_json(F.struct(F.concat(F.col("event_type"), F.lit(" "), _u()).alias("subject"), body.alias("body"), to.alias("to_addresses")))
    js = F.when(kind == "error", F.lit("{broken")).otherwise(js)
    return ev.select(F.col("event_id").alias("src_offset"), js.alias("value"), "event_ts")


def measurement_dicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring dict JSON per event; ``time`` in epoch milliseconds."""
    ev = events(spark, sf_dir)
    d = F.struct(
        F.col("event_type").alias("measurement"),
        F.struct(_u().alias("user"), _s().alias("shard")).alias("tags"),
        F.struct(
            F.col("value").alias("value"),
            F.col("k").alias("k"),
            (F.col("event_type") == "error").alias("bad"),
            F.col("event_type").alias("note"),
        ).alias("fields"),
        F.expr("ts_us div 1000").alias("time"),
    )
    return ev.select(F.col("event_id").alias("src_offset"), F.to_json(d).alias("value"), "event_ts")


def raw_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times written in different units: view s, click ms, signup µs, purchase ns, error ms x 10 (unknown)."""
    ev = events(spark, sf_dir)
    t = (
        F.when(F.col("event_type") == "view", F.expr("ts_us div 1000000"))
        .when(F.col("event_type") == "click", F.expr("ts_us div 1000"))
        .when(F.col("event_type") == "signup", F.col("ts_us"))
        .when(F.col("event_type") == "purchase", F.col("ts_ns"))
        .otherwise(F.expr("(ts_us div 1000) * 10"))
    )
    return ev.select(F.col("event_id").alias("src_offset"), "event_type", t.alias("raw_ts"), "event_ts")


def agent_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agent metric snapshots: ``value`` JSON ``{component: {Type, metric: "number"}}``, ``name``, ``endpoint``, ``sampled_ns``."""
    ev = events(spark, sf_dir)
    src = F.struct(
        F.lit("SOURCE").alias("Type"),
        F.col("k").cast("string").alias("EventReceivedCount"),
        F.col("user_id").cast("string").alias("OpenConnectionCount"),
        F.lit("n/a").alias("StartTime"),
        F.lit(None).cast("string").alias("ChannelFillPercentage"),
    )
    m = F.create_map(
        F.concat(F.lit("SOURCE.src_"), F.col("event_type")), src,
        F.concat(F.lit("CHANNEL.ch_"), _s()), F.struct(F.lit("CHANNEL").alias("Type"), F.lit(None).cast("string").alias("EventReceivedCount"),
                                                       F.lit(None).cast("string").alias("OpenConnectionCount"), F.lit(None).cast("string").alias("StartTime"),
                                                       F.col("value").cast("string").alias("ChannelFillPercentage")),
    )
    js = F.to_json(F.transform_values(m, lambda k, v: F.map_filter(
        F.from_json(F.to_json(v), "MAP<STRING,STRING>"), lambda kk, vv: vv.isNotNull())))
    return ev.select(
        F.col("event_id").alias("src_offset"),
        js.alias("value"),
        F.concat(F.lit("agent"), F.pmod("user_id", F.lit(4)).cast("string")).alias("name"),
        F.concat(F.lit("host"), F.pmod("user_id", F.lit(4)).cast("string"), F.lit(":5653")).alias("endpoint"),
        F.col("ts_ns").alias("sampled_ns"),
        "event_ts",
    )


# event type that reports each Spark-status kind
SNAPSHOT_TYPES = {"stats": ("signup",), "batches": ("purchase",), "executors": ("view", "error"), "allexecutors": ("click",)}


def _snapshot_obj(kind: str) -> Column:
    if kind == "stats":
        return F.struct(
            F.lit("2024-01-01T00:00:00.000GMT").alias("startTime"),
            F.lit(30000).alias("batchDuration"),
            F.pmod("user_id", F.lit(4)).alias("numReceivers"),
            F.col("k").alias("numTotalCompletedBatches"),
            F.col("value").alias("avgInputRate"),
        )
    if kind == "batches":
        return F.struct(
            F.expr("ts_us div 1000").alias("batchId"),
            F.lit("2024-01-01T00:00:00.000GMT").alias("batchTime"),
            F.lit("COMPLETED").alias("status"),
            F.col("k").alias("inputSize"),
            F.col("user_id").alias("processingTime"),
        )
    rdd = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("k").cast("string"))
    return F.struct(
        F.col("user_id").cast("string").alias("id"),
        F.concat(F.lit("host"), F.pmod("user_id", F.lit(4)).cast("string"), F.lit(":4040")).alias("hostPort"),
        (F.col("event_type") != "click").alias("isActive"),
        rdd.alias("rddBlocks"),
        (F.col("user_id") * 1000).alias("memoryUsed"),
        (F.pmod("user_id", F.lit(4)) + 1).alias("totalCores"),
        F.struct(F.concat(F.lit("http://host/logs/"), F.col("user_id").cast("string")).alias("stdout")).alias("executorLogs"),
        F.struct((F.col("k") * 10).alias("usedOnHeapStorageMemory"), F.lit(1000).alias("totalOnHeapStorageMemory")).alias("memoryMetrics"),
    )


def _snapshot_cols(value: Column, kind: Column | None = None) -> list:
    cols = [F.col("event_id").alias("src_offset"), value.alias("value"),
            F.concat(F.lit("app-"), F.pmod("user_id", F.lit(4)).cast("string")).alias("app_id"),
            F.col("ts_ns").alias("sampled_ns"), "event_ts"]
    return cols + ([kind.alias("kind")] if kind is not None else [])


def spark_snapshots_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four Spark-status shapes from one scan of ``events``, with a ``kind`` column."""
    ev = events(spark, sf_dir)
    kind = None
    value = None
    for k, types in SNAPSHOT_TYPES.items():
        cond = F.col("event_type").isin(*types)
        kind = F.when(cond, F.lit(k)) if kind is None else kind.when(cond, F.lit(k))
        js = F.to_json(_snapshot_obj(k))
        value = F.when(cond, js) if value is None else value.when(cond, js)
    return ev.select(*_snapshot_cols(value, kind))


def delivery_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery log of the LP records: send time, latency (ms, from ``k``) and bytes."""
    ev = events(spark, sf_dir)
    return ev.select(
        F.col("event_id").alias("src_offset"),
        "event_ts",
        F.col("k").alias("latency_ms"),
        F.octet_length(lp_text()).alias("bytes"),
    )


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LP records with malformed input: ``error`` events carry an extra piece ``oops``
    without ``=``; ``signup`` events with k >= 90 are a single token (no fields)."""
    ev = events(spark, sf_dir)
    head = F.concat(F.col("event_type"), F.lit(",user=u"), F.col("user_id").cast("string"), F.lit(",shard=s"),
                    F.pmod("user_id", F.lit(4)).cast("string"))
    oops = F.regexp_replace(lp_text(), " ([0-9]+)$", ",oops $1")
    value = (
        F.when(F.col("event_type") == "error", oops)
        .when((F.col("event_type") == "signup") & (F.col("k") >= 90), head)
        .otherwise(lp_text())
    )
    return ev.select(value.alias("value"), "event_ts", F.pmod("user_id", F.lit(4)).cast("int").alias("src_partition"),
                     F.col("event_id").alias("src_offset"))
