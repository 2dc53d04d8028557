"""Scans (S1-S4): topic, internal-topic, byte-payload and header-event sources.

On a cluster these read Kafka (``format='kafka'``, the connector jar on the
classpath); in tests the same functions read parquet/JSON/text folders with the
same column shapes. Offsets and progress live in the query checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lines as L

# Consumer settings of the reference -> Kafka source options.
CONSUMER_OPTION_MAP = {
    "bootstrap.servers": "kafka.bootstrap.servers",
    "group.id": "kafka.group.id",
    "fetch.min.bytes": "kafka.fetch.min.bytes",
    "receive.buffer.bytes": "kafka.receive.buffer.bytes",
    "max.poll.records": "maxOffsetsPerTrigger",
    "fail.on.data.loss": "failOnDataLoss",
}
# Fixed value: the reference's bound of one poll; here of one micro-batch.
MAX_POLL_RECORDS = 1_000_000
OFFSET_RESET = {"latest": "latest", "earliest": "earliest"}

RECORD_COLUMNS = ["key", "value", "event_ts", "src_partition", "src_offset"]


def kafka_options(consumer_cfg: dict, topic: str | None = None) -> dict:
    """S3: reference consumer config -> Spark Kafka source options.

    Lost offsets fail the query unless ``fail.on.data.loss`` is set to false, and a
    micro-batch holds at most ``max.poll.records`` records."""
    opts = {}
    for k, v in consumer_cfg.items():
        if k in CONSUMER_OPTION_MAP:
            opts[CONSUMER_OPTION_MAP[k]] = str(v).lower() if isinstance(v, bool) else str(v)
        elif k == "auto.offset.reset":
            opts["startingOffsets"] = OFFSET_RESET.get(str(v), "latest")
        elif k == "topic":
            opts["subscribe"] = str(v)
        else:
            opts[f"kafka.{k}"] = str(v)
    if topic:
        opts["subscribe"] = topic
    opts.setdefault("startingOffsets", "latest")
    opts.setdefault("failOnDataLoss", "true")
    opts.setdefault("maxOffsetsPerTrigger", str(MAX_POLL_RECORDS))
    return opts


def _kafka_records(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("event_ts"),
        F.col("partition").alias("src_partition"),
        F.col("offset").alias("src_offset"),
    )


def read_lines(spark: SparkSession, fmt: str = "kafka", options: dict | None = None, path: str | None = None,
               schema=None, stream: bool = True) -> DataFrame:
    """LP records ``key, value, event_ts, src_partition, src_offset``.

    Kafka: the record timestamp is the event time (as in the reference). Other
    formats must carry those columns (``key`` optional).
    """
    r = spark.readStream if stream else spark.read
    r = r.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        return _kafka_records(r.load())
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path) if path else r.load()
    if "key" not in df.columns:
        df = df.withColumn("key", F.lit(None).cast("string"))
    return df.select(*RECORD_COLUMNS)


def read_internal(spark: SparkSession, fmt: str = "kafka", options: dict | None = None, path: str | None = None,
                  schema=None, stream: bool = True, keep_bad: bool = False) -> DataFrame:
    """Internal records (key ``meas#field``, value ``tags#value#ts``) decoded to field rows."""
    recs = read_lines(spark, fmt, options, path, schema, stream)
    return L.decode_internal(recs.withColumnRenamed("value", "wire"), "key", "wire", keep_bad=keep_bad)


def read_bytes(spark: SparkSession, consumer_cfg: dict, stream: bool = True) -> DataFrame:
    """S3: byte payloads with the consumer's offset policy mapped to source options."""
    r = (spark.readStream if stream else spark.read).format("kafka").options(**kafka_options(consumer_cfg))
    df = r.load()
    return df.select("value", F.col("timestamp").alias("event_ts"), F.col("partition").alias("src_partition"),
                     F.col("offset").alias("src_offset"))


def read_events(spark: SparkSession, fmt: str = "kafka", options: dict | None = None, path: str | None = None,
                schema=None, stream: bool = True) -> DataFrame:
    """S4 (re-aimed): header events ``headers MAP<STRING,STRING>, body BINARY``.

    Kafka: record headers become the map, the value is the body. Other formats
    must already carry ``headers`` and ``body``.
    """
    r = (spark.readStream if stream else spark.read).format(fmt).options(**(options or {}))
    if fmt == "kafka":
        df = r.option("includeHeaders", "true").load()
        headers = F.map_from_entries(
            F.transform(F.coalesce("headers", F.array()), lambda h: F.struct(h["key"].alias("key"), F.decode(h["value"], "UTF-8").alias("value")))
        )
        return df.select(headers.alias("headers"), F.col("value").alias("body"), F.col("timestamp").alias("event_ts"),
                         F.col("partition").alias("src_partition"), F.col("offset").alias("src_offset"))
    if schema is not None:
        r = r.schema(schema)
    return r.load(path) if path else r.load()
