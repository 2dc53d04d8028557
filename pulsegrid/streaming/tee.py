"""Good and bad rows of one scan.

A micro-batch is parsed once and kept while its good rows go to the sink, its bad rows to the
error output and both are counted. The error output is a folder for each batch id, which a
replay overwrites, so that no bad row is there twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .progress import Totals

#: Bad rows as they are written: why, what came in, and its record time if known.
BAD = "error STRING, raw STRING, at TIMESTAMP"


def bad_rows(df: DataFrame, raw: str) -> DataFrame:
    at = F.col("event_ts").cast("timestamp") if "event_ts" in df.columns else F.lit(None).cast("timestamp")
    return df.filter(F.col("error").isNotNull()).select("error", F.col(raw).cast("string").alias("raw"), at.alias("at"))


def start_tee(parsed: DataFrame, raw: str, good: Callable[[DataFrame], DataFrame], send: Callable[[DataFrame, int], None], name: str, checkpoint: str,
              errors: str | None = None, totals: Totals | None = None, counters: dict | None = None, trigger: dict | None = None):
    """Start a stream of ``parsed`` rows (with ``error``, null if good).

    ``good(rows)`` makes what ``send(df, batch_id)`` gets. Bad rows go below the folder ``errors``
    as JSON. ``totals`` gets ``receivedRecords`` (rows with ``field_pos`` 0, or all where there
    is none), ``filteredRecords`` (bad rows) and of what is sent the ``counters`` (name: Column,
    default ``sentRecords``).
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            sent = good(rows.filter(F.col("error").isNull() | F.lit("field_pos" in rows.columns)))
            if totals is not None:
                sent = sent.persist()
            send(sent, batch_id)
            if errors:
                bad_rows(rows, raw).write.mode("overwrite").json(f"{errors.rstrip('/')}/batch={batch_id}")
            if totals is not None:
                first = F.col("field_pos") == 0 if "field_pos" in rows.columns else F.lit(True)
                seen = rows.agg(F.count_if(first).alias("receivedRecords"), F.count_if(F.col("error").isNotNull()).alias("filteredRecords")).first()
                out = sent.agg(*[c.alias(k) for k, c in (counters or {"sentRecords": F.count(F.lit(1))}).items()]).first()
                totals.add(batch_id, seen.asDict() | out.asDict())
                sent.unpersist()
        finally:
            rows.unpersist()

    return parsed.writeStream.queryName(name).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start()
