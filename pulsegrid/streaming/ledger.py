"""Tables keyed by micro-batch, and stateful jobs on them.

A ``Ledger`` has one folder for each batch id. A batch that Spark replays after a failure
has the same id and the same rows, and overwrites what its first attempt left: the table
never holds a row twice, whatever step was lost. State is kept in the same way: a batch reads
what ids before its own have written, and so gets the same state when it is replayed.

* ``start_to_ledger`` writes any append-mode stream to a ledger.
* ``start_changes`` detects changes (T4) with the batch operator, ``lag`` in offset chunks, so
  that no task holds a series and no row passes through Python. The last values are a delta
  for each batch, put together in a base from time to time.
* ``start_refresh`` emits the refresh grid (T5) on event time: a tick is due once the latest
  record time less the grace has passed it, so that ticks depend on the data alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import change as C
from ..session import app_checkpoint, checkpoint_root, use_rocksdb

#: Batches whose last values are kept as deltas before they are put together.
COMPACT = 16
LAST = "series STRING, measurement STRING, tags STRING, field STRING, value STRING"


class Ledger:
    """A table of one folder for each batch id below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, batch_id: int) -> str:
        return f"{self.root}/batch={int(batch_id)}"

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self.path(batch_id))

    def _folder(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def ids(self) -> list[int]:
        """The batches written to the end, by id."""
        fs, root = self._folder()
        if not fs.exists(root):
            return []
        done = [p.getPath() for p in fs.listStatus(root) if p.getPath().getName().startswith("batch=")]
        return sorted(int(p.getName()[6:]) for p in done if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def last_before(self, batch_id: int) -> int | None:
        return max((i for i in self.ids() if i < batch_id), default=None)

    def read(self, schema, ids: list[int] | None = None) -> DataFrame:
        """All rows of the batches ``ids`` (default: of all), with their ``batch``."""
        ids = self.ids() if ids is None else ids
        empty = self.spark.createDataFrame([], schema)
        if not ids:
            return empty.withColumn("batch", F.lit(None).cast("int"))
        return self.spark.read.schema(empty.schema).option("basePath", self.root).parquet(*map(self.path, ids)).withColumn("batch", F.col("batch").cast("int"))

    def drop_before(self, batch_id: int) -> None:
        """Forget the batches before an id; call it only when none of them can be replayed
        or read again."""
        fs, _ = self._folder()
        for i in self.ids():
            if i < batch_id:
                fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.path(i)), True)


def _start(df: DataFrame, each: Callable[[DataFrame, int], None], name: str, checkpoint: str | None, trigger: dict | None,
           done: Callable[[int], None] | None):
    use_rocksdb(df.sparkSession)

    def batch(rows: DataFrame, batch_id: int) -> None:
        each(rows, batch_id)
        if done:
            done(batch_id)

    ckpt = checkpoint or app_checkpoint(df.sparkSession, name, "query")
    return (df.writeStream.queryName(name).outputMode("append").foreachBatch(batch).option("checkpointLocation", ckpt)
            .trigger(**(trigger or {"availableNow": True})).start())


def start_to_ledger(df: DataFrame, out: Ledger, name: str, checkpoint: str | None = None, trigger: dict | None = None,
                    done: Callable[[int], None] | None = None):
    """A stream into a ledger. ``done(batch_id)`` is called once a batch is written; what
    it raises fails the query, and the batch is replayed at its next start."""
    return _start(df, out.write, name, checkpoint, trigger, done)


# --------------------------------------------------------------------------- T4
class LastValues:
    """The last value of every series as of any batch that can be replayed."""

    def __init__(self, spark: SparkSession, root: str, compact: int = COMPACT):
        self.base, self.delta, self.compact = Ledger(spark, f"{root}/base"), Ledger(spark, f"{root}/delta"), compact

    def before(self, batch_id: int) -> DataFrame:
        """One row a series, from the batches before an id."""
        start = self.base.last_before(batch_id)
        ids = [i for i in self.delta.ids() if i < batch_id and (start is None or i > start)]
        rows = self.delta.read(LAST, ids)
        if start is not None:
            rows = rows.unionByName(self.base.read(LAST, [start]))
        row = F.struct("measurement", "tags", "field", "value")
        return rows.groupBy("series").agg(F.max_by(row, "batch").alias("r")).select("series", "r.*")

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """The batch's own last values; every ``compact`` batches all are put together. What the
        base before the last one needed can't be asked for any more."""
        self.delta.write(rows, batch_id)
        if (batch_id + 1) % self.compact == 0:
            kept = self.base.last_before(batch_id)
            self.base.write(self.before(batch_id + 1), batch_id)
            if kept is not None:
                self.base.drop_before(kept)
                self.delta.drop_before(kept + 1)


def start_changes(fields: DataFrame, out: Ledger, state: str, name: str, checkpoint: str | None = None, trigger: dict | None = None,
                  chunk_rows: int = C.CHUNK_ROWS, compact: int = COMPACT, done: Callable[[int], None] | None = None):
    """T4: rows that are the first of their series or differ from the value before, in arrival
    order, into ``out``. The last values are kept below the folder ``state``.

    A micro-batch is compared within itself by ``changes``, one shuffle in offset chunks; only
    the first row of each series it touches is joined with the last values. The batch's own
    last values are those of its last changes, read from ``out``: a series without a change
    keeps the value that it had. So no batch is held in memory and its rows are sorted once.
    """
    last = LastValues(fields.sparkSession, state, compact)

    def each(batch: DataFrame, batch_id: int) -> None:
        found = C.changes(C.with_series(batch), chunk_rows, previous=last.before(batch_id))
        out.write(found, batch_id)
        last.put(C.latest(out.read(found.schema, [batch_id])).select("series", "measurement", "tags", "field", "value"), batch_id)

    return _start(fields, each, name, checkpoint, trigger, done)


# --------------------------------------------------------------------------- T5
TICKS = "series STRING, tick_ns BIGINT, ord STRUCT<src_partition: INT, src_offset: BIGINT, field_pos: INT>, r STRUCT<measurement: STRING, tags: STRING, field: STRING, value: STRING>"


def start_refresh(fields: DataFrame, period_s: int, out: Ledger, state: str, name: str, grace_s: int = 10, time_col: str = "event_ts",
                  checkpoint: str | None = None, trigger: dict | None = None, done: Callable[[int], None] | None = None):
    """T5 on event time: at every tick (multiples of the period) each series seen before it with
    its latest value, as ``refresh`` gives them, into ``out`` as soon as the latest time seen
    has passed the tick by ``grace_s``. Records of ticks that are out already are late: they
    are left out and counted in ``late`` of the clock.

    Below ``state`` a batch leaves the clock (one row), the reduced rows of ticks not yet due,
    and, where ticks were due, the value of each series at the last of them.
    """
    spark = fields.sparkSession
    clock, pending, seeds = (Ledger(spark, f"{state}/{part}") for part in ("clock", "pending", "seeds"))
    p_ns = int(period_s) * 1_000_000_000

    def each(batch: DataFrame, batch_id: int) -> None:
        before = clock.last_before(batch_id)
        was = clock.read("latest BIGINT, closed BIGINT, late BIGINT", [before]).first() if before is not None else None
        closed = was.closed if was and was.closed is not None else None
        reduced = C.ticks(batch, p_ns, time_col)
        checkpoint_root(spark)
        reduced = reduced.checkpoint()
        is_late = F.lit(False) if closed is None else F.col("tick_ns") <= closed
        seen = reduced.agg(F.max("latest").alias("latest"), F.sum(F.when(is_late, F.col("n")).otherwise(0)).alias("late")).first()
        latest = max((x for x in (seen.latest, was.latest if was else None) if x is not None), default=None)
        due = None if latest is None else (latest - int(grace_s) * 1_000_000_000) // p_ns * p_ns
        due = max((x for x in (due, closed) if x is not None), default=None)

        rows = reduced.filter(~is_late).select("series", "tick_ns", "ord", "r")
        if before is not None:
            rows = rows.unionByName(pending.read(TICKS, [before]).drop("batch"))
        limit = F.lit(due).cast("bigint")
        open_rows = rows if due is None else rows.filter(F.col("tick_ns") > limit)
        pending.write(C.last_of_ticks(open_rows), batch_id)
        grid = None
        if due is not None and due != closed:
            ready = rows.filter(F.col("tick_ns") <= limit)
            held = seeds.last_before(batch_id)
            if held is not None:  # the values at the last tick go on, behind any row of the next one
                ready = ready.unionByName(seeds.read(TICKS, [held]).withColumn("tick_ns", F.lit(closed + p_ns).cast("bigint")).drop("batch"))
            ready = C.last_of_ticks(ready).checkpoint()
            grid = C.grid(ready, p_ns, limit, ready.count())
            at_last = ready.groupBy("series").agg(F.max_by("r", "tick_ns").alias("r"))
            none = F.lit(None).cast("struct<src_partition: int, src_offset: bigint, field_pos: int>")
            seeds.write(at_last.select("series", limit.alias("tick_ns"), none.alias("ord"), "r"), batch_id)
        if grid is not None:
            out.write(grid, batch_id)
        # last: a batch whose clock is missing is done anew
        clock.write(spark.createDataFrame([(latest, due, int(seen.late or 0) + (was.late if was else 0))], "latest BIGINT, closed BIGINT, late BIGINT"), batch_id)
        if before is not None:
            oldest = clock.last_before(before)
            if oldest is not None:  # Spark replays the last batch at most
                clock.drop_before(oldest)
                pending.drop_before(oldest)
                seeds.drop_before(seeds.last_before(before) or 0)

    return _start(fields, each, name, checkpoint, trigger, done)
