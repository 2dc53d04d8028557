"""Streaming: late data (T2/T3), detector state across batches (T4), refresh timers (T5), progress."""

import json
import os
import time

from pyspark.sql import functions as F

from pulsegrid.functions import lines as L
from pulsegrid.operators import change as C
from pulsegrid.sources import rules as RU
from pulsegrid.streaming import jobs as SJ
from pulsegrid.streaming.detector import detect_changes
from pulsegrid.streaming.progress import progress_line

SCHEMA = "value string, event_ts timestamp, src_partition int, src_offset long"


def _write_batches(folder, batches):
    os.makedirs(folder, exist_ok=True)
    off = 0
    for i, batch in enumerate(batches):
        path = os.path.join(folder, f"b{i:03d}.json")
        with open(path, "w") as fh:
            for line, sec in batch:
                fh.write(json.dumps({"value": line, "event_ts": f"2024-01-01T00:00:{sec:02d}Z" if sec < 60 else f"2024-01-01T00:{sec // 60:02d}:{sec % 60:02d}Z",
                                     "src_partition": 0, "src_offset": off}) + "\n")
                off += 1
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def test_late_records_dropped(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    # Spark drops late rows against the previous batch's watermark, so the late
    # record comes one batch after the watermark passed its window (documented)
    _write_batches(src, [[("m f=1", 1), ("m f=3", 5)], [("m f=10", 35)], [("m f=20", 36)], [("m f=100", 3)], [("m f=7", 100)]])
    s = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    rules = RU.agg_rules({"sum_filter": [{"measurement": "m", "field.name": "f"}]})
    out = SJ.run_to_table(SJ.stream_aggregate(s, rules, window="10 seconds"), "late")
    got = sorted((r["window_end_ns"], r["value"]) for r in out.collect())
    base = 1704067200 * 10**9
    # window [0,10) closes at watermark 25 s; the late 100 is dropped; [30,40) closes later; [100,110) stays open
    assert got == [(base + 10 * 10**9, 4.0), (base + 40 * 10**9, 30.0)]


def test_detector_state_across_batches(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    batches = [[("m,h=a f=1i", 1), ("m,h=a f=1i", 2), ("m,h=b f=5", 3)], [("m,h=a f=1i", 4), ("m,h=a f=1.0", 5)], [("m,h=b f=5", 6), ("m,h=b f=6", 7)]]
    _write_batches(src, batches)
    s = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    out = SJ.run_to_table(detect_changes(L.explode_fields(s)), "det")
    got = sorted(r["src_offset"] for r in out.collect())
    batch = spark.read.schema(SCHEMA).json(src)
    want = sorted(r["src_offset"] for r in C.changes(L.explode_fields(batch)).collect())
    assert got == want == [0, 2, 4, 6]


def test_refresh_timer_emits_aligned_ticks(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    _write_batches(src, [[("m,h=a f=1", 1), ("m,h=b f=2", 2)]])
    s = spark.readStream.schema(SCHEMA).json(src)
    df = detect_changes(L.explode_fields(s), refresh_s=1)
    out = os.path.join(tmpdir_fresh, "out")
    q = SJ.start(df, "refresh_test", sink="parquet", path=out, trigger={"processingTime": "500 milliseconds"})
    deadline = time.time() + 120
    while time.time() < deadline:
        lp = q.lastProgress
        if lp is not None and lp["batchId"] >= 6:
            break
        time.sleep(0.5)
    q.stop()
    r = spark.read.parquet(out)
    refresh = r.filter(F.col("kind") == "refresh").collect()
    assert len(refresh) >= 2
    assert all(x["ts_ns"] % 1_000_000_000 == 0 for x in refresh)
    assert {x["line"].rsplit(" ", 1)[0] for x in refresh} <= {"m,h=a f=1", "m,h=b f=2"}


def test_progress_line(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    _write_batches(src, [[("m f=1", 1), ("m f=2", 2)]])
    s = spark.readStream.schema(SCHEMA).json(src).observe("router", F.count(F.lit(1)).alias("sentRecords"))
    q = s.writeStream.format("noop").trigger(availableNow=True).option("checkpointLocation", os.path.join(tmpdir_fresh, "ck")).start()
    q.awaitTermination()
    line = progress_line(q.lastProgress, tags={"application_id": "router", "hostname": "h"}, now_ms=5)
    assert line == "kafka_streams,application_id=router,hostname=h receivedRecords=2i,sentRecords=2i 5000000"


def test_detector_engines_agree(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    _write_batches(src, [[("m,h=a f=1", 1), ("m,h=a f=2", 2), ("m,h=b f=5", 3)], [("m,h=a f=2", 4), ("m,h=b f=6", 5)]])
    got = {}
    for eng in ("rows", "pandas", "group_state"):
        s = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
        out = SJ.run_to_table(detect_changes(L.explode_fields(s), engine=eng), f"eng_{eng}")
        got[eng] = sorted((r["src_offset"], r["line"]) for r in out.collect())
    assert got["rows"] == got["pandas"] == got["group_state"] == [(0, "m,h=a f=1"), (1, "m,h=a f=2"), (2, "m,h=b f=5"), (4, "m,h=b f=6")]


def test_restart_from_checkpoint_keeps_state(spark, tmpdir_fresh):
    """Stop the detector, add input, restart on the same checkpoint: no re-emission of known series."""
    src = os.path.join(tmpdir_fresh, "in")
    ck = os.path.join(tmpdir_fresh, "ck")
    out = os.path.join(tmpdir_fresh, "out")
    _write_batches(src, [[("m,h=a f=1", 1), ("m,h=b f=2", 2)]])
    for _ in range(2):
        s = spark.readStream.schema(SCHEMA).json(src)
        q = SJ.start(detect_changes(L.explode_fields(s)), "restart", sink="parquet", path=out, checkpoint=ck)
        q.awaitTermination()
        with open(os.path.join(src, "b900.json"), "w") as fh:
            fh.write(json.dumps({"value": "m,h=a f=1", "event_ts": "2024-01-01T00:00:09Z", "src_partition": 0, "src_offset": 9}) + "\n")
            fh.write(json.dumps({"value": "m,h=b f=3", "event_ts": "2024-01-01T00:00:10Z", "src_partition": 0, "src_offset": 10}) + "\n")
    got = sorted(r["src_offset"] for r in spark.read.parquet(out).collect())
    assert got == [0, 1, 10]


def test_processing_time_event_aggregate(spark, tmpdir_fresh):
    """Header events aggregated on arrival time (window = trigger interval)."""
    from pulsegrid.plans import configs
    from pulsegrid.plans import fixtures as fx

    rules, default = RU.metric_rules(configs.HEADER_AGGREGATOR)
    he = fx.header_events(spark, "/root/testdata/sf0.001")
    src = os.path.join(tmpdir_fresh, "he")
    he.write.parquet(src)
    s = spark.readStream.schema(he.schema).parquet(src)
    out = os.path.join(tmpdir_fresh, "out")

    def write_batch(df, batch_id):
        df.write.mode("append").parquet(out)

    q = SJ.start_event_aggregate_per_batch(s, rules, default, "1 second", write_batch, name="t6")
    deadline = time.time() + 120
    while time.time() < deadline and not os.path.exists(out):
        time.sleep(0.5)
    q.processAllAvailable()
    q.stop()
    r = spark.read.parquet(out)
    pts = SJ.EVT.event_points(he, rules, default).filter(F.col("error").isNull())
    assert r.count() == pts.select("fn", "metric_key").distinct().count()
    assert set(r.columns) == {"fn", "metric_key", "window_end_ns", "value"}


def test_progress_reporter_rate_limit():
    from pulsegrid.streaming.progress import ProgressReporter

    sent = []

    class Row:
        def __init__(self, d):
            self.d = d

        def asDict(self):
            return self.d

    class Prog:
        name = "router"
        numInputRows = 7
        observedMetrics = {"router": Row({"sentRecords": 5})}

    class Ev:
        progress = Prog()

    r = ProgressReporter("router", period_ms=60_000, tags={"application_id": "streams-app-router"}, sender=sent.append)
    r.onQueryProgress(Ev())
    r.onQueryProgress(Ev())  # within the period: not sent again
    assert len(sent) == 1
    assert sent[0].startswith("kafka_streams,application_id=streams-app-router,hostname=")
    assert " receivedRecords=7i,sentRecords=5i " in sent[0]
