"""Remaining public operators: S2/S4 readers, P34, U1, K8, detector stream, HTTP sink and header-aggregator apps."""

import json
import os
import time

import recorders
from pyspark.sql import functions as F

from pulsegrid.functions import lines as L
from pulsegrid.operators import aggregate as A
from pulsegrid.operators import events as EVT
from pulsegrid.plans import apps, configs
from pulsegrid.plans import fixtures as fx
from pulsegrid.sinks import writers as W
from pulsegrid.sources import streams as S
from pulsegrid.streaming import jobs as SJ
from tests.conftest import SF, rows

REC = "key string, value string, event_ts timestamp, src_partition int, src_offset long"


def _records(folder, recs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "r.json"), "w") as fh:
        for i, (k, v) in enumerate(recs):
            fh.write(json.dumps({"key": k, "value": v, "event_ts": f"2024-01-01T00:00:{i:02d}Z", "src_partition": 0, "src_offset": i}) + "\n")


def test_read_internal_batch_and_stream(spark, tmpdir_fresh):
    _records(tmpdir_fresh, [("m#f", "h=a#1#5"), ("bad", "x#y"), ("m#f", "h=a#2#")])
    b = S.read_internal(spark, "json", path=tmpdir_fresh, schema=REC, stream=False, keep_bad=True)
    assert rows(b.orderBy("src_offset"), "measurement", "tags", "field", "value", "ts_ns", "error") == [
        ("m", "h=a", "f", "1", 5, None), ("bad", "x", None, "y", None, "bad key"), ("m", "h=a", "f", "2", None, None)]
    s = S.read_internal(spark, "json", path=tmpdir_fresh, schema=REC)
    out = SJ.run_to_table(SJ.stream_detector(s.select("key", F.concat_ws("#", "tags", "value", F.coalesce(F.col("ts_ns").cast("string"), F.lit(""))).alias("wire"),
                                                      "event_ts", "src_partition", "src_offset")), "det_internal")
    assert sorted(r["line"] for r in out.collect()) == ["m,h=a f=1 5", "m,h=a f=2"]


def test_read_events_files(spark, tmpdir_fresh):
    he = fx.header_events(spark, SF)
    he.write.parquet(os.path.join(tmpdir_fresh, "he"))
    r = S.read_events(spark, "parquet", path=os.path.join(tmpdir_fresh, "he"), schema=he.schema, stream=False)
    assert r.count() == he.count()


def test_drop_empty_and_union(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "value string")
    assert rows(EVT.drop_empty(df)) == [("a",)]
    u = A.union_all(df, df, df)
    assert u.count() == 9


def test_console_sink_batch(spark, capsys):
    W.write_console(spark.createDataFrame([("x",)], "value string"))
    assert "x" in capsys.readouterr().out


def test_http_sink_app(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    _records(src, [(None, "m f=1"), (None, "m f=2"), (None, "m f=3")])
    s = spark.readStream.schema(REC).json(src)
    rec = os.path.join(tmpdir_fresh, "rec")
    q = apps.run_http_sink(spark, "http://db/write", 2, s, sender_factory=recorders.RecorderFactory(rec))
    q.processAllAvailable()
    q.stop()
    bodies = [r["body"] for r in recorders.read_recorded(rec)]
    assert sorted(x for b in bodies for x in b.split("\n")) == ["m f=1", "m f=2", "m f=3"]
    assert all(len(b.split("\n")) <= 2 for b in bodies)


def test_header_aggregator_app(spark, tmpdir_fresh):
    he = fx.header_events(spark, SF)
    src = os.path.join(tmpdir_fresh, "he")
    he.write.parquet(src)
    s = spark.readStream.schema(he.schema).parquet(src)
    rec = os.path.join(tmpdir_fresh, "rec")
    cfg = dict(configs.HEADER_MINMAX, general={"window": 1})
    q = apps.run_header_aggregator(spark, cfg, s, sender_factory=recorders.RecorderFactory(rec))
    deadline = time.time() + 120
    while time.time() < deadline and not (os.path.isdir(rec) and recorders.read_recorded(rec)):
        time.sleep(0.5)
    q.processAllAvailable()
    q.stop()
    got = [json.loads(r["payload"]) for r in recorders.read_recorded(rec)]
    assert got and all(g["headers"]["name"].endswith("_aggr") and g["body"] == "" for g in got)
    assert all(r["payload"].endswith("\n") for r in recorders.read_recorded(rec))


def test_stream_event_aggregate_matches_batch_closed_windows(spark, tmpdir_fresh):
    from pulsegrid.sources import rules as RU

    rules, default = RU.metric_rules(configs.HEADER_AGGREGATOR)
    he = fx.header_events(spark, SF)
    src = os.path.join(tmpdir_fresh, "he")
    he.write.parquet(src)
    s = spark.readStream.schema(he.schema).parquet(src)
    out = SJ.run_to_table(SJ.stream_event_aggregate(s, rules, default, window="1 hour"), "ev_agg")
    batch = EVT.aggregate_events(EVT.event_points(he, rules, default), window="1 hour")
    wm_ns = he.select((F.unix_micros(F.max("event_ts")) - 10_000_000) * 1000).first()[0]
    want = sorted((r[0], r[1], r[2], round(r[3], 6)) for r in batch.filter(F.col("window_end_ns") <= wm_ns).collect())
    got = sorted((r[0], r[1], r[2], round(r[3], 6)) for r in out.select("fn", "metric_key", "window_end_ns", "value").collect())
    assert got == want and len(got) > 0
