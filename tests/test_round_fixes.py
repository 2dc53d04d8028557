"""Plans and edge cases of the metric operators: scans, refresh, ticks, sums, typed maps."""

import re

from conftest import SF, rows
from pyspark.sql import functions as F

from pulsegrid.functions import lines as L
from pulsegrid.functions import typed as TY
from pulsegrid.operators import aggregate as A
from pulsegrid.operators import change as C
from pulsegrid.operators import route as R
from pulsegrid.operators import stats as ST
from pulsegrid.plans import catalog, configs
from pulsegrid.plans import fixtures as fx
from pulsegrid.sinks import writers as W
from pulsegrid.sources import rules as RU
from pulsegrid.streaming.detector import ChangeRowProcessor


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_aggregate_scan_reads_only_its_columns(spark):
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan(catalog.QUERIES["agg_multi"](spark, SF)))[1]
    assert "event_id" not in read and "event_type" in read


def test_refresh_keeps_records_without_payload_time(spark):
    d = spark.createDataFrame([("m,h=a f=1", 3, 0), ("m,h=b f=2 5000000000", 7, 1)], "value string, s long, src_offset long")
    d = d.select("value", F.timestamp_seconds("s").alias("event_ts"), F.lit(0).alias("src_partition"), "src_offset")
    got = sorted(rows(C.refresh(L.explode_fields(d), 5), "series", "tick_ns"))
    assert got == [("m,h=a#f", 5_000_000_000), ("m,h=a#f", 10_000_000_000), ("m,h=b#f", 10_000_000_000)]
    by_payload = sorted(rows(C.refresh(L.explode_fields(d), 5, time_col="ts_ns"), "series", "tick_ns"))
    assert by_payload == [("m,h=a#f", 5_000_000_000), ("m,h=a#f", 10_000_000_000), ("m,h=b#f", 10_000_000_000)]


def test_refresh_scans_once_and_in_bounded_runs(spark, monkeypatch):
    lines = fx.lines_from(fx.events_from(spark.read.parquet(f"{SF}/events.parquet")))
    made = C.refresh(L.explode_fields(lines), 86400)
    assert plan(made).count("FileScan") == 0  # reads the reduced rows that one scan has made
    want = sorted(rows(made, "series", "tick_ns", "value"))
    monkeypatch.setattr(C, "RUN", 3)
    assert sorted(rows(C.refresh(L.explode_fields(lines), 86400), "series", "tick_ns", "value")) == want


def test_missed_ticks_are_not_made_up_for():
    class Value:
        def __init__(self, v):
            self.v = v

        def get(self):
            return self.v

        def exists(self):
            return self.v is not None

    class Handle:
        timers: list = []

        def registerTimer(self, t):
            self.timers.append(t)

    class Now:
        def getCurrentProcessingTimeInMs(self):
            return 1_000_250

    p = ChangeRowProcessor(refresh_ms=100)
    p.handle, p.last = Handle(), Value(("m", "h=a", "f", "1"))
    out = list(p.handleExpiredTimer(("m,h=a#f",), Now(), None))
    assert len(out) == 1 and out[0]["ts_ns"] == 1_000_200 * 1_000_000 and p.handle.timers == [1_000_300]
    p.handle.timers.clear()
    p.last = Value(None)
    assert list(p.handleExpiredTimer(("m,h=a#f",), Now(), None)) == [] and p.handle.timers == []


def test_latency_sums_do_not_overflow(spark):
    d = spark.range(20).select(F.timestamp_seconds("id").alias("event_ts"), F.lit(4 * 10**18).alias("latency_ms"), F.lit(8 * 10**18).alias("bytes"))
    r = ST.latency_summary(d).first()
    assert r["avg_latency"] == 4e18 and r["count"] == 20 and r["p99"] == 4 * 10**18


def test_typed_maps_keep_the_last_value(spark):
    d = spark.createDataFrame([("m,a=1,b=2,a=3 x=1i,y=2,x=5i 7",), ("m,a=1 x=1i,y=2 7",), ("m x=1i 7",)], "value string")
    got = rows(d.select(TY.format_line(TY.parse_line("value"))))
    assert [g[0] for g in got] == ["m,a=3,b=2 x=5i,y=2.0 7", "m,a=1 x=1i,y=2.0 7", "m x=1i 7"]
    dropped = rows(d.select(TY.format_line(TY.drop_tags(TY.parse_line("value"), ["a"]))))
    assert [g[0] for g in dropped] == ["m,b=2 x=5i,y=2.0 7", "m x=1i,y=2.0 7", "m x=1i 7"]


def test_records_without_a_rule_are_left_out_first(spark):
    d = spark.createDataFrame([("cpu,h=a up=1i 1", 0), ("mem up=1i 1", 1), ("cpu up=2i 1", 2)], "value string, src_offset long")
    rules = RU.router_rules({"onoff_filter": [{"measurement": "cpu"}]})
    assert sorted(rows(A.listed(d, rules), "src_offset")) == [(0,), (2,)]
    p = plan(R.route(d, rules))
    assert "LeftSemi" in p and p.count("Generate") == 1 and p.index("Generate") < p.index("LeftSemi")  # the semi-join stands below


def test_rules_are_broadcast_by_bytes(spark, monkeypatch):
    rules = RU.agg_rules(configs.AGGREGATOR)
    assert 0 < rules.size_bytes < 10_000
    monkeypatch.setattr(RU, "MAX_BROADCAST_BYTES", 1)
    assert "broadcast" not in rules.df(spark)._jdf.queryExecution().logical().toString().lower()


def test_delivery_plan(spark):
    d = spark.createDataFrame([(0, i, v) for i, v in enumerate(["a", "", "b", None, "c", "d"])], "src_partition int, src_offset long, value string")
    assert sorted(rows(W.delivery_plan(d, [1, 2], 3), "src_offset", "port", "batch")) == [(0, 1, 0), (2, 2, 0), (4, 1, 0), (5, 2, 1)]
