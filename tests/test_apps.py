"""YAML-configured apps built on injected file-stream sources."""

import json
import os

import recorders
from pulsegrid.plans import apps
from pulsegrid.sinks import writers as W
from pulsegrid.streaming import jobs as SJ

SCHEMA = "key string, value string, event_ts timestamp, src_partition int, src_offset long"

ROUTER_YAML = """
component_config:
   topic.input: in
   topic.output.database: db
   topic.output.onoff: oo
   topic.output.aggregator: ag
database_filter:
   -   measurement: cpu
onoff_filter:
   -   measurement: cpu
       field.name: up
aggregator_filter:
   -   measurement: cpu
       field.name: load
"""

AGG_YAML = """
aggregation_config:
   window.s: 10
avg_filter:
   -   measurement: cpu
       field.name: load
       tags.remove: host
"""


def _write(folder, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "part.json"), "w") as fh:
        for i, (k, v, sec) in enumerate(rows):
            fh.write(json.dumps({"key": k, "value": v, "event_ts": f"2024-01-01T00:00:{sec:02d}Z", "src_partition": 0, "src_offset": i}) + "\n")


def test_router_then_aggregator(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    _write(src, [("k0", "cpu,host=a,dc=x load=1,up=1i 1", 1), (None, "cpu,host=b,dc=x load=3,up=1i 2", 2),
                 (None, "mem,host=a free=5 3", 3), (None, "cpu,host=a,dc=x load=8 40", 40)])
    routed = apps.build_router(spark, ROUTER_YAML, source=spark.readStream.schema(SCHEMA).json(src))
    out = SJ.run_to_table(routed, "router_app")
    got = sorted((r["topic"], r["key"] or "", r["value"]) for r in out.collect())
    assert ("db", "", "mem,host=a free=5 3") not in got
    assert ("db", "k0", "cpu,host=a,dc=x load=1,up=1i 1") in got  # the database branch keeps the record key
    assert [g for g in got if g[0] == "oo"] == [("oo", "cpu#up", "host=a,dc=x#1i#1"), ("oo", "cpu#up", "host=b,dc=x#1i#2")]
    ag = [g for g in got if g[0] == "ag"]
    assert len(ag) == 3 and len([g for g in got if g[0] == "db"]) == 3
    # the aggregator consumes the router's aggregator branch
    agg_in = os.path.join(tmpdir_fresh, "agg_in")
    out.filter("topic = 'ag'").select("key", "value", "event_ts", "src_partition", "src_offset").write.json(agg_in)
    agg = apps.build_aggregator(spark, AGG_YAML, source=spark.readStream.schema(SCHEMA).json(agg_in))
    res = sorted((r["key"], r["value"]) for r in SJ.run_to_table(agg, "agg_app").collect())
    assert res == [("cpu,dc=x#load", "cpu,dc=x load_avg=2.0 1704067210000000000")]


def test_webhook_app(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    os.makedirs(src)
    with open(os.path.join(src, "n.json"), "w") as fh:
        fh.write(json.dumps({"value": '{"description":"disk full","details":"sda"}'}) + "\n")
        fh.write(json.dumps({"value": '{"nothing":1}'}) + "\n")
    s = spark.readStream.schema("value string").json(src)
    rec = os.path.join(tmpdir_fresh, "rec")
    q = apps.run_webhook(spark, {apps.WEBHOOK_SECTION: {"url": "https://hook"}}, source=s, sender_factory=recorders.RecorderFactory(rec))
    q.processAllAvailable()
    q.stop()
    assert [json.loads(r["body"]) for r in recorders.read_recorded(rec)] == [{"text": "disk full\nsda"}]


def test_pass_through_sends_bodies(spark, tmpdir_fresh):
    """Reference UDP sink test, pass mode: each datagram equals the event body; empty bodies are not sent."""
    src = os.path.join(tmpdir_fresh, "ev")
    rows = [({"name": "m"}, f"m v={i}i".encode()) for i in range(10)] + [({"name": "m"}, b"")]
    spark.createDataFrame(rows, "headers map<string,string>, body binary").write.parquet(src)
    s = spark.readStream.schema("headers map<string,string>, body binary").parquet(src)
    rec = os.path.join(tmpdir_fresh, "rec")
    q = apps.run_pass_through(spark, {"output": {"hostname": "h", "port": 8089}}, s, sender_factory=recorders.RecorderFactory(rec))
    q.processAllAvailable()
    q.stop()
    got = sorted(r["payload"] for r in recorders.read_recorded(rec))
    assert got == sorted(f"m v={i}i" for i in range(10))
