"""Applications from YAML: restart on one checkpoint, error output, self-monitoring."""

import json
import os

import pytest
import recorders

from pulsegrid.plans import apps
from pulsegrid.session import app_checkpoint
from pulsegrid.sources import rules as RU
from pulsegrid.sources.streams import kafka_options
from pulsegrid.streaming import jobs as J

SCHEMA = "key string, value string, event_ts timestamp, src_partition int, src_offset long"
ROUTER = """
application.id: app one
component_config: {topic.input: in}
database_filter: [{measurement: cpu}]
onoff_filter: [{measurement: cpu, field.name: up}]
"""
DETECTOR = "{application.id: det, detector: {topic.input: in, topic.output: out}}"
AGGREGATOR = "{aggregation_config: {window.s: 10}, avg_filter: [{measurement: cpu, field.name: load}]}"


def put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        for k, v, sec, offset in rows:
            fh.write(json.dumps({"key": k, "value": v, "event_ts": f"2024-01-01T00:00:{sec:02d}Z", "src_partition": 0, "src_offset": offset}) + "\n")


def to_files(path):
    return lambda df, checkpoint: J.start(df, "app", sink="json", path=path, checkpoint=checkpoint)


def finish(spark, *more):
    for q in list(spark.streams.active):
        q.processAllAvailable()
        q.stop()


@pytest.mark.parametrize("name, run, cfg, first, second, want, bad", [
    ("router", apps.run_router, ROUTER, [("k", "cpu,h=a up=1i 1", 1, 0), (None, "cpu,h=a up 2", 2, 1)], [("k", "cpu,h=b up=2i 3", 3, 2)],
     {"cpu,h=a up=1i 1", "h=a#1i#1", "cpu,h=a up 2", "cpu,h=b up=2i 3", "h=b#2i#3"}, 1),
    ("detector", apps.run_detector, DETECTOR, [("cpu#up", "h=a#1i#1", 1, 0), ("cpu#up", "broken", 1, 1)], [("cpu#up", "h=a#1i#2", 2, 2), ("cpu#up", "h=a#0i#3", 3, 3)],
     {"cpu,h=a up=1i 1", "cpu,h=a up=0i 3"}, 1),
    ("aggregator", apps.run_aggregator, AGGREGATOR, [("cpu#load", "h=a#1#1", 1, 0), ("cpu#load", "broken", 1, 1)],
     [("cpu#load", "h=a#3#2", 2, 2), ("cpu#load", "h=a#9#3", 50, 3)], {"cpu,h=a load_avg=2.0 1704067210000000000"}, 1),
])
def test_restart_goes_on(spark, tmpdir_fresh, name, run, cfg, first, second, want, bad):
    src, out, err, ck = (os.path.join(tmpdir_fresh, x) for x in ("in", "out", "err", "ck"))
    for part, rows in (("1.json", first), ("2.json", second), ("3.json", [("cpu#load", "h=z#0#9", 59, 9)] if name == "aggregator" else [])):
        put(src, part, rows)
        run(spark, cfg, source=spark.readStream.schema(SCHEMA).json(src), checkpoint=ck, errors=err, write_topic=to_files(out))
        finish(spark)
    got = [r["value"] for r in spark.read.schema("value string").json(out).collect()]
    assert sorted(got) == sorted(want)  # nothing lost, nothing sent twice
    errors = spark.read.schema("error string, raw string").json(err).collect()
    assert len(errors) == bad and all(e["error"] and e["raw"] for e in errors)


def test_checkpoint_is_the_same_at_every_start(spark):
    cfg = RU.load_config(ROUTER)
    a, b = (app_checkpoint(spark, apps.app_id(cfg, "router"), "router") for _ in range(2))
    assert a == b and a.endswith("/app_one/router")
    assert apps.app_id({}, "router") == "pulsegrid-router" and apps.app_id({"kafka_config": {"application.id": "x"}}, "router") == "x"


def test_self_monitoring(spark, tmpdir_fresh):
    src, rec = os.path.join(tmpdir_fresh, "in"), os.path.join(tmpdir_fresh, "rec")
    os.makedirs(src)
    with open(os.path.join(src, "n.json"), "w") as fh:
        fh.write(json.dumps({"value": '{"description":"disk full"}'}) + "\n" + json.dumps({"value": '{"nothing":1}'}) + "\n")
    lines = []
    cfg = {"application.id": "w", apps.WEBHOOK_SECTION: {"url": "u"}, "stats_config": {"enabled": True, "period_ms": 0, "sender": lines.append}}
    s = spark.readStream.schema("value string").json(src)
    q = apps.run_webhook(spark, cfg, source=s, sender_factory=recorders.RecorderFactory(rec), checkpoint=os.path.join(tmpdir_fresh, "ck"))
    q.processAllAvailable()
    q.stop()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    assert any("receivedRecords=2i" in x and "sentRecords=1i" in x and "filteredRecords=1i" in x and "application-id=w" in x for x in lines)


def test_kafka_settings_pass_on():
    o = kafka_options({"bootstrap.servers": "b", "security.protocol": "SSL", "fail.on.data.loss": False}, "t")
    assert o["kafka.security.protocol"] == "SSL" and o["failOnDataLoss"] == "false" and o["maxOffsetsPerTrigger"] == "1000000" and o["subscribe"] == "t"


def test_unknown_function_is_refused():
    base = {"general": {}, "input": {}, "output": {}}
    with pytest.raises(ValueError, match="unknown function"):
        RU.metric_rules(base | {"aggr_functs": {"count": [{"metricname": "m"}]}})
    with pytest.raises(ValueError, match="unknown function"):
        RU.metric_rules(base | {"aggr_functs": {"default": {"function": "median"}}})


def test_session_keeps_what_is_set(monkeypatch):
    from pulsegrid import session

    assert session.is_cluster("local-cluster[2,1,1024]") and session.is_cluster("spark://x") and not session.is_cluster("local[4]")
