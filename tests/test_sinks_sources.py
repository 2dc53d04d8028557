"""Sinks with a recording sender (K3-K8) and source option mapping (S3)."""

import os
import urllib.error
import urllib.request

import pytest
import recorders
from pyspark.sql import functions as F

from pulsegrid.sinks import writers as W
from pulsegrid.sources.streams import kafka_options


_Factory = recorders.RecorderFactory


def test_udp_round_robin_and_empty_skipped(spark, tmpdir_fresh):
    df = spark.createDataFrame([("a",), ("",), ("b",), ("c",), (None,), ("d",)], "value string").coalesce(1)
    W.write_udp(df, "h", [1, 2, 3], sender_factory=_Factory(tmpdir_fresh))
    got = [(r["payload"], r["port"]) for r in recorders.read_recorded(tmpdir_fresh)]
    assert got == [("a", 1), ("b", 2), ("c", 3), ("d", 1)]


def test_udp_bytes_are_utf8(spark, tmpdir_fresh):
    df = spark.createDataFrame([("é",)], "value string")
    W.write_udp(df, "h", "9", sender_factory=_Factory(tmpdir_fresh), suffix="\n")
    assert [r["payload"] for r in recorders.read_recorded(tmpdir_fresh)] == ["é\n"]


def test_http_batches(spark, tmpdir_fresh):
    df = spark.createDataFrame([(f"l{i}",) for i in range(5)], "value string").coalesce(1)
    W.write_http(df, "http://x/write", batch_size=2, sender_factory=_Factory(tmpdir_fresh))
    assert [r["body"] for r in recorders.read_recorded(tmpdir_fresh)] == ["l0\nl1", "l2\nl3", "l4"]


def test_http_failure_fails_the_task(spark, tmpdir_fresh):
    df = spark.createDataFrame([("l",)], "value string")
    with pytest.raises(Exception, match="status 500"):
        W.write_http(df, "http://x/write", sender_factory=_Factory(tmpdir_fresh, status=500))


def test_webhook_and_email(spark, tmpdir_fresh):
    t = spark.createDataFrame([('{"text":"hi"}',)], "text string")
    W.write_webhook(t, "http://hook", sender_factory=_Factory(os.path.join(tmpdir_fresh, "w")))
    assert recorders.read_recorded(os.path.join(tmpdir_fresh, "w"))[0]["body"] == '{"text":"hi"}'
    m = spark.createDataFrame([("s", "b", "a@x", None), ("s", None, None, "missing")], "subject string, body string, address string, error string")
    W.write_email(m, {"from": "me@x"}, sender_factory=_Factory(os.path.join(tmpdir_fresh, "m")))
    got = recorders.read_recorded(os.path.join(tmpdir_fresh, "m"))
    assert [(g["to"], g["subject"], g["sender"]) for g in got] == [(["a@x"], "s", "me@x")]
    both = spark.createDataFrame([("s", "b", ["a@x", "b@x"], None), ("s", "b", [], None)], "subject string, body string, addresses array<string>, error string")
    W.write_email(both, {"from": "me@x"}, sender_factory=_Factory(os.path.join(tmpdir_fresh, "m2")))
    assert [g["to"] for g in recorders.read_recorded(os.path.join(tmpdir_fresh, "m2"))] == [["a@x", "b@x"]]  # one mail to all


def test_http_sender_returns_the_status_of_a_refusal(monkeypatch, caplog):
    def refuse(req, timeout):
        raise urllib.error.HTTPError(req.full_url, 500, "no", {}, None)

    monkeypatch.setattr(urllib.request, "urlopen", refuse)
    assert W.HttpSender().post("http://hook", b"{}") == 500
    write = W.webhook_partition_writer("http://hook")
    write([{"text": "{}"}])  # logged, the next message goes on
    assert "500" in caplog.text


def test_smtp_sender_without_and_with_tls(monkeypatch):
    calls = []

    class Smtp:
        def __init__(self, host, port):
            calls.append(("open", host, port))

        def __getattr__(self, name):
            return lambda *a, **k: calls.append((name, *(x for x in a if isinstance(x, str)), *k.values()))

    monkeypatch.setattr("smtplib.SMTP", Smtp)
    write = W.email_partition_writer({"hostname": "h", "username": "u", "password": "p", "from": "me@x"})
    write([{"addresses": ["a@x", "b@x"], "subject": "s", "body": "b"}])
    assert calls == [("open", "h", 25), ("login", "u", "p"), ("send_message", ["a@x", "b@x"]), ("quit",)]
    calls.clear()
    W.SmtpSender({"hostname": "h", "tls": True, "port": 587})
    assert calls == [("open", "h", 587), ("starttls",)]


def test_console_prints_every_row(spark, capsys):
    W.write_console(spark.range(45).selectExpr("concat('row', id) as value"), "value")
    assert len(capsys.readouterr().out.split()) == 45


def test_streaming_sink_via_foreach_batch(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    spark.createDataFrame([("x",), ("y",)], "value string").coalesce(1).write.text(src)
    s = spark.readStream.schema("value string").text(src)
    q = W.write_udp(s, "h", [5], sender_factory=_Factory(os.path.join(tmpdir_fresh, "r")),
                    checkpoint=os.path.join(tmpdir_fresh, "ck"), trigger={"availableNow": True})
    q.awaitTermination()
    assert sorted(r["payload"] for r in recorders.read_recorded(os.path.join(tmpdir_fresh, "r"))) == ["x", "y"]


def test_kafka_options():
    o = kafka_options({"bootstrap.servers": "b:9092", "topic": "t", "group.id": "g", "auto.offset.reset": "earliest",
                       "max.poll.records": 1000000, "fetch.min.bytes": 1})
    assert o == {"kafka.bootstrap.servers": "b:9092", "subscribe": "t", "kafka.group.id": "g", "startingOffsets": "earliest",
                 "maxOffsetsPerTrigger": "1000000", "kafka.fetch.min.bytes": "1", "failOnDataLoss": "true"}
