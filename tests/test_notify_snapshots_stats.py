"""Notifications (P24-P26), snapshots (P27-P30), stats."""

import json

from pyspark.sql import functions as F

from pulsegrid.operators import notify as NT
from pulsegrid.operators import snapshots as SN
from pulsegrid.operators import stats as ST
from pulsegrid.plans import fixtures as fx
from tests.conftest import SF, rows


def test_notifications(spark):
    vals = ['{"description":"d","client_url":"u","details":"x"}', '{"description":"d"}', '[1,2]', "nope", '{"details":"x"}']
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    assert [r[0] for r in NT.valid_notification(df).select("valid").collect()] == [True, True, False, False, False]
    t = [r[0] for r in NT.notification_text(df).select("text").collect()]
    assert json.loads(t[0]) == {"text": "d\nu\nx"} and json.loads(t[1]) == {"text": "d"} and t[2] is None


def test_email_rows(spark):
    df = spark.createDataFrame([('{"subject":"s","body":"b","to_addresses":"a@x,b@x,"}',), ('{"subject":"s"}',)], "value string")
    got = rows(NT.email_messages(df), "subject", "address", "error")
    assert got[:2] == [("s", "a@x", None), ("s", "b@x", None)]
    assert got[2][2] is not None and len(got) == 3


def test_to_nanos_and_python_floats(spark):
    now = 1_700_000_000
    df = spark.createDataFrame([(now,), (now * 1000,), (now * 1_000_000,), (now * 1_000_000_000,), (now * 10,)], "t long")
    got = [r[0] for r in df.select(SN.to_nanos("t", now)).collect()]
    assert got == [now * 10**9] * 4 + [None]
    fl = spark.createDataFrame([(v,) for v in [1e16, 1.5e-05, 0.1, 123.0, -2e-7]], "d double")
    assert [r[0] for r in fl.select(SN.py_float_text("d")).collect()] == [str(v) for v in [1e16, 1.5e-05, 0.1, 123.0, -2e-7]]


def test_dict_lines_types(spark):
    d = '{"measurement":"m","tags":{"b":"2","a":"1"},"fields":{"i":3,"f":1.10,"t":true,"s":"x"},"time":1700000000}'
    df = SN.parse_measurement_dict(spark.createDataFrame([(d,), ('{"tags":{}}',)], "value string"))
    got = rows(SN.measurements_to_lines(df, 1_700_000_000), "line", "error")
    assert got[0] == ('m,a=1,b=2 f=1.1,i=3i,s="x",t=true 1700000000000000000', None)
    assert got[1][0] is None and got[1][1] is not None


def test_spark_points_nested_and_excluded(spark):
    o = {"id": "1", "hostPort": "h:1", "isActive": True, "rddBlocks": 2.7, "executorLogs": {"stdout": "x"},
         "memoryMetrics": {"used": 5}}
    df = spark.createDataFrame([(json.dumps(o), "app", 1_700_000_000_000_000_000)], "value string, app_id string, sampled_ns long")
    p = SN.spark_points(df, "executors")
    got = rows(SN.measurements_to_lines(p.drop("error"), F.lit(1_700_000_000)), "line")
    assert got == [("spark_active_executors,hostPort=h:1,id=app,isActive=True rddBlocks=2i,used=5i 1700000000000000000",)]


def test_latency_summary_brute_force(spark):
    log = fx.delivery_log(spark, SF)
    s = ST.latency_summary(log).collect()[0]
    lat = sorted(r[0] for r in log.select("latency_ms").collect())
    n = len(lat)
    assert s["count"] == n and s["max_latency"] == lat[-1]
    for name, p in ST.PERCENTILES:
        assert s[name] == lat[int(p * n)], name
    assert abs(s["avg_latency"] - sum(lat) / n) < 1e-9


def test_count_stages(spark):
    a = spark.range(5)
    b = spark.range(3)
    assert sorted(rows(ST.count_stages(received=a, sent=b))) == [("received", 5), ("sent", 3)]


def test_latency_summary_wide_range(spark):
    import random

    rnd = random.Random(7)
    vals = [rnd.choice([rnd.randint(0, 50), rnd.randint(10**9, 10**12)]) for _ in range(3000)]
    log = spark.createDataFrame([(v, 10, i) for i, v in enumerate(vals)], "latency_ms long, bytes int, sec long").withColumn(
        "event_ts", F.timestamp_seconds("sec")
    )
    s = ST.latency_summary(log).collect()[0]
    lat = sorted(vals)
    for name, p in ST.PERCENTILES:
        assert s[name] == lat[int(p * len(lat))], name
