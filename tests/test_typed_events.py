"""Typed points (P12-P17), header events (P19, P21-P23, P31-P33), collectd."""

import json

from pyspark.sql import functions as F

from pulsegrid.functions import typed as TY
from pulsegrid.operators import collectd as CD
from pulsegrid.operators import events as EVT
from pulsegrid.sources import rules as RU
from tests.conftest import rows


def test_typed_parse_and_render(spark):
    df = spark.createDataFrame([('cpu,z=1 i=5i,d=1e10,s="x\\y",b=TRUE,t=0.0001 1000000',)], "v string")
    p = df.select(TY.parse_line("v").alias("p"))
    kinds = dict(rows(p.select(F.explode("p.fields").alias("k", "v")), "k", "v.kind"))
    assert kinds == {"i": "long", "d": "double", "s": "string", "b": "boolean", "t": "double"}
    line = rows(p.select(TY.format_line(TY.with_tag("p", "host", "a b,c"), "ms")))[0][0]
    assert line == 'cpu,host=a\\ b\\,c,z=1 b=true,d=10000000000.0,i=5i,s="x\\\\y",t=0.0001 1'


def test_plain_double(spark):
    vals = [1e10, 1e-4, 6.55, 100.0, -2.5e-7, 123456789.125, 0.0]
    df = spark.createDataFrame([(v,) for v in vals], "d double")
    got = [r[0] for r in df.select(TY.plain_double("d")).collect()]
    assert got == ["10000000000.0", "0.0001", "6.55", "100.0", "-0.00000025", "123456789.125", "0.0"]


def test_edit_and_triples(spark):
    df = spark.createDataFrame([("m,b=2,a=1 x=1i,y=2.5,z=true 7",)], "v string").select(TY.parse_line("v").alias("p"))
    q = TY.with_time(TY.with_field(TY.with_tag("p", "a", "9"), "n", 2.0), F.lit(3), "s")
    assert rows(df.select(TY.format_line(q)))[0][0] == "m,a=9,b=2 n=2.0,x=1i,y=2.5,z=true 3000000000"
    t = rows(df.select(F.explode(TY.triples("p", "max")).alias("t")), "t.key", "t.value", "t.fn")
    assert t == [("m,a=1,b=2|x", 1.0, "max"), ("m,a=1,b=2|y", 2.5, "max")]
    d = rows(df.select(TY.format_line(TY.drop_non_numeric("p"))))[0][0]
    assert d == "m,a=1,b=2 x=1i,y=2.5 7"


def _events(spark, headers):
    return spark.createDataFrame([(h,) for h in headers], "headers map<string,string>").withColumn("body", F.lit(b"").cast("binary"))


def test_events_to_lines_edges(spark):
    hs = [
        {"name": "cpu", "tag_host": "h1", "tag_cpu": "c1", "value_usage_idle": "0.98", "value_n": "3", "value_s": "up",
         "timestamp": "1519751192000000000"},
        {"tag_host": "h"},  # without name
        {"name": "x", "tag_a": "1"},  # without value_*
        {"name": "x", "value_v": "1", "timestamp": "1000"},  # pre-2018
        {"name": "x", "value_v": "1", "abcde": "q"},  # unknown five-letter key
    ]
    got = rows(EVT.events_to_lines(_events(spark, hs)), "line", "error")
    assert got[0] == ('cpu,cpu=c1,host=h1 n=3i,s="up",usage_idle=0.98 1519751192000000000', None)
    assert got[1] == (None, "no name header")
    assert got[2] == (None, "no value fields")
    assert got[3] == (None, "timestamp below the nanosecond range")
    assert got[4] == ("x v=1i", None)


def test_json_event_source(spark):
    payload = json.dumps({"body": "test", "headers": {"test": "testValue", "n": 5, "o": {"a": 1}}}) + "\n" + "not json\n" + "x" * 70000 + "\n"
    df = spark.createDataFrame([(payload,)], "value string")
    got = rows(EVT.parse_json_events(df).orderBy("event_pos"), "headers", "error")
    assert got[0][0] == {"test": "testValue", "n": "5", "o": '{"a":1}'} and got[0][1] is None
    assert got[1] == (None, "no headers object")
    assert got[2] == (None, "event over the size limit")


def test_event_points_default_and_metric_key(spark):
    rules, default = RU.metric_rules({
        "general": {}, "input": {}, "output": {},
        "aggr_functs": {"default": {"function": "avg", "removetags": ["tag_host"]},
                         "sum": [{"metricname": "m1", "removetags": ["tag_host", "tag_path"]}],
                         "max": [{"metricname": "m1", "removetags": []}]},
    })
    hs = [{"name": "m1", "tag_host": "h", "tag_path": "/a:b,c", "value_value": "2"},
          {"name": "other|x", "tag_host": "h", "tag_z": "1", "value_value": "1.5"},
          {"name": "m1", "value_value": "abc"}]
    got = sorted(rows(EVT.event_points(_events(spark, hs), rules, default), "fn", "metric_key", "value", "error"), key=str)
    assert ("max", "m1|tag_host:h,tag_path:/abc", 2.0, None) in got
    assert ("sum", "m1", 2.0, None) in got
    assert ("avg", "otherx|tag_z:1", 1.5, None) in got
    assert (None, None, None, "value header is not numeric") in got


def test_points_json(spark):
    df = spark.createDataFrame([("avg", "disk_usage|tag_host:h1,tag_path:/", 1.5, 10)], "fn string, metric_key string, value double, window_end_ns long")
    js = json.loads(rows(EVT.points_to_json(df), "json")[0][0])
    assert js == {"headers": {"name": "disk_usage_aggr", "value_avg": "1.5", "type_value": "double", "timestamp": "10",
                              "tag_host": "h1", "tag_path": "/"}, "body": ""}


def test_collectd_readme_sample_and_bad(spark):
    doc = ('[{"values":[24125440,24576],"dstypes":["derive","derive"],"dsnames":["read","write"],"time":1520605461.795,'
           '"interval":10.0,"host":"h","plugin":"disk","plugin_instance":"dev_sda1","type":"disk_octets","type_instance":""},'
           '{"values":[1],"dstypes":["gauge","gauge"],"dsnames":["a"],"time":1,"interval":1,"host":"h","plugin":"p","plugin_instance":"","type":"","type_instance":""},'
           '{"values":[1],"dstypes":["gauge"],"dsnames":["a"],"time":1,"interval":1,"host":"","plugin":"p","plugin_instance":"","type":"","type_instance":""},'
           '{"values":[1.5,2],"dstypes":["gauge","weird"],"dsnames":["a","b"],"time":1,"interval":1,"host":"h","plugin":"p","plugin_instance":"","type":"","type_instance":""}]')
    out = CD.explode_collectd(spark.createDataFrame([(doc,)], "value string")).orderBy("elem_pos", "value_pos")
    got = rows(out, "headers", "error")
    assert got[0][0] == {"tag_instance": "dev_sda1", "tag_type": "disk_octets", "timestamp": "1520605461795000064",
                         "tag_host": "h", "value_value": "24125440", "name": "disk_read", "type_value": "long"}
    assert got[1][0]["name"] == "disk_write" and "tag_type_instance" not in got[1][0]
    assert got[2] == (None, "counts of values, types and names differ")
    assert got[3] == (None, "empty host")
    assert got[4][0]["value_value"] == "1.5" and got[4][0]["type_value"] == "double"
    assert got[5] == (None, "unsupported value type: weird")
