"""Rules (S9-S11), router (P3-P5, J1), aggregation."""

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import lines as L
from pulsegrid.operators import aggregate as A
from pulsegrid.operators import route as R
from pulsegrid.sources import rules as RU
from tests.conftest import rows


def test_router_rules_last_wins_and_wildcard():
    r = RU.router_rules({
        "database_filter": [{"measurement": "a"}],
        "onoff_filter": [{"measurement": "a", "field.name": "x,y"}, {"measurement": "a", "field.name": "z"}, {"measurement": "b"}],
    })
    assert set(r.rows) == {("database", "a", None), ("onoff", "a", "z"), ("onoff", "b", None)}


def test_rules_missing_keys_fatal():
    with pytest.raises(ValueError):
        RU.router_rules({"onoff_filter": [{"field.name": "x"}]})
    with pytest.raises(ValueError):
        RU.agg_rules({"avg_filter": [{"measurement": "m"}]})
    with pytest.raises(ValueError):
        RU.metric_rules({"general": {}, "input": {}})


def test_agg_rules_yaml_text():
    txt = """
aggregation_config: {window.s: 30}
avg_filter:
  - measurement: m
    field.name: a,b
    tags.remove: host
  - measurement: m
    field.name: a
"""
    r = RU.agg_rules(txt)
    assert sorted(r.rows) == [("avg", "m", "a", [""]), ("avg", "m", "b", ["host"])]
    assert RU.agg_window_seconds(txt) == 30


def test_route_branches_not_exclusive(spark):
    rules = RU.router_rules({
        "database_filter": [{"measurement": "m"}],
        "onoff_filter": [{"measurement": "m", "field.name": "a"}],
        "aggregator_filter": [{"measurement": "m"}],
    })
    df = spark.createDataFrame([("m,t=1 a=1,b=2 5", 0), ("m b", 1), ("x a=1", 2)], "value string, src_offset long")
    out = R.route(df, rules).orderBy("branch", "src_offset", "key")
    got = rows(out, "branch", "key", "value")
    assert ("database", None, "m,t=1 a=1,b=2 5") in got
    assert ("database", None, "m b") in got  # malformed fields, whole record still routed
    assert ("onoff", "m#a", "t=1#1#5") in got
    assert ("aggregator", "m#a", "t=1#1#5") in got and ("aggregator", "m#b", "t=1#2#5") in got
    assert len(got) == 5


def test_semi_join_plans_as_broadcast_hash(spark):
    rules = RU.router_rules({"onoff_filter": [{"measurement": "m"}, {"measurement": "n", "field.name": "a"}]})
    df = spark.createDataFrame([("m a=1", 0)], "value string, src_offset long")
    plan = R.route_fields(df, rules, "onoff")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_aggregate_one_pass_all_functions(spark):
    rules = RU.agg_rules({
        "avg_filter": [{"measurement": "m", "field.name": "f", "tags.remove": "h"}],
        "max_filter": [{"measurement": "m", "field.name": "f"}],
        "sum_filter": [{"measurement": "m", "field.name": "s"}],
    })
    data = [("m,h=a,c=1 f=1i,s=true 0", 1), ("m,h=b,c=1 f=3.5 0", 2), ("m,h=b,c=1 f=2 0", 40)]
    df = spark.createDataFrame(data, "value string, sec int").withColumn("event_ts", F.timestamp_seconds("sec")).drop("sec")
    out = A.aggregate(L.explode_fields(df), rules, window="30 seconds").orderBy("fn", "series", "window_end_ns")
    got = rows(out, "fn", "series", "window_end_ns", "value", "line")
    assert ("avg", "m,c=1#f", 30_000_000_000, 2.25, "m,c=1 f_avg=2.25 30000000000") in got
    assert ("avg", "m,c=1#f", 60_000_000_000, 2.0, "m,c=1 f_avg=2.0 60000000000") in got
    assert ("max", "m,h=b,c=1#f", 30_000_000_000, 3.5, "m,h=b,c=1 f_max=3.5 30000000000") in got
    assert not [g for g in got if g[0] == "sum"]  # 'true' is not numeric: dropped
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
