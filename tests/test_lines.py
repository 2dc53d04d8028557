"""Line-protocol parsing and scalar functions (P1, P2, P7-P11, P20), F9 edge rows."""

from pyspark.sql import functions as F

from pulsegrid.functions import lines as L
from tests.conftest import rows


def _lp(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, src_offset long")


def test_minimal_record(spark):
    d = L.explode_fields(_lp(spark, "meas,tag1=key1 value=100i 1234567890"))
    assert rows(d, "measurement", "tags", "field", "value", "ts_ns") == [("meas", "tag1=key1", "value", "100i", 1234567890)]


def test_edge_rows(spark):
    df = _lp(
        spark,
        "m f=1",  # no tags, no timestamp
        "m,a=1 f=1 ",  # trailing space
        "m,a=1 f=hello world,g=2 99",  # value with spaces
        "m f=",  # empty value -> malformed
        "m a=b=c",  # extra '='
        "single",  # single token
        "m,a=1 f=v=",  # trailing '=' dropped like Java split
        "m,a=1,, f=1",  # trailing commas in tags
        "m f=1 notts",  # trailing token that is not a long joins the fields
    )
    d = L.explode_fields(df, keep_bad=True).orderBy("src_offset", "field_pos")
    got = rows(d, "src_offset", "measurement", "tags", "field", "value", "ts_ns", "error")
    assert got[0] == (0, "m", "", "f", "1", None, None)
    assert got[1] == (1, "m", "a=1", "f", "1", None, None)
    assert got[2] == (2, "m", "a=1", "f", "hello world", 99, None)
    assert got[3] == (2, "m", "a=1", "g", "2", 99, None)
    assert got[4][0] == 3 and got[4][-1] == "malformed field"
    assert got[5][0] == 4 and got[5][-1] == "malformed field"
    assert got[6][0] == 5 and got[6][-1] == "too few tokens"
    assert got[7] == (6, "m", "a=1", "f", "v", None, None)
    assert got[8] == (7, "m", "a=1", "f", "1", None, None)
    assert got[9] == (8, "m", "", "f", "1 notts", None, None)


def test_internal_roundtrip_and_bad(spark):
    df = spark.createDataFrame(
        [("m#f", "t=1#5#123"), ("m#f", "#5#"), ("m", "t#5"), ("m#f", "a#b#c#d"), ("m#f", "t#v#xx")], "key string, wire string"
    )
    d = L.decode_internal(df, keep_bad=True)
    got = rows(d, "measurement", "field", "tags", "value", "ts_ns", "error")
    assert got[0] == ("m", "f", "t=1", "5", 123, None)
    assert got[1] == ("m", "f", "", "5", None, None)
    assert got[2][-1] == "bad key"
    assert got[3][-1] == "bad value"
    assert got[4][-1] == "bad timestamp"


def test_numeric_coercion(spark):
    vals = ["100i", "5%", "1d", "0x1p3", " 5 ", "NaN", "Infinity", "inf", "true", '"text"', "1.5", "", "i"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(L.to_double("v")).collect()]
    assert got[0] == 100.0 and got[1] == 5.0 and got[2] == 1.0 and got[3] == 8.0 and got[4] == 5.0
    assert got[5] != got[5]  # NaN
    assert got[6] == float("inf")
    assert got[7] is None and got[8] is None and got[9] is None
    assert got[10] == 1.5 and got[11] is None and got[12] is None


def test_remove_tags_series_render(spark):
    df = spark.createDataFrame([("m", "host=a,card=b,x=c", "f", "1i", 5)], "measurement string, tags string, field string, value string, ts_ns long")
    d = df.select(
        L.remove_tags("tags", F.array(F.lit("card"))).alias("t"),
        L.series_key("measurement", L.remove_tags("tags", F.array(F.lit("host"), F.lit("card"), F.lit("x"))), "field").alias("s0"),
        L.series_key("measurement", "tags", "field").alias("s1"),
        L.render_line("measurement", F.lit(""), "field", "value", "ts_ns").alias("r"),
        L.render_aggregate(F.lit("m,host=a#f"), F.lit("avg"), F.lit(1e10), F.lit(30000000000)).alias("a"),
        L.tag_ingest_time(F.lit("m,a=1 f=1 5"), F.lit(7)).alias("i"),
    )
    assert rows(d) == [("host=a,x=c", "m#f", "m,host=a,card=b,x=c#f", "m f=1i 5", "m,host=a f_avg=1.0E10 30000000000", "m,a=1,timestamp=7 f=1 5")]
