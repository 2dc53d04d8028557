"""Change detection (W1-W3): chunked lag equals plain lag; latest; refresh grid."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsegrid.functions import lines as L
from pulsegrid.operators import change as C
from pulsegrid.plans import fixtures as fx
from tests.conftest import SF, rows


def _brute(fields):
    x = C.with_series(fields)
    w = Window.partitionBy("series").orderBy("src_partition", "src_offset")
    x = x.withColumn("_p", F.lag("value").over(w))
    return x.filter(F.col("_p").isNull() | (F.col("_p") != F.col("value")))


def test_chunked_changes_match_brute_force(spark):
    f = L.explode_fields(fx.lines(spark, SF))
    want = sorted(rows(_brute(f), "series", "src_offset"))
    for chunk in (1, 7, 100, 1 << 20):
        got = sorted(rows(C.changes(f, chunk_rows=chunk), "series", "src_offset"))
        assert got == want, chunk


def test_string_compare_and_hot_series(spark):
    # one hot series split over many chunks; 1i -> 1.0 is a change, equal text is not
    vals = ["1i", "1i", "1.0", "1.0", "2", "2", "1i"] * 30
    df = spark.createDataFrame([(f"m,h=a f={v} {i}", i) for i, v in enumerate(vals)], "value string, src_offset long")
    df = df.withColumn("src_partition", F.lit(0))
    f = L.explode_fields(df)
    got = sorted(r[0] for r in C.changes(f, chunk_rows=4).select("src_offset").collect())
    want = sorted(r[0] for r in _brute(f).select("src_offset").collect())
    assert got == want and len(got) == 4 * 30 - 29


def test_latest_and_refresh(spark):
    df = spark.createDataFrame(
        [("m,h=a f=1 5000000000", 0), ("m,h=a f=2 7000000000", 1), ("m,h=b f=9 25000000000", 2)], "value string, src_offset long"
    ).withColumn("src_partition", F.lit(0))
    f = L.explode_fields(df)
    assert sorted(rows(C.latest(f), "series", "value")) == [("m,h=a#f", "2"), ("m,h=b#f", "9")]
    r = sorted(rows(C.refresh(f, 10), "series", "tick_ns", "value", "line"))
    assert r == [
        ("m,h=a#f", 10_000_000_000, "2", "m,h=a f=2 10000000000"),
        ("m,h=a#f", 20_000_000_000, "2", "m,h=a f=2 20000000000"),
        ("m,h=a#f", 30_000_000_000, "2", "m,h=a f=2 30000000000"),
        ("m,h=b#f", 30_000_000_000, "9", "m,h=b f=9 30000000000"),
    ]


def test_refresh_until(spark):
    df = spark.createDataFrame([("m,h=a f=1 5000000000", 0), ("m,h=a f=2 27000000000", 1)], "value string, src_offset long").withColumn(
        "src_partition", F.lit(0)
    )
    r = sorted(rows(C.refresh(L.explode_fields(df), 10, until_ns=50_000_000_000), "tick_ns", "value"))
    assert r == [(10_000_000_000, "1"), (20_000_000_000, "1"), (30_000_000_000, "2"), (40_000_000_000, "2"), (50_000_000_000, "2")]
