"""What a task gets and keeps does not grow with the tables."""

import glob

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from pulsegrid.functions import lines as L
from pulsegrid.functions import typed as TY
from pulsegrid.operators import change as C
from pulsegrid.plans import catalog
from pulsegrid.plans import fixtures as fx
from pulsegrid.session import COUNT_ROWS, checkpoint_root, use_rocksdb
from pulsegrid.streaming import ledger as LG


@pytest.fixture
def sf(spark, tmpdir_fresh):
    ev = spark.range(4000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"), (F.col("id") % 50).alias("user_id"),
        F.element_at(F.array(*map(F.lit, ("view", "click", "error", "signup", "purchase"))), (F.col("id") % 5 + 1).cast("int")).alias("event_type"),
        (F.col("id") / 8).alias("value"), F.concat(F.lit('{"k": '), (F.col("id") % 100).cast("string"), F.lit("}")).alias("props"))
    ev.coalesce(1).write.parquet(f"{tmpdir_fresh}/events.parquet")
    return tmpdir_fresh


def test_one_row_group_is_dealt_out_by_its_size(spark, sf, monkeypatch):
    monkeypatch.setattr(fx, "PART_BYTES", 4096)
    t = fx.table(spark, sf, "events")
    n = t.rdd.getNumPartitions()
    assert n > spark.sparkContext.defaultParallelism
    most = t.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert t.count() == 4000 and most < 4000 / n * 3
    for name in ("triples", "typed_render", "edit_point"):
        assert catalog.QUERIES[name](spark, sf).rdd.getNumPartitions() == n
    monkeypatch.setattr(fx, "MOST_PARTS", 7)
    t = fx.table(spark, sf, "events")
    assert t.rdd.getNumPartitions() == 7 and t.count() == 4000


def test_a_record_is_split_into_tokens_once(spark):
    d = spark.createDataFrame([("m,a=1 x=2i,y=3.5,z=true 7",)], "value string")
    p = d.select(TY.parse_line("value").alias("p"))
    assert p._jdf.queryExecution().optimizedPlan().toString().count("split(rtrim(value") == 1
    got = p.first().p
    assert (got.measurement, got.tags, got.ts_ns) == ("m", {"a": "1"}, 7)
    assert {k: (v.kind, v.l, v.d, v.b) for k, v in got.fields.items()} == {"x": ("long", 2, None, None), "y": ("double", None, 3.5, None), "z": ("boolean", None, None, True)}


def test_java_double_takes_what_the_cast_takes_but_for_words(spark):
    texts = ["1", "-1.5", "+.5", "5.", "1e3", "1E-3", "2d", "2.5F", "0x1p3", " 7 ", "7\t", "7\n", "\t7", "76i", "5%", "true", "", " ", ".", "-", "e5", "d", "1e", "1 2", "1_0", "١",
             "NaN", "-NaN", " Infinity ", "+Infinity", "inf", "nan", "INFINITY", "Infinity\n", None]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    words = F.trim("v").rlike(r"(?i)^[+-]?(inf|infinity|nan)$") & ~F.trim("v").rlike(r"^[+-]?(Infinity|NaN)$")
    got = d.select("v", L.java_double("v").cast("string").alias("a"), F.when(~words, F.col("v").try_cast("double")).cast("string").alias("b"))
    assert [r for r in got.collect() if r.a != r.b] == []
    assert [r.v for r in got.collect() if r.a is None][:4] == ["76i", "5%", "true", ""]


def test_router_counters_keep_a_file_per_core_at_once(spark, sf, monkeypatch):
    monkeypatch.setattr(fx, "PART_BYTES", 4096)
    before = set(glob.glob(f"{checkpoint_root(spark)}/router_counters-*"))
    got = dict(rows(catalog.QUERIES["router_counters"](spark, sf), "counter", "n"))
    (root,) = set(glob.glob(f"{checkpoint_root(spark)}/router_counters-*")) - before
    assert len(glob.glob(f"{root}/out/batch=*")) > 1
    assert got["receivedRecords"] == 4000 and got["writtenErrors"] == got["filteredRecords"]
    assert got["writtenRecords"] == sum(got[f"sent{x}Records"] for x in ("Database", "OnOff", "Aggregator"))


def test_change_stream_holds_no_batch_and_goes_on_from_the_last_values(spark, tmpdir_fresh, monkeypatch):
    def held(self, *a, **k):
        raise AssertionError("a micro-batch is held")

    schema = "value string, src_partition int, src_offset long"
    out = LG.Ledger(spark, f"{tmpdir_fresh}/out")
    for batch in ([("m f=1 1", 0, 0), ("m f=2 2", 0, 1), ("m f=2 3", 0, 2), ("n f=5 3", 0, 3)], [("m f=2 4", 0, 4), ("n f=6 4", 0, 5)], [("m f=2 5", 0, 6), ("m f=1 6", 0, 7), ("n f=6 7", 0, 8)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{tmpdir_fresh}/in")
        lines = spark.readStream.schema(schema).parquet(f"{tmpdir_fresh}/in")
        with monkeypatch.context() as m:
            m.setattr(DataFrame, "persist", held)
            LG.start_changes(L.explode_fields(lines), out, f"{tmpdir_fresh}/state", "held", f"{tmpdir_fresh}/ckpt", compact=2).awaitTermination()
    got = out.read("series STRING, src_offset BIGINT, value STRING")
    assert sorted(rows(got, "src_offset", "value")) == [(0, "1"), (1, "2"), (3, "5"), (5, "6"), (7, "1")]
    assert sorted(rows(LG.LastValues(spark, f"{tmpdir_fresh}/state").before(3), "series", "value")) == [("m#f", "1"), ("n#f", "6")]


def test_slices_read_the_bounds_of_the_table_once(spark, sf, monkeypatch):
    reads = []
    table = fx.table
    monkeypatch.setattr(fx, "table", lambda *a: reads.append(table(*a)) or reads[-1])
    plans = []
    write = DataFrame.filter
    monkeypatch.setattr(DataFrame, "filter", lambda self, c: plans.append(write(self, c)) or plans[-1])

    class Ended:
        def awaitTermination(self):
            pass

    catalog._in_slices(spark, sf, "bounds", "ts", lambda s, ckpt, done: Ended())
    assert len(plans) == 3 and sum(p.count() for p in plans) == 4000
    assert all("scalar-subquery" not in p._jdf.queryExecution().optimizedPlan().toString() for p in plans)


def test_state_rows_are_not_counted(spark):
    use_rocksdb(spark)
    assert spark.conf.get(COUNT_ROWS) == "false"


def test_grid_deals_series_out_by_rows(spark, monkeypatch):
    monkeypatch.setattr(C, "GRID_ROWS", 10)
    d = spark.range(300).select(F.concat(F.lit("m,h="), F.col("id").cast("string"), F.lit(" f=1")).alias("value"), F.timestamp_seconds(F.col("id") % 3 * 60).alias("event_ts"),
                                F.lit(0).alias("src_partition"), F.col("id").alias("src_offset"))
    grid = C.refresh(L.explode_fields(d), 60)
    assert grid.rdd.getNumPartitions() == 30
    assert grid.count() == 100 * (3 + 2 + 1)
