"""Round 3: batch ledgers, restarted streams, deliveries with a ledger, numbering, radix selection."""

import json
import os
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pulsegrid.functions import lines as L
from pulsegrid.operators import change as C
from pulsegrid.operators import stats as ST
from pulsegrid.sinks import delivery as D
from pulsegrid.sinks import writers as W
from pulsegrid.streaming import jobs as J
from pulsegrid.streaming import ledger as LG
from tests.conftest import rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the recorder goes to the workers
SCHEMA = "value STRING, event_ts TIMESTAMP, src_partition INT, src_offset BIGINT"


def lp(spark, recs):
    """(line, second, partition, offset) as records."""
    return spark.createDataFrame([(v, t, p, o) for v, t, p, o in recs], "value STRING, t LONG, src_partition INT, src_offset LONG").select(
        "value", F.timestamp_seconds("t").alias("event_ts"), "src_partition", "src_offset")


def feed(spark, path, recs):
    lp(spark, recs).coalesce(1).write.mode("append").parquet(path)


def stop(_):
    raise RuntimeError("stopped before the commit")


def run(q):
    try:
        q.awaitTermination()
        return True
    except Exception as e:
        assert "stopped before the commit" in str(e) or "refused" in str(e)
        return False


# --- T4


@pytest.mark.parametrize("compact", [1, 2, 16])
def test_changes_over_restarts(spark, tmpdir_fresh, compact):
    rng = random.Random(compact)
    recs = [(f"m,h={'hot' if rng.random() < .5 else rng.randint(0, 3)} f={rng.randint(0, 1)},g=1i,f={rng.randint(0, 1)} {i}", i, 0, i) for i in range(120)]
    out = LG.Ledger(spark, f"{tmpdir_fresh}/out")
    for i in range(0, 120, 20):
        feed(spark, f"{tmpdir_fresh}/in", recs[i:i + 20])
        for done in (stop, None) if i % 40 else (None,):
            fields = L.explode_fields(spark.readStream.schema(SCHEMA).parquet(f"{tmpdir_fresh}/in"))
            run(LG.start_changes(fields, out, f"{tmpdir_fresh}/state", "t4", f"{tmpdir_fresh}/ck", chunk_rows=7, compact=compact, done=done))
    got = sorted(rows(out.read("series STRING, src_offset LONG, field_pos INT, value STRING, line STRING").drop("batch")))
    want = sorted(rows(C.changes(L.explode_fields(lp(spark, recs))), "series", "src_offset", "field_pos", "value", "line"))
    assert got == want and len(got) > 20
    # the fields of a record count in their order: f=.. and then f=.. again
    last, plain = {}, []
    for v, _, _, o in recs:
        head, fields, _ = v.split(" ")
        for pos, f in enumerate(fields.split(",")):
            name, value = f.split("=")
            if last.get((head, name)) != value:
                plain.append((f"{head}#{name}", o, pos, value))
            last[(head, name)] = value
    assert sorted(x[:4] for x in got) == sorted(plain)
    assert compact > 2 or len(LG.Ledger(spark, f"{tmpdir_fresh}/state/delta").ids()) < 6


def test_changes_job_uses_no_python(spark, tmpdir_fresh):
    previous = spark.createDataFrame([("m,h=a#f", "1")], "series STRING, value STRING")
    fields = L.explode_fields(lp(spark, [("m,h=a f=1", 1, 0, 1), ("m,h=a f=2", 2, 0, 2), ("m,h=b f=1", 3, 0, 3)]))
    df = C.changes(fields, previous=previous)
    assert sorted(rows(df, "src_offset")) == [(2,), (3,)]
    assert "Python" not in df._jdf.queryExecution().toString()


# --- T5


def test_refresh_over_restarts(spark, tmpdir_fresh):
    rng = random.Random(2)
    recs = [(f"m,h={rng.randint(0, 4)} f={i}", 10 * i + rng.randint(0, 9), i % 2, i) for i in range(90)]
    recs.sort(key=lambda r: r[1] // 60)  # out of order within a minute, which the grace allows
    out = LG.Ledger(spark, f"{tmpdir_fresh}/out")
    for i in range(0, 90, 15):
        feed(spark, f"{tmpdir_fresh}/in", recs[i:i + 15])
        for done in (stop, None) if i % 30 else (None,):
            fields = L.explode_fields(spark.readStream.schema(SCHEMA).parquet(f"{tmpdir_fresh}/in"))
            run(LG.start_refresh(fields, 25, out, f"{tmpdir_fresh}/state", "t5", grace_s=60, checkpoint=f"{tmpdir_fresh}/ck", done=done))
    due = (max(r[1] for r in recs) - 60) // 25 * 25 * 10**9
    got = sorted(rows(out.read("series STRING, tick_ns LONG, value STRING, line STRING").drop("batch")))
    want = [r for r in sorted(rows(C.refresh(L.explode_fields(lp(spark, recs)), 25), "series", "tick_ns", "value", "line")) if r[1] <= due]
    assert got == want and len(got) > 100
    assert LG.Ledger(spark, f"{tmpdir_fresh}/state/clock").read("late LONG").agg(F.max("late")).first()[0] == 0


def test_refresh_counts_late_records(spark, tmpdir_fresh):
    out = LG.Ledger(spark, f"{tmpdir_fresh}/out")
    for recs in ([("m f=1", 5, 0, 0), ("m f=2", 100, 0, 1)], [("m f=9", 6, 0, 2), ("n f=1", 101, 0, 3)], []):
        if recs:
            feed(spark, f"{tmpdir_fresh}/in", recs)
        fields = L.explode_fields(spark.readStream.schema(SCHEMA).parquet(f"{tmpdir_fresh}/in"))
        run(LG.start_refresh(fields, 10, out, f"{tmpdir_fresh}/state", "late", grace_s=10, checkpoint=f"{tmpdir_fresh}/ck"))
    got = sorted(rows(out.read("series STRING, tick_ns LONG, value STRING").drop("batch")))
    assert got == [("m#f", t * 10**9, "1") for t in range(10, 91, 10)]
    assert LG.Ledger(spark, f"{tmpdir_fresh}/state/clock").read("late LONG").agg(F.max("late")).first()[0] == 1


# --- T6


def test_batch_time_survives_a_replay(spark, tmpdir_fresh):
    feed(spark, f"{tmpdir_fresh}/in", [("a f=1", 1, 0, 0)])
    seen = []

    def each(df, batch_id):
        seen.append((batch_id, J.batch_time_ns(spark, f"{tmpdir_fresh}/ck", batch_id)))
        if len(seen) == 1:
            stop(batch_id)

    for _ in range(2):
        run(W.for_batches(spark.readStream.schema(SCHEMA).parquet(f"{tmpdir_fresh}/in"), each, f"{tmpdir_fresh}/ck", {"availableNow": True}))
    assert len(seen) == 2 and seen[0] == seen[1] and seen[0][1] > 10**18


# --- K4 L1


def test_numbering_in_chunks(spark):
    rng = random.Random(9)
    recs = [(f"x{i}" if i % 7 else "", i, i % 3 if i < 200 else 0, rng.randint(0, 10**6) * 1000 + i) for i in range(400)]
    df = lp(spark, recs)
    plain = {}
    for p in range(3):
        for i, r in enumerate(sorted((r for r in recs if r[2] == p and r[0]), key=lambda r: r[3])):
            plain[r[3]] = (5000 + i % 3, i // 10)
    for chunk in (1000, 10**7, 1 << 40):
        d = W.delivery_plan(df, [5000, 5001, 5002], 10, chunk=chunk)
        assert {r.src_offset: (r.port, r.batch) for r in d.collect()} == plain
    windows = [x for x in d._jdf.queryExecution().toString().splitlines() if "Window" in x and "row_number" in x]
    assert windows and all("_chunk" in x for x in windows)


class Recorder:
    """Writes what it is asked to send to a file; refuses while a named file is missing."""

    def __init__(self, path, gate=None):
        self.path, self.gate = path, gate

    def _log(self, *x):
        with open(f"{self.path}/{os.getpid()}", "a") as f:
            f.write(json.dumps(x) + "\n")

    def post(self, url, body, content_type="text/plain"):
        refused = self.gate and b"x3" in body.split(b"\n") and not os.path.exists(self.gate)
        self._log("refused" if refused else "sent", body.decode())
        return 503 if refused else 204 if content_type == "text/plain" else 200

    def send(self, *x):
        self._log("sent", *[v if isinstance(v, (str, int, list)) else v.decode() for v in x])

    def close(self):
        pass


def logged(path):
    return [json.loads(x) for f in os.listdir(path) for x in open(f"{path}/{f}")]


def test_udp_sends_by_the_plan(spark, tmpdir_fresh):
    df = lp(spark, [(f"x{i}", i, i % 2, i) for i in range(40)]).repartition(7)
    W.write_udp(df, "h", "1,2,3", sender_factory=lambda: Recorder(tmpdir_fresh))
    assert sorted((x[1], x[3]) for x in logged(tmpdir_fresh)) == sorted((f"x{i}", i // 2 % 3 + 1) for i in range(40))


# --- K5 K6 K7


def test_http_commits_what_was_accepted(spark, tmpdir_fresh):
    src, log, gate = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/log", f"{tmpdir_fresh}/gate"
    os.makedirs(log)
    feed(spark, src, [(f"x{i}", i, i % 2, i) for i in range(20)])

    def start():
        return W.write_http(spark.readStream.schema(SCHEMA).parquet(src), "u", 4, sender_factory=lambda: Recorder(log, gate), checkpoint=f"{tmpdir_fresh}/ck",
                            trigger={"availableNow": True}, ledger=f"{tmpdir_fresh}/sent")

    assert not run(start())  # one POST is refused: the micro-batch is not committed
    assert not os.path.exists(f"{tmpdir_fresh}/ck/commits/0")
    assert D.accepted(spark, f"{tmpdir_fresh}/sent", 0).count() == 16
    open(gate, "w").close()
    assert run(start())
    assert os.path.exists(f"{tmpdir_fresh}/ck/commits/0")
    sent = [x[1].split("\n") for x in logged(log) if x[0] == "sent"]
    assert sorted(v for b in sent for v in b) == sorted(f"x{i}" for i in range(20)) and max(map(len, sent)) == 4
    assert [x[1] for x in logged(log) if x[0] == "refused"] == ["x1\nx3\nx5\nx7"]
    assert D.accepted(spark, f"{tmpdir_fresh}/sent", 0).count() == 20


@pytest.mark.parametrize("kind", ["mail", "webhook"])
def test_no_second_mail_on_replay(spark, tmpdir_fresh, kind):
    src, log = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/log"
    os.makedirs(log)
    feed(spark, src, [(f"x{i}", i, 0, i) for i in range(6)])
    df = spark.read.parquet(src).select(F.col("value").alias("subject"), F.col("value").alias("body"), F.array("value").alias("addresses"), F.col("value").alias("text"), "src_partition", "src_offset")
    for _ in range(3):  # the same batch again and again, as after a crash before the commit
        if kind == "mail":
            W.write_email(df, {"from": "me"}, sender_factory=lambda: Recorder(log), ledger=f"{tmpdir_fresh}/sent")
        else:
            W.write_webhook(df, "u", sender_factory=lambda: Recorder(log), ledger=f"{tmpdir_fresh}/sent")
    assert sorted(x[-1] for x in logged(log)) == [f"x{i}" for i in range(6)]


# --- A8


def test_percentiles_of_a_crowded_octave(spark):
    n = 1 << 17
    df = spark.range(n).select((F.lit(1 << 40) + F.pmod(F.col("id") * 48271, F.lit(n))).alias("latency_ms"), F.lit(1).alias("bytes"), F.timestamp_seconds("id").alias("event_ts"))
    r = ST.latency_summary(df).first()
    assert (r.p50, r.p95, r.p99, r.p999) == tuple((1 << 40) + int(p * n) for p in (.5, .95, .99, .999))


@pytest.mark.parametrize("seed", range(4))
def test_order_statistics_brute_force(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([rng.randint(-3, 3), rng.randint(-(1 << 63), (1 << 63) - 1), rng.randint(0, 10**6)]) for _ in range(rng.choice([1, 2, 300]))] + ([-(1 << 63), (1 << 63) - 1] if seed else [])
    counts = spark.createDataFrame([(v,) for v in values], "lat LONG").groupBy("lat").agg(F.count("*").alias("c"))
    ranks = {str(i): rng.randrange(len(values)) for i in range(4)}
    assert ST.order_statistics(counts, ranks, min(values), max(values)) == {k: sorted(values)[i] for k, i in ranks.items()}


# --- T7


def test_router_counts_and_errors_in_one_scan(spark, tmpdir_fresh):
    from pulsegrid.plans import apps

    cfg = {"application.id": "r1", "component_config": {"topic.output.database": "db", "topic.output.onoff": "oo", "topic.output.aggregator": "ag"},
           "database_filter": [{"measurement": "cpu"}], "onoff_filter": [{"measurement": "cpu", "field.name": "up"}], "aggregator_filter": []}
    sent = []
    cfg["stats_config"] = {"enabled": True, "period_ms": 0, "sender": sent.append}
    src = f"{tmpdir_fresh}/in"
    feed(spark, src, [("cpu,h=a up=1i,load=2 1", 1, 0, 0), ("cpu,h=a up 2", 2, 0, 1), ("mem f=1", 3, 0, 2), ("broken", 4, 0, 3)])
    got, batches = [], []

    def write(df, batch_id):
        got.extend((r.topic, r.value) for r in df.collect())
        batches.append(batch_id)
        if len(batches) == 1:
            stop(batch_id)

    for _ in range(2):  # the first attempt is lost behind the sink: nothing is counted or written twice
        run(apps.run_router(spark, cfg, source=spark.readStream.schema(SCHEMA).parquet(src), checkpoint=f"{tmpdir_fresh}/ck", errors=f"{tmpdir_fresh}/err",
                            write_batch=write, trigger={"availableNow": True}))
    assert sorted(got) == sorted(2 * [("db", "cpu,h=a up=1i,load=2 1"), ("db", "cpu,h=a up 2"), ("oo", "h=a#1i#1")]) and batches == [0, 0]
    assert sorted(rows(spark.read.schema("error STRING, raw STRING").json(f"{tmpdir_fresh}/err"), "raw")) == [("broken",), ("cpu,h=a up 2",)]
    assert len(sent) == 1
    assert sent[0].startswith("kafka_streams,application_id=r1,hostname=")
    assert " receivedRecords=4i,filteredRecords=2i,sentDatabaseRecords=2i,sentOnOffRecords=1i,sentAggregatorRecords=0i " in sent[0]


def test_detector_counts_bad_records(spark, tmpdir_fresh):
    from pulsegrid.plans import apps

    sent, src = [], f"{tmpdir_fresh}/in"
    cfg = {"application.id": "d1", "detector": {}, "stats_config": {"enabled": True, "period_ms": 0, "sender": sent.append}}
    spark.createDataFrame([("cpu#up", "h=a#1i#1", 0), ("cpu#up", "broken", 1), ("cpu#up", "h=a#1i#3", 2)], "key STRING, value STRING, o LONG").select(
        "key", "value", F.timestamp_seconds("o").alias("event_ts"), F.lit(0).alias("src_partition"), F.col("o").alias("src_offset")).coalesce(1).write.parquet(src)
    s = spark.readStream.schema("key STRING, " + SCHEMA).parquet(src)
    name = apps.query_name(cfg, "detector")
    q = apps.run_detector(spark, cfg, source=s, checkpoint=f"{tmpdir_fresh}/ck",
                          write_topic=lambda df, ck: J.start(df, name, sink="json", path=f"{tmpdir_fresh}/out", checkpoint=ck))
    q.awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    assert any("filteredRecords=1i" in x and "sentRecords=1i" in x and "sentPeriodicRecords=0i" in x and "application_id=d1" in x for x in sent)
