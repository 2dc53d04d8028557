"""The reference's components as Structured Streaming apps, driven by the same YAML.

Each ``build_*`` returns the streaming DataFrame that goes to the sink (the
source may be injected, e.g. a file stream in tests); each ``run_*`` also
starts the sink and returns the query. Offsets and state stay in
``<spark.checkpoint.dir>/<application id>/<job>``, so that a restarted app goes
on where it stopped; bad rows go to ``error_output``, if one is named, and are
counted by the reporter of ``stats_config``. CLI::

    python -m pulsegrid.plans.apps router --config conf-router.yaml
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lines as L
from ..operators import aggregate as A
from ..operators import events as EVT
from ..operators import notify as NT
from ..operators import route as R
from ..sinks import writers as W
from ..sources import rules as RU
from ..sources import streams as S
from ..session import app_checkpoint, use_rocksdb
from ..streaming import jobs as J
from ..streaming import progress as P
from ..streaming import tee as TEE
from ..streaming.detector import detect_changes

# Section names of the reference's YAML files (kept for drop-in configs).
WEBHOOK_SECTION = "mattermost_config"
EMAIL_SECTION = "email_config"
SENDER_SECTION = "sender_config"
CONSUMER_SECTION = "kafka_consumer_config"
STATS_SECTION = "stats_config"
APPLICATION_ID = "application.id"
#: Own key: a folder for bad rows.
ERROR_OUTPUT = "error_output"


def _bootstrap(cfg: dict, section: str = "kafka_config") -> str:
    return str((cfg.get(section) or {}).get("bootstrap.servers", ""))


def app_id(cfg: dict, name: str) -> str:
    """``application.id`` (at the top or in a Kafka section), else the component's name."""
    for part in (cfg, cfg.get("kafka_config") or {}, cfg.get(CONSUMER_SECTION) or {}):
        if part.get(APPLICATION_ID):
            return str(part[APPLICATION_ID])
    return f"pulsegrid-{name}"


def _checkpoint(spark: SparkSession, cfg: dict, name: str, given: str | None) -> str:
    """A restarted application finds its offsets and state where it left them."""
    return given or app_checkpoint(spark, app_id(cfg, name), name)


def _lines_source(spark: SparkSession, cfg: dict, topic: str, source: DataFrame | None) -> DataFrame:
    if source is not None:
        return source
    kafka = {k: v for k, v in (cfg.get("kafka_config") or {}).items() if k != APPLICATION_ID}
    return S.read_lines(spark, "kafka", S.kafka_options(kafka, topic))


_bad = TEE.bad_rows


def _start_errors(bad: DataFrame, cfg: dict, checkpoint: str, errors: str | None):
    """Write bad rows as JSON to ``errors`` (or ``error_output`` in the YAML) by a query of
    its own with its own checkpoint. None if no output is named: they are then only counted."""
    path = errors or cfg.get(ERROR_OUTPUT)
    if not path:
        return None
    return J.start(bad, f"{checkpoint.rstrip('/').rsplit('/', 1)[-1]}-errors", sink="json", path=str(path), checkpoint=f"{checkpoint}-errors",
                   trigger={"processingTime": "1 second"})


def _stats(cfg: dict) -> dict | None:
    """``stats_config``, if it is enabled."""
    stats = cfg.get(STATS_SECTION) or {}
    return stats if str(stats.get("enabled", "false")).lower() == "true" else None


def _report_to(stats: dict) -> dict:
    return {"period_ms": int(stats.get("period_ms", 10_000)), "host": str(stats.get("hostname", "localhost")), "port": int(stats.get("port", 8090)), "sender": stats.get("sender")}


# Names that dashboards on the reference's self-monitoring lines ask for.
STREAMS, CONSUMER, APP_TAG = "kafka_streams", "kafka_consumer", "application_id"
BRANCH_COUNTERS = {"database": "sentDatabaseRecords", "onoff": "sentOnOffRecords", "aggregator": "sentAggregatorRecords"}
CONSUMER_TAGS = {"udp-consumer": "InfluxDB", "email": "Emailer", "webhook": "Mattermost"}


def _watched(df: DataFrame, cfg: dict, name: str, error: bool = False, **counters) -> DataFrame:
    """``df`` with the counters of ``stats_config`` attached and its reporter registered
    (``enabled``, ``hostname``, ``port``, ``period_ms``; from code also a ``sender``): sent
    and filtered rows, or the given ``counters`` (name=Column)."""
    stats = _stats(cfg)
    if stats is None:
        return df
    bad = F.count(F.when(F.col("error").isNotNull(), 1)) if error else F.lit(0).cast("bigint")
    tags = {"application-id": app_id(cfg, name), APP_TAG: app_id(cfg, name)}
    measurement = CONSUMER if name in CONSUMER_TAGS else STREAMS
    if name in CONSUMER_TAGS:
        tags["endpoint_type"] = CONSUMER_TAGS[name]
        topic, sink = (cfg.get(CONSUMER_SECTION) or {}).get("topic"), cfg.get(SENDER_SECTION) or {}
        if topic:
            tags["topic"] = str(topic)
        if name == "udp-consumer":
            tags["endpoint"] = f"{sink.get('hostname', 'localhost')}:{sink.get('port', '8089')}".replace(",", "|")
    df.sparkSession.streams.addListener(P.ProgressReporter(query_name(cfg, name), measurement=measurement, tags=tags, **_report_to(stats)))
    return P.observe_counts(df, name, **(counters or {"sentRecords": F.count(F.lit(1)) - bad, "filteredRecords": bad}))


def _filtered(parsed: DataFrame, cfg: dict, name: str) -> DataFrame:
    """Parsed rows with their bad ones counted in the query's own scan, before they are left out."""
    if _stats(cfg) is None:
        return parsed
    return P.observe_counts(parsed, f"{name}-parsed", filteredRecords=F.count_if(F.col("error").isNotNull()))


def query_name(cfg: dict, name: str) -> str:
    return f"{app_id(cfg, name)}.{name}"


# --------------------------------------------------------------------------- router
def _router_source(spark: SparkSession, cfg: dict, source: DataFrame | None) -> DataFrame:
    return _lines_source(spark, cfg, (cfg.get("component_config") or {}).get("topic.input", ""), source)


def _topics(cfg: dict) -> dict:
    comp = cfg.get("component_config") or {}
    return {b: comp.get(f"topic.output.{b}", b) for b in RU.ROUTER_BRANCHES}


def build_router(spark: SparkSession, cfg, source: DataFrame | None = None) -> DataFrame:
    cfg = RU.load_config(cfg)
    return J.stream_router(_router_source(spark, cfg, source), RU.router_rules(cfg), _topics(cfg))


def _run_topic(spark: SparkSession, cfg: dict, name: str, out: DataFrame, bad: DataFrame, topic: str | None, checkpoint: str | None,
               errors: str | None, write_topic=None):
    """Start the sink of a topic application and its error output."""
    use_rocksdb(spark)
    ckpt = _checkpoint(spark, cfg, name, checkpoint)
    counters = {"sentRecords": F.count(F.lit(1))}
    if "kind" in out.columns:
        periodic = F.col("kind") == "refresh"
        counters = {"sentPeriodicRecords": F.count_if(periodic), "sentRecords": F.count_if(~periodic)}
    out = _watched(out, cfg, name, **counters).drop("kind")
    _start_errors(bad, cfg, ckpt, errors)
    if write_topic is not None:
        return write_topic(out, ckpt)
    return W.write_topic(out, _bootstrap(cfg), topic, checkpoint=ckpt, name=query_name(cfg, name))


def run_router(spark: SparkSession, cfg, source: DataFrame | None = None, checkpoint: str | None = None, errors: str | None = None, write_topic=None,
               write_batch=None, trigger: dict | None = None):
    """With ``stats_config`` or an error output each micro-batch is parsed once, and from there
    sent, counted by branch and its bad rows written. ``write_batch(df, batch_id)`` may replace
    the Kafka writer; ``write_topic(df, checkpoint)`` may do so for a plain stream, here and
    below, whose errors a query of their own writes."""
    cfg = RU.load_config(cfg)
    lines = _router_source(spark, cfg, source)
    path, stats, rules, topics = errors or cfg.get(ERROR_OUTPUT), _stats(cfg), RU.router_rules(cfg), _topics(cfg)
    if write_topic is not None or not (path or stats or write_batch):
        bad = _bad(L.explode_fields(lines, keep_bad=True), "line")
        return _run_topic(spark, cfg, "router", build_router(spark, cfg, lines), bad, None, checkpoint, errors, write_topic)
    use_rocksdb(spark)
    totals = P.Totals(STREAMS, {APP_TAG: app_id(cfg, "router")}, **_report_to(stats)) if stats else None
    counters = {name: F.count_if(F.col("branch") == branch) for branch, name in BRANCH_COUNTERS.items()}
    send = write_batch or (lambda df, _id: W.write_topic(df, _bootstrap(cfg)))
    parsed = R.parsed(lines, key_col="key" if "key" in lines.columns else None)
    return TEE.start_tee(parsed, "line", lambda x: R.routed(x, rules, topics), send, query_name(cfg, "router"), _checkpoint(spark, cfg, "router", checkpoint),
                         str(path) if path else None, totals, counters, trigger)


# --------------------------------------------------------------------------- aggregator
def _internal(spark: SparkSession, cfg: dict, section: str, source: DataFrame | None) -> DataFrame:
    recs = _lines_source(spark, cfg, (cfg.get(section) or {}).get("topic.input", ""), source)
    return recs.withColumnRenamed("value", "wire")


def build_aggregator(spark: SparkSession, cfg, source: DataFrame | None = None) -> DataFrame:
    """Internal records (router's aggregator branch) -> closed-window aggregate LP lines."""
    cfg = RU.load_config(cfg)
    ac = cfg.get("aggregation_config") or {}
    parsed = L.decode_internal(_internal(spark, cfg, "aggregation_config", source), "key", "wire", keep_bad=True)
    fields = L.good_rows(_filtered(parsed, cfg, "aggregator")).drop("error")
    window = f"{int(ac.get('window.s', 30))} seconds"
    agg = A.aggregate(fields, RU.agg_rules(cfg), window=window, watermark=A.GRACE)
    return agg.select("key", F.col("line").alias("value"))


def run_aggregator(spark: SparkSession, cfg, source: DataFrame | None = None, checkpoint: str | None = None, errors: str | None = None, write_topic=None):
    cfg = RU.load_config(cfg)
    bad = _bad(L.decode_internal(_internal(spark, cfg, "aggregation_config", source), "key", "wire", keep_bad=True), "wire")
    topic = (cfg.get("aggregation_config") or {}).get("topic.output")
    return _run_topic(spark, cfg, "aggregator", build_aggregator(spark, cfg, source), bad, topic, checkpoint, errors, write_topic)


# --------------------------------------------------------------------------- on/off detector
def build_detector(spark: SparkSession, cfg, source: DataFrame | None = None) -> DataFrame:
    cfg = RU.load_config(cfg)
    parsed = L.decode_internal(_internal(spark, cfg, "detector", source), "key", "wire", keep_bad=True)
    fields = L.good_rows(_filtered(parsed, cfg, "detector")).drop("error")
    refresh = (cfg.get("detector") or {}).get("refresh.period.s")
    out = detect_changes(fields, refresh_s=int(refresh) if refresh else None)
    return out.select("key", F.col("line").alias("value"), "kind")


def run_detector(spark: SparkSession, cfg, source: DataFrame | None = None, checkpoint: str | None = None, errors: str | None = None, write_topic=None):
    cfg = RU.load_config(cfg)
    bad = _bad(L.decode_internal(_internal(spark, cfg, "detector", source), "key", "wire", keep_bad=True), "wire")
    topic = (cfg.get("detector") or {}).get("topic.output")
    return _run_topic(spark, cfg, "detector", build_detector(spark, cfg, source), bad, topic, checkpoint, errors, write_topic)


# --------------------------------------------------------------------------- consumers
def _bytes_source(spark: SparkSession, cfg: dict, source: DataFrame | None) -> DataFrame:
    if source is not None:
        return source
    return S.read_bytes(spark, {k: v for k, v in (cfg.get(CONSUMER_SECTION) or {}).items() if k != APPLICATION_ID})


def run_udp_consumer(spark: SparkSession, cfg, source: DataFrame | None = None, sender_factory=None, checkpoint: str | None = None):
    """Topic -> datagrams, round robin over the configured ports, empty payloads skipped."""
    cfg = RU.load_config(cfg)
    sc = cfg.get(SENDER_SECTION) or {}
    df = _watched(EVT.drop_empty(_bytes_source(spark, cfg, source)), cfg, "udp-consumer")
    return W.write_udp(df, sc.get("hostname", "localhost"), str(sc.get("port", "8089")), sender_factory=sender_factory,
                       checkpoint=_checkpoint(spark, cfg, "udp-consumer", checkpoint), name=query_name(cfg, "udp-consumer"))


def _ledger(df: DataFrame, checkpoint: str) -> str | None:
    """Where deliveries are kept, for records that have a place in their source."""
    return f"{checkpoint}-sent" if W.has_order(df) else None


def build_webhook(spark: SparkSession, cfg, source: DataFrame | None = None) -> DataFrame:
    cfg = RU.load_config(cfg)
    df = _bytes_source(spark, cfg, source).withColumn("value", F.col("value").cast("string"))
    return NT.notification_text(df)


def run_webhook(spark: SparkSession, cfg, source: DataFrame | None = None, sender_factory=None, checkpoint: str | None = None, errors: str | None = None):
    cfg = RU.load_config(cfg)
    url = (cfg.get(WEBHOOK_SECTION) or {}).get("url", "")
    made = build_webhook(spark, cfg, source)
    ckpt = _checkpoint(spark, cfg, "webhook", checkpoint)
    _start_errors(_bad(made, "value"), cfg, ckpt, errors)
    out = _watched(made, cfg, "webhook", error=True).filter(F.col("error").isNull())
    return W.write_webhook(out, url, sender_factory=sender_factory, checkpoint=ckpt, name=query_name(cfg, "webhook"), ledger=_ledger(out, ckpt))


def build_email(spark: SparkSession, cfg, source: DataFrame | None = None) -> DataFrame:
    cfg = RU.load_config(cfg)
    df = _bytes_source(spark, cfg, source).withColumn("value", F.col("value").cast("string"))
    return NT.email_messages(df, each=False)


def run_email(spark: SparkSession, cfg, source: DataFrame | None = None, sender_factory=None, checkpoint: str | None = None, errors: str | None = None):
    cfg = RU.load_config(cfg)
    made = build_email(spark, cfg, source)
    ckpt = _checkpoint(spark, cfg, "email", checkpoint)
    _start_errors(_bad(made, "value"), cfg, ckpt, errors)
    return W.write_email(_watched(made, cfg, "email", error=True), cfg.get(EMAIL_SECTION) or {}, sender_factory=sender_factory, checkpoint=ckpt,
                         name=query_name(cfg, "email"), ledger=_ledger(made, ckpt))


# --------------------------------------------------------------------------- header-event apps
def _events_source(spark: SparkSession, cfg: dict, source: DataFrame | None) -> DataFrame:
    """Header events: the source given, else Kafka records with headers (``input``: topic and
    consumer settings)."""
    if source is not None:
        return source
    return S.read_events(spark, "kafka", S.kafka_options({k: v for k, v in (cfg.get("input") or {}).items() if k not in ("bindaddress", "port")}))


def run_header_aggregator(spark: SparkSession, cfg, source: DataFrame | None = None, sender_factory=None, checkpoint: str | None = None,
                          errors: str | None = None):
    """Header events -> per-batch aggregates -> JSON events -> datagrams (window = batch interval)."""
    cfg = RU.load_config(cfg)
    rules, default = RU.metric_rules(cfg)
    out = cfg.get("output") or {}
    interval = f"{RU.header_window_seconds(cfg)} seconds"
    events = _events_source(spark, cfg, source)
    ckpt = _checkpoint(spark, cfg, "header-aggregator", checkpoint)
    bad = EVT.event_points(events, rules, default)
    _start_errors(_bad(bad.withColumn("raw", F.to_json("headers")), "raw"), cfg, ckpt, errors)

    def write_batch(df: DataFrame, _batch_id: int) -> None:
        js = EVT.points_to_json(df).select(F.col("json").alias("value"))
        W.write_udp(js, out.get("hostname", "localhost"), str(out.get("port", "0")), sender_factory=sender_factory, suffix="\n")

    return J.start_event_aggregate_per_batch(_watched(events, cfg, "header-aggregator"), rules, default, interval, write_batch,
                                             name=query_name(cfg, "header-aggregator"), checkpoint=ckpt)


def run_pass_through(spark: SparkSession, cfg, source: DataFrame | None = None, sender_factory=None, checkpoint: str | None = None,
                     errors: str | None = None):
    """Header events -> body bytes as datagrams (empty bodies are errors, not sent)."""
    cfg = RU.load_config(cfg)
    out = cfg.get("output") or {}
    made = EVT.pass_body(_events_source(spark, cfg, source))
    ckpt = _checkpoint(spark, cfg, "pass-through", checkpoint)
    _start_errors(_bad(made.withColumn("raw", F.to_json("headers")), "raw"), cfg, ckpt, errors)
    body = _watched(made, cfg, "pass-through", error=True).filter(F.col("error").isNull()).select(F.col("payload").alias("value"))
    return W.write_udp(body, out.get("hostname", "localhost"), str(out.get("port", "0")), sender_factory=sender_factory, checkpoint=ckpt,
                       name=query_name(cfg, "pass-through"))


def run_http_sink(spark: SparkSession, url: str, batch_size: int, source: DataFrame, sender_factory=None, cfg: dict | None = None,
                  checkpoint: str | None = None):
    """LP records -> batched HTTP writes (only 200/204 commit)."""
    cfg = cfg or {}
    ckpt = _checkpoint(spark, cfg, "http-sink", checkpoint)
    rows = source.select("value", *[c for c in W.ORDER if W.has_order(source)])
    return W.write_http(_watched(rows, cfg, "http-sink"), url, batch_size, sender_factory=sender_factory, checkpoint=ckpt,
                        name=query_name(cfg, "http-sink"), ledger=_ledger(source, ckpt))


def run_http_sink_from_config(spark: SparkSession, cfg, source: DataFrame | None = None, sender_factory=None, checkpoint: str | None = None):
    """The HTTP sink from YAML: ``output`` has ``url`` and ``batchsize``, ``kafka_config`` the input."""
    cfg = RU.load_config(cfg)
    out = cfg.get("output") or {}
    lines = _lines_source(spark, cfg, str(out.get("topic.input", "")), source)
    return run_http_sink(spark, str(out.get("url", "")), int(out.get("batchsize", 500_000)), lines, sender_factory, cfg, checkpoint)


APPS = {
    "router": run_router,
    "aggregator": run_aggregator,
    "onoff": run_detector,
    "udp-consumer": run_udp_consumer,
    "webhook-consumer": run_webhook,
    "email-consumer": run_email,
    "header-aggregator": run_header_aggregator,
    "pass-through": run_pass_through,
    "http-sink": run_http_sink_from_config,
}


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="pulsegrid")
    p.add_argument("app", choices=sorted(APPS))
    p.add_argument("--config", required=True)
    a = p.parse_args(argv)
    from ..session import get_session

    spark = get_session()
    q = APPS[a.app](spark, a.config)
    if q is not None:
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
