"""Sinks (K1-K8).

Topic sinks are Spark's Kafka writer. Datagram, HTTP, webhook and mail sinks
run per partition inside ``foreachBatch`` (streaming) or directly on a batch
DataFrame: one connection per partition, records streamed from the partition
iterator (never collected). The network call is a ``sender`` object, so tests
inject a recorder and open no port.

Delivery: the HTTP sink raises on any status other than 200/204 or on I/O
error, which fails the task; Spark retries it and, in streaming, replays the
micro-batch from the checkpoint (at-least-once), like the reference's rollback.
"""

from __future__ import annotations

import logging
import socket
import urllib.error
import urllib.request

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workers import ship_by_value
from . import delivery as D

ship_by_value(__name__)

log = logging.getLogger("pulsegrid.sinks")

HTTP_OK = (200, 204)


# --------------------------------------------------------------------------- senders
class UdpSender:
    """One datagram socket per partition."""

    def __init__(self):
        self.sock = socket.socket(socket.AF_INET, socket.SOCK_DGRAM)

    def send(self, payload: bytes, host: str, port: int) -> None:
        self.sock.sendto(payload, (host, port))

    def close(self) -> None:
        self.sock.close()


class HttpSender:
    def post(self, url: str, body: bytes, content_type: str = "text/plain") -> int:
        req = urllib.request.Request(url, data=body, method="POST", headers={"Content-Type": content_type})
        try:
            with urllib.request.urlopen(req, timeout=30) as resp:  # noqa: S310 - configured endpoint
                return resp.status
        except urllib.error.HTTPError as e:  # an answer, not a failure of the connection
            return e.code

    def close(self) -> None:
        pass


class SmtpSender:
    """One connection per partition; ``tls: true`` in the configuration asks for STARTTLS."""

    def __init__(self, cfg: dict):
        import smtplib

        self.smtp = smtplib.SMTP(cfg["hostname"], int(cfg.get("port", 25)))
        if str(cfg.get("tls", "false")).lower() == "true":
            self.smtp.starttls()
        if cfg.get("username"):
            self.smtp.login(cfg["username"], cfg.get("password", ""))

    def send(self, sender: str, to: list[str], subject: str, body: str) -> None:
        from email.message import EmailMessage

        m = EmailMessage()
        m["From"], m["To"], m["Subject"] = sender, ", ".join(to), subject
        m.set_content(body)
        self.smtp.send_message(m, to_addrs=list(to))

    def close(self) -> None:
        self.smtp.quit()


# --------------------------------------------------------------------------- helpers
def _for_each(df: DataFrame, fn, checkpoint: str | None = None, trigger: dict | None = None, name: str | None = None, plan=lambda b: b):
    """Run ``fn(partition_rows)`` on every partition of a batch DataFrame, or of
    every micro-batch of a streaming one (returns the started query), as ``plan`` arranges it."""
    return for_batches(df, lambda b, _id: plan(b).foreachPartition(fn), checkpoint, trigger, name)


def for_batches(df: DataFrame, each, checkpoint: str | None = None, trigger: dict | None = None, name: str | None = None):
    """``each(batch, batch_id)`` on a batch DataFrame (as batch 0) or on every micro-batch."""
    if not df.isStreaming:
        each(df, 0)
        return None
    w = df.writeStream.foreachBatch(each)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return w.trigger(**(trigger or {"processingTime": "1 second"})).start()


ORDER = ("src_partition", "src_offset")
#: Offsets of a source partition that are numbered in one task.
CHUNK_OFFSETS = 1 << 20


def _ports(ports) -> list[int]:
    return [int(p) for p in (ports if isinstance(ports, (list, tuple)) else str(ports).split(","))]


def numbered(df: DataFrame, name: str, order=ORDER, chunk: int = CHUNK_OFFSETS) -> DataFrame:
    """``df`` with the place of each row in its source partition, from 0, in arrival order.

    Rows are numbered within chunks of offsets; what a partition's earlier chunks hold is added
    from a table of one row a chunk. So one task has at most a chunk, however large a partition is.
    """
    part, offset = order
    x = df.withColumn("_chunk", F.expr(f"{offset} div {int(chunk)}"))
    chunks = x.groupBy(part, "_chunk").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(F.col(part).alias("_part"), F.col("_chunk").alias("_of"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    x = x.withColumn("_in", F.row_number().over(Window.partitionBy(part, "_chunk").orderBy(offset)) - 1)
    x = x.join(chunks, F.col(part).eqNullSafe(F.col("_part")) & F.col("_chunk").eqNullSafe(F.col("_of")))
    return x.withColumn(name, F.col("_before") + F.col("_in")).drop("_chunk", "_in", "_part", "_of", "_before")


def delivery_plan(df: DataFrame, ports, batch_size: int, order=ORDER, chunk: int = CHUNK_OFFSETS) -> DataFrame:
    """K4/L1 as columns: the port and the batch that each record of a partition gets in
    arrival order (ports in turn, ``batch_size`` records a batch; empty payloads get none).
    The datagram and HTTP sinks deliver by it."""
    ports = _ports(ports)
    kept = numbered(df.filter(F.col("value").isNotNull() & (F.octet_length("value") > 0)), "_i", order, chunk)
    port = F.element_at(F.array(*[F.lit(p) for p in ports]), (F.col("_i") % len(ports) + 1).cast("int"))
    return kept.withColumns({"port": port, "batch": F.floor(F.col("_i") / batch_size).cast("bigint")}).drop("_i")


def has_order(df: DataFrame) -> bool:
    return all(c in df.columns for c in ORDER)


# --------------------------------------------------------------------------- K1 K2
def write_topic(df: DataFrame, bootstrap: str, topic: str | None = None, checkpoint: str | None = None,
                options: dict | None = None, name: str | None = None):
    """K1/K2: ``key``/``value`` (and per-row ``topic`` when ``topic`` is None) to Kafka."""
    cols = [F.col("key").cast("string"), F.col("value").cast("string")]
    if topic is None:
        cols.append(F.col("topic"))
    out = df.select(*cols)
    if df.isStreaming:
        w = out.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
        if topic:
            w = w.option("topic", topic)
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        if name:
            w = w.queryName(name)
        for k, v in (options or {}).items():
            w = w.option(k, v)
        return w.start()
    w = out.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
    if topic:
        w = w.option("topic", topic)
    return w.save()


# --------------------------------------------------------------------------- K3 K4
def udp_partition_writer(host: str, ports, value_col: str = "value", sender_factory=None, suffix: str = ""):
    """Sends each row to its own ``port``, or without that column to the ports in turn."""
    ports = _ports(ports)

    def write(rows) -> None:
        sender = sender_factory() if sender_factory else UdpSender()
        i = -1
        try:
            for r in rows:
                v = r[value_col]
                if v is None:
                    continue
                payload = (v if isinstance(v, (bytes, bytearray)) else (v + suffix).encode("utf-8"))
                if len(payload) == 0:
                    continue  # zero-length payloads are skipped
                i = (i + 1) % len(ports)  # round robin over the ports
                sender.send(bytes(payload), host, r["port"] if "port" in r else ports[i])
        finally:
            sender.close()

    return write


def write_udp(df: DataFrame, host: str, ports, value_col: str = "value", sender_factory=None, suffix: str = "",
              checkpoint: str | None = None, trigger: dict | None = None, name: str | None = None):
    """K3/K4: one datagram per record (UTF-8 bytes, D17). Records with ``src_partition`` and
    ``src_offset`` get the ports of ``delivery_plan``, others the ports in turn within a task."""
    ports = _ports(ports)
    if len(ports) > 1 and has_order(df):
        plan = lambda b: delivery_plan(b.select(F.col(value_col).alias("value"), *ORDER), ports, 1).select("value", "port")
        return _for_each(df, udp_partition_writer(host, ports, "value", sender_factory, suffix), checkpoint, trigger, name, plan)
    return _for_each(df.select(value_col), udp_partition_writer(host, ports, value_col, sender_factory, suffix), checkpoint, trigger, name)


# --------------------------------------------------------------------------- K5
def http_partition_writer(url: str, batch_size: int = 500_000, value_col: str = "value", sender_factory=None):
    def flush(sender, batch) -> None:
        if not batch:
            return
        body = "\n".join(batch).encode("utf-8")
        try:
            status = sender.post(url, body)
        except OSError as e:
            raise RuntimeError(f"HTTP write failed: {e}") from e
        if status not in HTTP_OK:
            raise RuntimeError(f"HTTP write rejected with status {status}")

    def write(rows) -> None:
        sender = sender_factory() if sender_factory else HttpSender()
        batch: list[str] = []
        try:
            for r in rows:
                v = r[value_col]
                if v is None:
                    continue
                if isinstance(v, (bytes, bytearray)):
                    v = bytes(v).decode("utf-8")
                if len(v) == 0:
                    continue
                batch.append(v)
                if len(batch) >= batch_size:
                    flush(sender, batch)
                    batch = []
            flush(sender, batch)
        finally:
            sender.close()

    return write


def write_http(df: DataFrame, url: str, batch_size: int = 500_000, value_col: str = "value", sender_factory=None,
               checkpoint: str | None = None, trigger: dict | None = None, name: str | None = None, ledger: str | None = None):
    """K5: up to ``batch_size`` bodies joined by newlines per POST; any status other than
    200/204 or an I/O error fails the micro-batch (retry / replay). With a ``ledger`` folder
    (records need ``src_partition`` and ``src_offset``) the answer to each record is kept there,
    POSTs are those of ``delivery_plan``, and a replay sends only what was not accepted."""
    if ledger:
        rows = df.select(F.col(value_col).alias("value"), *ORDER)
        return for_batches(rows, lambda b, i: D.deliver(b, i, ledger, D.http(url, batch_size, sender_factory), lambda r: D.in_batches(r, batch_size)), checkpoint, trigger, name)
    return _for_each(df.select(value_col), http_partition_writer(url, batch_size, value_col, sender_factory), checkpoint, trigger, name)


# --------------------------------------------------------------------------- K6
def webhook_partition_writer(url: str, text_col: str = "text", sender_factory=None):
    def write(rows) -> None:
        sender = sender_factory() if sender_factory else HttpSender()
        try:
            for r in rows:
                t = r[text_col]
                if t is None:
                    continue
                status = sender.post(url, t.encode("utf-8"), "application/json")
                if status != 200:
                    log.error("webhook response code %s", status)
        finally:
            sender.close()

    return write


def write_webhook(df: DataFrame, url: str, text_col: str = "text", sender_factory=None,
                  checkpoint: str | None = None, trigger: dict | None = None, name: str | None = None, ledger: str | None = None):
    """K6: POST each ``{"text": ...}`` JSON (P25 output); a non-200 answer is logged. With a
    ``ledger`` folder no record is posted again by a replay."""
    if ledger:
        return for_batches(df.select(F.col(text_col).alias("text"), *ORDER), lambda b, i: D.deliver(b, i, ledger, D.webhook(url, sender_factory)), checkpoint, trigger, name)
    return _for_each(df.select(text_col), webhook_partition_writer(url, text_col, sender_factory), checkpoint, trigger, name)


# --------------------------------------------------------------------------- K7
def email_partition_writer(smtp_cfg: dict, sender_factory=None):
    def write(rows) -> None:
        sender = None
        try:
            for r in rows:
                to = [a for a in (r["addresses"] or []) if a]
                if not to:
                    continue
                try:
                    if sender is None:
                        sender = sender_factory() if sender_factory else SmtpSender(smtp_cfg)
                    sender.send(smtp_cfg.get("from", ""), to, r["subject"], r["body"])
                except Exception as e:  # noqa: BLE001 - a mail that fails is logged, the others go on
                    log.error("mail to %s failed: %s", ", ".join(to), e)
        finally:
            if sender is not None:
                sender.close()

    return write


def write_email(df: DataFrame, smtp_cfg: dict, sender_factory=None, checkpoint: str | None = None, trigger: dict | None = None, name: str | None = None,
                ledger: str | None = None):
    """K7: one message per row to all its ``addresses`` (an array, or one ``address``). With a
    ``ledger`` folder no mail is sent again by a replay."""
    rows = df.filter(F.col("error").isNull()) if "error" in df.columns else df
    to = F.col("addresses") if "addresses" in df.columns else F.array("address")
    if ledger:
        rows = rows.select("subject", "body", to.alias("addresses"), *ORDER)
        return for_batches(rows, lambda b, i: D.deliver(b, i, ledger, D.email(smtp_cfg, sender_factory)), checkpoint, trigger, name)
    return _for_each(rows.select("subject", "body", to.alias("addresses")), email_partition_writer(smtp_cfg, sender_factory), checkpoint, trigger, name)


# --------------------------------------------------------------------------- K8
def write_console(df: DataFrame, value_col: str | None = None, checkpoint: str | None = None, trigger: dict | None = None):
    """K8: print every row on the driver, one partition in hand at a time: ``value_col``, or
    the whole row."""
    def show(batch: DataFrame, _id: int = 0) -> None:
        for r in batch.toLocalIterator():
            print(r[value_col] if value_col else ", ".join(f"{k}={v}" for k, v in r.asDict().items()), flush=True)

    if not df.isStreaming:
        return show(df)
    w = df.writeStream.foreachBatch(show)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "1 second"})).start()
