"""Self-monitoring (A7, T7): counters per micro-batch as LP lines.

Counters are Spark observations (``df.observe``), computed inside the query's
own tasks, and a ``StreamingQueryListener`` turns each progress report into one
LP line, at most once per period, handed to a sender (UDP by default).
"""

from __future__ import annotations

import socket
import time
from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def observe_counts(df: DataFrame, name: str, **counters: Column) -> DataFrame:
    """Attach named counters, e.g. ``observe_counts(df, 'router', sentRecords=F.count(F.lit(1)))``."""
    return df.observe(name, *[c.alias(k) for k, c in counters.items()])


def progress_line(progress, measurement: str = "kafka_streams", tags: dict | None = None, now_ms: int | None = None) -> str:
    """One LP line from a ``StreamingQueryProgress``: ``receivedRecords`` is the batch's
    input rows, every observed metric becomes an integer field."""
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    tag_txt = "".join(f",{k}={v}" for k, v in sorted((tags or {}).items()))
    fields = {"receivedRecords": int(progress.numInputRows)}
    for _, row in sorted((progress.observedMetrics or {}).items()):
        for k, v in row.asDict().items():
            if v is not None:
                fields[k] = int(v)
    field_txt = ",".join(f"{k}={v}i" for k, v in fields.items())
    return f"{measurement}{tag_txt} {field_txt} {now_ms}000000"


class ProgressReporter(StreamingQueryListener):
    """Sends a progress line for the named query at most once per ``period_ms``."""

    def __init__(self, query_name: str, period_ms: int = 10_000, host: str = "localhost", port: int = 8090,
                 measurement: str = "kafka_streams", tags: dict | None = None, sender=None):
        self.query_name = query_name
        self.period_ms = period_ms
        self.addr = (host, int(port))
        self.measurement = measurement
        self.tags = dict(tags or {})
        self.tags.setdefault("hostname", socket.gethostname())
        self.sender = sender
        self.last_ms = 0
        self.lines: deque[str] = deque(maxlen=100)  # the latest, for a look from outside

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.query_name:
            return
        now = int(time.time() * 1000)
        if now - self.last_ms < self.period_ms:
            return
        self.last_ms = now
        line = progress_line(p, self.measurement, self.tags, now)
        self.lines.append(line)
        if self.sender is not None:
            self.sender(line)
        else:
            with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as s:
                s.sendto(line.encode("utf-8"), self.addr)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class Totals:
    """Counters since the start, sent as an LP line at most once per ``period_ms``."""

    def __init__(self, measurement: str = "kafka_streams", tags: dict | None = None, period_ms: int = 10_000, host: str = "localhost", port: int = 8090, sender=None):
        self.measurement, self.tags, self.period_ms, self.addr, self.sender = measurement, dict(tags or {}), period_ms, (host, int(port)), sender
        self.tags.setdefault("hostname", socket.gethostname())
        self.values: dict[str, int] = {}
        self.last_ms, self.last_batch = 0, -1

    def line(self, now_ms: int) -> str:
        tags = "".join(f",{k}={v}" for k, v in sorted(self.tags.items()))
        return f"{self.measurement}{tags} " + ",".join(f"{k}={v}i" for k, v in self.values.items()) + f" {now_ms}000000"

    def add(self, batch_id: int, counts: dict) -> None:
        """Add a batch's counts; a batch that is replayed in the same run counts once."""
        if batch_id <= self.last_batch:
            return
        self.last_batch = batch_id
        for k, v in counts.items():
            self.values[k] = self.values.get(k, 0) + int(v or 0)
        now = int(time.time() * 1000)
        if now - self.last_ms < self.period_ms:
            return
        self.last_ms = now
        if self.sender is not None:
            self.sender(self.line(now))
        else:
            with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as s:
                s.sendto(self.line(now).encode("utf-8"), self.addr)
