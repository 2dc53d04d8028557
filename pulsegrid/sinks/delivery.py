"""Deliveries with a ledger (K5-K7): what was accepted is not sent again.

A micro-batch is sent by a job whose output is the ledger: one row a record with the answer
it got. Spark runs the job once for a batch; where records were refused, the batch fails after
their answers are written, and its replay sends only the records that no attempt got accepted.
A batch that was sent whole but not committed (a crash in between) sends nothing the second
time. Records are known by ``(src_partition, src_offset)``. What stays at-least-once is a task
that is lost between a delivery and the end of its job.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..streaming.ledger import Ledger
from ..workers import ship_by_value

ship_by_value(__name__)

log = logging.getLogger("pulsegrid.sinks")
KEYS = ("src_partition", "src_offset")
ANSWERS = "src_partition INT, src_offset BIGINT, status INT, accepted BOOLEAN"
#: Batches whose ledgers are kept behind the one at work.
KEEP = 8
HTTP_OK = (200, 204)

#: Sends the records of a task and yields the answer to each.
Send = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


class Refused(RuntimeError):
    """Records of a micro-batch were not accepted: it is to be replayed."""


def deliver(batch: DataFrame, batch_id: int, root: str, send: Send, arrange: Callable[[DataFrame], DataFrame] = lambda r: r) -> int:
    """Send the records of a batch that no earlier attempt got accepted; their number. Raises
    ``Refused`` if any was refused, after the answers are kept."""
    spark = batch.sparkSession
    tries = Ledger(spark, f"{root.rstrip('/')}/{int(batch_id)}")
    ids = tries.ids()
    rest = batch.withColumns({"src_partition": F.col("src_partition").cast("int"), "src_offset": F.col("src_offset").cast("bigint")})
    if ids:
        rest = rest.join(tries.read(ANSWERS).filter("accepted").select(*KEYS), list(KEYS), "left_anti")
    attempt = ids[-1] + 1 if ids else 0
    tries.write(arrange(rest).mapInPandas(send, ANSWERS), attempt)
    n, bad = tries.read(ANSWERS, [attempt]).agg(F.count("*"), F.count_if(~F.col("accepted"))).first()
    if bad:
        raise Refused(f"{bad} of {n} records of batch {batch_id} were refused")
    Ledger(spark, f"{root.rstrip('/')}/{int(batch_id) - KEEP}").drop_before(1 << 62)
    return n


def accepted(spark, root: str, batch_id: int) -> DataFrame:
    """The records of a batch that were accepted."""
    return Ledger(spark, f"{root.rstrip('/')}/{int(batch_id)}").read(ANSWERS).filter("accepted")


def answers(rows: pd.DataFrame, status: list[int], ok: list[bool]) -> pd.DataFrame:
    return pd.DataFrame({"src_partition": rows["src_partition"].to_numpy(), "src_offset": rows["src_offset"].to_numpy(), "status": status, "accepted": ok})


def in_batches(rows: DataFrame, batch_size: int) -> DataFrame:
    """Records together by the batch that ``delivery_plan`` gives them, in arrival order."""
    from .writers import delivery_plan

    plan = delivery_plan(rows, [0], batch_size).drop("port")
    return plan.repartition("src_partition", "batch").sortWithinPartitions("src_partition", "batch", "src_offset")


def http(url: str, batch_size: int, sender_factory=None) -> Send:
    """One POST a batch: its records are accepted with 200 or 204, else refused."""
    def post(sender, rows: pd.DataFrame) -> pd.DataFrame:
        texts = [bytes(v).decode("utf-8") if isinstance(v, (bytes, bytearray)) else v for v in rows["value"]]
        try:
            status = sender.post(url, "\n".join(texts).encode("utf-8"))
        except OSError as e:
            log.error("HTTP write failed: %s", e)
            status = 0
        return answers(rows, [status] * len(rows), [status in HTTP_OK] * len(rows))

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from .writers import HttpSender

        sender = sender_factory() if sender_factory else HttpSender()
        held = None  # the batch under way, of batch_size records at most
        try:
            for frame in frames:
                for _, rows in frame.groupby(["src_partition", "batch"], sort=False, dropna=False):
                    key = (rows["src_partition"].iloc[0], rows["batch"].iloc[0])
                    if held is not None and held[0] == key:
                        held = (key, pd.concat([held[1], rows], ignore_index=True))
                        continue
                    if held is not None:
                        yield post(sender, held[1])
                    held = (key, rows)
            if held is not None:
                yield post(sender, held[1])
        finally:
            sender.close()

    return send


def webhook(url: str, sender_factory=None) -> Send:
    """One POST a record; any answer is final, one that is not 200 is logged."""
    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from .writers import HttpSender

        sender = sender_factory() if sender_factory else HttpSender()
        try:
            for frame in frames:
                rows = frame[frame["text"].notna()]
                status = [sender.post(url, t.encode("utf-8"), "application/json") for t in rows["text"]]
                for s in status:
                    if s != 200:
                        log.error("webhook response code %s", s)
                yield answers(rows, status, [True] * len(rows))
        finally:
            sender.close()

    return send


def email(smtp_cfg: dict, sender_factory=None) -> Send:
    """One mail a record; one that fails is logged and final, the others go on."""
    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from .writers import SmtpSender

        sender = None
        try:
            for frame in frames:
                status = []
                for to, subject, body in zip(frame["addresses"], frame["subject"], frame["body"]):
                    to = [a for a in (to if to is not None else []) if a]
                    try:
                        if to:
                            sender = sender or (sender_factory() if sender_factory else SmtpSender(smtp_cfg))
                            sender.send(smtp_cfg.get("from", ""), to, subject, body)
                        status.append(1 if to else 0)
                    except Exception as e:  # noqa: BLE001 - as without a ledger
                        log.error("mail to %s failed: %s", ", ".join(to), e)
                        status.append(-1)
                yield answers(frame, status, [True] * len(frame))
        finally:
            if sender is not None:
                sender.close()

    return send
