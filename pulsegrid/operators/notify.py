"""Notifications (P24-P26): JSON text in, webhook text / e-mail rows out.

All three are narrow projections over a JSON column (``from_json``), so they
run map-side, batch or streaming, before the webhook / mail sinks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lines import java_split

# Keys of the two notification formats.
DESCRIPTION, CLIENT_URL, DETAILS = "description", "client_url", "details"
EMAIL_KEYS = ("subject", "body", "to_addresses")


def valid_notification(df: DataFrame, value_col: str = "value") -> DataFrame:
    """``valid`` = the text is a JSON object carrying ``description``."""
    m = F.from_json(F.col(value_col), "MAP<STRING,STRING>")
    return df.withColumn("valid", F.coalesce(F.map_contains_key(m, DESCRIPTION), F.lit(False)))


def notification_text(df: DataFrame, value_col: str = "value") -> DataFrame:
    """P25: ``{"text": description[\\nclient_url][\\ndetails]}`` for valid notifications,
    an ``error`` otherwise."""
    s = F.from_json(
        F.col(value_col), f"{DESCRIPTION} STRING, {CLIENT_URL} STRING, {DETAILS} STRING"
    )
    m = F.from_json(F.col(value_col), "MAP<STRING,STRING>")
    ok = F.coalesce(F.map_contains_key(m, DESCRIPTION), F.lit(False))
    msg = F.concat_ws("\n", s[DESCRIPTION], s[CLIENT_URL], s[DETAILS])
    return df.withColumns(
        {
            "text": F.when(ok, F.to_json(F.struct(msg.alias("text")))),
            "error": F.when(~ok, F.lit("not a JSON object with description")),
        }
    )


def email_messages(df: DataFrame, value_col: str = "value", each: bool = True) -> DataFrame:
    """One row per recipient (or, without ``each``, per message with an array ``addresses``) ``(subject, body, address)``; a missing key is an error row."""
    s = F.from_json(F.col(value_col), ", ".join(f"{k} STRING" for k in EMAIL_KEYS))
    m = F.from_json(F.col(value_col), "MAP<STRING,STRING>")
    missing = ~F.coalesce(
        F.map_contains_key(m, "subject") & F.map_contains_key(m, "body") & F.map_contains_key(m, "to_addresses"),
        F.lit(False),
    )
    d = df.withColumns(
        {
            "subject": s["subject"],
            "body": s["body"],
            "error": F.when(missing, F.lit("mail lacks a required key")),
        }
    )
    addrs = F.when(F.col("error").isNull(), java_split(s["to_addresses"], ","))
    if not each:
        return d.withColumn("addresses", addrs)
    return d.select(*d.columns, F.explode_outer(addrs).alias("address"))
