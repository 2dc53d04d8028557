"""Shared column expressions and table access for the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

WS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder (``spark.checkpoint.dir``). Its
    shuffle files, which nothing reads afterwards, go with it and not when the driver
    happens to collect its garbage."""
    checkpoint_root(df.sparkSession)
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint()  # a query takes the setting when it is made
    finally:
        conf.set(CLEANUP, before)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row: a lambda variable is never
    inlined, while a projected column used once inside another lambda would be
    recomputed for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text, white space being space and U+0009 to U+000D (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WS, -1), lambda w: w != "")
