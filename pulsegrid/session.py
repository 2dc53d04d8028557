"""Session helpers: sensible defaults for local runs, and the shared scratch root."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
#: Counting the state's rows costs a look-up for every row that is put or removed.
COUNT_ROWS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


def get_session(master: str | None = None, partitions: int | None = None, app: str = "pulsegrid",
                checkpoint_dir: str | None = None) -> SparkSession:
    """Build (or reuse) a session. What spark-submit or the caller's configuration sets is
    left alone: without ``master`` the master, all sizes and ``spark.checkpoint.dir`` come
    from there. Only a local ``master`` (tests, bench) gets a partition count, a driver
    heap and a checkpoint folder here."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master).config("spark.ui.enabled", "false")
    if master and master.startswith("local"):
        b = b.config("spark.sql.shuffle.partitions", str(partitions or 8))
        # local mode runs everything in the driver JVM; Spark's 1 GB default heap
        # turns a long session into a GC-bound one
        b = b.config("spark.driver.memory", os.environ.get("PULSEGRID_DRIVER_MEMORY", "16g"))
        if not is_cluster(master):
            b = b.config("spark.checkpoint.dir", checkpoint_dir or tempfile.mkdtemp(prefix="pulsegrid-ckpt-"))
    elif partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    if checkpoint_dir:
        b = b.config("spark.checkpoint.dir", checkpoint_dir)
    spark = b.getOrCreate()
    given = spark.sparkContext.getConf()
    for k, v in {"spark.sql.session.timeZone": "UTC", PROVIDER: ROCKSDB_PROVIDER, CHANGELOG: "true"}.items():
        if not given.contains(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_cluster(master: str) -> bool:
    """Whether executors are other processes, which don't see the driver's own folders."""
    return not master.startswith("local") or master.startswith("local-cluster")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (read from the
    session). Only when nothing is configured (a local run) do we pick a folder."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        cur = sc._jsc.sc().getCheckpointDir()
        if cur.isDefined():
            root = cur.get()
    if not root:
        if is_cluster(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="pulsegrid-ckpt-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root for one run of one job."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def app_checkpoint(spark: SparkSession, app_id: str, job: str) -> str:
    """The checkpoint of one job of an application, the same at every start: a restarted
    application goes on from its offsets and state."""
    safe = re.sub(r"[^A-Za-z0-9_.-]", "_", app_id) or "app"
    return f"{checkpoint_root(spark).rstrip('/')}/{safe}/{job}"


def use_rocksdb(spark: SparkSession) -> None:
    """Stateful operators in this package expect the RocksDB state store (spills, changelog)."""
    if spark.conf.get(PROVIDER, "") != ROCKSDB_PROVIDER:
        spark.conf.set(PROVIDER, ROCKSDB_PROVIDER)
    if spark.conf.get(CHANGELOG, "false") != "true":
        spark.conf.set(CHANGELOG, "true")
    if spark.conf.get(COUNT_ROWS, "true") != "false":
        spark.conf.set(COUNT_ROWS, "false")
