"""Session defaults and the shared scratch location.

Scratch data (staged upserts, NDJSON round trips, stream checkpoints) lives
under the folder the cluster names in ``spark.checkpoint.dir``. Where that setting
is absent a local folder serves a local master (tests, laptops); on a cluster
it is an error, since executors would each write to their own disk.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library relies on.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "histmart",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Pin the runtime SQL settings on an existing session (driver-made sessions)."""
    for k, v in SESSION_DEFAULTS.items():
        if k.startswith("spark.ui."):
            continue
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; a local one only for a local master without the setting."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="histmart-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def is_local(master: str) -> bool:
    """True where driver and executors are one process (``local``, ``local[n]``; not ``local-cluster``)."""
    return master == "local" or master.startswith("local[")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/histmart/{name}-{uuid.uuid4().hex}"
