"""Session set-up and the shared scratch location.

Months are UTC months, so every entry point pins the session time zone to
UTC. Scratch output (streaming checkpoints, restated tables) goes under the
cluster's ``spark.checkpoint.dir``; a local folder is created only in a local
session that has none configured (tests, single-machine runs).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def ensure_utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "ledgerline",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the models rely on.

    ``shuffle_partitions`` should be sized to the shuffle volume on a cluster
    (roughly total shuffle bytes / 200 MB); AQE then coalesces small
    partitions and splits skewed join partitions at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return ensure_utc(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    Only a session whose executors are on this machine may go without one: a
    local folder is then made. On a cluster each executor would write to its own
    disk and results would be incomplete, so that is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named folder under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run in here drop their shuffle files when they end: for jobs whose results are tables in the shared folder."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _place(spark: SparkSession, path: str):
    """A path and the file system it is in, whatever that is."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder; nothing happens if it does not exist."""
    place, files = _place(spark, path)
    files.delete(place, True)
