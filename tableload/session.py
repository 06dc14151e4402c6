"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "tableload", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the package relies on (UTC, AQE, no web page)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is made only where the setting is missing and Spark runs in local mode.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="tableload-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path below the scratch root; nothing is created yet."""
    return os.path.join(
        scratch_root(spark), "tableload", spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex[:12]}"
    )


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate rows from the shared storage it lies in."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _located(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    system, folder = _located(spark, path)
    return system.exists(folder)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    system, folder = _located(spark, path)
    return [found.getPath().getName() for found in system.listStatus(folder)] if system.exists(folder) else []


def modified_at(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 at which a file was last written."""
    system, folder = _located(spark, path)
    return system.getFileStatus(folder).getModificationTime() / 1000


def take_name(spark: SparkSession, path: str) -> bool:
    """Make an empty file unless it is there; of several writers one succeeds. True if this one did."""
    system, name = _located(spark, path)
    system.mkdirs(name.getParent())
    if system.getScheme() == "file":  # Hadoop's local file system looks first and creates then
        return spark._jvm.java.io.File(name.toUri().getPath()).createNewFile()
    try:
        system.create(name, False).close()
    except Py4JJavaError:
        if not system.exists(name):
            raise
        return False
    return True


def is_utc(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00")
