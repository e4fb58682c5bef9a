"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Diff and page text packs well: small partitions on disk are large once unpacked.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.ui.enabled": "false",
}

_own_folders: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(cores: str = "*", shuffle_partitions: int = 8, name: str = "patchloom") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as named by ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder of its own;
    on a cluster the setting is required, since a machine-local folder is lost
    with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.TemporaryDirectory(prefix="patchloom-", ignore_cleanup_errors=True)
    return _own_folders[app].name


#: Paths handed out inside each open scope, the innermost last.
_scopes: list[list[str]] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses; inside a ``run_scope`` it goes when the scope ends."""
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def run_scope(spark: SparkSession) -> Iterator[None]:
    """A run whose stored tables are of no use after it: whatever the library put into the shared folder inside is removed at the end,
    also after a failure. Results that are still lazy read these tables, so they belong written elsewhere, or collected, before the scope ends.
    """
    _scopes.append([])
    try:
        yield
    finally:
        files = spark._jvm.org.apache.hadoop.fs
        for path in _scopes.pop():
            place = files.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialised(df, name: str):
    """Write a table to the shared folder and read it back: lineage ends there and
    a lost executor costs only the read."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
