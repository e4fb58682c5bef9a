"""Repository files at a commit."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_tree(files: DataFrame, root: str) -> int:
    """Export files (repo, commit_sha, path, content) as a tree ``root/<org>/<repo>/<commit>/<path>``; gives their number.

    ``root`` is a folder that all executors see under the same name. A file is written under another name and then named, so a task that
    is done again, or twice at once, leaves whole files. Rows with a null in any column give no file; a path that leads out of its commit is an error.
    """
    top = re.sub(r"^file:(//)?", "", root)
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", top):
        raise ValueError("a tree is written to a folder that is mounted everywhere")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for repo, commit, path, content in zip(*(column.to_pylist() for column in batch.columns)):
                folder = os.path.join(top, repo, commit)
                target = os.path.normpath(os.path.join(folder, path))
                if not target.startswith(os.path.normpath(folder) + os.sep):
                    raise ValueError(f"not below its commit: {path}")
                os.makedirs(os.path.dirname(target), exist_ok=True)
                part = f"{target}.{uuid.uuid4().hex}"
                with open(part, "wb") as out:
                    out.write(content.encode("utf-8"))
                os.replace(part, target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    rows = files.select("repo", "commit_sha", "path", "content").dropna()
    return rows.mapInArrow(write, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _mounted(spark: SparkSession, root: str) -> str | None:
    """The folder ``root`` names in the local file system of every machine; null for a place in another store. A root that is not there is an error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.getUri().getScheme() != "file" or not store.exists(place):
        return None  # Spark's reader tells what is wrong
    return place.toUri().getPath().rstrip("/") + "/"


def _hidden(name: str) -> bool:
    """Names that file scans pass over."""
    return name.startswith(".") or name.endswith("._COPYING_") or (
        name.startswith("_") and "=" not in name and not name.startswith(("_metadata", "_common_metadata")))


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + (len(row[-1]) if isinstance(row[-1], bytes) else 0)
        if size > _BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


_BATCH_BYTES = 4 << 20
_LISTED, _READ = "path string, size bigint", "path string, content binary"


def _listed(spark: SparkSession, top: str, commits: list[str] | None) -> DataFrame:
    """Path below ``top`` and size of every file, listed in tasks: level by level down to the commits, then each commit by one task."""
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)

    def inside(folder: str, deep: bool) -> Iterator[tuple[str, int | None]]:
        waiting = [folder]
        while waiting:
            at = waiting.pop()
            try:
                entries = os.scandir(top + at)
            except (FileNotFoundError, NotADirectoryError):
                continue
            with entries:
                for entry in entries:
                    if _hidden(entry.name):
                        continue
                    path = f"{at}/{entry.name}" if at else entry.name
                    if not entry.is_dir():
                        yield path, entry.stat().st_size
                    elif deep:
                        waiting.append(path)
                    else:
                        yield path, None

    def listing(deep: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = (found for batch in batches for path, size in zip(*(c.to_pylist() for c in batch.columns))
                    for found in ([(path, size)] if size is not None else inside(path, deep)))
            return _batches(rows, ["path", "size"], [pa.string(), pa.int64()])

        return run

    found = spark.createDataFrame([(c, None) for c in (commits if commits is not None else [""])], _LISTED)
    for _ in range(3 if commits is None else 0):
        found = found.mapInArrow(listing(False), _LISTED).repartition(tasks, "path")
    return found.repartition(tasks, "path").mapInArrow(listing(True), _LISTED).filter("size > 0")


def _contents(files: DataFrame, top: str) -> DataFrame:
    """Path and bytes of listed files, read in tasks over which they are spread anew."""
    tasks = max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), files.sparkSession.sparkContext.defaultParallelism)

    def read(path: str) -> bytes:
        with open(top + path, "rb") as f:
            return f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((path, read(path)) for batch in batches for path in batch.column(0).to_pylist())
        return _batches(rows, ["path", "content"], [pa.string(), pa.binary()])

    return files.select("path").repartition(tasks, "path").mapInArrow(run, _READ)


def repo_files_scan(spark: SparkSession, root: str, commits: list[tuple[str, str]] | None = None) -> DataFrame:
    """Rows (repo, commit_sha, path, content) of an exported tree ``root/<org>/<repo>/<commit>/<path>``.

    A mounted tree is listed and read in tasks, so no list of its files stands on the driver. Given ``commits`` (repo, commit), only their folders are listed and read; of a long list of commits in a table, join the landed
    files instead. Commits that are not there give no row.

    Each file is one whole text; one that is not UTF-8 has null content, and is
    passed over by whoever needs its text. File scans leave out files of no
    bytes, so these give no row. A landed table of the same columns serves as
    well, and keeps them. Files that lie less deep are listed by
    ``misplaced_files``; what the folders are called does not matter.
    """
    wanted = None if commits is None else [f"{repo}/{commit}" for repo, commit in dict.fromkeys(commits)]
    if wanted is not None and not wanted:
        return spark.createDataFrame([], "repo string, commit_sha string, path string, content string")
    top = _mounted(spark, root)
    if top is None:
        found = _below(spark, root, wanted).filter(F.size("p") == 4)
    else:
        parts = F.split("path", "/", 4)
        found = _contents(_listed(spark, top, wanted).filter(F.size(parts) == 4), top).select(parts.alias("p"), "content")
    return found.select(
        F.concat_ws("/", F.get("p", 0), F.get("p", 1)).alias("repo"), F.get("p", 2).alias("commit_sha"),
        F.get("p", 3).alias("path"), F.try_validate_utf8(F.col("content").cast("string")).alias("content"),
    )


def misplaced_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths of files under ``root`` that belong to no commit folder."""
    top = _mounted(spark, root)
    parts = _below(spark, root) if top is None else _listed(spark, top, None).select(F.split("path", "/", 4).alias("p"))
    return parts.filter(F.size("p") < 4).select(F.array_join("p", "/").alias("path"))


def _existing(spark: SparkSession, folders: list[str]) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path
    settings = spark._jsc.hadoopConfiguration()
    return [f for f in folders if (p := path(f)).getFileSystem(settings).exists(p)]


def _below(spark: SparkSession, root: str, commits: list[str] | None = None) -> DataFrame:
    """The parts of each file's path below ``root``, the last one holding the rest, and its bytes; of some commits only, if given. For stores that
    are not mounted: Spark lists their files on the driver."""
    bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/") + "/"
    folders = None if commits is None else _existing(spark, [f"{root.rstrip('/')}/{c}" for c in commits])
    if folders is not None and not folders:
        return spark.createDataFrame([], "p array<string>, content binary")
    after = F.locate(bare, F.col("path")) + len(bare)
    below = F.substring(F.col("path"), after, F.length("path"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders or root)
    return files.select(F.split(below, "/", 4).alias("p"), "content")
