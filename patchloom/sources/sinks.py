"""Writers of stage tables and failures."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom import schemas


def write_stage(
    rows: DataFrame, path: str, resume: bool = False, partition_by: tuple[str, ...] = ("org", "repo"),
    sort_desc: str | None = None, file_format: str = "parquet", run: str | None = None,
) -> None:
    """Write a stage table, appended on resume, else replaced.

    Given ``run``, the rows go into a folder of that run (a partition column ``run`` when the table is read), which is replaced as a
    whole: a run that is done again leaves its rows once, and those of other runs alone.

    Rows are rebalanced by the partition columns first: small repositories share
    tasks, and a repository that holds most rows is split over many files.
    """
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    if sort_desc:
        rows = rows.sortWithinPartitions(*partition_by, rows[sort_desc].desc())
    if run is not None:
        path, resume = f"{path}/run={run}", False
    writer = rows.write.mode("append" if resume else "overwrite").format(file_format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def stored_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table as it is stored so far; empty where nothing is."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        # A plan without rows, not rows from Python: joins with it fall away, and no worker is started for it.
        columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)]
        return spark.range(1).select(*columns).filter(F.lit(False))


def all_failures(parts: list[DataFrame]) -> DataFrame:
    """Failures of several stages as one table."""
    return reduce(DataFrame.unionByName, parts)


def append_failures(failures: DataFrame, path: str, run: str, stage: str) -> None:
    """Put the failures of one stage of a run beside those of other stages and runs.

    The stage's own folder of the run is replaced, also by nothing: a stage that is done again leaves its failures once, and a
    failure that did not come again is gone.
    """
    names = [c.split()[0] for c in schemas.FAILURES.split(", ") if not c.startswith("stage ")]
    failures.select(*names).write.mode("overwrite").parquet(f"{path}/run={run}/stage={stage}")


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """All failures with their run and stage."""
    return spark.read.schema(f"{schemas.FAILURES}, run string").parquet(path)
