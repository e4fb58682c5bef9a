"""Dump files that arrive over time: each key is taken once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from patchloom.operators.sketch import key_sketch
from patchloom.sources.jsonl import read_jsonl_tolerant
from patchloom.sources.sinks import stored_table


def arriving_records(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Records of newly arrived files, broken lines skipped."""
    return read_jsonl_tolerant(spark.readStream.text(folder, lineSep="\n"), schema)


def taken_records(spark: SparkSession, sink: str, schema: str) -> DataFrame:
    """What has been taken in so far, with the ``batch`` it came in."""
    return stored_table(spark, sink, f"{schema}, batch bigint")


def take_new(batch: DataFrame, number: int, sink: str, schema: str, keys: list[str]) -> None:
    """Put the rows of a batch whose key is new into the sink, in a folder of the batch.

    Of rows with one key in a batch any one is taken; null keys are keys. The sink is read by its keys, and in that scan a sketch of the batch's
    keys leaves next to nothing for the join. The batch's folder is replaced, and is not held against the batch, so a batch that is
    done again after a failure leaves the same rows once.
    """
    batch = batch.persist()
    try:
        arrived = key_sketch(batch.select(*keys), keys)
        earlier = taken_records(batch.sparkSession, sink, schema).filter(F.col("batch") != number)
        earlier = earlier.filter(arrived(*map(F.col, keys))).select(*[F.col(k).alias(f"taken_{k}") for k in keys])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"taken_{k}")) for k in keys])
        batch.dropDuplicates(keys).join(earlier, same, "left_anti").write.mode("overwrite").parquet(f"{sink}/batch={number}")
    finally:
        batch.unpersist()


def stream_dedup(
    spark: SparkSession, folder: str, schema: str, keys: list[str], sink: str, checkpoint: str
) -> StreamingQuery:
    """Take in all files that are there now and append new keys to the sink.

    The first row of a key stays, also over later runs. What has been taken is known from the sink itself, so the query keeps no state,
    however many keys arrive over time; streams side by side share nothing. ``checkpoint`` and ``sink`` belong on shared storage.
    """
    return (
        arriving_records(spark, folder, schema)
        .writeStream.foreachBatch(lambda batch, number: take_new(batch, number, sink, schema, keys))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
