"""JSON-lines tables: tolerant, counted and strict reading.

A line counts as broken when it is not one JSON object. A field of another type
than declared breaks nothing: it reads as null and the line is kept.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.functions import answers as A
from patchloom.functions.text import once, strip

_BAD = "_bad_line"


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all files under a path, with their file name; a missing path reads as empty."""
    try:
        found = spark.read.text(path, lineSep="\n")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file_name string, value string")
    return found.select(F.col("_metadata.file_name").alias("file_name"), "value")


def _parsed(value: Column, schema: str) -> Column:
    whole = T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField(_BAD, T.StringType())])
    return F.from_json(value, whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})


def _broken(value: Column) -> Column:
    return ~A.is_object(F.try_parse_json(value))


def with_records(lines: DataFrame, schema: str) -> DataFrame:
    """Non-blank lines with their record, and what is wrong with them.

    ``broken`` marks lines that are no JSON object, ``mistyped`` those with a
    field of another type. The second, shape-checking parse only runs on lines
    the first one stumbled over.
    """
    value = strip(F.col("value"))
    rows = lines.withColumn("value", value).filter(F.col("value") != "").select("*", once("_r", _parsed(F.col("value"), schema)))
    odd = F.col("_r").isNull() | F.col(f"_r.{_BAD}").isNotNull() | ~F.col("value").startswith("{")
    broken = F.when(odd, _broken(F.col("value"))).otherwise(F.lit(False))
    return rows.withColumn("broken", broken).withColumn("mistyped", odd & ~F.col("broken"))


def _fields(schema: str) -> list[Column]:
    return [F.col(f"_r.{name}").alias(name) for name in T.StructType.fromDDL(schema).fieldNames()]


def read_jsonl_tolerant(lines: DataFrame, schema: str) -> DataFrame:
    """Records of all readable lines; blank and broken lines are skipped."""
    return with_records(lines, schema).filter(~F.col("broken")).select(*_fields(schema))


def bad_line_count(lines: DataFrame, schema: str) -> DataFrame:
    """Per file: non-blank lines, broken lines and lines with a mistyped field."""
    return with_records(lines, schema).groupBy("file_name").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if("broken").alias("broken"),
        F.count_if("mistyped").alias("mistyped"),
    )


def bad_lines(lines: DataFrame, schema: str) -> DataFrame:
    """The broken lines themselves, with their file."""
    return with_records(lines, schema).filter("broken").select("file_name", "value")


def read_jsonl_strict(lines: DataFrame, schema: str) -> DataFrame:
    """Records of all lines; one blank or broken line fails the job."""
    value = F.col("value")
    checked = F.when(_broken(value), F.raise_error(F.concat(F.lit("broken line: "), value))).otherwise(value)
    return lines.select(_parsed(checked, schema).alias("_r")).select(*_fields(schema))
