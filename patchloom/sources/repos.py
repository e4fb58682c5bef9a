"""Which repositories take part, and their settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom import fixed, schemas
from patchloom.functions.text import none_if_empty, strip


def default_repo_config(spark: SparkSession) -> DataFrame:
    """Settings of the default repositories; a caller's own table has the same columns."""
    return spark.createDataFrame(fixed.DEFAULT_REPO_CONFIG, schemas.REPO_CONFIG)


def default_repo_specs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s,) for s in fixed.DEFAULT_REPOS], "spec string")


def repo_config_dim(doc_dirs: DataFrame) -> DataFrame:
    """Settings with one row per repository, from one row per documentation root."""
    return doc_dirs.groupBy("repo").agg(F.array_sort(F.collect_set("doc_dir")).alias("doc_dirs"))


def parse_repo_specs(specs: DataFrame) -> DataFrame:
    """``org/repo`` texts split at the first slash, both parts trimmed; ``valid`` tells whether there was one."""
    halves = F.split("spec", "/", 2)
    return specs.select(
        "spec", F.contains(F.col("spec"), F.lit("/")).alias("valid"),
        strip(F.get(halves, 0)).alias("org"), strip(F.get(halves, 1)).alias("repo"),
    ).withColumns({c: F.when(F.col("valid"), F.col(c)) for c in ("org", "repo")})


def select_repos(rows: DataFrame, specs: DataFrame) -> DataFrame:
    """Rows of the named repositories: one job over all of them."""
    wanted = parse_repo_specs(specs).filter("valid").select("org", "repo").distinct()
    return rows.join(wanted, ["org", "repo"], "left_semi")


def repo_from_filename(file_name: Column, record_repo: Column, candidate_file: bool = False) -> Column:
    """(org, repo) from a dump's file name, else from the record's ``org/repo``; null when neither tells."""
    pattern = fixed.CANDIDATE_FILE_NAME if candidate_file else fixed.STAGE_FILE_NAME
    halves = F.when(record_repo.contains("/"), F.split(record_repo, "/", 2))
    return F.struct(
        F.coalesce(none_if_empty(F.regexp_extract(file_name, pattern, 1)), F.get(halves, 0)).alias("org"),
        F.coalesce(none_if_empty(F.regexp_extract(file_name, pattern, 2)), F.get(halves, 1)).alias("repo"),
    )
