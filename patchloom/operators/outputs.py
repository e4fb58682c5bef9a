"""Assembly of reviewed records and their routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom import fixed, schemas
from patchloom.operators.materials import RECORD_JOIN, RECORD_KEY
from patchloom.operators.pulls import dedup_last_wins

_EVIDENCE = [
    "lang", "rtl_files", "commit_id", "timestamp", "pr_title", "pr_body", "merge_commit_sha",
    "issue_title", "issue_body", "commit_message", "fix_patch",
]


def assemble_outputs(
    reviews: DataFrame, candidates: DataFrame, specs: DataFrame, materials: DataFrame,
    selected: DataFrame, review_order: list[str] | None = None,
) -> DataFrame:
    """One row per reviewed record that has a candidate and a spec, with all its evidence.

    Missing source and selection read as empty. Given ``review_order``, only the
    last review of a record counts; without it, keys are taken to be unique. All
    four joins share one key, so each table is shuffled once.
    """
    if review_order:
        reviews = dedup_last_wins(reviews, RECORD_JOIN, review_order)
    none = F.array().cast("array<string>")
    return (
        reviews.select(*RECORD_KEY, "passed", "checks", "reasoning")
        .join(candidates.select(*RECORD_KEY, *_EVIDENCE), RECORD_JOIN, "inner")
        .join(specs.select(*RECORD_KEY, "spec"), RECORD_JOIN, "inner")
        .join(materials.select(*RECORD_KEY, "fixed_rtl_code"), RECORD_JOIN, "left")
        .join(selected.select(*RECORD_KEY, "selected_doc_paths"), RECORD_JOIN, "left")
        .withColumn("passed", F.coalesce("passed", F.lit(False)))
        .withColumn("fixed_rtl_code", F.coalesce("fixed_rtl_code", F.lit("")))
        .withColumn("selected_doc_paths", F.coalesce("selected_doc_paths", none))
    )


def accepted_inputs(assembled: DataFrame) -> DataFrame:
    """Final records of the passed reviews."""
    return assembled.filter("passed").select(
        F.struct("repo", "pr_id", "lang", "rtl_files", "spec", "commit_id", "timestamp").alias("input"),
        F.array().cast(f"array<{schemas.BUG_INFO}>").alias("bug_info"),
        F.struct(
            "merge_commit_sha", "pr_title", "pr_body", "issue_title", "issue_body", "commit_message",
            "fix_patch", "fixed_rtl_code", "selected_doc_paths",
        ).alias("aux"),
    )


def with_bug_infos(inputs: DataFrame, bug_infos: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Final records with the annotations of their pull request (repo, pr_id, bug_info) merged in.

    An annotation replaces what a record held before; a record without one keeps its own. Given ``order``, the last of several
    annotations of a record counts; without it, their keys are taken to be unique. The records meet narrow rows on their key.
    """
    if order:
        bug_infos = dedup_last_wins(bug_infos, RECORD_JOIN, order)
    found = bug_infos.select(
        F.col("repo").alias("_repo"), F.col("pr_id").alias("_pr_id"), F.col("bug_info").cast(f"array<{schemas.BUG_INFO}>").alias("_found"))
    none = F.array().cast(f"array<{schemas.BUG_INFO}>")
    return inputs.join(found, (F.col("input.pr_id") == F.col("_pr_id")) & (F.col("input.repo") == F.col("_repo")), "left").select(
        "input", F.coalesce("_found", "bug_info", none).alias("bug_info"), "aux")


def manual_review_queue(assembled: DataFrame) -> DataFrame:
    """Records of the failed reviews, with what a person needs to decide."""
    return assembled.filter("not passed").select(
        *RECORD_KEY,
        F.struct("passed", "checks", "reasoning").alias("review_result"),
        F.col("spec").alias("generated_spec"),
        "fixed_rtl_code", "pr_title", "pr_body", "fix_patch",
    )


def route_by_review(assembled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted records and the manual queue. When both are written, assemble into a table first."""
    return accepted_inputs(assembled), manual_review_queue(assembled)


def review_consistency(reviews: DataFrame) -> DataFrame:
    """Marks reviews whose verdict disagrees with their own checks."""
    all_true = F.lit(True)
    for name in fixed.REVIEW_CHECKS:
        all_true = all_true & F.coalesce(F.col("checks")[name], F.lit(False))
    return reviews.withColumn("all_checks", all_true).withColumn(
        "consistent", F.coalesce("passed", F.lit(False)) == all_true
    )
