"""The single-source-file filter and the candidate rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions.paths import is_test_path, rtl_lang
from patchloom.functions.text import iso_utc, or_empty
from patchloom.operators.issues import first_issue
from patchloom.operators.pulls import head_commit


def rtl_files(modified_files: Column) -> Column:
    """Hardware source files among the paths, test files left out, order kept."""
    return F.filter(modified_files, lambda p: rtl_lang(p).isNotNull() & ~is_test_path(p))


def non_test_files(modified_files: Column) -> Column:
    return F.filter(modified_files, lambda p: ~is_test_path(p))


def single_rtl_file(rows: DataFrame) -> DataFrame:
    """Exactly one hardware source file changed."""
    return rows.filter(F.size(rtl_files(F.col("modified_files"))) == 1)


def single_non_test_file(rows: DataFrame) -> DataFrame:
    """Exactly one file outside tests changed, of any kind."""
    return rows.filter(F.size(non_test_files(F.col("modified_files"))) == 1)


def changes_one_rtl_file(modified_files: Column) -> Column:
    """Both file conditions in one expression, for a filter over paths that are costly to find.

    A hardware source outside tests is a file outside tests, so the only one of these has to be it. The one-element array binds
    the files, so they are worked out once per row.
    """
    return F.exists(F.array(non_test_files(modified_files)), lambda rest: (F.size(rest) == 1) & rtl_lang(F.get(rest, 0)).isNotNull())


def has_base_sha(rows: DataFrame) -> DataFrame:
    return rows.filter(F.coalesce(F.col("base.sha"), F.lit("")) != "")


def repo_slug(org: Column, repo: Column) -> Column:
    return F.trim(F.concat(or_empty(org), F.lit("/"), or_empty(repo)), F.lit("/"))


def candidate_projection(patches: DataFrame) -> DataFrame:
    """Reshape to the candidate columns; missing texts become empty."""
    issue_title, issue_body = first_issue(F.col("resolved_issues"))
    files = rtl_files(F.col("modified_files"))
    moment = F.col("merged_at") if dict(patches.dtypes)["merged_at"] == "string" else iso_utc(F.col("merged_at"))
    return patches.select(
        repo_slug(F.col("org"), F.col("repo")).alias("repo"),
        F.col("number").alias("pr_id"),
        rtl_lang(F.try_element_at(files, F.lit(1))).alias("lang"),
        files.alias("rtl_files"),
        F.col("base.sha").alias("commit_id"),
        moment.alias("timestamp"),
        or_empty(F.col("title")).alias("pr_title"),
        or_empty(F.col("body")).alias("pr_body"),
        or_empty(F.col("merge_commit_sha")).alias("merge_commit_sha"),
        issue_title.alias("issue_title"),
        issue_body.alias("issue_body"),
        or_empty(head_commit(F.col("commits"))["message"]).alias("commit_message"),
        or_empty(F.col("fix_patch")).alias("fix_patch"),
        or_empty(F.col("test_patch")).alias("test_patch"),
        "modified_files",
        F.coalesce("lines_added", F.lit(0).cast("bigint")).alias("lines_added"),
        F.coalesce("lines_removed", F.lit(0).cast("bigint")).alias("lines_removed"),
    )


def single_rtl_candidates(patches: DataFrame) -> DataFrame:
    """Rows that change one hardware source file and nothing else outside tests, as candidates."""
    return candidate_projection(has_base_sha(single_non_test_file(single_rtl_file(patches))))


def order_desc(rows: DataFrame, key: str) -> DataFrame:
    """Highest key first, over the whole table."""
    return rows.orderBy(F.col(key).desc())
