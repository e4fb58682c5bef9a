"""Which issues are wanted, and the join that attaches them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom import schemas
from patchloom.functions.text import or_empty
from patchloom.operators.pulls import PULL_JOIN, PULL_KEY, dedup_last_wins

_ISSUE_FIELDS = ["org", "repo", "number", "state", "title", "body"]


def target_issues(linked: DataFrame) -> DataFrame:
    """Distinct issues named by any pull request; references that are no numbers are passed over."""
    number = F.col("ref").cast("string").try_cast("bigint")
    return (
        linked.select("org", "repo", F.explode("issue_numbers").alias("ref"))
        .select("org", "repo", number.alias("number"))
        .filter(F.col("number").isNotNull())
        .distinct()
    )


def pending_issues(wanted: DataFrame, fetched: DataFrame) -> DataFrame:
    """Wanted issues that are not there yet."""
    keys = ["org", "repo", "number"]
    return wanted.select(*keys).join(fetched.select(*keys), keys, "left_anti")


def resolve_issues(linked: DataFrame, issues: DataFrame) -> DataFrame:
    """Issue rows per pull request, in the order of the numbers; only keys and issue rows are shuffled."""
    refs = linked.select(*PULL_KEY, F.posexplode("issue_numbers").alias("pos", "issue_number"))
    found = issues.select(
        "org", "repo", F.col("number").alias("issue_number"),
        F.struct(*_ISSUE_FIELDS).alias("issue"),
    )
    return (
        refs.join(found, ["issue_number", "org", "repo"], "inner")
        .groupBy(*PULL_JOIN)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "issue"))).alias("entries"))
        .select(*PULL_KEY, F.transform("entries", lambda e: e["issue"]).alias("resolved_issues"))
    )


def attach_issues(linked: DataFrame, issues: DataFrame, issue_order: list[str] | None = None) -> DataFrame:
    """Replace issue numbers by issue rows: numbers without a row vanish, the pull request stays.

    Given ``issue_order``, an issue that landed several times counts with its last
    row; without it, issue keys are taken to be unique.
    """
    if issue_order:
        issues = dedup_last_wins(issues, PULL_JOIN, issue_order)
    none = F.array().cast(f"array<{schemas.ISSUE}>")
    return linked.join(resolve_issues(linked, issues), PULL_JOIN, "left").withColumn(
        "resolved_issues", F.coalesce("resolved_issues", none)
    )


def first_issue(resolved_issues: Column) -> tuple[Column, Column]:
    """Title and body of the first resolved issue, empty when there is none."""
    first = F.try_element_at(resolved_issues, F.lit(1))
    return or_empty(first["title"]), or_empty(first["body"])
