"""Pull request rows: filters, deduplication, commits and issue references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchloom.functions import refs
from patchloom.functions.text import once, or_empty

PULL_KEY = ["org", "repo", "number"]
#: The same key for joins and groupings. Sorts compare its first column by value and the others only where that is equal; names of
#: repositories are equal most of the time, numbers are not.
PULL_JOIN = ["number", "org", "repo"]


def merged_only(pulls: DataFrame) -> DataFrame:
    """Closed pull requests that were merged (``merged_at`` may be a timestamp or text)."""
    kept = (F.col("state") == "closed") & F.col("merged_at").isNotNull()
    if dict(pulls.dtypes)["merged_at"] == "string":
        kept = kept & (F.col("merged_at") != "")
    return pulls.filter(kept)


def drop_unfetched_merged(pulls: DataFrame) -> DataFrame:
    """Leave out merged rows whose commits are unknown (null); a later run brings them again.

    An empty array means known to have none, and stays.
    """
    return pulls.filter(F.col("merged_at").isNull() | F.col("commits").isNotNull())


def dedup_last_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last by ``order``.

    ``row_number() = 1`` is cut down inside every input partition before the
    shuffle, so a key with very many copies sends few rows.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def dedup_report(pulls: DataFrame, ident: str = "id") -> DataFrame:
    """Fetched and distinct counts per repository."""
    return pulls.groupBy("org", "repo").agg(
        F.count(F.lit(1)).alias("fetched"), F.count_distinct(F.col(ident)).alias("distinct_pulls")
    )


def head_commit(commits: Column) -> Column:
    """The last commit of a pull request, null when there is none."""
    return F.try_element_at(commits, F.lit(-1))


def with_head_commit(pulls: DataFrame) -> DataFrame:
    head = head_commit(F.col("commits"))
    return pulls.withColumn("head_sha", head["sha"]).withColumn("commit_message", or_empty(head["message"]))


def link_issues(pulls: DataFrame, own_repository_only: bool = False) -> DataFrame:
    """Add ``issue_numbers``, the issues a pull request names; drop rows that name none."""
    text = refs.strip_html_comments(
        refs.pr_text(F.col("title"), F.col("body"), F.col("commits.message"))
    )
    own = (F.col("org"), F.col("repo")) if own_repository_only else (None, None)
    return has_issue_ref(pulls.select("*", once("issue_numbers", refs.ref_union(text, *own))))


def link_answered_issues(pulls: DataFrame, answers: DataFrame) -> DataFrame:
    """Add ``issue_numbers`` from parsed answers (org, repo, number, issues) instead of from the text."""
    numbers = F.array_sort(F.array_distinct(F.filter(
        F.transform(F.col("issues"), lambda t: t.try_cast("bigint")), lambda n: n > 0)))
    return has_issue_ref(
        pulls.join(answers.select(*PULL_KEY, numbers.alias("issue_numbers")), PULL_JOIN, "inner")
    )


def has_issue_ref(pulls: DataFrame) -> DataFrame:
    return pulls.filter(F.size("issue_numbers") > 0)
