"""Landed dumps of the hosting API, reshaped to tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom import schemas

_PLAIN = [
    "number", "state", "title", "body", "url", "id", "node_id", "html_url", "diff_url", "patch_url", "issue_url",
]
_LINKS = ["commits_url", "review_comments_url", "review_comment_url", "comments_url"]


def commits_shape(commits: Column, merged: Column) -> Column:
    """Commits as (sha, parents, message).

    Only merged pull requests carry them; others get an empty array. Null stays
    null: the commits are unknown.
    """
    shaped = F.transform(
        commits,
        lambda c: F.struct(
            c["sha"].alias("sha"),
            F.transform(c["parents"], lambda p: p["sha"]).alias("parents"),
            c["commit"]["message"].alias("message"),
        ),
    )
    return F.when(merged, shaped).otherwise(F.array().cast(f"array<{schemas.COMMIT}>"))


def pulls_from_dump(payloads: DataFrame) -> DataFrame:
    """Pull request rows of all states from API payloads (org, repo, payload text)."""
    p = F.from_json("payload", schemas.PULL_PAYLOAD)
    rows = payloads.select("org", "repo", p.alias("p"))
    moment = lambda name: F.col(f"p.{name}").try_cast("timestamp").alias(name)
    merged = F.coalesce(F.col("p.merged_at"), F.lit("")) != ""
    return rows.select(
        "org", "repo",
        *[F.col(f"p.{name}").alias(name) for name in _PLAIN],
        *[moment(name) for name in ("created_at", "updated_at", "closed_at", "merged_at")],
        F.col("p.merge_commit_sha").alias("merge_commit_sha"),
        F.transform("p.labels", lambda x: x["name"]).alias("labels"),
        F.col("p.draft").alias("draft"),
        *[F.col(f"p.{name}").alias(name) for name in _LINKS],
        F.struct(F.col("p.base.sha").alias("sha")).alias("base"),
        commits_shape(F.col("p.commits"), merged).alias("commits"),
    )


def issues_from_dump(payloads: DataFrame) -> DataFrame:
    """Issue rows from API payloads (org, repo, payload text)."""
    p = F.from_json("payload", schemas.ISSUE_PAYLOAD)
    return payloads.select("org", "repo", p.alias("p")).select(
        "org", "repo", *[F.col(f"p.{name}").alias(name) for name in ("number", "state", "title", "body")]
    )
