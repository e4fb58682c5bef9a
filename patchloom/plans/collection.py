"""From landed pull requests, issues and diffs to candidates, over all repositories at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom import schemas
from patchloom.functions import diffs
from patchloom.operators.candidates import candidate_projection, changes_one_rtl_file
from patchloom.operators.issues import attach_issues
from patchloom.operators.patches import is_comparable, parse_diffs
from patchloom.operators.pulls import (
    PULL_JOIN, PULL_KEY, dedup_last_wins, drop_unfetched_merged, link_answered_issues, link_issues, merged_only,
)
from patchloom.operators.incremental import resume_anti, unexamined
from patchloom.operators.sketch import key_sketch
from patchloom.session import materialised
from patchloom.sources.sinks import stored_table, write_stage


def collected_pulls(dump: DataFrame, order: list[str], done: DataFrame | None = None) -> DataFrame:
    """New pull requests of a dump: one row per id, merged ones only with their commits."""
    newest = dedup_last_wins(dump, ["id"], order)
    rows = drop_unfetched_merged(newest).drop(*order)
    return rows if done is None else resume_anti(rows, done, ["id"])


def pull_version() -> Column:
    """A number that changes with all that a pull request alone contributes to its candidate."""
    return F.xxhash64("state", "merged_at", "title", "body", "merge_commit_sha", "base", "commits")


def examined_pulls(pulls: DataFrame, compare_diffs: DataFrame) -> DataFrame:
    """Ledger rows (key, version) of a run: every pull request it could decide on, rejected ones included.

    One whose diff has not landed yet is left out, so that a later run takes it up.
    """
    waiting = merged_only(pulls).filter(is_comparable()).select(*PULL_KEY).join(compare_diffs.select(*PULL_KEY), PULL_JOIN, "left_anti")
    return pulls.select(*PULL_KEY, pull_version().alias("version")).join(waiting, PULL_JOIN, "left_anti").select(*PULL_KEY, "version")


def pending_diffs(compare_diffs: DataFrame, pulls: DataFrame) -> DataFrame:
    """Diffs of some pull requests and next to no others, told in the scan: no text of the others is parsed or moved."""
    wanted = key_sketch(pulls.select(*PULL_KEY), PULL_KEY)
    return compare_diffs.filter(wanted(*map(F.col, PULL_KEY)))


def candidates_plan(
    pulls: DataFrame, issues: DataFrame, compare_diffs: DataFrame, issue_answers: DataFrame | None = None,
    issue_order: list[str] | None = None, ledger: DataFrame | None = None,
) -> DataFrame:
    """Candidates of all repositories.

    Issue references come from the text, or from parsed answers when given. Given ``issue_order``, an issue that landed
    several times counts with its last row. Given a ``ledger`` of earlier runs (see ``examined_pulls``), only pull requests it does not
    know are looked at, and only their diffs are parsed.

    Both large tables are read once: a diff is judged by its paths before it is parsed
    and shuffled, so only fitting diffs meet the linked pull requests. What is left
    is written to the shared folder, since attaching issues reads it twice.
    """
    comparable = merged_only(pulls).filter(is_comparable())
    if ledger is not None:
        comparable = unexamined(comparable, ledger, PULL_JOIN, pull_version())
        compare_diffs = pending_diffs(compare_diffs, comparable)
    linked = link_issues(comparable) if issue_answers is None else link_answered_issues(comparable, issue_answers)
    # A change of one source file always leaves a fix patch, so that needs no filter of its own.
    fitting = parse_diffs(compare_diffs.filter(changes_one_rtl_file(diffs.paths(F.col("diff_text")))))
    patches = materialised(linked.join(fitting, PULL_JOIN, "inner"), "single-rtl")
    return candidate_projection(attach_issues(patches, issues, issue_order))


def resumed_candidates(
    pulls: DataFrame, issues: DataFrame, compare_diffs: DataFrame, folder: str, run: str, **settings,
) -> DataFrame:
    """Add the candidates of pull requests that no earlier run has examined to ``folder``; gives the candidates of all runs, the last
    run's row for one that was examined again.

    Candidates and ledger are kept per run. A run that is done again replaces its own part and ends in the same tables; the
    ledger is written last, so a run that broke off is no run.
    """
    spark = pulls.sparkSession
    ledger = stored_table(spark, f"{folder}/ledger", "org string, repo string, number bigint, version bigint, run string").filter(F.col("run") != run)
    found = candidates_plan(pulls, issues, compare_diffs, ledger=ledger, **settings)
    write_stage(found.withColumn("examined", F.current_timestamp()), f"{folder}/candidates", partition_by=(), run=run)
    write_stage(unexamined(examined_pulls(pulls, compare_diffs).withColumnRenamed("version", "seen"), ledger, PULL_JOIN, F.col("seen"))
                .withColumnRenamed("seen", "version"), f"{folder}/ledger", partition_by=(), run=run)
    every = stored_table(spark, f"{folder}/candidates", f"{schemas.CANDIDATES}, examined timestamp, run string")
    return dedup_last_wins(every, ["repo", "pr_id"], ["examined"]).drop("examined", "run")
