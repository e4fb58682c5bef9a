"""From candidates to reviewed records; every model step is request table -> answer table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.operators import answering
from patchloom.operators.incremental import resume_anti
from patchloom.operators.materials import RECORD_JOIN, RECORD_KEY, material_checks, parted_materials
from patchloom.operators.outputs import assemble_outputs, route_by_review, with_bug_infos
from patchloom.operators.pulls import dedup_last_wins
from patchloom.session import materialised
from patchloom.sources.sinks import all_failures


@dataclass
class Construction:
    """Tables of one run over landed answers."""

    materials: DataFrame
    selected: DataFrame
    specs: DataFrame
    reviews: DataFrame
    inputs: DataFrame
    manual_review_queue: DataFrame
    failures: DataFrame


def construct(
    candidates: DataFrame, repo_config: DataFrame, repo_files: DataFrame, answers: DataFrame,
    candidate_order: list[str] | None = None, done: DataFrame | None = None, bug_infos: DataFrame | None = None,
) -> Construction:
    """Run all steps over an answer table (stages ``select``, ``spec``, ``review``).

    Every candidate ends up among the inputs, in the queue or among the failures:
    selected records without materials and records that some step never answered
    give failure rows too. Of several answers of one step the last attempt counts;
    given ``candidate_order``, so does the last of several rows of a candidate
    (without it, candidate keys are taken to be unique).

    Candidates whose key is in ``done`` (repo, pr_id; see ``finished``) were brought to an end by an earlier run and take no part: no
    source or document is read for them. ``bug_infos`` (repo, pr_id, bug_info) are merged into the final records.

    Materials and the assembled records are each read by several later tables,
    so they are written once to the shared folder instead of being worked out
    again.
    """
    if candidate_order:
        candidates = materialised(dedup_last_wins(candidates, RECORD_JOIN, candidate_order), "candidates")
    if done is not None:
        candidates = materialised(resume_anti(candidates, done, RECORD_KEY), "candidates")
        answers = answers.join(done.select(*RECORD_KEY), RECORD_JOIN, "left_anti")
    checked = materialised(material_checks(candidates, repo_config, repo_files), "checked")
    ready, material_failures = parted_materials(checked, candidates, repo_config, repo_files)
    materials = materialised(ready, "materials")
    selected, select_failures = answering.parse_selection_answers(
        answering.latest_answers(answers, "select"), materials
    )
    specs, spec_failures = answering.parse_spec_answers(answering.latest_answers(answers, "spec"))
    reviews, review_failures = answering.parse_review_answers(answering.latest_answers(answers, "review"))
    _, without_materials = answering.spec_request_join(selected, materials)
    _, orphans = answering.review_request_join(specs, candidates, materials)
    assembled = materialised(
        assemble_outputs(reviews, candidates, specs, materials, selected), "assembled"
    )
    inputs, queue = route_by_review(assembled)
    if bug_infos is not None:
        inputs = with_bug_infos(inputs, bug_infos)
    known = materialised(all_failures(
        [material_failures, select_failures, without_materials, spec_failures, orphans, review_failures]), "failures")
    accounted = assembled.select(*RECORD_KEY).unionByName(known.select(*RECORD_KEY))
    silent = candidates.select(*RECORD_KEY).join(accounted, RECORD_JOIN, "left_anti")
    failures = known.unionByName(answering.failure_rows(silent, "spec", "llm", F.lit("a step was never answered")))
    return Construction(materials, selected, specs, reviews, inputs, queue, failures)


def finished(run: Construction) -> DataFrame:
    """Keys that a run brought to an end: accepted records and those for a person to judge. Failures are tried again by a later run."""
    return run.inputs.select("input.repo", "input.pr_id").unionByName(run.manual_review_queue.select("repo", "pr_id"))
