"""Requests for the external model, and what becomes of its answers.

Each model step is two jobs with a table between them: a request table that is
built here, and an answer table (stage, repo, pr_id, attempt, content, error)
that something else fills. Runs can be replayed without a model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom import fixed, schemas
from patchloom.functions import answers as A
from patchloom.functions import diffs
from patchloom.functions import requests as R
from patchloom.functions import titles
from patchloom.functions.refs import pr_text
from patchloom.functions.text import once
from patchloom.operators.materials import RECORD_JOIN, RECORD_KEY, official_spec, selected_texts, sources_before
from patchloom.operators.pulls import dedup_last_wins


def failure_rows(rows: DataFrame, stage: str, kind: str, error: Column) -> DataFrame:
    """Failure rows of one stage, in the shape of the shared failures table."""
    return rows.select(
        F.lit(stage).alias("stage"), F.lit(kind).alias("kind"), *RECORD_KEY,
        F.lit(None).cast("string").alias("rtl_file"), error.alias("error"),
    )


def latest_answers(answers: DataFrame, stage: str) -> DataFrame:
    """The last attempt per record of one stage."""
    return dedup_last_wins(answers.filter(F.col("stage") == stage), RECORD_JOIN, ["attempt"])


# --- requests ---------------------------------------------------------------------------------


def issue_ref_requests(pulls: DataFrame) -> DataFrame:
    """One request per pull request. The text keeps its comments."""
    text = pr_text(F.col("title"), F.col("body"), F.col("commits.message"))
    return pulls.select("org", "repo", "number", R.fill(R.ISSUE_REFS, text=text).alias("request"))


def selection_requests(materials: DataFrame) -> DataFrame:
    return materials.select(
        *RECORD_KEY,
        R.fill(
            R.DOC_SELECTION,
            repo=F.col("repo"), rtl_file=F.col("rtl_file"), fixed_rtl_code=F.col("fixed_rtl_code"),
            doc_toc=titles.format_doc_toc(F.col("doc_toc")),
        ).alias("request"),
    )


def spec_request_join(selected: DataFrame, materials: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Selected records with their materials, and failure rows for those without."""
    joined = selected.select(*RECORD_KEY, "selected_doc_paths").join(materials, RECORD_JOIN, "left")
    ready = joined.filter(F.col("rtl_file").isNotNull())
    failed = failure_rows(joined.filter(F.col("rtl_file").isNull()), "spec", "llm", F.lit(fixed.MISSING_MATERIALS))
    return ready, failed


def spec_requests(
    selected: DataFrame, materials: DataFrame, repo_files: DataFrame
) -> tuple[DataFrame, DataFrame]:
    ready, failed = spec_request_join(selected, materials)
    ready = ready.withColumn("commit_sha", F.col("merge_commit_sha"))
    texts = selected_texts(ready, repo_files)
    requests = ready.join(texts, ["commit_sha", "repo"], "left").select(
        *RECORD_KEY,
        R.fill(
            R.SPEC,
            repo=F.col("repo"), lang=F.col("lang"), rtl_files=F.to_json("rtl_files"),
            rtl_code=F.col("fixed_rtl_code"), official_spec=official_spec(F.col("selected_doc_paths"), F.col("texts")),
            banned_words=F.lit(", ".join(fixed.BANNED_WORDS)),
        ).alias("request"),
    )
    return requests, failed


def review_request_join(
    specs: DataFrame, candidates: DataFrame, materials: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Specs with candidate and source; failure rows for specs without a candidate.

    Missing materials are no failure: the source slot stays empty.
    """
    known = candidates.drop("rtl_file").withColumn("_known", F.lit(True))
    joined = (
        specs.select(*RECORD_KEY, "spec")
        .join(known, RECORD_JOIN, "left")
        .join(materials.select(*RECORD_KEY, "fixed_rtl_code"), RECORD_JOIN, "left")
        .withColumn("fixed_rtl_code", F.coalesce("fixed_rtl_code", F.lit("")))
    )
    failed = failure_rows(joined.filter(F.col("_known").isNull()), "review", "llm", F.lit(fixed.MISSING_CANDIDATE))
    return joined.filter(F.col("_known").isNotNull()).drop("_known"), failed


def review_requests(
    specs: DataFrame, candidates: DataFrame, materials: DataFrame
) -> tuple[DataFrame, DataFrame]:
    ready, failed = review_request_join(specs, candidates, materials)
    evidence = {name: F.col(name) for _, name in fixed.PR_CONTEXT_SECTIONS}
    requests = ready.select(
        *RECORD_KEY,
        R.fill(
            R.REVIEW,
            pr_contexts=R.pr_contexts(evidence), fix_patch=F.col("fix_patch"),
            rtl_code=F.col("fixed_rtl_code"), generated_spec=F.col("spec"),
        ).alias("request"),
    )
    return requests, failed


def _evidence() -> Column:
    return R.pr_contexts({name: F.col(name) for _, name in fixed.PR_CONTEXT_SECTIONS})


def shortlist_requests(candidates: DataFrame, base_files: DataFrame) -> DataFrame:
    """Which hunks of the fix patch may hold the cause? Hunk names count over the fix patch, so its answers are read against it."""
    return candidates.join(sources_before(candidates, base_files), RECORD_JOIN, "inner").select(
        *RECORD_KEY,
        R.fill(
            R.HUNK_SHORTLIST, repo=F.col("repo"), lang=F.col("lang"), pr_contexts=_evidence(), rtl_code=F.col("rtl_code"),
            hunks=diffs.hunk_list(F.col("fix_patch")),
        ).alias("request"),
    )


def annotation_requests(confirmed: DataFrame, candidates: DataFrame, specs: DataFrame, base_files: DataFrame) -> DataFrame:
    """What is wrong in each confirmed hunk (repo, pr_id, hunk_no, over the fix patch)? Asked of records that have a spec and a confirmed hunk."""
    hunks = diffs.all_hunks(F.col("fix_patch"))
    named = confirmed.groupBy(*RECORD_JOIN).agg(F.array_sort(F.collect_set("hunk_no")).alias("hunk_nos"))
    rows = (
        candidates.join(named, RECORD_JOIN, "inner").join(specs.select(*RECORD_KEY, "spec"), RECORD_JOIN, "inner")
        .join(sources_before(candidates, base_files), RECORD_JOIN, "inner").select("*", once("_hunks", hunks))
    )
    code = F.transform("hunk_nos", lambda n: F.struct(
        F.concat(F.lit("HUNK_"), n.cast("string")).alias("hunk_id"), F.get("_hunks", (n - 1).cast("int")).alias("root_cause_code")))
    types = "\n".join(f"- {a} / {b}" for a, b in fixed.BUG_TYPES)
    return rows.select(
        *RECORD_KEY,
        R.fill(
            R.ANNOTATION, repo=F.col("repo"), lang=F.col("lang"), spec=F.col("spec"), root_cause_hunks=F.to_json(code),
            rtl_code=F.col("rtl_code"), pr_contexts=_evidence(), bug_types=F.lit(types),
        ).alias("request"),
    )


# --- answers ----------------------------------------------------------------------------------


def _failed_answers(rows: DataFrame, stage: str) -> DataFrame:
    return failure_rows(rows, stage, "llm", F.coalesce("error", F.lit(_WRONG_SHAPE)))


def parse_issue_answers(answers: DataFrame) -> DataFrame:
    """Adds ``issues``: numbers as text; null where the answer has another shape."""
    rows = answers.select("*", once("_value", A.parsed(A.fenced_block(F.col("content")))))
    return rows.withColumn("issues", A.issue_numbers(F.col("_value"))).drop("_value")


_WRONG_SHAPE = "answer has the wrong shape"


def selection_answers(answers: DataFrame) -> DataFrame:
    """Every answer with the paths it selects and its reason, or with ``error``: good and failed ones in one table."""
    value = A.parsed(A.unfenced(F.col("content")))
    rows = answers.select("*", once("_value", F.when(F.col("error").isNull(), value)))
    good = F.coalesce(A.is_object(F.col("_value")), F.lit(False))
    return rows.select(
        *RECORD_KEY,
        F.when(good, A.selected_paths(F.col("_value"))).alias("paths"),
        F.when(good, A.selection_reason(F.col("_value"))).alias("reason"),
        F.when(~good, F.coalesce("error", F.lit(_WRONG_SHAPE))).alias("error"),
    )


def parted_selections(parsed: DataFrame, materials: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Selected paths that exist in the record's contents list, with the reason; and failure rows."""
    available = materials.select(
        *RECORD_KEY, F.transform("doc_toc", lambda e: e["path"]).alias("_available")
    )
    selected = parsed.filter("error is null").join(available, RECORD_JOIN, "left").select(
        *RECORD_KEY, A.valid_paths(F.col("paths"), F.col("_available")).alias("selected_doc_paths"), "reason")
    return selected, failure_rows(parsed.filter("error is not null"), "select", "llm", F.col("error"))


def parse_selection_answers(answers: DataFrame, materials: DataFrame) -> tuple[DataFrame, DataFrame]:
    return parted_selections(selection_answers(answers), materials)


def parse_spec_answers(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A spec is the answer text as it is; an answer that never came is a failure."""
    good = F.col("error").isNull() & F.col("content").isNotNull()
    specs = answers.filter(good).select(*RECORD_KEY, F.col("content").alias("spec"))
    return specs, _failed_answers(answers.filter(~good), "spec")


def review_answers(answers: DataFrame) -> DataFrame:
    """Every answer as a review with plain booleans and text, or with ``error``: good and failed ones in one table."""
    value = A.parsed(A.unfenced(F.col("content")))
    rows = answers.select("*", once("_value", F.when(F.col("error").isNull(), value)))
    good = F.coalesce(A.review_is_readable(F.col("_value")), F.lit(False))
    return rows.select(
        *RECORD_KEY,
        F.when(good, A.truthy(A.at(F.col("_value"), "$.passed"))).alias("passed"),
        F.when(good, A.review_checks(F.col("_value"))).alias("checks"),
        F.when(good, A.review_reasoning(F.col("_value"))).alias("reasoning"),
        F.when(~good, F.coalesce("error", F.lit(_WRONG_SHAPE))).alias("error"),
    )


def parted_reviews(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reviews, and failure rows."""
    return parsed.filter("error is null").drop("error"), failure_rows(parsed.filter("error is not null"), "review", "llm", F.col("error"))


def parse_review_answers(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    return parted_reviews(review_answers(answers))


def answer_requests(
    requests: DataFrame, stage: str, make_client: Callable[[], Callable[[str], str]]
) -> DataFrame:
    """Send every request (repo, pr_id, request) through a caller's function.

    ``make_client`` is called once per partition and returns the function that
    answers one request. A request that raises yields a row with its error; the
    others go on. Filter before this step: nothing is pushed through it. Requests
    sent again carry their ``attempt``, so that the later answer counts; without
    that column all are first attempts.
    """

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for batch in batches:
            content, error = [], []
            for request in batch["request"]:
                try:
                    content.append(client(request))
                    error.append(None)
                except Exception as problem:  # noqa: BLE001 - any failure becomes a row
                    content.append(None)
                    error.append(str(problem))
            yield pd.DataFrame({
                "stage": stage, "repo": batch["repo"], "pr_id": batch["pr_id"], "attempt": batch["attempt"],
                "content": pd.Series(content, index=batch.index, dtype=object),
                "error": pd.Series(error, index=batch.index, dtype=object),
            })

    attempt = F.coalesce("attempt", F.lit(1)) if "attempt" in requests.columns else F.lit(1)
    return requests.select(*RECORD_KEY, "request", attempt.cast("bigint").alias("attempt")).mapInPandas(answer, schemas.MODEL_ANSWERS)
