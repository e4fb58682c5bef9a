"""Quality gates on specs, and bug annotation by hunk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchloom import fixed
from patchloom.functions import answers as A
from patchloom.functions import diffs, gates
from patchloom.functions.text import once
from patchloom.operators.candidates import repo_slug
from patchloom.operators.materials import RECORD_JOIN, RECORD_KEY
from patchloom.operators.patches import blocks_by_hunk, hunk_counts
from patchloom.operators.pulls import PULL_JOIN, PULL_KEY
from patchloom.operators.sketch import key_sketch


def patch_leakage(specs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Identifiers of the changed patch lines that recur in the spec, per record.

    One equi-join on the record key brings patch and spec into one row, where the
    two token sets are intersected: tokens are never exploded or shuffled.
    """
    leaked = F.array_sort(F.array_intersect(
        gates.identifiers(diffs.changed_text(F.col("fix_patch"))), gates.identifiers(F.col("spec"))
    ))
    return (
        specs.select(*RECORD_KEY, "spec")
        .join(candidates.select(*RECORD_KEY, "fix_patch"), RECORD_JOIN, "inner")
        .select(*RECORD_KEY, leaked.alias("leaked"))
        .withColumn("no_patch_leakage", F.size("leaked") == 0)
    )


def bug_type_valid(rows: DataFrame) -> DataFrame:
    """Adds ``valid``: whether (level1, level2) is one of the allowed pairs, letter by letter.

    The allowed pairs are a fixed list of eight, so they go into the expression
    and no join is needed.
    """
    pair = F.concat_ws("::", "level1", "level2")
    allowed = [f"{a}::{b}" for a, b in fixed.BUG_TYPES]
    known = F.col("level1").isNotNull() & F.col("level2").isNotNull()
    return rows.withColumn("valid", known & pair.isin(allowed))


_NO_OBJECT, _NO_LIST, _NO_TYPE, _NO_HUNK, _NO_LINE = (
    "answer has the wrong shape", "answer lists nothing", "bug type not allowed", "hunk not in the diff", "hunk changes no line")


def _hunk_number(hunk_id: Column) -> Column:
    return F.regexp_extract(hunk_id, r"\AHUNK_([1-9][0-9]*)\z", 1).try_cast("bigint")


def _exists(hunk_id: Column, hunks: Column) -> Column:
    """Whether a hunk name lies between the first and the last of a diff of so many hunks."""
    return F.coalesce(_hunk_number(hunk_id) <= hunks, F.lit(False))


def _asked_diffs(answers: DataFrame, compare_diffs: DataFrame) -> DataFrame:
    """Diffs of the answered pull requests, and next to no others: told in their scan, so no diff moves."""
    asked = key_sketch(answers.select(*PULL_KEY), PULL_KEY)
    return compare_diffs.filter(asked(*map(F.col, PULL_KEY)))


def _name_of(value: Column) -> Column:
    """A hunk name as it stands; one that is no text as its JSON."""
    return F.when(A.is_string(value), F.try_variant_get(value, "$", "string")).otherwise(F.to_json(value))


def parse_hunk_shortlists(answers: DataFrame) -> DataFrame:
    """One row per hunk named in a shortlist answer: verdict, hunk_id, reason; and one row with a ``problem`` per unreadable answer.

    An answer with a list that names no hunk gives no row.
    """
    rows = answers.select(*PULL_KEY, once("_value", A.parsed(A.unfenced(F.col("content")))))

    def entries(path: str, verdict: str):
        return F.transform(A.items(F.col("_value"), path), lambda e: F.struct(F.lit(verdict).alias("verdict"), e.alias("entry")))

    def listed(path: str):
        return A.is_array(A.at(F.col("_value"), path))

    kept, left = "$.candidate_root_cause_hunks", "$.filtered_non_root_cause_hunks"
    named = F.flatten(F.transform(F.concat(entries(kept, "candidate"), entries(left, "filtered")), lambda e: F.transform(
        A.items(e["entry"], "$.hunk_ids"),
        lambda h: F.struct(e["verdict"].alias("verdict"), _name_of(h).alias("hunk_id"), A.string_at(e["entry"], "$.reason").alias("reason")),
    )))
    problem = F.when(~F.coalesce(A.is_object(F.col("_value")), F.lit(False)), _NO_OBJECT).when(~listed(kept) & ~listed(left), _NO_LIST)
    return rows.select(*PULL_KEY, problem.alias("problem"), F.explode_outer(named).alias("h")).filter(
        "h is not null or problem is not null").select(*PULL_KEY, "h.verdict", "h.hunk_id", "h.reason", "problem")


def hunk_shortlists(answers: DataFrame, compare_diffs: DataFrame) -> DataFrame:
    """Every row of the shortlists with ``error``: null where the hunk exists in the diff, else why it is no use.

    A name is tested against the number of hunks, one narrow row per diff. Good rows and failures are one table, to be written once and
    then parted.
    """
    counts = hunk_counts(_asked_diffs(answers, compare_diffs))
    error = F.coalesce("problem", F.when(~_exists(F.col("hunk_id"), F.col("hunks")), _NO_HUNK))
    return parse_hunk_shortlists(answers).join(counts, PULL_JOIN, "left").withColumn("error", error).drop("problem", "hunks")


def shortlisted_hunks(rows: DataFrame) -> DataFrame:
    """The numbers of the hunks that usable shortlist rows keep: org, repo, number, hunk_no."""
    return rows.filter("error is null and verdict = 'candidate'").select(*PULL_KEY, _hunk_number(F.col("hunk_id")).alias("hunk_no")).distinct()


def _annotated(answers: DataFrame) -> DataFrame:
    """Every answer in one row: ``problem`` where it is unreadable, and ``_notes``, an array of hunk_id, level1, level2, bug_desc, fix_hint."""
    path = "$.bug_info"
    rows = answers.select(*PULL_KEY, once("_value", A.parsed(A.unfenced(F.col("content")))))
    rows = rows.select("*", once("_listed", A.array_at(F.col("_value"), path)))
    blocks = F.flatten(F.transform("_listed", lambda b: F.coalesce(A.array_at(b), F.array(b))))
    fields = {
        "hunk_id": "$.hunk_id", "level1": "$.bug_type.level1", "level2": "$.bug_type.level2",
        "bug_desc": "$.bug_desc", "fix_hint": "$.fix_hint",
    }
    notes = F.transform(blocks, lambda b: F.struct(*[A.string_at(b, path).alias(name) for name, path in fields.items()]))
    # What holds a list at a path is an object: the shape of the whole is asked for only where there is none.
    problem = F.when(F.col("_listed").isNull(), F.when(A.is_object(F.col("_value")), _NO_LIST).otherwise(_NO_OBJECT))
    return rows.select(*PULL_KEY, problem.alias("problem"), once("_notes", notes))


def _unpacked(annotated: DataFrame, *kept: str) -> DataFrame:
    """A row per note, with its place in the answer, and one per unreadable answer."""
    return annotated.select(*PULL_KEY, "problem", *kept, F.posexplode_outer("_notes").alias("pos", "_note")).filter(
        "pos is not null or problem is not null").select(*PULL_KEY, "pos", "_note.*", "problem", *kept)


def parse_annotations(answers: DataFrame) -> DataFrame:
    """One row per annotated hunk: position, hunk_id, level1, level2, bug_desc, fix_hint; and one row with a ``problem`` per unreadable answer.

    An answer with a list that holds no note gives no row.
    """
    return _unpacked(_annotated(answers))


def _ranges_of(number: Column, told: Column) -> Column:
    """The changed line ranges of one hunk, one after the other, by its number; null where it changes no line. ``told`` holds the blocks by hunk
    of every diff that landed for a pull request: as a rule of one, whose blocks are in order."""
    def of(blocks: Column) -> Column:
        return F.get(blocks, F.when(number <= F.size(blocks), (number - 1).cast("int")))

    of_several = F.array_sort(F.flatten(F.filter(F.transform(told, of), lambda b: b.isNotNull())))
    found = F.when(F.size(told) == 1, of(F.get(told, 0))).otherwise(of_several)
    return F.get(F.transform(F.filter(F.array(found), lambda b: F.size(b) > 0), lambda b: F.flatten(
        F.transform(b, lambda r: F.array(r["line_start"], r["line_end"])))), 0)


def annotation_notes(answers: DataFrame, compare_diffs: DataFrame) -> DataFrame:
    """Every note of the annotation answers with the changed line ranges of its hunk (``bug_lineno``) and ``error``: null where it can be
    used, else why not. Good notes and failures are one table, to be written once and then parted.

    Diffs are cut down in their scan and parsed in place, once: a row per diff holds the blocks of its hunks, and an answer meets it in a row. Notes
    are unpacked after that. Several diffs of a pull request give their blocks to one another.
    """
    landed = Window.partitionBy(*PULL_JOIN)
    told = blocks_by_hunk(_asked_diffs(answers, compare_diffs)).select(
        *PULL_KEY, F.size("blocks").alias("hunks"), F.collect_list("blocks").over(landed).alias("_told"))
    rows = _unpacked(_annotated(answers).join(told, PULL_JOIN, "left"), "hunks", "_told")
    rows = bug_type_valid(rows.select("*", once("_number", _hunk_number(F.col("hunk_id")))))
    rows = rows.select("*", once("bug_lineno", _ranges_of(F.col("_number"), F.col("_told"))))
    error = (
        F.when(F.col("problem").isNotNull(), F.col("problem")).when(~F.col("valid"), _NO_TYPE)
        .when(~_exists(F.col("hunk_id"), F.col("hunks")), _NO_HUNK).when(F.col("bug_lineno").isNull(), _NO_LINE)
    )
    return rows.select(
        *PULL_JOIN, "hunk_id", "pos", "level1", "level2", "bug_desc", "fix_hint", "bug_lineno", error.alias("error"))


def annotation_join(notes: DataFrame) -> DataFrame:
    """``bug_info`` per pull request from usable notes: one entry per annotated hunk, in answer order."""
    entry = F.struct(
        "bug_lineno", F.struct("level1", "level2").alias("bug_type"), "bug_desc", "fix_hint"
    )
    return (
        notes.filter("error is null")
        .groupBy(*PULL_JOIN)
        .agg(F.array_sort(F.collect_list(F.struct("pos", entry.alias("entry")))).alias("entries"))
        .select(*PULL_KEY, F.transform("entries", lambda e: e["entry"]).alias("bug_info"))
    )


def annotation_failures(notes: DataFrame) -> DataFrame:
    """The notes and answers that could not be used, as rows of the shared failures table."""
    named = F.when(F.col("hunk_id").isNotNull(), F.concat(F.col("hunk_id"), F.lit(": "))).otherwise("")
    return notes.filter("error is not null").select(
        F.lit("annotation").alias("stage"), F.lit("llm").alias("kind"), repo_slug(F.col("org"), F.col("repo")).alias("repo"),
        F.col("number").alias("pr_id"), F.lit(None).cast("string").alias("rtl_file"), F.concat(named, F.col("error")).alias("error"))
