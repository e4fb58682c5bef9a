"""Materials, requests, reviews and routing on literal rows."""

import json

import pytest
from pyspark.sql import functions as F

from patchloom import fixed, schemas
from patchloom.operators import annotation, answering, materials, outputs
from patchloom.plans.construction import construct, finished

SHA = "c" * 40


def _candidate(pr_id, repo="o/r", **over):
    row = dict(repo=repo, pr_id=pr_id, lang="sv", rtl_files=["rtl/a.sv"], commit_id="b", timestamp="t", pr_title=" Title ", pr_body="",
               merge_commit_sha=SHA, issue_title="I", issue_body=" ", commit_message="msg", fix_patch="P", test_patch="", modified_files=["rtl/a.sv"],
               lines_added=1, lines_removed=0)
    return tuple((row | over).values())


@pytest.fixture(scope="module")
def config(spark):
    return spark.createDataFrame([("o/r", "u", ["doc"], "rtl", [".sv"])], schemas.REPO_CONFIG)


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame([
        ("o/r", SHA, "rtl/a.sv", "module a;"), ("o/r", SHA, "doc/z.rst", "Zed\n==="), ("o/r", SHA, "doc/a.md", "# Alpha\ntext"),
        ("o/r", SHA, "doc/gone.md", None), ("o/r", SHA, "other/b.md", "# B"), ("o/r", "d" * 40, "doc/old.md", "# Old"),
        ("q/q", SHA, "rtl/a.sv", "module q;")], schemas.REPO_FILES)


@pytest.fixture(scope="module")
def found(spark):
    return spark.createDataFrame([
        _candidate(1), _candidate(2, rtl_files=["rtl/none.sv"]), _candidate(3, rtl_files=[]), _candidate(4, merge_commit_sha=""),
        _candidate(5, repo="q/q"), _candidate(6, lang=None)], schemas.CANDIDATES)


def test_materials(found, config, files):
    ready, failed = materials.materials_join(found, config, files)
    rows = {r.pr_id: r for r in ready.collect()}
    assert set(rows) == {1, 6}
    assert rows[1].fixed_rtl_code == "module a;" and rows[6].lang == "sv"
    assert [tuple(e) for e in rows[1].doc_toc] == [("doc/a.md", "Alpha"), ("doc/z.rst", "Zed")]
    assert {(r.pr_id, r.kind, r.rtl_file) for r in failed.collect()} == {
        (2, "read", "rtl/none.sv"), (3, "checkout", None), (4, "checkout", None), (5, "checkout", None)}


def test_contents_with_texts(config, files):
    row = materials.doc_toc(materials.doc_files(files, config), with_texts=True).filter(F.col("commit_sha") == SHA).first()
    assert row.doc_full_texts == {"doc/a.md": "# Alpha\ntext", "doc/z.rst": "Zed\n==="}


def test_official_specs(spark, found, config, files):
    ready, _ = materials.materials_join(found, config, files)
    chosen = spark.createDataFrame([("o/r", 1, ["doc/z.rst", "doc/none.md", "doc/a.md"], ""), ("o/r", 6, [], "")], schemas.SELECTED_DOCS)
    rows = {r.pr_id: r.official_spec for r in materials.official_specs(chosen, ready, files).collect()}
    assert rows == {1: "### doc/z.rst\n\nZed\n===\n\n### doc/none.md\n\n\n\n### doc/a.md\n\n# Alpha\ntext", 6: "None"}


def test_requests_hold_their_slots(spark, found, config, files):
    ready, _ = materials.materials_join(found, config, files)
    text = answering.selection_requests(ready).filter("pr_id = 1").first().request
    assert all(x in text for x in ("o/r", "rtl/a.sv", "module a;", "- doc/a.md: Alpha", '"selected_doc_paths"'))
    specs = spark.createDataFrame([("o/r", 1, "S"), ("o/r", 2, "S2"), ("o/r", 77, "S3")], schemas.SPECS)
    asked, failed = answering.review_requests(specs, found, ready)
    rows = {r.pr_id: r.request for r in asked.collect()}
    assert set(rows) == {1, 2}
    assert "#### PR Title\nTitle\n\n#### Issue Title\nI\n\n#### Commit Message\nmsg" in rows[1] and "module a;" in rows[1]
    assert "module a;" not in rows[2]
    assert [(r.pr_id, r.error) for r in failed.collect()] == [(77, fixed.MISSING_CANDIDATE)]
    chosen = spark.createDataFrame([("o/r", 1, ["doc/a.md"], ""), ("o/r", 5, [], "")], schemas.SELECTED_DOCS)
    asked, failed = answering.spec_requests(chosen, ready, files)
    text = asked.collect()[0].request
    assert '["rtl/a.sv"]' in text and "### doc/a.md" in text and "incorrectly, broken" in text
    assert [(r.pr_id, r.error) for r in failed.collect()] == [(5, fixed.MISSING_MATERIALS)]


def test_no_evidence_gives_a_fixed_sentence(spark):
    from patchloom.functions.requests import pr_contexts
    row = spark.createDataFrame([(" ", None, "", "\n", None)], ", ".join(f"{n} string" for _, n in fixed.PR_CONTEXT_SECTIONS))
    assert row.select(pr_contexts({n: F.col(n) for _, n in fixed.PR_CONTEXT_SECTIONS})).first()[0] == fixed.EMPTY_PR_CONTEXT


def test_whole_construction(spark, found, config, files):
    ok = {c: True for c in fixed.REVIEW_CHECKS}
    answers = [
        ("select", "o/r", 1, 1, json.dumps({"selected_doc_paths": ["doc/a.md"], "reason": "r"}), None), ("select", "o/r", 6, 1, "[]", None),
        ("spec", "o/r", 1, 1, "Spec 1", None), ("spec", "o/r", 2, 1, "Spec 2", None), ("spec", "o/r", 9, 1, "Spec 9", None), ("spec", "o/r", 6, 1, None, "timeout"),
        ("review", "o/r", 1, 1, json.dumps({"passed": False}), None), ("review", "o/r", 1, 2, json.dumps({"passed": True, "checks": ok, "reasoning": "y"}), None),
        ("review", "o/r", 2, 1, json.dumps({"passed": False, "reasoning": "n"}), None), ("review", "o/r", 6, 1, json.dumps({"passed": True}), None)]
    run = construct(found, config, files, spark.createDataFrame(answers, schemas.MODEL_ANSWERS))
    accepted = [r.asDict(recursive=True) for r in run.inputs.collect()]
    assert accepted == [{
        "input": dict(repo="o/r", pr_id=1, lang="sv", rtl_files=["rtl/a.sv"], spec="Spec 1", commit_id="b", timestamp="t"), "bug_info": [],
        "aux": dict(merge_commit_sha=SHA, pr_title=" Title ", pr_body="", issue_title="I", issue_body=" ", commit_message="msg", fix_patch="P",
                    fixed_rtl_code="module a;", selected_doc_paths=["doc/a.md"])}]
    queue = [r.asDict(recursive=True) for r in run.manual_review_queue.collect()]
    assert queue == [dict(
        repo="o/r", pr_id=2, review_result=dict(passed=False, checks={c: False for c in fixed.REVIEW_CHECKS}, reasoning="n"),
        generated_spec="Spec 2", fixed_rtl_code="", pr_title=" Title ", pr_body="", fix_patch="P")]
    # Passed, queued and dropped records (no spec or no candidate) add up to the reviews.
    assert len(accepted) + len(queue) + 1 == run.reviews.count()
    assert {(r.stage, r.pr_id) for r in run.failures.collect()} == {
        ("materials", 2), ("materials", 3), ("materials", 4), ("materials", 5), ("select", 6), ("spec", 6), ("review", 9)}
    # every candidate is accounted for
    seen = {r["input"]["pr_id"] for r in accepted} | {r["pr_id"] for r in queue} | {r.pr_id for r in run.failures.collect()}
    assert seen >= {r.pr_id for r in found.collect()}


def test_repeated_and_unanswered_candidates(spark, found, config, files):
    ok = json.dumps({"passed": True, "checks": {c: True for c in fixed.REVIEW_CHECKS}})
    answers = [("spec", "o/r", 1, 1, "Spec 1", None), ("review", "o/r", 1, 1, ok, None), ("spec", "o/r", 6, 1, "Spec 6", None)]
    twice = found.withColumn("landed", F.lit(1)).unionByName(found.withColumn("landed", F.lit(2)).withColumn("pr_title", F.lit("later")))
    run = construct(twice, config, files, spark.createDataFrame(answers, schemas.MODEL_ANSWERS), candidate_order=["landed"])
    assert [(r.input.pr_id, r.aux.pr_title) for r in run.inputs.collect()] == [(1, "later")]
    assert ("spec", 6, "a step was never answered") in {(r.stage, r.pr_id, r.error) for r in run.failures.collect()}


def test_consistency(spark):
    rows = spark.createDataFrame([("o/r", 1, True, (True, True, True), ""), ("o/r", 2, True, (True, None, True), ""), ("o/r", 3, False, (False,) * 3, "")], schemas.REVIEWS)
    assert {r.pr_id: r.consistent for r in outputs.review_consistency(rows).collect()} == {1: True, 2: False, 3: True}


# --- annotation

DIFF = "diff --git a/a.v b/a.v\n--- a/a.v\n+++ b/a.v\n@@ -5,4 +5,5 @@\n x\n-old_sig <= 1;\n y\n+new_sig <= 0;\n z\n@@ -30 +31 @@\n-p\n+q\n"


def _notes(*blocks):
    return json.dumps({"bug_info": [list(blocks)]})


def _note(hunk, one, two, desc="d"):
    return {"hunk_id": hunk, "bug_type": {"level1": one, "level2": two}, "bug_desc": desc, "fix_hint": "f"}


def test_annotation(spark):
    diffs = spark.createDataFrame([("o", "r", 1, DIFF)], schemas.COMPARE_DIFFS)
    content = _notes(_note("HUNK_2", *fixed.BUG_TYPES[7], desc="late"), _note("HUNK_1", *fixed.BUG_TYPES[2]), _note("HUNK_9", *fixed.BUG_TYPES[0]),
                     _note("HUNK_1", "Functional Bug", "Syntax Error"), _note("HUNK_1", 3, "Syntax Error"))
    answers = spark.createDataFrame([("o", "r", 1, content)], "org string, repo string, number bigint, content string")
    answers = answers.unionByName(spark.createDataFrame(
        [("o", "r", 2, "no json"), ("o", "r", 3, "[1]"), ("o", "r", 4, '{"bug_info": 3}'), ("o", "r", 5, '{"bug_info": []}'), ("o", "r", 6, None)], answers.schema))
    notes = annotation.annotation_notes(answers, diffs).cache()
    row = annotation.annotation_join(notes).first()
    assert [(b.bug_lineno, tuple(b.bug_type), b.bug_desc) for b in row.bug_info] == [
        ([30, 30], fixed.BUG_TYPES[7], "late"), ([6, 6, 7, 7], fixed.BUG_TYPES[2], "d")]
    # every note and every answer is either used or has its reason
    assert sorted((r.number, r.pos, r.error) for r in notes.filter("number = 1").collect()) == [
        (1, 0, None), (1, 1, None), (1, 2, "hunk not in the diff"), (1, 3, "bug type not allowed"), (1, 4, "bug type not allowed")]
    assert {(r.number, r.error) for r in notes.filter("number > 1").collect()} == {
        (2, "answer has the wrong shape"), (3, "answer has the wrong shape"), (4, "answer lists nothing"), (6, "answer has the wrong shape")}
    failed = annotation.annotation_failures(notes)
    assert notes.count() == 2 + failed.count() and failed.columns == [c.split()[0] for c in schemas.FAILURES.split(", ")]
    assert ("o/r", 1, "HUNK_9: hunk not in the diff") in {(r.repo, r.pr_id, r.error) for r in failed.collect()}
    valid = annotation.bug_type_valid(annotation.parse_annotations(answers)).filter("problem is null").orderBy("pos").collect()
    assert [r.valid for r in valid] == [True, True, True, False, False]


def test_shortlists(spark):
    diffs = spark.createDataFrame([("o", "r", 1, DIFF)], schemas.COMPARE_DIFFS)
    content = json.dumps({"candidate_root_cause_hunks": [{"hunk_ids": ["HUNK_1", 4, "HUNK_7"], "reason": "a"}], "filtered_non_root_cause_hunks": [{"hunk_ids": ["HUNK_2"]}]})
    answers = spark.createDataFrame([("o", "r", 1, content), ("o", "r", 2, "oops")], "org string, repo string, number bigint, content string")
    rows = annotation.hunk_shortlists(answers, diffs)
    assert {(r.number, r.verdict, r.hunk_id, r.reason, r.error) for r in rows.collect()} == {
        (1, "candidate", "HUNK_1", "a", None), (1, "filtered", "HUNK_2", None, None), (1, "candidate", "HUNK_7", "a", "hunk not in the diff"),
        (1, "candidate", "4", "a", "hunk not in the diff"), (2, None, None, None, "answer has the wrong shape")}
    assert [(r.number, r.hunk_no) for r in annotation.shortlisted_hunks(rows).collect()] == [(1, 1)]


def test_notes_on_a_hunk_without_changes(spark):
    diffs = spark.createDataFrame([("o", "r", 1, "diff --git a/a.v b/a.v\n--- a/a.v\n+++ b/a.v\n@@ -5 +5 @@\n x\n")], schemas.COMPARE_DIFFS)
    answers = spark.createDataFrame([("o", "r", 1, _notes(_note("HUNK_1", *fixed.BUG_TYPES[0])))], "org string, repo string, number bigint, content string")
    assert [r.error for r in annotation.annotation_notes(answers, diffs).collect()] == ["hunk changes no line"]


def test_annotations_replace_what_a_record_held(spark):
    info = lambda text: [([1, 2], ("a", "b"), text, "f")]
    record = lambda i, held: (("o/r", i, "sv", [], "s", "c", "t"), held, tuple([""] * 8 + [[]]))
    inputs = spark.createDataFrame([record(1, []), record(2, info("old")), record(3, info("old"))], schemas.INPUTS)
    infos = spark.createDataFrame(
        [("o/r", 1, info("first"), 1), ("o/r", 1, info("last"), 2), ("o/r", 3, info("new"), 1), ("o/q", 2, info("other"), 1)],
        f"repo string, pr_id bigint, bug_info array<{schemas.BUG_INFO}>, attempt int")
    rows = {r.input.pr_id: [b.bug_desc for b in r.bug_info] for r in outputs.with_bug_infos(inputs, infos, ["attempt"]).collect()}
    assert rows == {1: ["last"], 2: ["old"], 3: ["new"]}


def test_requests_about_hunks(spark):
    found = spark.createDataFrame([_candidate(1, fix_patch=DIFF), _candidate(2, fix_patch=DIFF, commit_id="gone")], schemas.CANDIDATES)
    base = spark.createDataFrame([("o/r", "b", "rtl/a.sv", "module before;"), ("o/r", "z", "rtl/a.sv", "no")], schemas.REPO_FILES)
    asked = {r.pr_id: r.request for r in answering.shortlist_requests(found, base).collect()}
    assert "module before;" in asked[1] and "module before;" not in asked[2] and '{"HUNK_2":"@@ -30 +31 @@' in asked[1] and "Title" in asked[1]
    confirmed = spark.createDataFrame([("o/r", 1, 2), ("o/r", 1, 1), ("o/r", 9, 1)], "repo string, pr_id bigint, hunk_no bigint")
    specs = spark.createDataFrame([("o/r", 1, "It must hold."), ("o/r", 2, "S")], schemas.SPECS)
    rows = answering.annotation_requests(confirmed, found, specs, base).collect()
    assert [r.pr_id for r in rows] == [1]
    text = rows[0].request
    assert "It must hold." in text and text.index('{"hunk_id":"HUNK_1"') < text.index('{"hunk_id":"HUNK_2","root_cause_code":"@@ -30 +31 @@')
    assert all(f"- {a} / {b}" in text for a, b in fixed.BUG_TYPES)


def test_a_finished_record_is_not_taken_up_again(spark, found, config, files):
    ok = json.dumps({"passed": True, "checks": {c: True for c in fixed.REVIEW_CHECKS}})
    landed = [("spec", "o/r", 1, 1, "Spec 1", None), ("review", "o/r", 1, 1, ok, None)]
    table = lambda rows: spark.createDataFrame(rows, schemas.MODEL_ANSWERS)
    first = construct(found, config, files, table(landed))
    done = finished(first)
    assert [tuple(r) for r in done.collect()] == [("o/r", 1)]
    landed += [("spec", "o/r", 6, 1, "Spec 6", None), ("review", "o/r", 6, 1, ok, None)]
    second = construct(found, config, files, table(landed), done=done)
    assert [r.input.pr_id for r in second.inputs.collect()] == [6] and 1 not in {r.pr_id for r in second.materials.collect()}
    assert 1 not in {r.pr_id for r in second.failures.collect()}
    whole = construct(found, config, files, table(landed))
    both = first.inputs.unionByName(second.inputs)
    assert sorted(map(str, both.collect())) == sorted(map(str, whole.inputs.collect()))
    third = construct(found, config, files, table(landed), done=done.unionByName(finished(second)))
    assert third.inputs.count() == 0 and third.materials.count() == 0


def test_leakage(spark):
    patches = spark.createDataFrame([_candidate(1, fix_patch=DIFF), _candidate(2, fix_patch=DIFF)], schemas.CANDIDATES)
    specs = spark.createDataFrame([("o/r", 1, "It sets new_sig and old_sig; x y begin"), ("o/r", 2, "Must hold x")], schemas.SPECS)
    rows = {r.pr_id: (r.leaked, r.no_patch_leakage) for r in annotation.patch_leakage(specs, patches).collect()}
    assert rows == {1: (["new_sig", "old_sig"], False), 2: ([], True)}


def test_spec_words(spark):
    from helpers import values
    from patchloom.functions import gates
    given = ["It MUST hold", "mustard shallow shoulder", "fixed, Bug; debugged unfixed bug", ""]
    assert values(spark, given, gates.uses_normative_words) == [True, False, False, False]
    assert values(spark, given, gates.banned_word_count) == [0, 0, 3, 0]
