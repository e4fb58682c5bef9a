"""Registered queries: joins, aggregates, assembly and incremental runs."""

import json

from pyspark.sql import functions as F

from patchloom import schemas
from patchloom.catalog.changes import NOTES_SQL
from patchloom.catalog.parts import PR
from patchloom.catalog.registry import joined, query
from patchloom.catalog.views import diff_of_parts
from patchloom.functions.diffs import file_entries
from patchloom.functions.refs import pr_text
from patchloom.operators import annotation, answering, issues, materials, outputs, pulls, summaries
from patchloom.operators.candidates import repo_slug
from patchloom.operators.incremental import refresh_latest, resume_anti
from patchloom.operators.patches import extract_patches, parse_diffs
from patchloom.plans import collection
from patchloom.plans.collection import collected_pulls
from patchloom.plans.construction import construct
from patchloom.session import fresh_path, materialised
from patchloom.sources import jsonl, sinks
from patchloom.streaming.arrivals import stream_dedup

_KEY = ("org", "repo", "number")


def _toc_text(column="doc_toc"):
    return F.array_join(F.transform(column, lambda e: F.concat(e["path"], F.lit("|"), e["title"])), ";")


def _selected(t, ready):
    """The last selection of every record."""
    return answering.parse_selection_answers(answering.latest_answers(t.view("model_answers"), "select"), ready)


@query("attach_issues", f"""
select l.org, l.repo, l.number, l.issue_numbers, coalesce(r.resolved, '') as resolved from linked l left join resolved r using ({PR})""",
       uses=("linked", "resolved"))
def attach_issues(t):
    """Every issue landed twice: the later row counts. What is linked is found once, for its two uses."""
    landed = t.issues().withColumn("landed", F.lit(2))
    landed = landed.unionByName(landed.withColumn("title", F.lit("earlier")).withColumn("landed", F.lit(1)))
    linked = materialised(pulls.link_issues(pulls.merged_only(t.pulls())), "linked")
    rows = issues.attach_issues(linked, landed, ["landed"])
    return rows.select(*_KEY, joined("issue_numbers").alias("issue_numbers"),
                       joined(F.transform("resolved_issues", lambda i: i["number"])).alias("resolved"))


@query("materials_join", "select repo, pr_id, lang, rtl_file, md5(rtl_code) as code_md5, toc from materials", uses=("materials",))
def materials_join(t):
    ready, _ = materials.materials_join(t.stored_candidates, t.repo_config(), t.repo_files())
    return ready.select("repo", "pr_id", "lang", "rtl_file", F.md5("fixed_rtl_code").alias("code_md5"), _toc_text().alias("toc"))


@query("spec_request_join", """
select a.repo, a.pr_id, m.rtl_file, case when m.repo is null then 'no materials for this record' end as error from s2_latest a
left join materials m using (repo, pr_id) where a.stage = 'select' and json_type(a.v) = 'OBJECT'""", uses=("s2_latest", "materials"))
def spec_request_join(t):
    selected, _ = _selected(t, t.stored_materials)
    good, failed = answering.spec_request_join(selected, t.stored_materials)
    return good.select("repo", "pr_id", "rtl_file", F.lit(None).cast("string").alias("error")).unionByName(
        failed.select("repo", "pr_id", "rtl_file", "error"))


@query("review_request_join", """
select s.repo, s.pr_id, case when c.repo is not null then s.spec end as spec, md5(c.fix_patch) as fix_md5,
 case when c.repo is not null then md5(coalesce(m.rtl_code, '')) end as code_md5, case when c.repo is null then 'no candidate for this spec' end as error
from specs s left join candidates c using (repo, pr_id) left join materials m using (repo, pr_id)""",
       uses=("specs", "candidates", "materials"))
def review_request_join(t):
    good, failed = answering.review_request_join(t.view("specs"), t.stored_candidates, t.stored_materials)
    return good.select(
        "repo", "pr_id", "spec", F.md5("fix_patch").alias("fix_md5"), F.md5("fixed_rtl_code").alias("code_md5"),
        F.lit(None).cast("string").alias("error"),
    ).unionByName(failed.select("repo", "pr_id", "error"), allowMissingColumns=True)


_ASSEMBLED = """
select r.repo, r.pr_id, r.passed, r.reasoning, r.describes_correct_behavior and r.no_patch_leakage and r.sufficient_for_diagnosis as all_checks,
 c.lang, c.rtl_file, c.commit_id, c.timestamp, c.pr_title, c.pr_body, c.merge_commit_sha, c.commit_message, s.spec,
 md5(c.fix_patch) as fix_md5, md5(coalesce(m.rtl_code, '')) as code_md5, coalesce(p.paths, '') as selected
from (select *, row_number() over (partition by repo, pr_id order by seq desc) as k from reviews) r
join candidates c using (repo, pr_id) join specs s using (repo, pr_id) left join materials m using (repo, pr_id)
left join (select pp.repo, pp.pr_id, string_agg(pp.p, ',' order by pp.k) as paths from last_paths pp join materials mm
  on mm.repo = pp.repo and mm.pr_id = pp.pr_id join docs d on d.repo = mm.repo and d.commit_sha = mm.merge_commit_sha and d.path = pp.p
  group by pp.repo, pp.pr_id) p using (repo, pr_id) where r.k = 1"""
_ASSEMBLED_USES = ("reviews", "candidates", "specs", "materials", "last_paths", "docs")


def _assembled(t):
    selected, _ = _selected(t, t.stored_materials)
    return outputs.assemble_outputs(
        t.reviews(), t.stored_candidates, t.view("specs"), t.stored_materials, selected, review_order=["seq"])


def _all_checks():
    checks = F.col("checks")
    return checks["describes_correct_behavior"] & checks["no_patch_leakage"] & checks["sufficient_for_diagnosis"]


@query("assemble_outputs", _ASSEMBLED, uses=_ASSEMBLED_USES)
def assemble_outputs(t):
    return _assembled(t).select(
        "repo", "pr_id", "passed", "reasoning", _all_checks().alias("all_checks"), "lang",
        F.get("rtl_files", 0).alias("rtl_file"), "commit_id", "timestamp", "pr_title", "pr_body", "merge_commit_sha",
        "commit_message", "spec", F.md5("fix_patch").alias("fix_md5"), F.md5("fixed_rtl_code").alias("code_md5"),
        joined("selected_doc_paths").alias("selected"))


@query("route_by_review", f"""
select case when passed then 'input' else 'queue' end as route, repo, pr_id, spec, code_md5, fix_md5 from ({_ASSEMBLED}) x""",
       uses=_ASSEMBLED_USES)
def route_by_review(t):
    inputs, queue = outputs.route_by_review(materialised(_assembled(t), "assembled"))
    one = inputs.select(F.lit("input").alias("route"), "input.repo", "input.pr_id", "input.spec",
                        F.md5("aux.fixed_rtl_code").alias("code_md5"), F.md5("aux.fix_patch").alias("fix_md5"))
    two = queue.select(F.lit("queue").alias("route"), "repo", "pr_id", F.col("generated_spec").alias("spec"),
                       F.md5("fixed_rtl_code").alias("code_md5"), F.md5("fix_patch").alias("fix_md5"))
    return one.unionByName(two)


@query("construct", """
select c.repo, c.pr_id, case when s.repo is null or r.repo is null then 'failed' when r.passed then 'input' else 'queue' end as route
from candidates c
left join (select l.repo, l.pr_id from latest l where l.stage = 'spec' and l.error is null and l.content is not null) s using (repo, pr_id)
left join (select repo, pr_id, passed from last_reviews where ok) r using (repo, pr_id)""", uses=("candidates", "latest", "last_reviews"))
def constructed(t):
    """Every candidate landed twice: where does the whole run put it?"""
    found = t.stored_candidates.withColumn("landed", F.lit(1))
    twice = found.unionByName(found.withColumn("landed", F.lit(2)))
    run = construct(twice, t.repo_config(), t.repo_files(), t.view("model_answers"), candidate_order=["landed"])
    done = run.inputs.select("input.repo", "input.pr_id", F.lit("input").alias("route")).unionByName(
        run.manual_review_queue.select("repo", "pr_id", F.lit("queue").alias("route")))
    failed = run.failures.select("repo", "pr_id").distinct().join(found.select("repo", "pr_id"), ["repo", "pr_id"], "left_semi").join(
        done, ["repo", "pr_id"], "left_anti")
    return done.unionByName(failed.withColumn("route", F.lit("failed")))


@query("final_structs", f"""
select x.repo, x.pr_id, lang, spec, timestamp, coalesce(n.bugs, 0) as bugs, merge_commit_sha, selected, code_md5 from ({_ASSEMBLED}) x
left join (select org || '/' || repo as repo, number as pr_id, count(*) as bugs from ({NOTES_SQL}) f where error is null group by all) n
 on n.repo = x.repo and n.pr_id = x.pr_id where passed""", uses=(*_ASSEMBLED_USES, "annotation_answers", "blocks", "hunk_heads"))
def final_structs(t):
    """Final records with the annotations of their pull requests; each annotation came twice, and the later one counts."""
    notes = materialised(annotation.annotation_notes(t.view("annotation_answers"), t.diffs()), "notes")
    infos = annotation.annotation_join(notes).select(
        repo_slug(F.col("org"), F.col("repo")).alias("repo"), F.col("number").alias("pr_id"), "bug_info", F.lit(2).alias("attempt"))
    twice = infos.unionByName(infos.withColumn("bug_info", F.slice("bug_info", 1, 0)).withColumn("attempt", F.lit(1)))
    path = fresh_path(t.spark, "inputs")
    records = outputs.with_bug_infos(outputs.accepted_inputs(_assembled(t)), twice, ["attempt"])
    records.write.option("ignoreNullFields", "false").json(path)
    return t.spark.read.schema(schemas.INPUTS).json(path).select(
        "input.repo", "input.pr_id", "input.lang", "input.spec", "input.timestamp", F.size("bug_info").cast("bigint").alias("bugs"),
        "aux.merge_commit_sha", joined("aux.selected_doc_paths").alias("selected"), F.md5("aux.fixed_rtl_code").alias("code_md5"))


# --- aggregates


@query("modified_files", f"""
select {PR}, string_agg(path, ',' order by f) as modified_files from
 (select {PR}, path, min(file_no) as f from file_diffs group by all) x group by {PR}""", uses=("file_diffs",))
def modified_files(t):
    paths = F.array_distinct(F.transform(file_entries(F.col("diff_text")), lambda f: f["path"]))
    return t.diffs().select(*_KEY, joined(paths).alias("modified_files"))


@query("line_totals", f"""
select {PR}, count(*) filter (where kind = '+') as lines_added, count(*) filter (where kind = '-') as lines_removed
from numbered_lines group by {PR}""", uses=("numbered_lines",))
def line_totals(t):
    return parse_diffs(t.diffs()).select(*_KEY, "lines_added", "lines_removed")


@query("fix_test_split", f"""
select p.org, p.repo, p.number, md5(coalesce(fix_patch, '')) as fix_md5, md5(coalesce(test_patch, '')) as test_md5,
 coalesce(lines_added, 0) as lines_added, coalesce(lines_removed, 0) as lines_removed from pulls p left join pr_patches using ({PR})""", uses=("pulls", "pr_patches"))
def fix_test_split(t):
    rows = extract_patches(t.pulls(), t.diff_parts(), "files", diff_of_parts)
    return rows.select(*_KEY, F.md5("fix_patch").alias("fix_md5"), F.md5("test_patch").alias("test_md5"), "lines_added", "lines_removed")


@query("target_issues", "select distinct org, repo, ref as number from refs", uses=("refs",))
def target_issues(t):
    return issues.target_issues(pulls.link_issues(t.pulls()))


@query("doc_toc", "select repo, commit_sha, toc from tocs", uses=("tocs",))
def doc_toc(t):
    """Titles are found once for each content of a document."""
    return materials.contents_lists(materials.doc_entries(t.repo_files(), t.repo_config())).select("repo", "commit_sha", _toc_text().alias("toc"))


@query("stage_funnel", """
select 'pulls' as stage, count(*) filter (where json_valid(value) and left(value, 1) <> '[') as loaded,
 count(*) filter (where not json_valid(value) or left(value, 1) = '[') as bad,
 count(*) filter (where json_valid(value) and left(value, 1) <> '[') as written, 0 as failed from dump_lines where trim(value) <> ''
union all select 'materials', count(*), 0, count(*) filter (where kind is null), count(*) filter (where kind is not null) from checked
union all select 'review', count(*), 0, count(*) filter (where ok), count(*) filter (where not ok) from last_reviews
union all select 'select', count(*), 0, count(*) filter (where json_type(v) = 'OBJECT'), count(*) filter (where v is null or json_type(v) <> 'OBJECT')
from s2_latest where stage = 'select'""", uses=("dump_lines", "checked", "last_reviews", "s2_latest"))
def stage_funnel(t):
    """Four stages, each written once; their numbers are taken from the writes."""
    counts = summaries.StageCounts()
    lines = jsonl.with_records(t.view("dump_lines").select("value"), "number bigint, state string, title string")
    lines = counts.seen("pulls", lines, loaded=~F.col("broken"), bad=F.col("broken"), written=~F.col("broken"))
    materialised(lines.filter(~F.col("broken")).select("_r.number", "_r.state", "_r.title"), "pulls")
    t.stored_stages(counts)
    return counts.table(t.spark)


@query("run_summary", """
select org, repo, cast(1 as bigint) as total, cast(1 - bad as bigint) as success, cast(bad as bigint) as failures
from (select org, repo, max(case when base_sha is null and number % 5 = 4 then 1 else 0 end) as bad from pulls group by org, repo) x
union all select null, null, count(*), cast(sum(1 - bad) as bigint), cast(sum(bad) as bigint)
from (select org, repo, max(case when base_sha is null and number % 5 = 4 then 1 else 0 end) as bad from pulls group by org, repo) y""", uses=("pulls",))
def run_summary(t):
    code = F.when(F.col("base_sha").isNull() & (F.col("number") % 5 == 4), 1).otherwise(0)
    return summaries.run_summary(t.view("pulls").select("org", "repo", code.alias("return_code")))


_PAGES = "select org, repo, number as id, state, 1 as page from pulls union all select org, repo, number, 'closed', 2 from pulls where state = 'open'"


@query("dedup_report", f"""
select org, repo, count(*) as fetched, count(distinct id) as distinct_pulls from ({_PAGES}) x group by org, repo""", uses=("pulls",))
def dedup_report(t):
    pages = t.view("pulls").select("org", "repo", F.col("number").alias("id"), "state")
    return pulls.dedup_report(pages.unionByName(pages.filter("state = 'open'")))


@query("review_consistency", """
select repo, pr_id, seq, passed, describes_correct_behavior and no_patch_leakage and sufficient_for_diagnosis as all_checks,
 passed = (describes_correct_behavior and no_patch_leakage and sufficient_for_diagnosis) as consistent from reviews""", uses=("reviews",))
def review_consistency(t):
    return outputs.review_consistency(t.reviews()).select("repo", "pr_id", "seq", "passed", "all_checks", "consistent")


# --- incremental runs


@query("resume_append", f"""
select {PR}, case when merged_at is not null then 'first' else 'second' end as run from pulls""", uses=("pulls",))
def resume_append(t):
    path = fresh_path(t.spark, "resumed")
    rows = t.view("pulls").select(*_KEY, "state", "merged_at")
    schema = "org string, repo string, number bigint, run string"
    sinks.write_stage(pulls.merged_only(rows).select(*_KEY, F.lit("first").alias("run")), path)
    done = t.spark.read.schema(schema).parquet(path)
    new = resume_anti(rows.select(*_KEY, F.lit("second").alias("run")), done, pulls.PULL_KEY)
    sinks.write_stage(new, path, resume=True)
    return t.spark.read.schema(schema).parquet(path).select(*_KEY, "run")


@query("resumed_candidates", """
select repo, pr_id, lang, issue_title, md5(fix_patch) as fix_md5, lines_added from candidates""", uses=("candidates",))
def resumed_candidates(t):
    """Three runs over what has landed: pull requests with a body, all, all again; together they give what one run gives."""
    folder, found, compared = fresh_path(t.spark, "candidates"), materialised(t.pulls(), "pulls"), materialised(t.diffs(), "diffs")
    for run, landed in (("1", found.filter("body is not null")), ("2", found), ("3", found)):
        rows = collection.resumed_candidates(landed, t.issues(), compared, folder, run)
    return rows.select("repo", "pr_id", "lang", "issue_title", F.md5("fix_patch").alias("fix_md5"), "lines_added")


@query("refresh_latest", f"select {PR}, case when state = 'open' then 'merged' else state end as state from pulls", uses=("pulls",))
def refresh(t):
    rows = t.view("pulls").select(*_KEY, "state", F.lit(1).alias("updated_at"))
    later = rows.filter("state = 'open'").withColumn("state", F.lit("merged")).withColumn("updated_at", F.lit(2))
    return refresh_latest(rows, later, pulls.PULL_KEY, ["updated_at"]).select(*_KEY, "state")


@query("collected_pulls", f"""
select {PR}, case when state = 'open' then 'closed' else state end as state from pulls p
where merged_at is null or exists (select 1 from messages m where m.number = p.number)""", uses=("pulls", "messages"))
def collected(t):
    first = t.pulls().withColumn("id", F.col("number")).withColumn("page", F.lit(1))
    second = first.filter("state = 'open'").withColumn("state", F.lit("closed")).withColumn("page", F.lit(2))
    return collected_pulls(first.unionByName(second), ["page"]).select(*_KEY, "state")


@query("stream_dedup", f"select {PR} from pulls", uses=("pulls",))
def streamed(t):
    """Two arrivals: all pull requests with broken lines between them, then the open ones again."""
    folder, sink, checkpoint = (fresh_path(t.spark, n) for n in ("arrivals", "sink", "checkpoint"))
    schema = "org string, repo string, number bigint, state string"
    records = t.view("pulls").select(F.to_json(F.struct(*_KEY, "state")).alias("value"))
    broken = t.view("dump_lines").filter("value not like '%}'").select("value")
    for lines in (records.unionByName(broken), records.filter("value like '%open%'")):
        lines.write.mode("append").text(folder)
        stream_dedup(t.spark, folder, schema, list(_KEY), sink, checkpoint).awaitTermination()
    return t.spark.read.schema(schema).parquet(sink).select(*_KEY)


def _pure_client():
    """Stands for a model: answers with the request's length, refuses the longest ones."""

    def answer(request: str) -> str:
        if len(request) % 10 == 9:
            raise ValueError("request refused")
        return json.dumps({"length": len(request)})

    return answer


@query("answer_requests", """
select 'refs' as stage, org || '/' || repo as repo, number as pr_id, case when length(text) % 10 <> 9 then '{"length": ' || cast(length(text) as string) || '}' end as content,
 case when length(text) % 10 = 9 then 'request refused' end as error from texts""", uses=("texts",))
def answer_requests(t):
    text = pr_text(F.col("title"), F.col("body"), F.col("commits.message"))
    requests = t.pulls().select(
        repo_slug(F.col("org"), F.col("repo")).alias("repo"), F.col("number").alias("pr_id"), text.alias("request"))
    return answering.answer_requests(requests, "refs", _pure_client).drop("attempt")
