"""Registered queries: filters, ordering, deduplication and set operations."""

from pyspark.sql import functions as F

from patchloom.catalog.parts import IS_TEST, LANG, PR
from patchloom.catalog.registry import joined, query
from patchloom.catalog.views import diff_of_parts
from patchloom.functions import answers, paths
from patchloom.functions.refs import pr_text, ref_union, strip_html_comments
from patchloom.functions.text import once
from patchloom.operators import candidates, issues, materials, patches, pulls
from patchloom.operators.answering import latest_answers
from patchloom.operators.incremental import resume_anti

_FILES_BY_PR = f"(select org, repo, number, string_agg(path, ',' order by pos) filter (where {{0}}) as files, count(*) filter (where {{0}}) as n from pull_files group by {PR}) x"


def _modified(t):
    return t.view("pull_files").groupBy("org", "repo", "number").agg(
        F.array_sort(F.collect_list(F.struct("pos", "path"))).alias("f")
    ).select("org", "repo", "number", F.transform("f", lambda x: x["path"]).alias("modified_files"))


def _with_text(t):
    return t.pulls().withColumn("text", strip_html_comments(
        pr_text(F.col("title"), F.col("body"), F.col("commits.message"))))


@query("merged_only", f"select {PR} from merged", uses=("merged",))
def merged_only(t):
    return pulls.merged_only(t.view("pulls")).select("org", "repo", "number")


@query("is_test_path", f"select {PR}, path, {IS_TEST} as is_test from pull_files", uses=("pull_files",))
def is_test_path(t):
    return t.view("pull_files").select("org", "repo", "number", "path", paths.is_test_path(F.col("path")).alias("is_test"))


@query("rtl_lang", f"select {PR}, path, {LANG} as lang from pull_files", uses=("pull_files",))
def rtl_lang(t):
    return t.view("pull_files").select("org", "repo", "number", "path", paths.rtl_lang(F.col("path")).alias("lang"))


@query("rtl_files", f"select {PR}, coalesce(files, '') as rtl_files from " + _FILES_BY_PR.format(f"{LANG} is not null and not {IS_TEST}"),
       uses=("pull_files",))
def rtl_files(t):
    return _modified(t).select("org", "repo", "number", joined(candidates.rtl_files(F.col("modified_files"))).alias("rtl_files"))


@query("single_rtl_file", f"select {PR}, files as rtl_file from " + _FILES_BY_PR.format(f"{LANG} is not null and not {IS_TEST}") + " where n = 1",
       uses=("pull_files",))
def single_rtl_file(t):
    return candidates.single_rtl_file(_modified(t)).select(
        "org", "repo", "number", joined(candidates.rtl_files(F.col("modified_files"))).alias("rtl_file"))


@query("single_non_test_file", f"select {PR}, files as file from " + _FILES_BY_PR.format(f"not {IS_TEST}") + " where n = 1",
       uses=("pull_files",))
def single_non_test_file(t):
    return candidates.single_non_test_file(_modified(t)).select(
        "org", "repo", "number", joined(candidates.non_test_files(F.col("modified_files"))).alias("file"))


@query("has_base_sha", f"select {PR}, base_sha from pulls where coalesce(base_sha, '') <> ''", uses=("pulls",))
def has_base_sha(t):
    rows = t.view("pulls").withColumn("base", F.struct(F.col("base_sha").alias("sha")))
    return candidates.has_base_sha(rows).select("org", "repo", "number", F.col("base.sha").alias("base_sha"))


@query("has_fix_patch", f"select {PR}, md5(fix_patch) as fix_md5 from pr_patches where fix_patch <> ''", uses=("pr_patches",))
def has_fix_patch(t):
    rows = patches.has_fix_patch(patches.extract_patches(t.pulls(), t.diff_parts(), "files", diff_of_parts))
    return rows.select("org", "repo", "number", F.md5("fix_patch").alias("fix_md5"))


@query("has_issue_ref", f"select {PR}, issue_numbers from linked", uses=("linked",))
def has_issue_ref(t):
    rows = pulls.link_issues(pulls.merged_only(t.pulls()))
    return rows.select("org", "repo", "number", joined("issue_numbers").alias("issue_numbers"))


@query("doc_files", "select repo, commit_sha, path, length(content) as characters from docs", uses=("docs",))
def doc_files(t):
    return materials.doc_files(t.repo_files(), t.repo_config()).select(
        "repo", "commit_sha", "path", F.length("content").cast("bigint").alias("characters"))


@query("material_checks", "select repo, pr_id, rtl_file, kind, md5(case when kind is null then rtl_code end) as code_md5 from checked",
       uses=("checked",))
def material_checks(t):
    rows = materials.material_checks(t.stored_candidates, t.repo_config(), t.repo_files())
    return rows.select("repo", "pr_id", "rtl_file", "kind", F.when(F.col("kind").isNull(), F.md5("fixed_rtl_code")).alias("code_md5"))


# --- deduplication and order


@query("dedup_last_wins", """
select repo, pr_id, max(seq) as seq, arg_max(passed, seq) as passed, arg_max(reasoning, seq) as reasoning
from reviews group by repo, pr_id""", uses=("reviews",))
def dedup_last_wins(t):
    return pulls.dedup_last_wins(t.view("reviews"), ["repo", "pr_id"], ["seq"]).select("repo", "pr_id", "seq", "passed", "reasoning")


@query("head_commit", f"select {PR}, head_sha, last_message as commit_message from messages", uses=("messages",))
def head_commit(t):
    return pulls.with_head_commit(t.commits()).select("org", "repo", "number", "head_sha", "commit_message")


@query("first_issue", f"""
select l.org, l.repo, l.number, coalesce(issue_title, '') as issue_title, coalesce(issue_body, '') as issue_body
from linked l left join resolved r using ({PR})""", uses=("linked", "resolved"))
def first_issue(t):
    rows = issues.attach_issues(pulls.link_issues(pulls.merged_only(t.pulls())), t.issues())
    title, body = issues.first_issue(F.col("resolved_issues"))
    return rows.select("org", "repo", "number", title.alias("issue_title"), body.alias("issue_body"))


@query("order_desc", "select repo, pr_id, lang from candidates order by pr_id desc", uses=("candidates",))
def order_desc(t):
    rows = t.candidates().select("repo", "pr_id", "lang")
    return candidates.order_desc(rows, "pr_id")


# --- set operations


@query("ref_union", f"select {PR}, string_agg(cast(ref as string), ',' order by ref) as issue_numbers from refs group by {PR}", uses=("refs",))
def refs_of_all(t):
    rows = pulls.has_issue_ref(_with_text(t).select("*", once("issue_numbers", ref_union(F.col("text")))))
    return rows.select("org", "repo", "number", joined("issue_numbers").alias("issue_numbers"))


@query("selected_paths_valid", """
select a.repo, a.pr_id, coalesce(p.paths, '') as paths from s2_latest a left join
 (select pp.repo, pp.pr_id, string_agg(pp.p, ',' order by pp.k) as paths from last_paths pp
  join pulls u on u.org || '/' || u.repo = pp.repo and u.number = pp.pr_id
  join docs d on d.repo = pp.repo and d.commit_sha = u.merge_commit_sha and d.path = pp.p group by all) p
 on p.repo = a.repo and p.pr_id = a.pr_id
where a.stage = 'select'""", uses=("s2_latest", "last_paths", "pulls", "docs"))
def selected_paths_valid(t):
    commits = t.view("pulls").select(
        candidates.repo_slug(F.col("org"), F.col("repo")).alias("repo"), F.col("number").alias("pr_id"),
        F.col("merge_commit_sha").alias("commit_sha"))
    tocs = materials.doc_toc(materials.doc_files(t.repo_files(), t.repo_config()))
    value = answers.parsed(answers.unfenced(F.col("content")))
    rows = latest_answers(t.view("model_answers"), "select").join(commits, ["repo", "pr_id"]).join(tocs, ["repo", "commit_sha"], "left")
    chosen = answers.valid_paths(answers.selected_paths(value), F.transform("doc_toc", lambda e: e["path"]))
    return rows.select("repo", "pr_id", joined(chosen).alias("paths"))


@query("pending_issues", """
select org, repo, ref as number from (select distinct org, repo, ref from refs) r
where not exists (select 1 from issues i where i.org = r.org and i.repo = r.repo and i.number = r.ref)""", uses=("refs", "issues"))
def pending_issues(t):
    linked = pulls.link_issues(t.pulls())
    return issues.pending_issues(issues.target_issues(linked), t.issues())


@query("resume_anti", f"""
select {PR}, state from pulls p where not exists
 (select 1 from merged m where m.org = p.org and m.repo = p.repo and m.number = p.number)""", uses=("pulls", "merged"))
def resume(t):
    rows = t.view("pulls").select("org", "repo", "number", "state", "merged_at")
    return resume_anti(rows, pulls.merged_only(rows), pulls.PULL_KEY).select("org", "repo", "number", "state")


