"""Registered queries: text, regex, JSON and document functions."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom import fixed
from patchloom.catalog.parts import IS_TEST, PR
from patchloom.catalog.registry import joined, query
from patchloom.functions import answers, refs, titles
from patchloom.functions import requests as R
from patchloom.functions.text import once
from patchloom.operators import annotation, answering, candidates, materials
from patchloom.operators.pulls import link_answered_issues

_KEY = ("org", "repo", "number")


def _text(t):
    return t.pulls().select(*_KEY, refs.pr_text(
        F.col("title"), F.col("body"), F.col("commits.message")).alias("text"))


@query("pr_text", f"select {PR}, md5(text) as text_md5, length(text) as characters from texts", uses=("texts",))
def pr_text(t):
    return _text(t).select(*_KEY, F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("characters"))


@query("strip_html_comments", """
select page_id, md5(regexp_replace(html, '(?s)<!--.*?-->', '', 'g')) as html_md5,
 length(html) - length(regexp_replace(html, '(?s)<!--.*?-->', '', 'g')) as dropped from pages""")
def strip_html_comments(t):
    bare = refs.strip_html_comments(F.col("html"))
    return t.driver("pages").select(
        "page_id", F.md5(bare).alias("html_md5"), (F.length("html") - F.length(bare)).cast("bigint").alias("dropped"))


@query("keyword_issue_refs", f"""
select {PR}, string_agg(cast(ref as string), ',' order by seq) as refs from keyword_refs where ref > 0 group by {PR}""",
       uses=("keyword_refs",))
def keyword_issue_refs(t):
    found = refs.keyword_issue_refs(refs.strip_html_comments(F.col("text")))
    return _text(t).select("*", once("r", found)).filter(F.size("r") > 0).select(*_KEY, joined("r").alias("refs"))


@query("url_issue_refs", f"""
select {PR}, string_agg(cast(ref as string), ',') as refs from url_refs where ref > 0 group by {PR}""", uses=("url_refs",))
def url_issue_refs(t):
    found = refs.url_issue_refs(refs.strip_html_comments(F.col("text")))
    return _text(t).select("*", once("r", found)).filter(F.size("r") > 0).select(*_KEY, joined("r").alias("refs"))


@query("parse_issue_answer", """
select a.stage, a.repo, a.pr_id, a.attempt, case when json_type(a.v) in ('OBJECT', 'ARRAY') then coalesce(x.issues, '') end as issues
from s1_json a left join (select stage, repo, pr_id, attempt, string_agg(n, ',' order by k) as issues from (
 select distinct on (stage, repo, pr_id, attempt, n) * from (
  select stage, repo, pr_id, attempt, k, trim(e->>'$') as n from (
   select *, unnest(es) as e, generate_subscripts(es, 1) as k from (select *, case json_type(v) when 'ARRAY' then v->'$[*]' else v->'$.issues[*]' end as es from s1_json) w) y
  where json_type(e) in ('VARCHAR', 'UBIGINT', 'BIGINT')) z where regexp_matches(n, '^0*[1-9][0-9]*$')
  order by stage, repo, pr_id, attempt, n, k) q group by all) x
 on x.stage = a.stage and x.repo = a.repo and x.pr_id = a.pr_id and x.attempt = a.attempt""", uses=("s1_json",))
def parse_issue_answer(t):
    rows = answering.parse_issue_answers(t.view("model_answers"))
    return rows.select("stage", "repo", "pr_id", "attempt", joined("issues").alias("issues"))


@query("link_answered_issues", """
select p.org, p.repo, p.number, string_agg(cast(n as string), ',' order by n) as issue_numbers from merged p join (
 select distinct repo, pr_id, cast(trim(e->>'$') as bigint) as n from (
  select repo, pr_id, unnest(case json_type(v) when 'ARRAY' then v->'$[*]' else v->'$.issues[*]' end) as e from s1_json
   join (select stage, repo, pr_id, attempt from latest where stage = 'refs') l using (stage, repo, pr_id, attempt)) y
 where json_type(e) in ('VARCHAR', 'UBIGINT', 'BIGINT') and regexp_matches(trim(e->>'$'), '^0*[1-9][0-9]*$')) a
 on a.repo = p.org || '/' || p.repo and a.pr_id = p.number group by all""", uses=("merged", "s1_json", "latest"))
def answered(t):
    rows = answering.parse_issue_answers(answering.latest_answers(t.view("model_answers"), "refs"))
    slug = F.split("repo", "/", 2)
    keyed = rows.select(slug[0].alias("org"), slug[1].alias("repo"), F.col("pr_id").alias("number"), "issues")
    merged = t.view("pulls").filter("state = 'closed' and merged_at is not null").select(*_KEY)
    return link_answered_issues(merged, keyed).select(*_KEY, joined("issue_numbers").alias("issue_numbers"))


@query("strip_code_fence", """
select a.stage, a.repo, a.pr_id, a.attempt, a.j as first_block, b.j as whole_block from s1_json a
join s2_json b on a.stage = b.stage and a.repo = b.repo and a.pr_id = b.pr_id and a.attempt = b.attempt""", uses=("s1_json", "s2_json"))
def strip_code_fence(t):
    return t.view("model_answers").select(
        "stage", "repo", "pr_id", "attempt", answers.fenced_block(F.col("content")).alias("first_block"),
        answers.unfenced(F.col("content")).alias("whole_block"))


@query("parse_selection_answer", """
select a.stage, a.repo, a.pr_id, a.attempt, coalesce(json_type(v) = 'OBJECT', false) as readable,
 case when json_type(v) = 'OBJECT' then coalesce(p.paths, '') end as paths,
 case when json_type(v) = 'OBJECT' then coalesce(v->>'$.reason', '') end as reason
from s2_json a left join (select stage, repo, pr_id, attempt, string_agg(p, ',' order by k) as paths from parsed_paths group by all) p
 on p.stage = a.stage and p.repo = a.repo and p.pr_id = a.pr_id and p.attempt = a.attempt""", uses=("s2_json", "parsed_paths"))
def parse_selection_answer(t):
    rows = t.view("model_answers").select("*", once("v", answers.parsed(answers.unfenced(F.col("content")))))
    good = answers.is_object(F.col("v"))
    return rows.select(
        "stage", "repo", "pr_id", "attempt", good.alias("readable"),
        F.when(good, joined(F.array_distinct(answers.selected_paths(F.col("v"))))).alias("paths"),
        F.when(good, answers.selection_reason(F.col("v"))).alias("reason"))


@query("parse_review_answer", f"""
select repo, pr_id, attempt, passed, {", ".join(fixed.REVIEW_CHECKS)}, reasoning from parsed_reviews where stage = 'review' and ok""",
       uses=("parsed_reviews",))
def parse_review_answer(t):
    rows = t.view("model_answers").filter("stage = 'review'").select("*", once("v", answers.parsed(answers.unfenced(F.col("content")))))
    v = F.col("v")
    return rows.filter(F.col("error").isNull() & answers.review_is_readable(v)).select(
        "repo", "pr_id", "attempt", answers.truthy(answers.at(v, "$.passed")).alias("passed"),
        answers.review_checks(v).alias("c"), answers.review_reasoning(v).alias("reasoning")
    ).select("repo", "pr_id", "attempt", "passed", "c.*", "reasoning")


@query("md_title", "select f.repo, f.commit_sha, f.path, m.title from repo_files f left join md_titles m using (repo, commit_sha, path)",
       uses=("repo_files", "md_titles"))
def md_title(t):
    return t.repo_files().select("repo", "commit_sha", "path", titles.md_title(F.col("content")).alias("title"))


@query("rst_title", "select repo, commit_sha, path, title from rst_titles", uses=("rst_titles",))
def rst_title(t):
    return t.repo_files().select("repo", "commit_sha", "path", titles.rst_title(F.col("content")).alias("title"))


@query("doc_title", "select repo, commit_sha, path, title from doc_titles", uses=("doc_titles",))
def doc_title(t):
    return t.repo_files().select("repo", "commit_sha", "path", titles.doc_title(F.col("path"), F.col("content")).alias("title"))


@query("format_doc_toc", "select repo, pr_id, md5(toc_text) as toc_md5 from materials", uses=("materials",))
def format_doc_toc(t):
    ready, _ = materials.materials_join(t.stored_candidates, t.repo_config(), t.repo_files())
    return ready.select("repo", "pr_id", F.md5(titles.format_doc_toc(F.col("doc_toc"))).alias("toc_md5"))


_SELECTED = """
select a.repo, a.pr_id, string_agg('### ' || p.p || chr(10) || chr(10) || coalesce(f.content, ''), chr(10) || chr(10) order by p.k) as spec
from s2_latest a left join last_paths p on p.repo = a.repo and p.pr_id = a.pr_id
left join pulls u on u.org || '/' || u.repo = a.repo and u.number = a.pr_id
left join repo_files f on f.repo = a.repo and f.commit_sha = u.merge_commit_sha and f.path = p.p
where a.stage = 'select' and json_type(v) = 'OBJECT' group by a.repo, a.pr_id, u.merge_commit_sha"""


@query("format_official_spec", f"""
select repo, pr_id, coalesce(md5(case when spec like '### %' then spec end), md5('None')) as spec_md5, coalesce(length(case when spec like '### %' then spec end), 4) as characters
from ({_SELECTED}) x""", uses=("s2_latest", "last_paths", "pulls", "repo_files"))
def format_official_spec(t):
    value = answers.parsed(answers.unfenced(F.col("content")))
    chosen = answering.latest_answers(t.view("model_answers"), "select").select("*", once("v", value)).filter(answers.is_object(F.col("v"))).select(
        "repo", "pr_id", F.array_distinct(answers.selected_paths(F.col("v"))).alias("selected_doc_paths"))
    commits = t.view("pulls").select(
        candidates.repo_slug(F.col("org"), F.col("repo")).alias("repo"), F.col("number").alias("pr_id"), "merge_commit_sha")
    spec = materials.official_specs(chosen, commits, t.repo_files())
    return spec.select("repo", "pr_id", F.md5("official_spec").alias("spec_md5"),
                       F.length("official_spec").cast("bigint").alias("characters"))


@query("pr_contexts", """
select repo, pr_id, concat_ws(chr(10) || chr(10), case when trim(pr_title) <> '' then '#### PR Title' || chr(10) || trim(pr_title) end,
 case when trim(pr_body) <> '' then '#### PR Body' || chr(10) || trim(pr_body) end,
 case when issue_title <> '' then '#### Issue Title' || chr(10) || issue_title end,
 case when issue_body <> '' then '#### Issue Body' || chr(10) || issue_body end,
 case when trim(commit_message) <> '' then '#### Commit Message' || chr(10) || trim(commit_message) end) as context
from candidates""", uses=("candidates",))
def pr_contexts(t):
    columns = {name: F.col(name) for _, name in fixed.PR_CONTEXT_SECTIONS}
    return t.candidates().select("repo", "pr_id", R.pr_contexts(columns).alias("context"))


def _sql_fill(template: str, **slots: str) -> str:
    """The template as a SQL concatenation."""
    for name, sql in slots.items():
        template = template.replace("{" + name + "}", f"' || {sql} || '")
    return f"md5('{template}')"


_CONTEXTS = (
    "concat_ws(chr(10) || chr(10), '#### PR Title' || chr(10) || c.pr_title, case when c.pr_body <> '' then '#### PR Body' || chr(10) || c.pr_body end,"
    " case when c.issue_title <> '' then '#### Issue Title' || chr(10) || c.issue_title end, case when c.issue_body <> '' then '#### Issue Body' || chr(10) || c.issue_body end,"
    " '#### Commit Message' || chr(10) || c.commit_message)")
_TYPES = "'" + "\n".join(f"- {a} / {b}" for a, b in fixed.BUG_TYPES) + "'"


@query("build_requests", f"""
with fix_hunks as (
 select org || '/' || repo as repo, number as pr_id, hunk, row_number() over (partition by org, repo, number order by file_no, hunk_no) as k
 from hunk_heads join hunk_texts using ({PR}, file_no, hunk_no) where not {IS_TEST}),
listed as (select repo, pr_id, '[' || string_agg('{{"HUNK_' || cast(k as string) || '":' || cast(to_json(hunk) as string) || '}}', ',' order by k) || ']' as hunks
 from fix_hunks group by all),
confirmed as (
 select f.repo, f.pr_id, '[' || string_agg('{{"hunk_id":"HUNK_' || cast(k as string) || '","root_cause_code":' || cast(to_json(hunk) as string) || '}}', ',' order by k) || ']' as hunks
 from fix_hunks f join shortlist_answers a on a.org || '/' || a.repo = f.repo and a.number = f.pr_id
 where json_valid(a.content) and (f.k = 1 or f.k = a.number % 7 + 2) group by f.repo, f.pr_id),
before as (select c.repo, c.pr_id, coalesce(b.content, '') as code from candidates c left join base_files b
 on b.repo = c.repo and b.commit_sha = c.commit_id and b.path = c.rtl_file)
select 'issue_refs' as kind, org || '/' || repo as repo, number as pr_id, {_sql_fill(R.ISSUE_REFS, text="text")} as request_md5 from texts
union all select 'selection', repo, pr_id, {_sql_fill(R.DOC_SELECTION, repo="repo", rtl_file="rtl_file", fixed_rtl_code="rtl_code", doc_toc="toc_text")} from materials
union all select 'spec', m.repo, m.pr_id, {_sql_fill(
    R.SPEC, repo="m.repo", lang="m.lang", rtl_files="'[\"' || m.rtl_file || '\"]'", rtl_code="m.rtl_code",
    official_spec="coalesce(d.spec, 'None')", banned_words="'" + ", ".join(fixed.BANNED_WORDS) + "'")}
 from s2_latest a join materials m using (repo, pr_id)
 left join (select pp.repo, pp.pr_id, string_agg('### ' || pp.p || chr(10) || chr(10) || x.content, chr(10) || chr(10) order by pp.k) as spec
  from last_paths pp join materials mm on mm.repo = pp.repo and mm.pr_id = pp.pr_id
  join docs x on x.repo = mm.repo and x.commit_sha = mm.merge_commit_sha and x.path = pp.p group by pp.repo, pp.pr_id) d
  on d.repo = m.repo and d.pr_id = m.pr_id where a.stage = 'select' and json_type(a.v) = 'OBJECT'
union all select 'review', s.repo, s.pr_id, {_sql_fill(
    R.REVIEW, pr_contexts=_CONTEXTS, fix_patch="c.fix_patch",
    rtl_code="coalesce(m.rtl_code, '')", generated_spec="s.spec")}
from specs s join candidates c using (repo, pr_id) left join materials m using (repo, pr_id)
union all select 'hunk_shortlist', c.repo, c.pr_id, {_sql_fill(
    R.HUNK_SHORTLIST, repo="c.repo", lang="c.lang", pr_contexts=_CONTEXTS, rtl_code="b.code", hunks="coalesce(l.hunks, '[]')")}
from candidates c join before b using (repo, pr_id) left join listed l using (repo, pr_id)
union all select 'annotation', c.repo, c.pr_id, {_sql_fill(
    R.ANNOTATION, repo="c.repo", lang="c.lang", spec="s.spec", root_cause_hunks="f.hunks", rtl_code="b.code", pr_contexts=_CONTEXTS, bug_types=_TYPES)}
from candidates c join before b using (repo, pr_id) join specs s using (repo, pr_id) join confirmed f using (repo, pr_id)""",
       uses=("texts", "materials", "docs", "specs", "candidates", "s2_latest", "last_paths", "hunk_heads", "hunk_texts", "shortlist_answers", "base_files"))
def build_requests(t):
    found, ready = t.stored_candidates, t.stored_materials
    selected, _ = answering.parse_selection_answers(answering.latest_answers(t.view("model_answers"), "select"), ready)
    spec, _ = answering.spec_requests(selected, ready, t.repo_files())
    review, _ = answering.review_requests(t.view("specs"), found, ready)
    of_refs = answering.issue_ref_requests(t.pulls()).select(
        candidates.repo_slug(F.col("org"), F.col("repo")).alias("repo"), F.col("number").alias("pr_id"), "request")
    patches = found.select(
        F.split_part("repo", F.lit("/"), F.lit(1)).alias("org"), F.split_part("repo", F.lit("/"), F.lit(2)).alias("repo"),
        F.col("pr_id").alias("number"), F.col("fix_patch").alias("diff_text"))
    kept = annotation.shortlisted_hunks(annotation.hunk_shortlists(t.view("shortlist_answers"), patches)).select(
        candidates.repo_slug(F.col("org"), F.col("repo")).alias("repo"), F.col("number").alias("pr_id"), "hunk_no")
    kinds = {
        "issue_refs": of_refs, "selection": answering.selection_requests(ready), "spec": spec, "review": review,
        "hunk_shortlist": answering.shortlist_requests(found, t.view("base_files")),
        "annotation": answering.annotation_requests(kept, found, t.view("specs"), t.view("base_files")),
    }
    parts = [d.select(F.lit(k).alias("kind"), "repo", "pr_id", F.md5("request").alias("request_md5")) for k, d in kinds.items()]
    return reduce(DataFrame.unionByName, parts)


@query("candidate_projection", """
select repo, pr_id, lang, rtl_file as rtl_files, commit_id, timestamp, pr_title, pr_body, merge_commit_sha, issue_title, issue_body,
 commit_message, md5(fix_patch) as fix_md5, md5(test_patch) as test_md5, modified_files, lines_added, lines_removed from candidates""",
       uses=("candidates",))
def candidate_projection(t):
    return t.candidates().select(
        "repo", "pr_id", "lang", joined("rtl_files").alias("rtl_files"), "commit_id", "timestamp", "pr_title", "pr_body",
        "merge_commit_sha", "issue_title", "issue_body", "commit_message", F.md5("fix_patch").alias("fix_md5"),
        F.md5("test_patch").alias("test_md5"), joined("modified_files").alias("modified_files"), "lines_added", "lines_removed")
