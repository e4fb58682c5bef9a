"""Registered queries: sources and sinks."""

from pyspark.sql import functions as F

from patchloom.catalog.parts import PR
from patchloom.catalog.registry import joined, query
from patchloom.functions.text import iso_utc
from patchloom.operators import answering
from patchloom.operators.materials import parted_materials
from patchloom.operators.pulls import drop_unfetched_merged
from patchloom.session import fresh_path
from patchloom.sources import dumps, files, jsonl, repos, sinks

_LINE = "number bigint, state string, title string"


def _dump(t, lines):
    """Lines written to the shared folder as text files and read back."""
    path = fresh_path(t.spark, "dump")
    lines.select("value").write.text(path)
    return jsonl.text_lines(t.spark, path)


@query("read_jsonl_tolerant", """
select case when number % 10 = 2 then null else number end as number,
 case when number % 10 = 2 then 'open' else state end as state, case when number % 10 = 2 then 't' else title end as title
from pulls where number % 10 not in (0, 1, 3)""", uses=("pulls",))
def read_jsonl_tolerant(t):
    return jsonl.read_jsonl_tolerant(_dump(t, t.view("dump_lines")), _LINE)


@query("bad_line_count", """
select count(*) filter (where trim(value) <> '') as lines,
 count(*) filter (where trim(value) <> '' and (not json_valid(value) or left(value, 1) = '[')) as broken,
 count(*) filter (where contains(value, '"x')) as mistyped from dump_lines""", uses=("dump_lines",))
def bad_line_count(t):
    counted = jsonl.bad_line_count(_dump(t, t.view("dump_lines")), _LINE)
    return counted.agg(*[F.sum(c).alias(c) for c in ("lines", "broken", "mistyped")])


@query("read_jsonl_strict", "select number, state, title, body from pulls", uses=("pulls",))
def read_jsonl_strict(t):
    lines = t.view("pulls").select(F.to_json(F.struct("number", "state", "title", "body")).alias("value"))
    return jsonl.read_jsonl_strict(_dump(t, lines), _LINE + ", body string")


@query("write_stage", f"select {PR}, state, title from pulls", uses=("pulls",))
def write_stage(t):
    path = fresh_path(t.spark, "stage")
    rows = t.view("pulls").select("org", "repo", "number", "state", "title")
    sinks.write_stage(rows.filter("state = 'closed'"), path, sort_desc="number")
    sinks.write_stage(rows.filter("state <> 'closed'"), path, resume=True, sort_desc="number")
    return t.spark.read.schema(rows.schema).parquet(path)


def _payloads(t):
    """API payloads, made from the pull request rows."""
    commit = F.transform("commits", lambda c: F.struct(
        c["sha"].alias("sha"), F.transform(c["parents"], lambda p: F.struct(p.alias("sha"))).alias("parents"),
        F.struct(c["message"].alias("message")).alias("commit")))
    moment = iso_utc(F.col("merged_at"))
    payload = F.to_json(F.struct(
        "number", "state", "title", "body", F.col("number").alias("id"), moment.alias("merged_at"), "merge_commit_sha",
        F.array(F.struct(F.col("state").alias("name")), F.struct(F.lit("all").alias("name"))).alias("labels"),
        F.lit(False).alias("draft"), F.concat(F.lit("https://x/"), F.col("number").cast("string")).alias("url"),
        "base", commit.alias("commits")))
    return t.pulls().select("org", "repo", payload.alias("payload"))


@query("pulls_from_dump", f"""
select p.org, p.repo, p.number, state, title, body, 'https://x/' || cast(p.number as string) as url, p.number as id,
 strftime(merged_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' as merged_at, merge_commit_sha, state || ',all' as labels, false as draft,
 base_sha, case when merged_at is null then 0 else coalesce(n_commits, -1) end as n_commits
from pulls p left join messages using ({PR})""", uses=("pulls", "messages"))
def pulls_from_dump(t):
    rows = dumps.pulls_from_dump(_payloads(t))
    return rows.select(
        "org", "repo", "number", "state", "title", "body", "url", "id", iso_utc(F.col("merged_at")).alias("merged_at"),
        "merge_commit_sha", joined("labels").alias("labels"), "draft", F.col("base.sha").alias("base_sha"),
        F.coalesce(F.size("commits"), F.lit(-1)).cast("bigint").alias("n_commits"))


@query("commits_shape", f"""
select p.org, p.repo, p.number, case when merged_at is null then '' else
 string_agg(sha || ' ' || parent_sha || ' ' || message, ';' order by pos) end as commits
from pulls p left join pull_commits c using ({PR}) group by p.org, p.repo, p.number, merged_at""",
       uses=("pulls", "pull_commits"))
def commits_shape(t):
    rows = dumps.pulls_from_dump(_payloads(t))
    return rows.select("org", "repo", "number", F.array_join(F.transform("commits", lambda c: F.concat_ws(
        " ", c["sha"], F.array_join(c["parents"], "+"), c["message"])), ";").alias("commits"))


@query("drop_unfetched_merged", f"""
select {PR} from pulls p where merged_at is null or exists (select 1 from messages m where m.number = p.number)""",
       uses=("pulls", "messages"))
def drop_unfetched(t):
    return drop_unfetched_merged(t.pulls()).select("org", "repo", "number")


@query("issues_from_dump", "select org, repo, number, state, title, body from issues", uses=("issues",))
def issues_from_dump(t):
    payload = F.to_json(F.struct("number", "state", "title", "body"))
    return dumps.issues_from_dump(t.issues().select("org", "repo", payload.alias("payload")))


@query("repo_files_scan", """
select repo, commit_sha, count(*) as files, cast(sum(length(content)) as bigint) as characters,
 min(path) as first_path from repo_files group by repo, commit_sha
union all select null, null, count(distinct repo), null, min(split_part(repo, '/', 1) || '/loose/' || split_part(repo, '/', 2) || '.md') from repo_files""",
       uses=("repo_files",))
def repo_files_scan(t):
    """All files as an exported tree with one file too high up in each organisation; the row without a repository is for these."""
    root = fresh_path(t.spark, "tree")
    files.write_tree(t.repo_files(), root)
    org, repo = (F.split_part("repo", F.lit("/"), F.lit(i)) for i in (1, 2))
    loose = t.repo_files().select("repo").distinct().select(
        org.alias("repo"), F.lit("loose").alias("commit_sha"), F.concat(repo, F.lit(".md")).alias("path"), F.lit("x").alias("content"))
    files.write_tree(loose, root)
    found = files.repo_files_scan(t.spark, root).groupBy("repo", "commit_sha").agg(
        F.count(F.lit(1)).alias("files"), F.sum(F.length("content")).alias("characters"), F.min("path").alias("first_path"))
    none = F.lit(None).cast("string")
    misplaced = files.misplaced_files(t.spark, root).agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("first_path"))
    return found.unionByName(misplaced.select(
        none.alias("repo"), none.alias("commit_sha"), "files", F.lit(None).cast("bigint").alias("characters"), "first_path"))


@query("repo_config_dim", """
select r.repo, r.files, coalesce(c.doc_dirs, '') as doc_dirs
from (select repo, count(*) as files from repo_files group by repo) r
left join (select repo, string_agg(doc_dir, ',' order by doc_dir) as doc_dirs from doc_dirs group by repo) c on r.repo = c.repo""",
       uses=("repo_files", "doc_dirs"))
def repo_config_dim(t):
    counts = t.repo_files().groupBy("repo").agg(F.count(F.lit(1)).alias("files"))
    return counts.join(t.repo_config(), "repo", "left").select(
        "repo", "files", F.coalesce(joined("doc_dirs"), F.lit("")).alias("doc_dirs"))


_FILE_NAME = """
 case number % 4 when 0 then org || '__' || repo || '_s01_06_single_rtl_candidates.jsonl'
  when 1 then 'a_b__c__' || repo || '_s01_01_prs.jsonl' when 2 then 'part-0.json' else 'other.jsonl' end"""
_RECORD_REPO = "case when number % 4 = 3 then repo else org || '/' || repo end"


@query("repo_from_filename", f"""
select number, coalesce(nullif(regexp_extract(file_name, '^(.+)__(.+)_s01_[0-9][0-9]_[a-z_]+[.]jsonl$', 1), ''),
  case when contains(record_repo, '/') then split_part(record_repo, '/', 1) end) as org,
 coalesce(nullif(regexp_extract(file_name, '^(.+)__(.+)_s01_[0-9][0-9]_[a-z_]+[.]jsonl$', 2), ''),
  case when contains(record_repo, '/') then split_part(record_repo, '/', 2) end) as repo
from (select number, {_FILE_NAME} as file_name, {_RECORD_REPO} as record_repo from pulls) x""", uses=("pulls",))
def repo_from_filename(t):
    rows = t.view("pulls").select("number", F.expr(_FILE_NAME).alias("file_name"), F.expr(_RECORD_REPO).alias("record_repo"))
    return rows.select("number", repos.repo_from_filename(F.col("file_name"), F.col("record_repo")).alias("r")).select(
        "number", "r.org", "r.repo")


@query("multi_repo_union", f"select {PR} from pulls where org in ('org0', 'org1')", uses=("pulls",))
def multi_repo_union(t):
    return repos.select_repos(t.view("pulls"), t.view("repo_specs")).select("org", "repo", "number")


_FAILURES = """
select 'materials' as stage, kind, repo, pr_id, case when kind = 'read' then rtl_file end as rtl_file,
 case when kind = 'checkout' then 'no settings for repository ' || repo else 'source file missing at the merge commit: ' || rtl_file end as error
from checked where kind is not null
union all select stage, 'llm', repo, pr_id, null, coalesce(error, 'answer has the wrong shape') from s2_latest
where stage = 'select' and (v is null or json_type(v) <> 'OBJECT')
union all select stage, 'llm', repo, pr_id, null, coalesce(error, 'answer has the wrong shape') from last_reviews
where not ok"""


@query("failures_sink", _FAILURES, uses=("checked", "s2_latest", "last_reviews"))
def failures_sink(t):
    """Every stage is written once, good and failed rows alike; its failures are put down twice, as by a run that is done again."""
    checked, selections, reviews = t.stored_stages()
    ready, failed = parted_materials(checked, t.stored_candidates, t.repo_config(), t.repo_files())
    parts = {"materials": failed, "select": answering.parted_selections(selections, ready)[1], "review": answering.parted_reviews(reviews)[1]}
    path = fresh_path(t.spark, "failures")
    for stage, part in [*parts.items(), *parts.items()]:
        sinks.append_failures(part, path, "first", stage)
    return sinks.read_failures(t.spark, path).drop("run")


@query("model_answers_scan", "select stage, repo, pr_id, attempt, content, error from latest where stage = 'review'",
       uses=("latest",))
def model_answers_scan(t):
    return answering.latest_answers(t.view("model_answers"), "review")
