"""Tables of pull request shape, derived from the driver tables.

Every view is plain SQL that Spark and DuckDB read alike, over whole tables.
Spark runs it with the driver tables as parquet relations; for a SQL twin the
same text becomes a WITH clause.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patchloom.functions.text import once
from patchloom.operators.pulls import PULL_JOIN

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Orders, customers, parts and documents are dealt out to commits of a fixed size, so
# the number of commits grows with the data. Commits are dealt out to three repositories.
def _commit(key: str, per_commit: int) -> str:
    return f"cast(floor({key} / {per_commit}) as bigint)"


_ORDER_COMMIT = _commit("o_orderkey", 120)
_LINE_COMMIT = _commit("l_orderkey", 120)


def _names(commit: str) -> str:
    return f"'org' || cast({commit} % 3 as string) as org, 'repo' || cast({commit} % 3 as string) as repo"


def _slug(commit: str) -> str:
    return f"'org' || cast({commit} % 3 as string) || '/repo' || cast({commit} % 3 as string) as repo"


VIEWS: dict[str, tuple[list[str], str]] = {}

# One pull request per order: open, closed and merged; null bodies, comments, near-miss
# references, addresses of other repositories, missing base commits.
VIEWS["pulls"] = ([], f"""
select {_names(_ORDER_COMMIT)}, o_orderkey as number,
 case when o_orderstatus = 'P' then 'open' else 'closed' end as state,
 case when o_orderkey % 4 = 0 then 'Fixes #' || cast(o_custkey as string)
      when o_orderkey % 4 = 1 then 'fix: #' || cast(o_custkey as string) else 'tidy' end as title,
 case when o_orderkey % 5 = 0 then '<!-- closes #7 --> resolves' || chr(10) || '#' || cast(o_custkey % 50 as string)
      when o_orderkey % 5 = 1 then 'see https://github.com/a/b/issues/' || cast(o_custkey + 1 as string)
      when o_orderkey % 5 = 2 then null else 'closes #0' end as body,
 case when o_orderstatus = 'F' then o_orderdate end as merged_at,
 case when o_orderkey % 97 = 0 then null
      else substr(md5(cast(o_orderkey as string)) || md5(cast(o_orderkey + 1 as string)), 1, 40) end as base_sha,
 md5(cast({_ORDER_COMMIT} as string)) as merge_commit_sha
from orders""")

# One issue per customer. References reach issues of other repositories or none at all, so some dangle.
VIEWS["issues"] = ([], f"""
select {_names(_commit('c_custkey', 12))}, c_custkey as number,
 case when c_acctbal < 0 then 'open' else 'closed' end as state, c_name as title,
 case when c_custkey % 6 = 0 then null else c_mktsegment end as body
from customer""")

# Ordered commits per pull request; some messages carry a reference.
_COMMIT_TEXT = """cast(l_linenumber as string) || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string)"""
_COMMIT_SHA = "substr(md5(k) || md5(cast(number as string)), 1, 40)"
_COMMIT_PARENT = "md5(cast(number as string) || k)"
_COMMIT_MESSAGE = "case when length(k) % 3 = 0 then 'resolves #' || cast(number as string) else 'step ' || k end"
_LINE_PATH = """case l_partkey % 8 when 0 then 'rtl/core_' || cast(l_partkey % 40 as string) || '.sv' when 1 then 'rtl/alu.V'
  when 2 then 'dv/tb/top.sv' when 3 then 'doc/readme.md' when 4 then 'rtl/outbound_fifo.sv'
  when 5 then 'rtl/defs.svh' when 6 then 'tests/run.py' else 'dir.v/Makefile' end"""

VIEWS["pull_commits"] = ([], f"""
select {_names(_commit('number', 120))}, number,
 cast(row_number() over (partition by number order by k) as bigint) as pos,
 {_COMMIT_SHA} as sha,
 {_COMMIT_PARENT} as parent_sha,
 {_COMMIT_MESSAGE} as message
from (select distinct l_orderkey as number,
 {_COMMIT_TEXT} as k
 from lineitem) x""")

# Distinct paths per pull request: substring trap, upper-case suffix, dotted directory.
VIEWS["pull_files"] = ([], f"""
select {_names(_commit('number', 120))}, number,
 cast(row_number() over (partition by number order by path) as bigint) as pos, path, added, removed
from (select l_orderkey as number,
 {_LINE_PATH} as path,
 cast(max(l_quantity) as int) % 7 + 1 as added, cast(max(l_suppkey) % 5 as int) as removed
 from lineitem group by 1, 2) x""")

def _file_diff(of: str = "", pos: str = "pos") -> str:
    """The text of one file of a diff; ``of`` goes before the names of the file's columns."""
    return f"""'diff --git a/' || {of}path || ' b/' || {of}path || chr(10)
 || case when {of}path = 'tests/run.py' then 'deleted file mode 100644' || chr(10) else '' end
 || '--- a/' || {of}path || chr(10)
 || case when {of}path = 'tests/run.py' then '+++ /dev/null' else '+++ b/' || {of}path end || chr(10)
 || '@@ -' || cast(number % 900 + 1 as string) || ',' || cast({of}removed + 2 as string)
 || ' +' || cast(number % 900 + 1 as string) || ',' || cast({of}added + 2 as string) || ' @@' || chr(10)
 || ' ctx' || chr(10) || repeat('--assign old_sig = 0;' || chr(10), {of}removed)
 || repeat('+++ assign new_sig = 1;' || chr(10), {of}added) || ' end' || chr(10)
 || case when number % 3 = 0 then '@@ -' || cast(number % 900 + 101 as string) || ' +'
     || cast(number % 900 + 101 + {of}added - {of}removed as string) || ',3 @@ module m' || chr(10)
     || '-wire w_' || cast({pos} as string) || ';' || chr(10) || '+wire v;' || chr(10) || '+wire u;' || chr(10)
     || '+' || chr(10) else '' end
 || case when number % 5 = 0 then '\\ No newline at end of file' || chr(10) else '' end"""


# Unified diff per pull request: deletions, changed lines that look like file headers, hunk
# headers without counts, the no-newline remark.
VIEWS["pull_diffs"] = (["pull_files"], f"""
select org, repo, number, {{ordered_text:{_file_diff()}}} as diff_text
from pull_files group by org, repo, number""")

# Files at a commit: documents of four kinds with their whole text, and hardware sources.
VIEWS["repo_files"] = ([], f"""
select *, md5(content) as blob_sha from (
select {_slug(_commit('doc_id', 8))}, md5(cast({_commit('doc_id', 8)} as string)) as commit_sha,
 case when doc_id % 7 = 0 then 'src/' when doc_id % 7 = 1 then 'docs/' else 'doc/' end || 'n_' || cast(doc_id as string)
  || case doc_id % 4 when 0 then '.md' when 1 then '.rst' when 2 then '.RST' else '.txt' end as path,
 case doc_id % 4
  when 0 then case when doc_id % 3 = 0 then text else 'intro' || chr(10) || '  # ' || h || ' ' || chr(10) || text end
  when 1 then h || chr(10) || repeat('=', length(h) + cast(doc_id % 3 as int) - 1) || chr(10) || text
  when 2 then '.. Title:: ' || h || chr(10) || text else text end as content
from (select doc_id, text, 'H ' || lang || ' ' || source || ' ' || cast(doc_id as string) as h from documents) x
union all
select {_slug(_commit('p_partkey', 16))}, md5(cast({_commit('p_partkey', 16)} as string)) as commit_sha,
 case p_partkey % 16 when 0 then 'rtl/alu.V' when 1 then 'rtl/defs.svh'
  else 'rtl/core_' || cast(p_partkey % 40 as string) || '.sv' end as path,
 'module ' || replace(p_name, ' ', '_') || ';' || chr(10) || '// ' || p_brand || chr(10) || 'endmodule' as content
from part) f""")

# The hardware sources of every pull request before its change.
VIEWS["base_files"] = (["pulls", "pull_files"], """
select p.org || '/' || p.repo as repo, p.base_sha as commit_sha, f.path, 'module before_' || cast(p.number as string) || ';' as content
from pulls p join pull_files f on f.number = p.number where p.base_sha is not null and f.path like 'rtl/%'""")

# Documentation roots, one with a trailing slash; the third repository has none.
VIEWS["doc_dirs"] = ([], """
select 'org0/repo0' as repo, 'doc/' as doc_dir union all select 'org0/repo0', 'docs'
union all select 'org1/repo1', 'doc'""")

# Specs of all pull requests that are not pending: normative words, banned words, a leaked
# signal, empty text, look-alikes.
VIEWS["specs"] = ([], f"""
select {_slug(_ORDER_COMMIT)}, o_orderkey as pr_id,
 case o_orderkey % 5 when 0 then 'The unit must hold its output while stalled.' when 1 then 'It shall drive new_sig after the fix.'
  when 2 then 'The bug is FIXED here, previously broken; old_sig.' when 3 then '' else 'A mustard shallow unit.' end as spec
from orders where o_orderstatus <> 'P'""")

# Review rows: some records have none, urgent ones have two (the later one counts).
VIEWS["reviews"] = ([], f"""
select {_slug(_ORDER_COMMIT)}, o_orderkey as pr_id, seq,
 o_orderkey % 3 <> 0 and seq = 1 or o_orderkey % 4 = 0 as passed, o_orderkey % 2 = 0 as describes_correct_behavior,
 o_orderkey % 5 <> 1 as no_patch_leakage, o_orderkey % 11 <> 0 as sufficient_for_diagnosis,
 'r' || cast(seq as string) as reasoning
from (select o_orderkey, 1 as seq from orders where o_orderpriority <> '5-LOW'
 union all select o_orderkey, 2 as seq from orders where o_orderpriority = '1-URGENT') x""")

_FENCE = "chr(96) || chr(96) || chr(96)"

_ASKED = " union all ".join(f"""
select o_orderkey, o_custkey, cast({attempt} as bigint) as attempt, '{stage}' as stage, {step} as step,
 case when {failed} end as error from orders where (o_orderkey + {step}) % 29 <> 0 and {who}"""
    for step, stage in enumerate(("refs", "select", "spec", "review"))
    for attempt, failed, who in ((1, "o_orderpriority = '1-URGENT' then 'timeout'", "true"),
                                 (2, "o_orderstatus = 'P' then 'refused'", "o_orderpriority = '1-URGENT'")))

# Answers of every step for every record, asked again for urgent ones: broken JSON, a bare array,
# fences, text booleans, duplicates, wrong types, calls that failed, and steps never answered.
VIEWS["model_answers"] = ([], f"""
select stage, {_slug(_ORDER_COMMIT)}, o_orderkey as pr_id, attempt,
 case when error is not null then null when stage = 'spec' then 'The unit must do step ' || cast(o_orderkey + attempt as string)
 else case (o_orderkey + attempt + step) % 11
  when 0 then 'not json' when 1 then '[1, 2]'
  when 2 then {_FENCE} || 'json' || chr(10) || '{{"passed": true, "issues": ["31"], "reason": "f"}}' || chr(10) || {_FENCE}
  when 3 then '{{"passed": "false", "checks": {{"no_patch_leakage": true}}}}'
  when 4 then '{{"issues": ["12", "12", "x", "0", 7, 7, -3, 2.5, " 44 ", null, true]}}'
  when 5 then '{{"selected_doc_paths": ["doc/n_' || cast({_ORDER_COMMIT} * 8 as string) || '.md", "doc/zz.md", "doc/n_'
    || cast({_ORDER_COMMIT} * 8 + 4 as string) || '.md", 5, "doc/n_' || cast({_ORDER_COMMIT} * 8 as string) || '.md"], "reason": "r"}}'
  when 6 then '{{"selected_doc_paths": "doc/a.md", "passed": 0, "checks": []}}'
  when 7 then 'note ' || {_FENCE} || chr(10) || '["5", 6]' || chr(10) || {_FENCE} || ' end'
  when 8 then '{{"passed": [0], "checks": {{"describes_correct_behavior": "", "no_patch_leakage": 1}}, "reasoning": null}}'
  when 9 then '{{"passed": true, "checks": "all"}}'
  else '{{"passed": ' || case when o_custkey % 2 = 0 then 'true' else 'false' end
    || ', "checks": {{"describes_correct_behavior": true}}, "reasoning": "ok"}}' end end as content, error
from ({_ASKED}) x""")

# True bug ranges: tasks hold many bugs, some bugs of two ranges, some without a file or a line.
VIEWS["bugs"] = ([], """
select cast(floor(o_custkey / 10) as bigint) as task_id, o_orderkey as bug_id,
 case when o_orderkey % 101 <> 0 then 'f' || cast(o_orderkey % 2 as string) || '.sv' end as file,
 case when o_orderkey % 103 <> 0 then (o_orderkey * 37) % 20000 end as line_start,
 case when o_orderkey % 107 > 1 then (o_orderkey * 37) % 20000 + o_orderkey % 13 end as line_end from orders
union all
select cast(floor(o_custkey / 10) as bigint), o_orderkey, 'f' || cast(o_orderkey % 2 as string) || '.sv',
 (o_orderkey * 37) % 20000 + 40, (o_orderkey * 37) % 20000 + 43 from orders where o_orderpriority = '1-URGENT'""")

# Predicted ranges, some in files without bugs, some ending before they start, some without a file or a line.
VIEWS["reports"] = ([], """
select user_id as task_id, event_id as report_id, case when event_id % 97 <> 0 then 'f' || cast(event_id % 3 as string) || '.sv' end as file,
 case when event_id % 89 > 1 then (event_id * 53) % 20100 end as line_start,
 case when event_id % 83 <> 0 then (event_id * 53) % 20100 + event_id % 41 - 1 end as line_end from events""")

# Hunk shortlist answers: named hunks exist or not; some answers are no JSON.
VIEWS["shortlist_answers"] = (["pulls"], """
select org, repo, number, case when number % 13 = 0 then 'no hunk stands out' else '{"candidate_root_cause_hunks": [{"hunk_ids": ["HUNK_1", "HUNK_' || cast(number % 7 + 2 as string)
 || '"], "reason": "logic"}], "filtered_non_root_cause_hunks": [{"hunk_ids": ["HUNK_3"], "reason": "comment"}]}' end as content
from pulls""")

# Annotation answers: allowed and misspelt bug types, hunks that do not exist, answers that are no JSON.
VIEWS["annotation_answers"] = (["pulls"], """
select org, repo, number, case when number % 17 = 0 then 'sorry' else '{"bug_info": [[{"hunk_id": "HUNK_' || cast(number % 4 + 1 as string)
 || '", "bug_type": {"level1": "Functional Bug", "level2": "' || case number % 3 when 0 then 'Control Flow Bug'
   when 1 then 'control flow bug' else 'State Machine Bug' end
 || '"}, "bug_desc": "d' || cast(number as string) || '", "fix_hint": "h"}, {"hunk_id": "HUNK_1", "bug_type": {"level1": '
 || case when number % 2 = 0 then '"Non-functional Bug"' else '7' end
 || ', "level2": "Syntax Error"}, "bug_desc": "e", "fix_hint": "g"}]]}' end as content
from pulls""")


# Lines of a dump: records, broken JSON, blank lines, a field of another type, a bare array.
VIEWS["dump_lines"] = (["pulls"], """
select number, case number % 10 when 0 then '{"number": ' || cast(number as string) when 1 then '   '
 when 2 then '{"number": "x' || cast(number as string) || '", "state": "open", "title": "t"}' when 3 then '[{"number": 1}]'
 else '{"number": ' || cast(number as string) || ', "state": "' || state || '", "title": "' || title || '"}' end as value
from pulls""")

# Repository lists as people type them: blanks around the parts, no slash, unknown names.
VIEWS["repo_specs"] = ([], """
select case r_regionkey when 0 then ' org0 / repo0 ' when 1 then 'org1/repo1' when 2 then 'repo2'
 else 'org2/repo' || cast(r_regionkey as string) || '/x' end as spec from region""")


def _needed(names: list[str]) -> list[str]:
    order: list[str] = []
    for name in names:
        for dep in [*_needed(VIEWS[name][0]), name]:
            if dep not in order:
                order.append(dep)
    return order


def _text(name: str, engine: str) -> str:
    sql = VIEWS[name][1]
    start = sql.find("{ordered_text:")
    if start >= 0:
        end = sql.index("} as diff_text")
        inner = sql[start + len("{ordered_text:"):end]
        aggregate = (
            f"listagg({inner}, '') within group (order by pos)" if engine == "spark"
            else f"string_agg({inner}, '' order by pos)"
        )
        sql = sql[:start] + aggregate + sql[end + 1:]
    # Spark reads a backslash in a literal as an escape; the other engine does not.
    return sql.replace("\\", "\\\\") if engine == "spark" else sql


def with_views(names: list[str], sql: str) -> str:
    """A DuckDB query over views: their texts as WITH clauses, then the query."""
    if not names:
        return sql.strip()
    clauses = [f"{n} as ({_text(n, 'duckdb')})" for n in _needed(names)]
    joined = ",\n".join(clauses)
    if sql.lstrip().lower().startswith("with "):
        return f"with {joined},\n{sql.lstrip()[5:]}"
    return f"with {joined}\n{sql}"


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_PULL_KEY = ["org", "repo", "number"]


def _lines_by_pull(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Narrow rows of the line table, dealt out once by pull request: whatever is grouped, ranked or joined by its key afterwards stays where it is."""
    named = [*_names(_commit("number", 120)).split(", "), "number", *columns]
    lines = driver_table(spark, sf_dir, "lineitem").withColumn("number", F.col("l_orderkey"))
    return lines.selectExpr(*named).repartition(*PULL_JOIN)


def _ranked(rows: DataFrame, order: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*PULL_JOIN).orderBy(order))
    return rows.withColumn("pos", place.cast("bigint"))


def _pull_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines_by_pull(spark, sf_dir, f"{_COMMIT_TEXT} as k").distinct()
    return _ranked(rows, "k").selectExpr(
        *_PULL_KEY, "pos", f"{_COMMIT_SHA} as sha", f"{_COMMIT_PARENT} as parent_sha", f"{_COMMIT_MESSAGE} as message")


def _changed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines_by_pull(spark, sf_dir, f"{_LINE_PATH} as path", "l_quantity", "l_suppkey")
    return rows.groupBy(*PULL_JOIN, "path").agg(
        F.expr("cast(max(l_quantity) as int) % 7 + 1").alias("added"), F.expr("cast(max(l_suppkey) % 5 as int)").alias("removed"))


def _pull_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(_changed_paths(spark, sf_dir), "path").select(*_PULL_KEY, "pos", "path", "added", "removed")


def diff_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``pull_diffs`` makes texts of, in their order, per pull request (``files``): narrow rows, gathered in one step."""
    return _changed_paths(spark, sf_dir).groupBy(*PULL_JOIN).agg(
        F.sort_array(F.collect_list(F.struct("path", "added", "removed"))).alias("files")).select(*_PULL_KEY, "files")


def diff_of_parts(files: str = "files") -> Column:
    """The text of a diff, of its number and the named column of its files; null where nothing of them can be told."""
    text = _file_diff("f.", "cast(i + 1 as bigint)").replace("\\", "\\\\").replace("chr(10)", "'\\n'")
    text = re.sub(r"(?<!')'\s*\|\|\s*'(?!')", "", text)  # plain pieces that follow one another are one piece
    return F.expr(f"nullif(array_join(transform({files}, (f, i) -> {text}), ''), '')")


def _pull_diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are gathered as narrow rows, and a diff's text is made after that, so no text is sorted or kept in a buffer of an aggregate."""
    return diff_parts(spark, sf_dir).select(*_PULL_KEY, once("diff_text", diff_of_parts()))


def commit_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that ``pull_commits`` makes commits of, in their order, per pull request (``ks``): narrow rows, gathered in one step. A
    null is a text, too, and the first."""
    gathered = _lines_by_pull(spark, sf_dir, f"{_COMMIT_TEXT} as k").groupBy(*PULL_JOIN).agg(
        F.sort_array(F.collect_set("k")).alias("ks"), F.bool_or(F.col("k").isNull()).alias("unnamed"))
    texts = F.when(F.col("unnamed"), F.concat(F.array(F.lit(None).cast("string")), F.col("ks"))).otherwise(F.col("ks"))
    return gathered.select(*_PULL_KEY, texts.alias("ks"))


def with_commits(rows: DataFrame) -> DataFrame:
    """The commits (sha, parents, message) of ``ks``, in its place; null where there are none. What depends on the number alone is worked out once a row."""
    sha, parent, message = (x.replace("md5(cast(number as string))", "hash").replace("cast(number as string)", "name")
                            for x in (_COMMIT_SHA, _COMMIT_PARENT, _COMMIT_MESSAGE))
    once_a_row = F.expr("array(struct(cast(number as string) as name, md5(cast(number as string)) as hash))")
    made = f"transform(ks, k -> named_struct('sha', {sha}, 'parents', array({parent}), 'message', {message}))"
    rows = rows.select("*", F.inline(once_a_row))
    return rows.select("*", once("commits", F.expr(made))).drop("ks", "name", "hash")


#: Views that Spark builds with one exchange, of narrow rows; the same rows as their texts give.
_BY_PULL = {"pull_commits": _pull_commits, "pull_files": _pull_files, "pull_diffs": _pull_diffs}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a DataFrame over the parquet tables."""
    if name in _BY_PULL:
        return _BY_PULL[name](spark, sf_dir)
    folder = sf_dir.rstrip("/")
    texts = {n: _text(n, "spark") for n in _needed([name])}
    tables = [t for t in DRIVER_TABLES if any(f"from {t}" in sql for sql in texts.values())]
    clauses = [f"{t} as (select * from parquet.`{folder}/{t}.parquet`)" for t in tables]
    clauses += [f"{n} as ({sql})" for n, sql in texts.items()]
    return spark.sql("with " + ",\n".join(clauses) + f"\nselect * from {name}")
