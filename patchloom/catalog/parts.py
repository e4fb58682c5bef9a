"""Intermediate results of the SQL twins, written for DuckDB only.

They restate the rules independently of the Spark code: by unnested lines,
windows and joins where the operators use array expressions.
"""

from __future__ import annotations

from patchloom import fixed
from patchloom.catalog.views import VIEWS
from patchloom.functions.text import BLANKS

PR = "org, repo, number"
KEYWORDS = "|".join(fixed.CLOSING_KEYWORDS)
IS_TEST = "(" + " or ".join(f"contains(lower(path), '{k}')" for k in fixed.TEST_PATH_KEYWORDS) + ")"
SUFFIX = r"lower(regexp_extract(path, '[^/](\.[^./]+)$', 1))"
LANG = f"(case {SUFFIX} when '.v' then 'v' when '.sv' then 'sv' when '.svh' then 'sv' end)"


def strip(x: str) -> str:
    return f"trim({x}, '{BLANKS}')"


def lines(x: str) -> str:
    return rf"string_split_regex({x}, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]')"


def part(name: str, deps: list[str], sql: str) -> None:
    VIEWS[name] = (deps, sql)


# --- pull requests and references
part("merged", ["pulls"], "select * from pulls where state = 'closed' and merged_at is not null")
part("messages", ["pull_commits"], f"""
select {PR}, string_agg(message, chr(10) order by pos) as messages, arg_max(message, pos) as last_message,
 arg_max(sha, pos) as head_sha, count(*) as n_commits from pull_commits group by {PR}""")
part("texts", ["pulls", "messages"], f"""
select {PR}, coalesce(title, '') || chr(10) || coalesce(body, '') || chr(10) || coalesce(messages, '') as text
from pulls left join messages using ({PR})""")
part("clean_texts", ["texts"], f"select {PR}, regexp_replace(text, '(?s)<!--.*?-->', '', 'g') as text from texts")
part("keyword_refs", ["clean_texts"], rf"""
select {PR}, try_cast(regexp_extract(m, '[0-9]+$') as bigint) as ref, row_number() over () as seq
from (select {PR}, unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+\s+#[0-9]+')) as m from clean_texts) x
where regexp_matches(lower(m), '^({KEYWORDS})\s')""")
part("url_refs", ["clean_texts"], rf"""
select {PR}, try_cast(regexp_extract(m, '[0-9]+$') as bigint) as ref
from (select {PR}, unnest(regexp_extract_all(text, 'github\.com/[^/\s]+/[^/\s]+/issues/[0-9]+')) as m from clean_texts) x""")
part("refs", ["keyword_refs", "url_refs"], f"""
select {PR}, ref from keyword_refs where ref > 0 union select {PR}, ref from url_refs where ref > 0""")
part("linked", ["merged", "refs"], f"""
select m.*, r.issue_numbers from merged m join
 (select {PR}, string_agg(cast(ref as string), ',' order by ref) as issue_numbers from refs group by {PR}) r using ({PR})""")
part("resolved", ["refs", "issues"], f"""
select r.org, r.repo, r.number, string_agg(cast(i.number as string), ',' order by i.number) as resolved,
 arg_min(i.title, i.number) as issue_title, arg_min(coalesce(i.body, ''), i.number) as issue_body
from refs r join issues i on r.org = i.org and r.repo = i.repo and r.ref = i.number group by all""")

# --- diffs
part("cut_diffs", ["pull_diffs"], f"""
select {PR}, string_split(chr(10) || diff_text, chr(10) || 'diff --git ') as pieces from pull_diffs""")
part("file_diffs", ["cut_diffs"], rf"""
select *, coalesce(nullif(regexp_extract(head, '\n\+\+\+ b/([^\n]*)', 1), ''),
  nullif(regexp_extract(head, '\n--- a/([^\n]*)', 1), '')) as path
from (select {PR}, file_no, 'diff --git ' || piece || case when file_no < n then chr(10) else '' end as file_diff,
  split_part('diff --git ' || piece, chr(10) || '@@ -', 1) as head
 from (select {PR}, unnest(pieces) as piece, generate_subscripts(pieces, 1) - 1 as file_no, len(pieces) - 1 as n from cut_diffs) x
 where file_no > 0) y""")
part("raw_lines", ["file_diffs"], rf"""
select {PR}, file_no, path, line, line_no, cast(sum(case when regexp_matches(line, '^@@ -[0-9]') then 1 else 0 end)
  over (partition by {PR}, file_no order by line_no) as bigint) as hunk_no
from (select {PR}, file_no, path, unnest(ls) as line, generate_subscripts(ls, 1) as line_no
 from (select {PR}, file_no, path, string_split(left(file_diff, length(file_diff) - 1), chr(10)) as ls from file_diffs) x) y""")
part("hunk_heads", ["raw_lines"], rf"""
select {PR}, file_no, hunk_no, path, line_no as head_no,
 cast(regexp_extract(line, '^@@ -([0-9]+)', 1) as bigint) as old_start,
 coalesce(cast(nullif(regexp_extract(line, '^@@ -[0-9]+,([0-9]+)', 1), '') as bigint), 1) as old_count,
 cast(regexp_extract(line, '^@@ -[0-9,]+ \+([0-9]+)', 1) as bigint) as new_start,
 coalesce(cast(nullif(regexp_extract(line, '^@@ -[0-9,]+ \+[0-9]+,([0-9]+)', 1), '') as bigint), 1) as new_count,
 row_number() over (partition by {PR} order by file_no, hunk_no) as hunk_idx
from raw_lines where regexp_matches(line, '^@@ -[0-9]')""")
part("hunk_texts", ["raw_lines"], f"""
select {PR}, file_no, hunk_no, string_agg(line || chr(10), '' order by line_no) as hunk
from raw_lines where hunk_no > 0 group by all""")
part("body_lines", ["raw_lines", "hunk_heads"], f"""
select r.org, r.repo, r.number, r.file_no, r.hunk_no, r.path, h.hunk_idx, r.line_no - h.head_no - 1 as pos,
 case left(line, 1) when '+' then '+' when '-' then '-' else ' ' end as kind, h.old_start, h.new_start, substr(line, 2) as text
from raw_lines r join hunk_heads h using ({PR}, file_no, hunk_no)
where r.line_no > h.head_no and left(line, 1) <> chr(92)""")
part("numbered_lines", ["body_lines"], f"""
select {PR}, file_no, hunk_no, hunk_idx, path, pos, kind, text,
 old_start + count(*) filter (where kind <> '+') over w - case when kind <> '+' then 1 else 0 end as old_at,
 new_start + count(*) filter (where kind <> '-') over w - case when kind <> '-' then 1 else 0 end as new_at,
 pos - row_number() over (partition by {PR}, file_no, hunk_no, kind = ' ' order by pos) as island
from body_lines window w as (partition by {PR}, file_no, hunk_no order by pos)""")
part("blocks", ["numbered_lines"], f"""
select {PR}, file_no, hunk_no, hunk_idx, path, island, min(pos) as first_pos,
 coalesce(min(old_at) filter (where kind = '-'), greatest(min(old_at) - 1, 0)) as line_start,
 coalesce(max(old_at) filter (where kind = '-'), greatest(min(old_at) - 1, 0)) as line_end,
 count(*) filter (where kind = '+') as added, count(*) filter (where kind = '-') as removed
from numbered_lines where kind <> ' ' group by all""")
part("pr_patches", ["file_diffs", "numbered_lines", "pulls", "messages"], f"""
select f.org, f.repo, f.number, fix_patch, test_patch, modified_files, coalesce(a, 0) as lines_added, coalesce(r, 0) as lines_removed
from (select {PR}, coalesce(string_agg(file_diff, '' order by file_no) filter (where not {IS_TEST}), '') as fix_patch,
  coalesce(string_agg(file_diff, '' order by file_no) filter (where {IS_TEST}), '') as test_patch,
  string_agg(path, ',' order by file_no) as modified_files from file_diffs group by {PR}) f
left join (select {PR}, count(*) filter (where kind = '+') as a, count(*) filter (where kind = '-') as r
  from numbered_lines group by {PR}) n using ({PR})
join pulls p using ({PR}) join messages m using ({PR}) where p.base_sha is not null""")
part("single_rtl", ["file_diffs"], f"""
select {PR}, min(path) filter (where not {IS_TEST}) as rtl_file, min(case when not {IS_TEST} then {LANG} end) as lang
from (select distinct {PR}, path from file_diffs) d group by {PR}
having count(*) filter (where not {IS_TEST}) = 1 and count(*) filter (where not {IS_TEST} and {LANG} is not null) = 1""")
part("candidates", ["linked", "pr_patches", "single_rtl", "messages", "resolved"], f"""
select l.org || '/' || l.repo as repo, l.number as pr_id, s.lang, s.rtl_file, l.base_sha as commit_id,
 strftime(l.merged_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' as timestamp, l.title as pr_title, coalesce(l.body, '') as pr_body,
 l.merge_commit_sha, coalesce(r.issue_title, '') as issue_title, coalesce(r.issue_body, '') as issue_body,
 m.last_message as commit_message, p.fix_patch, p.test_patch, p.modified_files, p.lines_added, p.lines_removed
from linked l join pr_patches p using ({PR}) join single_rtl s using ({PR}) join messages m using ({PR})
left join resolved r using ({PR}) where p.fix_patch <> ''""")

# --- documents
part("config", ["doc_dirs"], "select distinct repo, rtrim(doc_dir, '/') as root from doc_dirs")
part("docs", ["repo_files", "config"], f"""
select * from repo_files f where {SUFFIX} in ('.md', '.rst')
 and exists (select 1 from config c where c.repo = f.repo and starts_with(f.path, c.root || '/'))""")
part("doc_lines", ["repo_files"], f"""
select repo, commit_sha, path, {strip('l')} as line, i, lead({strip('l')}) over (partition by repo, commit_sha, path order by i) as below
from (select repo, commit_sha, path, unnest(ls) as l, generate_subscripts(ls, 1) as i
 from (select repo, commit_sha, path, {lines('content')} as ls from repo_files) x) y""")
part("md_titles", ["doc_lines"], rf"""
select repo, commit_sha, path, arg_min({strip("substr(line, 2)")}, i) as title from doc_lines
where regexp_matches(line, '^#\s+[^\s]') group by all""")
part("rst_titles", ["doc_lines"], rf"""
select repo, commit_sha, path, coalesce(
 arg_min({strip("regexp_extract(line, '(?i)^[.][.]\\s*title::(.*)$', 1)")}, i) filter (where regexp_matches(line, '(?i)^[.][.]\s*title::\s*[^\s]')),
 arg_min(line, i) filter (where line <> '' and regexp_matches(below, '^(=+|-+|~+|\^+)$') and length(below) >= length(line))) as title
from doc_lines group by all""")
part("name_words", ["repo_files"], r"""
select repo, commit_sha, path, string_agg(upper(w[1]) || lower(substr(w, 2)), '' order by k) as title
from (select repo, commit_sha, path, unnest(ws) as w, generate_subscripts(ws, 1) as k
 from (select repo, commit_sha, path, regexp_extract_all(trim(regexp_replace(
   regexp_replace(regexp_extract(path, '[^/]*$'), '(.)\.[^.]+$', '\1'), '[^a-zA-Z0-9]+', ' ', 'g')), '[a-zA-Z]+|[0-9]+| ') as ws
  from repo_files) x) y group by all""")
part("doc_titles", ["repo_files", "md_titles", "rst_titles", "name_words"], f"""
select f.repo, f.commit_sha, f.path, coalesce(case {SUFFIX.replace('path', 'f.path')} when '.md' then m.title when '.rst' then r.title end, n.title) as title
from repo_files f left join md_titles m using (repo, commit_sha, path) left join rst_titles r using (repo, commit_sha, path)
left join name_words n using (repo, commit_sha, path)""")
part("tocs", ["docs", "doc_titles"], """
select repo, commit_sha, string_agg(path || '|' || title, ';' order by path) as toc,
 string_agg('- ' || path || ': ' || title, chr(10) order by path) as toc_text
from docs join doc_titles using (repo, commit_sha, path) group by all""")
part("checked", ["candidates", "repo_files", "config"], """
select c.*, f.content as rtl_code, case when c.repo not in (select repo from config) then 'checkout' when f.content is null then 'read' end as kind
from candidates c left join repo_files f on f.repo = c.repo and f.commit_sha = c.merge_commit_sha and f.path = c.rtl_file""")
part("materials", ["checked", "tocs"], """
select c.repo, c.pr_id, c.lang, c.rtl_file, c.merge_commit_sha, c.rtl_code, coalesce(t.toc, '') as toc,
 coalesce(t.toc_text, 'No official documents available.') as toc_text
from checked c left join tocs t on t.repo = c.repo and t.commit_sha = c.merge_commit_sha where c.kind is null""")

# --- answers
_T = strip("content")
part("latest", ["model_answers"], """
select * from (select *, row_number() over (partition by stage, repo, pr_id order by attempt desc) as k from model_answers) x where k = 1""")
part("s1_json", ["model_answers"], rf"""
select *, case when json_valid(j) then j::json end as v from (select *, case
 when regexp_matches({_T}, '(?is)```json\s*(.*?)\s*```') then {strip(rf"regexp_extract({_T}, '(?is)```json\s*(.*?)\s*```', 1)")}
 when regexp_matches({_T}, '(?s)```\s*(.*?)\s*```') then {strip(rf"regexp_extract({_T}, '(?s)```\s*(.*?)\s*```', 1)")}
 else {_T} end as j from model_answers) x""")
part("s2_json", ["model_answers"], rf"""
select *, case when error is null and json_valid(j) then j::json end as v from (select *, case
 when regexp_matches({_T}, '(?is)^```(json)?\s*\n(.*?)\n```$') then {strip(rf"regexp_extract({_T}, '(?is)^```(?:json)?\s*\n(.*?)\n```$', 1)")}
 else {_T} end as j from model_answers) x""")

part("s2_latest", ["s2_json", "latest"], """
select s.* from s2_json s join (select stage, repo, pr_id, attempt from latest) l using (stage, repo, pr_id, attempt)""")


def truthy(value: str) -> str:
    """Truth of a JSON value as SQL; absent and null are false."""
    return (
        f"coalesce(case json_type({value}) when 'NULL' then false when 'BOOLEAN' then {value}::varchar = 'true'"
        f" when 'VARCHAR' then {value}::varchar <> '\"\"' when 'ARRAY' then json_array_length({value}) > 0"
        f" when 'OBJECT' then len(json_keys({value})) > 0 else try_cast({value}::varchar as double) <> 0 end, false)"
    )


part("parsed_reviews", ["s2_json"], f"""
select stage, repo, pr_id, attempt, error,
 coalesce(json_type(v) = 'OBJECT' and (json_type(v, '$.checks') = 'OBJECT' or not {truthy("(v->'$.checks')")}), false) as ok,
 {truthy("(v->'$.passed')")} as passed,
 {", ".join(truthy(f"(v->'$.checks.{c}')") + f" as {c}" for c in fixed.REVIEW_CHECKS)},
 coalesce(v->>'$.reasoning', '') as reasoning
from s2_json""")
part("last_reviews", ["parsed_reviews", "latest"], """
select p.* from parsed_reviews p join (select stage, repo, pr_id, attempt from latest where stage = 'review') l using (stage, repo, pr_id, attempt)""")
part("parsed_paths", ["s2_json"], """
select distinct on (stage, repo, pr_id, attempt, p) stage, repo, pr_id, attempt, p, k
from (select stage, repo, pr_id, attempt, e->>'$' as p, json_type(e) as kind, k
 from (select stage, repo, pr_id, attempt, unnest(v->'$.selected_doc_paths[*]') as e,
   generate_subscripts(v->'$.selected_doc_paths[*]', 1) as k
  from s2_json where json_type(v, '$.selected_doc_paths') = 'ARRAY') x) y
where kind = 'VARCHAR' order by stage, repo, pr_id, attempt, p, k""")
part("last_paths", ["parsed_paths", "latest"], """
select p.repo, p.pr_id, p.p, p.k from parsed_paths p
join (select stage, repo, pr_id, attempt from latest where stage = 'select') l using (stage, repo, pr_id, attempt)""")
