"""Registered queries: diff tables, gates, annotation and scores."""

from pyspark.sql import functions as F

from patchloom.catalog.parts import PR
from patchloom.catalog.registry import joined, query
from patchloom.functions import diffs, gates
from patchloom.operators import annotation, patches, scoring
from patchloom.session import materialised

_KEY = ("org", "repo", "number")


@query("diff_files", f"select {PR}, file_no, path, md5(file_diff) as diff_md5 from file_diffs", uses=("file_diffs",))
def diff_files(t):
    return patches.diff_files(t.diffs()).select(*_KEY, "file_no", "path", F.md5("file_diff").alias("diff_md5"))


@query("diff_hunks", f"""
select {PR}, file_no, hunk_no, 'HUNK_' || cast(hunk_idx as string) as hunk_id, path, old_start, old_count, new_start, new_count, md5(hunk) as hunk_md5
from hunk_heads join hunk_texts using ({PR}, file_no, hunk_no)""", uses=("hunk_heads", "hunk_texts"))
def diff_hunks(t):
    return patches.diff_hunks(t.diffs()).withColumn("hunk_md5", F.md5("hunk")).drop("hunk")


@query("diff_lines", f"""
select {PR}, file_no, hunk_no, path, pos, kind, case when kind <> '+' then old_at end as old_line,
 case when kind <> '-' then new_at end as new_line, text from numbered_lines""", uses=("numbered_lines",))
def diff_lines(t):
    return patches.diff_lines(t.diffs()).drop("hunk_id")


@query("file_line_counts", f"""
select f.org, f.repo, f.number, f.file_no, f.path, count(*) filter (where kind = '+') as added, count(*) filter (where kind = '-') as removed
from file_diffs f left join numbered_lines n using ({PR}, file_no) group by all""", uses=("file_diffs", "numbered_lines"))
def file_line_counts(t):
    return patches.file_line_counts(t.diffs())


@query("hunk_list", f"""
select {PR}, '[' || string_agg('{{"HUNK_' || cast(hunk_idx as string) || '":' || cast(to_json(hunk) as string) || '}}', ',' order by hunk_idx) || ']' as hunks
from hunk_heads join hunk_texts using ({PR}, file_no, hunk_no) group by {PR}""", uses=("hunk_heads", "hunk_texts"))
def hunk_list(t):
    return t.diffs().select(*_KEY, diffs.hunk_list(F.col("diff_text")).alias("hunks"))


@query("change_blocks", f"""
select {PR}, file_no, hunk_no, 'HUNK_' || cast(hunk_idx as string) as hunk_id, path, line_start, line_end, added, removed from blocks""", uses=("blocks",))
def change_blocks(t):
    return patches.change_blocks(t.diffs())


# --- gates


@query("normative_words", r"select repo, pr_id, regexp_matches(spec, '(?i)\b(must|shall|should)\b') as normative from specs", uses=("specs",))
def normative_words(t):
    return t.view("specs").select("repo", "pr_id", gates.uses_normative_words(F.col("spec")).alias("normative"))


@query("banned_words", r"""
select repo, pr_id, len(regexp_extract_all(lower(spec), '\b(incorrectly|broken|fixed|bug|patched|repaired)\b')) as banned from specs""",
       uses=("specs",))
def banned_words(t):
    return t.view("specs").select("repo", "pr_id", gates.banned_word_count(F.col("spec")).alias("banned"))


_WORDS_SQL = ", ".join(f"'{w}'" for w in gates.LANGUAGE_WORDS)


@query("patch_leakage", f"""
select s.repo, s.pr_id, coalesce(string_agg(distinct w.tok, ',' order by w.tok), '') as leaked, count(w.tok) = 0 as no_patch_leakage
from specs s join candidates c using (repo, pr_id) left join (
 select org || '/' || repo as repo, number as pr_id, unnest(regexp_extract_all(text, '[A-Za-z_][A-Za-z0-9_$]*')) as tok
 from numbered_lines where kind <> ' ' and path not like '%test%' and path not like '%tb%') w
 on w.repo = s.repo and w.pr_id = s.pr_id and w.tok not in ({_WORDS_SQL})
 and list_contains(regexp_extract_all(s.spec, '[A-Za-z_][A-Za-z0-9_$]*'), w.tok)
group by s.repo, s.pr_id""", uses=("specs", "candidates", "numbered_lines"))
def patch_leakage(t):
    return annotation.patch_leakage(t.view("specs"), t.candidates()).select("repo", "pr_id", joined("leaked").alias("leaked"), "no_patch_leakage")


_NOTES = """
select org, repo, number, k - 1 as pos, e->>'$.hunk_id' as hunk_id, case when json_type(e, '$.bug_type.level1') = 'VARCHAR' then e->>'$.bug_type.level1' end as level1,
 e->>'$.bug_type.level2' as level2, e->>'$.bug_desc' as bug_desc, e->>'$.fix_hint' as fix_hint
from (select org, repo, number, unnest(content::json->'$.bug_info[*][*]') as e, generate_subscripts(content::json->'$.bug_info[*][*]', 1) as k
 from annotation_answers where json_valid(content)) x"""
_VALID = """coalesce((level1 = 'Functional Bug' and level2 in ('Logic Operation Bug', 'State Machine Bug', 'Control Flow Bug', 'Data Flow Bug',
 'Boundary Condition Bug', 'Exception Scenario Bug')) or (level1 = 'Non-functional Bug' and level2 in ('Configuration Bug', 'Syntax Error')), false)"""


@query("bug_type_valid", f"select org, repo, number, pos, hunk_id, level1, level2, {_VALID} as valid from ({_NOTES}) n", uses=("annotation_answers",))
def bug_type_valid(t):
    rows = annotation.bug_type_valid(annotation.parse_annotations(t.view("annotation_answers"))).filter("problem is null")
    return rows.select(*_KEY, F.col("pos").cast("bigint").alias("pos"), "hunk_id", "level1", "level2", "valid")


_COUNTED = f"(select {PR}, max(hunk_idx) as hunks from hunk_heads group by all)"
_HUNK_NO = "try_cast(regexp_extract(hunk_id, '^HUNK_([1-9][0-9]*)$', 1) as bigint)"


@query("hunk_shortlist_parse", f"""
select s.org, s.repo, s.number, s.verdict, s.hunk_id, s.reason,
 case when s.verdict is null then 'answer has the wrong shape' when coalesce({_HUNK_NO} <= hunks, false) then null else 'hunk not in the diff' end as error from (
 select org, repo, number, 'candidate' as verdict, unnest(content::json->'$.candidate_root_cause_hunks[0].hunk_ids[*]')->>'$' as hunk_id, 'logic' as reason
  from shortlist_answers where json_valid(content)
 union all select org, repo, number, 'filtered', unnest(content::json->'$.filtered_non_root_cause_hunks[0].hunk_ids[*]')->>'$', 'comment'
  from shortlist_answers where json_valid(content)
 union all select org, repo, number, null, null, null from shortlist_answers where not json_valid(content)) s
left join {_COUNTED} h using ({PR})""", uses=("shortlist_answers", "hunk_heads"))
def hunk_shortlist_parse(t):
    return annotation.hunk_shortlists(t.view("shortlist_answers"), t.diffs())


NOTES_SQL = f"""
select n.*, {_VALID} as valid, r.ranges, case when not {_VALID} then 'bug type not allowed'
 when not coalesce({_HUNK_NO} <= c.hunks, false) then 'hunk not in the diff' when r.ranges is null then 'hunk changes no line' end as error
from ({_NOTES}) n left join {_COUNTED} c using ({PR})
left join (select {PR}, hunk_idx, string_agg(cast(line_start as string) || ',' || cast(line_end as string), ',' order by line_start, line_end) as ranges
 from blocks group by all) r on r.org = n.org and r.repo = n.repo and r.number = n.number and n.hunk_id = 'HUNK_' || cast(r.hunk_idx as string)"""


@query("annotation_join", f"""
with flagged as ({NOTES_SQL})
select org, repo, number, string_agg(ranges || ' ' || level1 || '::' || level2 || ' ' || bug_desc || ' ' || fix_hint, ';' order by pos) as bug_info, null as error
from flagged where error is null group by org, repo, number
union all select org, repo, number, null, hunk_id || ': ' || error from flagged where error is not null
union all select org, repo, number, null, 'answer has the wrong shape' from annotation_answers where not json_valid(content)""",
       uses=("annotation_answers", "blocks", "hunk_heads"))
def annotation_join(t):
    """The notes of every pull request, and every note or answer that is no use."""
    notes = materialised(annotation.annotation_notes(t.view("annotation_answers"), t.diffs()), "notes")
    text = F.transform("bug_info", lambda b: F.concat_ws(
        " ", joined(b["bug_lineno"]), F.concat_ws("::", b["bug_type"]["level1"], b["bug_type"]["level2"]), b["bug_desc"], b["fix_hint"]))
    good = annotation.annotation_join(notes).select(*_KEY, F.array_join(text, ";").alias("bug_info"), F.lit(None).cast("string").alias("error"))
    failed = annotation.annotation_failures(notes).select(
        F.split_part("repo", F.lit("/"), F.lit(1)).alias("org"), F.split_part("repo", F.lit("/"), F.lit(2)).alias("repo"),
        F.col("pr_id").alias("number"), F.lit(None).cast("string").alias("bug_info"), "error")
    return good.unionByName(failed)


# --- scores

_MEETS = "b.task_id = r.task_id and b.file = r.file and b.line_start <= r.line_end and b.line_end >= r.line_start and r.line_start <= r.line_end"


@query("overlap_match", f"""
select 'report' as side, r.task_id, r.report_id as id, r.file, r.line_start, r.line_end, count(b.bug_id) as met
from reports r left join bugs b on {_MEETS} group by all
union all select 'bug', b.task_id, b.bug_id, b.file, b.line_start, b.line_end, count(r.report_id)
from bugs b left join reports r on {_MEETS} group by all""", uses=("bugs", "reports"))
def overlap_match(t):
    return scoring.overlap_match(t.view("bugs"), t.view("reports")).drop("bugs_in_file")


_COUNTS = f"""
(select task_id, cast(sum(reports) as bigint) as reports, cast(sum(matched_reports) as bigint) as matched_reports, cast(sum(file_hits) as bigint) as file_hits,
 cast(sum(bugs) as bigint) as bugs, cast(sum(matched_bugs) as bigint) as matched_bugs from (
 select r.task_id, count(distinct r.report_id) as reports, count(distinct case when b.bug_id is not null then r.report_id end) as matched_reports,
  count(distinct case when exists (select 1 from bugs f where f.task_id = r.task_id and f.file = r.file) then r.report_id end) as file_hits, 0 as bugs, 0 as matched_bugs
  from reports r left join bugs b on {_MEETS} group by r.task_id
 union all select b.task_id, 0, 0, 0, count(distinct b.bug_id), count(distinct case when r.report_id is not null then b.bug_id end)
  from bugs b left join reports r on {_MEETS} group by b.task_id) u group by grouping sets ((task_id), ())) c"""
_LP = "(matched_reports::double / nullif(reports, 0))"
_FA = "(file_hits::double / nullif(reports, 0))"
_RC = "(matched_bugs::double / nullif(bugs, 0))"
_F1 = f"(({_LP} * {_RC} * 2.0::double) / nullif({_LP} + {_RC}, 0))"
_WS = (f"case when coalesce({_LP}, {_FA}, {_RC}, {_F1}) is not null then 0.0::double + coalesce({_LP}, 0) * 0.2::double"
       f" + coalesce({_FA}, 0) * 0.05::double + coalesce({_RC}, 0) * 0.2::double + coalesce({_F1}, 0) * 0.1::double end")
_SCOPE = "case when task_id is null then 'pooled' else 'task' end as scope, task_id"


def _score(t, *columns):
    return scoring.score(t.view("bugs"), t.view("reports")).select("scope", "task_id", *columns)


@query("line_precision", f"select {_SCOPE}, reports, matched_reports, {_LP} as line_precision from {_COUNTS}", uses=("bugs", "reports"))
def line_precision(t):
    return _score(t, "reports", "matched_reports", "line_precision")


@query("file_accuracy", f"select {_SCOPE}, reports, file_hits, {_FA} as file_accuracy from {_COUNTS}", uses=("bugs", "reports"))
def file_accuracy(t):
    return _score(t, "reports", "file_hits", "file_accuracy")


@query("recall", f"select {_SCOPE}, bugs, matched_bugs, {_RC} as recall from {_COUNTS} where bugs > 0", uses=("bugs", "reports"))
def recall(t):
    return _score(t, "bugs", "matched_bugs", "recall").filter("bugs > 0")


@query("f1", f"select {_SCOPE}, {_F1} as f1 from {_COUNTS}", uses=("bugs", "reports"))
def f1(t):
    return _score(t, "f1")


@query("weighted_score", f"select {_SCOPE}, {_WS} as weighted_score from {_COUNTS}", uses=("bugs", "reports"))
def weighted_score(t):
    return _score(t, "weighted_score")
