"""Declared schemas of every landed and produced table.

Schemas are never inferred: a column that is null throughout, or an empty
array, would be inferred wrongly.
"""

from __future__ import annotations

COMMIT = "struct<sha:string,parents:array<string>,message:string>"
ISSUE = "struct<org:string,repo:string,number:bigint,state:string,title:string,body:string>"
CHECKS = "struct<describes_correct_behavior:boolean,no_patch_leakage:boolean,sufficient_for_diagnosis:boolean>"
DOC_ENTRY = "struct<path:string,title:string>"
BUG_INFO = (
    "struct<bug_lineno:array<bigint>,bug_type:struct<level1:string,level2:string>,bug_desc:string,fix_hint:string>"
)

# One pull request as the hosting API delivers it (only the parts that are read).
PULL_PAYLOAD = (
    "number bigint, state string, title string, body string, url string, id bigint, node_id string,"
    " html_url string, diff_url string, patch_url string, issue_url string, created_at string,"
    " updated_at string, closed_at string, merged_at string, merge_commit_sha string,"
    " labels array<struct<name:string>>, draft boolean, commits_url string, review_comments_url string,"
    " review_comment_url string, comments_url string,"
    " base struct<sha:string,ref:string,repo:struct<name:string,owner:struct<login:string>>>,"
    " commits array<struct<sha:string,parents:array<struct<sha:string>>,commit:struct<message:string>>>"
)

ISSUE_PAYLOAD = (
    "number bigint, state string, title string, body string, repository_url string"
)

PULLS = (
    "org string, repo string, number bigint, state string, title string, body string, url string, id bigint,"
    " node_id string, html_url string, diff_url string, patch_url string, issue_url string,"
    " created_at timestamp, updated_at timestamp, closed_at timestamp, merged_at timestamp,"
    " merge_commit_sha string, labels array<string>, draft boolean, commits_url string,"
    " review_comments_url string, review_comment_url string, comments_url string,"
    f" base struct<sha:string>, commits array<{COMMIT}>"
)

ISSUES = "org string, repo string, number bigint, state string, title string, body string"

COMPARE_DIFFS = "org string, repo string, number bigint, diff_text string"

REPO_FILES = "repo string, commit_sha string, path string, content string"

REPO_CONFIG = "repo string, url string, doc_dirs array<string>, rtl_dir string, rtl_extensions array<string>"

MODEL_ANSWERS = "stage string, repo string, pr_id bigint, attempt bigint, content string, error string"

CANDIDATES = (
    "repo string, pr_id bigint, lang string, rtl_files array<string>, commit_id string, timestamp string,"
    " pr_title string, pr_body string, merge_commit_sha string, issue_title string, issue_body string,"
    " commit_message string, fix_patch string, test_patch string, modified_files array<string>,"
    " lines_added bigint, lines_removed bigint"
)

MATERIALS = (
    "repo string, pr_id bigint, lang string, rtl_files array<string>, rtl_file string, merge_commit_sha string,"
    f" fixed_rtl_code string, doc_toc array<{DOC_ENTRY}>"
)

SELECTED_DOCS = "repo string, pr_id bigint, selected_doc_paths array<string>, reason string"

SPECS = "repo string, pr_id bigint, spec string"

REVIEWS = f"repo string, pr_id bigint, passed boolean, checks {CHECKS}, reasoning string"

FAILURES = "stage string, kind string, repo string, pr_id bigint, rtl_file string, error string"

INPUTS = (
    "input struct<repo:string,pr_id:bigint,lang:string,rtl_files:array<string>,spec:string,commit_id:string,"
    f"timestamp:string>, bug_info array<{BUG_INFO}>,"
    " aux struct<merge_commit_sha:string,pr_title:string,pr_body:string,issue_title:string,issue_body:string,"
    "commit_message:string,fix_patch:string,fixed_rtl_code:string,selected_doc_paths:array<string>>"
)

MANUAL_REVIEW_QUEUE = (
    f"repo string, pr_id bigint, review_result struct<passed:boolean,checks:{CHECKS},reasoning:string>,"
    " generated_spec string, fixed_rtl_code string, pr_title string, pr_body string, fix_patch string"
)
