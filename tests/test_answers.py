"""Answer parsing: fences, shapes and truth values."""

import json

import pytest
from helpers import values
from pyspark.sql import functions as F

from patchloom import schemas
from patchloom.functions import answers as A
from patchloom.operators import answering


def test_fences(spark):
    given = ["```json\n{\"a\": 1}\n```", "say ```JSON {} ``` and ```x```", "```\nz\n``` tail", "  plain ", "```\n\n```"]
    assert values(spark, given, A.fenced_block) == ['{"a": 1}', "{}", "z", "plain", ""]
    assert values(spark, given, A.unfenced) == ['{"a": 1}', given[1], given[2], "plain", ""]


@pytest.mark.parametrize("value", [
    None, True, False, 0, 1, -2, 0.0, 0.5, "", "false", [], [0], [None], {}, {"a": None}, 10**25,
])
def test_truthiness(spark, value):
    text = json.dumps({"v": value})
    assert values(spark, [text], lambda c: A.truthy(A.at(A.parsed(c), "$.v"))) == [bool(value)]


def test_absent_is_false(spark):
    assert values(spark, ["{}"], lambda c: A.truthy(A.at(A.parsed(c), "$.v"))) == [False]


def test_issue_answers(spark):
    given = [
        '{"issues": ["12", "12", "x", "0", 7, 7, -3, 2.5, " 44 ", null, true, "007", "7"]}', '["5", 6]', '{"issues": "5"}', "{}", "7",
        "not json", "[]", '{"issues": [[1], {"a": 2}]}',
    ]
    found = values(spark, given, lambda c: A.issue_numbers(A.parsed(c)))
    assert found == [["12", "7", "44", "007"], ["5", "6"], [], [], None, None, [], []]


def test_selection(spark):
    given = ['{"selected_doc_paths": ["b", 1, "a", "b"]}', '{"selected_doc_paths": "a", "reason": null}', '{"reason": ["x"]}']
    assert values(spark, given, lambda c: A.selected_paths(A.parsed(c))) == [["b", "a", "b"], [], []]
    assert values(spark, given, lambda c: A.selection_reason(A.parsed(c))) == ["", None, '["x"]']


def test_valid_paths_keep_order(spark):
    rows = spark.createDataFrame([(["z", "b", "a", "b"], ["a", "b"]), (None, ["a"]), (["a"], None)], "s array<string>, a array<string>")
    assert [r[0] for r in rows.select(A.valid_paths(F.col("s"), F.col("a"))).collect()] == [["b", "a"], [], []]


def _answers(spark, contents):
    return spark.createDataFrame(
        [("s", "o/r", i, 1, c, None) for i, c in enumerate(contents)] + [("s", "o/r", 99, 1, None, "timeout")], schemas.MODEL_ANSWERS)


def test_review_answers(spark):
    contents = [
        '{"passed": "false", "checks": {"no_patch_leakage": 1}, "reasoning": "why"}', "[1]", '{"checks": "all"}',
        '{"checks": [], "reasoning": null}', "oops", '```json\n{"passed": true, "checks": {}, "reasoning": 5}\n```',
    ]
    reviews, failed = answering.parse_review_answers(_answers(spark, contents))
    found = {r.pr_id: (r.passed, tuple(r.checks), r.reasoning) for r in reviews.collect()}
    assert found == {
        0: (True, (False, True, False), "why"), 3: (False, (False,) * 3, ""), 5: (True, (False,) * 3, "5")}
    assert {(r.pr_id, r.kind, r.stage) for r in failed.collect()} == {(i, "llm", "review") for i in (1, 2, 4, 99)}
    assert {r.error for r in failed.filter("pr_id = 99").collect()} == {"timeout"}


def test_selection_answers_split_into_rows_and_failures(spark):
    materials = spark.createDataFrame(
        [("o/r", 0, [("doc/a.md", "A"), ("doc/b.md", "B")])], f"repo string, pr_id bigint, doc_toc array<{schemas.DOC_ENTRY}>")
    contents = ['{"selected_doc_paths": ["doc/b.md", "nope", "doc/b.md", "doc/a.md"], "reason": "r"}', "[]", '{"selected_doc_paths": ["doc/a.md"]}']
    selected, failed = answering.parse_selection_answers(_answers(spark, contents), materials)
    assert {r.pr_id: (r.selected_doc_paths, r.reason) for r in selected.collect()} == {0: (["doc/b.md", "doc/a.md"], "r"), 2: ([], "")}
    assert {r.pr_id for r in failed.collect()} == {1, 99}


def test_latest_answer_counts(spark):
    rows = spark.createDataFrame(
        [("s", "o/r", 1, a, f"c{a}", None) for a in (1, 3, 2)] + [("t", "o/r", 1, 9, "other", None)], schemas.MODEL_ANSWERS)
    assert [r.content for r in answering.latest_answers(rows, "s").collect()] == ["c3"]


def test_answer_requests_catches_errors_per_row(spark):
    requests = spark.createDataFrame([("o/r", i, f"q{i}") for i in range(6)], "repo string, pr_id bigint, request string")

    def make():
        def answer(q):
            if q == "q3":
                raise RuntimeError("no")
            return q.upper()
        return answer

    rows = {r.pr_id: (r.content, r.error) for r in answering.answer_requests(requests, "spec", make).collect()}
    assert rows == {i: ((None, "no") if i == 3 else (f"Q{i}", None)) for i in range(6)}
