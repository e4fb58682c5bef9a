"""Every registered query against its SQL twin on DuckDB, on whole tables."""

import duckdb
import pytest
from helpers import canonical

from __spark_entry__ import entry
from patchloom.catalog import QUERIES, TWINS
from patchloom.catalog.views import DRIVER_TABLES, VIEWS, view, with_views


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in DRIVER_TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    ours = canonical(result.columns, result.collect())
    answer = duck.execute(TWINS[name])
    theirs = canonical([c[0] for c in answer.description], answer.fetchall())
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]
    assert ours[1]


@pytest.mark.parametrize("name", ["pulls", "issues", "pull_commits", "pull_files", "pull_diffs", "repo_files", "specs",
                                  "reviews", "model_answers", "bugs", "reports"])
def test_views_are_alike_in_both_engines(spark, duck, sf_dir, name):
    rows = view(spark, sf_dir, name)
    answer = duck.execute(with_views([name], f"select * from {name}"))
    text = lambda cols, data: sorted(str(sorted((c, str(v)) for c, v in zip(cols, r))) for r in data)
    assert text(rows.columns, rows.collect()) == text([c[0] for c in answer.description], answer.fetchall())
    assert name in VIEWS


def test_entry(spark):
    result = entry(spark)
    assert result.columns[:2] == ["repo", "pr_id"]
    assert result.count() > 0
