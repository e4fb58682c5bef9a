"""Names of the registered queries, and the tables they start from."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.catalog import views
from patchloom.functions.text import once
from patchloom.operators import answering
from patchloom.operators.materials import material_checks, materials_join
from patchloom.operators.pulls import PULL_JOIN, PULL_KEY
from patchloom.operators.summaries import StageCounts
from patchloom.plans.collection import candidates_plan
from patchloom.session import materialised
from patchloom.sources.repos import repo_config_dim

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Register ``run(tables)`` under a name, with its SQL twin over the named views."""

    def register(run: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: run(Tables(spark, sf_dir))
        if sql is not None:
            TWINS[name] = views.with_views(list(uses), sql)
        return run

    return register


class Tables:
    """The derived views of one data folder, and the landed tables built from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def driver(self, name: str) -> DataFrame:
        return views.driver_table(self.spark, self.sf_dir, name)

    def view(self, name: str) -> DataFrame:
        return views.view(self.spark, self.sf_dir, name)

    def commits(self) -> DataFrame:
        """Ordered commit arrays per pull request."""
        return views.with_commits(views.commit_texts(self.spark, self.sf_dir))

    def pulls(self) -> DataFrame:
        """Pull requests with base and commits; commits are null where none landed. Times are UTC.

        The join sorts the commits' short texts; commits are made of them after it, once, and only of rows that a later filter keeps.
        """
        return views.with_commits(
            self.view("pulls").withColumn("base", F.struct(F.col("base_sha").alias("sha"))).drop("base_sha")
            .withColumn("merged_at", F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("merged_at")).cast("timestamp"))
            .join(views.commit_texts(self.spark, self.sf_dir), PULL_JOIN, "left"))

    def candidates(self) -> DataFrame:
        """The candidates, lazily: for queries that read them once."""
        return candidates_plan(self.pulls(), self.issues(), self.diffs())

    @cached_property
    def stored_candidates(self) -> DataFrame:
        """The candidates, written once: for queries that read them several times."""
        return materialised(self.candidates(), "candidates")

    @cached_property
    def stored_materials(self) -> DataFrame:
        ready, _ = materials_join(self.stored_candidates, self.repo_config(), self.repo_files())
        return materialised(ready, "materials")

    def stored_stages(self, counts: StageCounts | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Checked candidates, parsed selections and parsed reviews, each written once with its good and failed rows; counted as they are written."""
        answers = self.view("model_answers")
        counts = counts or StageCounts()
        stages = {
            "materials": (material_checks(self.stored_candidates, self.repo_config(), self.repo_files()), F.col("kind")),
            "select": (answering.selection_answers(answering.latest_answers(answers, "select")), F.col("error")),
            "review": (answering.review_answers(answering.latest_answers(answers, "review")), F.col("error")),
        }
        return tuple(
            materialised(counts.seen(name, rows, loaded=F.lit(True), written=reason.isNull(), failed=reason.isNotNull()), name)
            for name, (rows, reason) in stages.items())

    def diffs(self) -> DataFrame:
        return self.view("pull_diffs")

    def diff_parts(self) -> DataFrame:
        """What the texts of ``diffs`` are made of (``files``): for a join that should not sort texts. ``views.diff_of_parts`` makes them."""
        return views.diff_parts(self.spark, self.sf_dir)

    def issues(self) -> DataFrame:
        return self.view("issues")

    def repo_files(self) -> DataFrame:
        return self.view("repo_files")

    def repo_config(self) -> DataFrame:
        return repo_config_dim(self.view("doc_dirs"))

    def reviews(self) -> DataFrame:
        checks = ["describes_correct_behavior", "no_patch_leakage", "sufficient_for_diagnosis"]
        return self.view("reviews").withColumn("checks", F.struct(*checks)).drop(*checks)


def joined(column: str, separator: str = ",", missing: str = ""):
    """An array of plain values as one text."""
    return F.array_join(F.transform(column, lambda x: x.cast("string")), separator, missing)
