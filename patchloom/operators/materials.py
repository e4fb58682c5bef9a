"""Source and documentation of every candidate, and the selected documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom import fixed, schemas
from patchloom.functions import titles
from patchloom.functions.paths import is_doc_file, rtl_lang, suffix
from patchloom.functions.text import once, or_empty
from patchloom.operators.sketch import key_sketch

RECORD_KEY = ["repo", "pr_id"]
#: The same key for joins and groupings: sorts tell most rows apart by the number (see ``pulls.PULL_JOIN``).
RECORD_JOIN = ["pr_id", "repo"]


def doc_files(repo_files: DataFrame, repo_config: DataFrame) -> DataFrame:
    """Documentation files of configured repositories, with their content."""
    roots = repo_config.select("repo", "doc_dirs")
    return (
        repo_files.join(roots, "repo", "inner")
        .filter(is_doc_file(F.col("path"), F.col("doc_dirs")))
        .select("repo", "commit_sha", "path", "content")
    )


def doc_toc(docs: DataFrame, with_texts: bool = False) -> DataFrame:
    """Table of contents per commit: array of (path, title) in path order.

    It is kept per commit, not per pull request, and the texts stay in their own
    rows: titles are found before the grouping, so only short columns move.
    ``with_texts`` adds the path -> text map, for a final output only.
    """
    narrow = docs.filter(F.col("content").isNotNull())
    title = titles.doc_title(F.col("path"), F.col("content")).alias("title")
    if not with_texts:
        return contents_lists(narrow.select("repo", "commit_sha", "path", title))
    return narrow.groupBy("repo", "commit_sha").agg(
        F.array_sort(F.collect_list(F.struct("path", title))).alias("doc_toc"),
        F.map_from_entries(F.collect_list(F.struct("path", "content"))).alias("doc_full_texts"))


def doc_entries(repo_files: DataFrame, repo_config: DataFrame, commits: DataFrame | None = None) -> DataFrame:
    """Path and title of the documentation files of configured repositories.

    Titles are found in the scan, so no text takes part in the join with the
    settings or in any join after it. Given ``commits`` (repo, commit_sha), a sketch of
    them goes before the titles, so that next to none are made for other commits; the few
    that pass all the same stay in the result.

    Where the landed files carry ``blob_sha``, a name of their content, a document that does not change is
    read for its title at one commit only, the least (``_titles_by_content``).
    """
    documents = repo_files.filter(suffix(F.col("path")).isin(fixed.DOC_SUFFIXES))
    if commits is not None:
        wanted = key_sketch(commits, ["repo", "commit_sha"])
        documents = documents.filter(wanted(F.col("repo"), F.col("commit_sha")))
    if "blob_sha" in repo_files.columns:
        return _titles_by_content(documents, repo_config)
    title = titles.doc_title(F.col("path"), F.col("content"))
    return (
        documents.filter(F.col("content").isNotNull())
        .select("repo", "commit_sha", "path", once("title", title))
        .join(repo_config.select("repo", "doc_dirs"), "repo", "inner")
        .filter(is_doc_file(F.col("path"), F.col("doc_dirs")))
        .select("repo", "commit_sha", "path", "title")
    )


def _titles_by_content(documents: DataFrame, repo_config: DataFrame) -> DataFrame:
    """Entries of documents with ``blob_sha`` (null where there is no text).

    A narrow table says which commits hold which content, and picks one of them; a sketch of these picks runs in a second scan, the only one
    that reads texts. Titles join back by content, so no text moves.
    """
    named = (
        documents.filter(F.col("blob_sha").isNotNull()).select("repo", "commit_sha", "path", "blob_sha")
        .join(repo_config.select("repo", "doc_dirs"), "repo", "inner")
        .filter(is_doc_file(F.col("path"), F.col("doc_dirs"))).drop("doc_dirs")
    )
    content = ["repo", "path", "blob_sha"]
    picked = key_sketch(named.groupBy(*content).agg(F.min("commit_sha").alias("commit_sha")), ["repo", "commit_sha", "path"])
    title = titles.doc_title(F.col("path"), F.col("content"))
    titled = (
        documents.filter(F.col("content").isNotNull() & picked(F.col("repo"), F.col("commit_sha"), F.col("path")))
        .select(*content, once("title", title)).dropDuplicates(content)
    )
    return named.join(titled, content, "inner").select("repo", "commit_sha", "path", "title")


def contents_lists(entries: DataFrame) -> DataFrame:
    """Entries (path, title) gathered per commit, in path order."""
    return entries.groupBy("repo", "commit_sha").agg(F.array_sort(F.collect_list(F.struct("path", "title"))).alias("doc_toc"))


def material_checks(candidates: DataFrame, repo_config: DataFrame, repo_files: DataFrame) -> DataFrame:
    """Candidates with their source text, or the reason why it cannot be had.

    Adds rtl_file, fixed_rtl_code, kind and error. ``kind`` is ``checkout`` for a
    repository without settings, a row without source file or without merge
    commit, ``read`` for a source file missing at the merge commit, else null.
    """
    configured = repo_config.select("repo", F.lit(True).alias("_configured"))
    rows = candidates.withColumn("rtl_file", F.try_element_at("rtl_files", F.lit(1)))
    # File contents are cut down to the wanted paths in their scan, before they move.
    file = ["repo", "commit_sha", "path"]
    wanted = key_sketch(rows.select("repo", F.col("merge_commit_sha").alias("commit_sha"), F.col("rtl_file").alias("path")), file)
    sources = (
        repo_files.filter(rtl_lang(F.col("path")).isNotNull()).filter(wanted(*map(F.col, file)))
        .select("repo", F.col("commit_sha").alias("merge_commit_sha"), F.col("path").alias("rtl_file"),
                F.col("content").alias("fixed_rtl_code"))
    )
    rows = rows.join(configured, "repo", "left").join(sources, ["merge_commit_sha", "rtl_file", "repo"], "left")
    reasons = [
        (F.col("_configured").isNull(), "checkout",
         F.concat(F.lit("no settings for repository "), F.col("repo"))),
        (F.col("rtl_file").isNull(), "checkout", F.lit("no source file listed")),
        (or_empty(F.col("merge_commit_sha")) == "", "checkout", F.lit("no merge commit")),
        (F.col("fixed_rtl_code").isNull(), "read",
         F.concat(F.lit("source file missing at the merge commit: "), F.col("rtl_file"))),
    ]
    kind, error = F.lit(None).cast("string"), F.lit(None).cast("string")
    for condition, name, text in reversed(reasons):
        kind = F.when(condition, name).otherwise(kind)
        error = F.when(condition, text).otherwise(error)
    return rows.withColumn("kind", kind).withColumn("error", error).drop("_configured")


def materials_join(
    candidates: DataFrame, repo_config: DataFrame, repo_files: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Materials rows and failure rows.

    A materials row carries the contents list of its merge commit, not the
    documents' texts; those join by path once documents are selected. Candidates
    are read several times, so they should come from a written table.
    """
    checked = material_checks(candidates, repo_config, repo_files)
    return parted_materials(checked, candidates, repo_config, repo_files)


def parted_materials(checked: DataFrame, candidates: DataFrame, repo_config: DataFrame, repo_files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Materials rows and failure rows of checked candidates; written once, the checks serve both."""
    commits = candidates.select("repo", F.col("merge_commit_sha").alias("commit_sha"))
    toc = contents_lists(doc_entries(repo_files, repo_config, commits)).withColumnRenamed("commit_sha", "merge_commit_sha")
    none = F.array().cast(f"array<{schemas.DOC_ENTRY}>")
    ready = (
        checked.filter("kind is null")
        .join(toc, ["merge_commit_sha", "repo"], "left")
        .select(
            *RECORD_KEY, F.coalesce("lang", F.lit("sv")).alias("lang"), "rtl_files", "rtl_file",
            "merge_commit_sha", "fixed_rtl_code", F.coalesce("doc_toc", none).alias("doc_toc"),
        )
    )
    failed = checked.filter("kind is not null").select(
        F.lit("materials").alias("stage"), "kind", *RECORD_KEY,
        F.when(F.col("kind") == "read", F.col("rtl_file")).alias("rtl_file"), "error",
    )
    return ready, failed


def selected_texts(wanted: DataFrame, repo_files: DataFrame) -> DataFrame:
    """The texts that ``wanted`` (repo, commit_sha, selected_doc_paths) asks for, gathered per commit: ``texts``, an array of (path, content).

    Other files are left out in the scan, and a text moves once, to its commit; whoever needs it meets it there by narrow rows.
    """
    file = ["repo", "commit_sha", "path"]
    asked = wanted.filter(F.col("commit_sha").isNotNull()).select("repo", "commit_sha", F.explode("selected_doc_paths").alias("path"))
    chosen = key_sketch(asked, file)
    return (
        repo_files.select(*file, "content").filter(F.col("content").isNotNull() & chosen(*map(F.col, file)))
        .groupBy("commit_sha", "repo").agg(F.collect_list(F.struct("path", "content")).alias("texts"))
    )


def official_spec(paths: Column, texts: Column) -> Column:
    """The selected documents as one text, in the order of selection. A path without text gives an empty section; no paths give a fixed word."""
    text = lambda p: F.get(F.filter(texts, lambda t: t["path"] == p), F.lit(0))["content"]
    blocks = F.array_join(F.transform(paths, lambda p: titles.doc_block(p, text(p))), "\n\n")
    return F.when(F.size(paths) > 0, blocks).otherwise(fixed.EMPTY_OFFICIAL_SPEC)


def official_specs(selected: DataFrame, materials: DataFrame, repo_files: DataFrame) -> DataFrame:
    """The text of the selected documents per record, in the order of selection."""
    commits = materials.select(*RECORD_KEY, F.col("merge_commit_sha").alias("commit_sha"))
    wanted = selected.select(*RECORD_KEY, "selected_doc_paths").join(commits, RECORD_JOIN, "left")
    return wanted.join(selected_texts(wanted, repo_files), ["commit_sha", "repo"], "left").select(
        *RECORD_KEY, official_spec(F.col("selected_doc_paths"), F.col("texts")).alias("official_spec"))


def sources_before(candidates: DataFrame, base_files: DataFrame) -> DataFrame:
    """The source file of every candidate as it was before the change: repo, pr_id, rtl_code (empty where it is not there).

    ``base_files`` holds files (repo, commit_sha, path, content) at base commits; other files are left out in the scan.
    """
    file = ["repo", "commit_sha", "path"]
    wanted = candidates.select(
        *RECORD_KEY, F.col("commit_id").alias("commit_sha"), F.try_element_at("rtl_files", F.lit(1)).alias("path"))
    chosen = key_sketch(wanted, file)
    found = base_files.select(*file, "content").filter(chosen(*map(F.col, file)))
    return wanted.join(found, ["commit_sha", "path", "repo"], "left").select(*RECORD_KEY, or_empty(F.col("content")).alias("rtl_code"))
