"""A corpus from raw documents: language, near-duplicates, benchmark passages, personal data, piece ids.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written and read again as the next
stage's documents. All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.llm import decontamination, language_id, near_duplicates, pii, segmentation
from patchloom.llm.rows import table
from patchloom.session import materialised

#: A document stays if its language is told at least this surely.
LEAST_SURE = 0.5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told: null texts, texts without letters, undecided ones. A table without
    labelled documents offers no languages; then only documents without a letter go."""
    model = language_id.learned(language_id.training_rows(docs))
    found = language_id.identified(docs, model, docs.columns)
    if not model.languages:
        return found.filter(F.coalesce(F.col("row")["text"], F.lit("")).rlike(r"\p{L}")).select("row.*")
    return found.filter((F.col("language") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SURE)).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of documents whose SimHash fingerprints over shingles of three words link
    at three or fewer differing bits. Null and empty texts are one group; an empty table stays empty."""
    return near_duplicates.kept_documents(docs, shingle=3, distance=3)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of ten words of a benchmark item (of an item of fewer words, all of them). Null and empty
    texts stay, repeated rows share their fate, and without benchmark items all documents stay."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind in brackets in place of personal data; ``n_chars`` follows where it stood. Null and empty texts stay as they are."""
    return pii.masked_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of each document, and its two best alternatives. A null text has null ids, an empty one none; repeated rows are encoded
    alike, and an empty table gives an empty one."""
    found = segmentation.encoded(docs, ["doc_id", "lang", "source"], n_best=3)
    return found.select("row.*", F.size("ids").cast("long").alias("n_pieces"), "ids", "score", "alternatives", "exact")


STAGES = [
    ("language_id", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("pii", mask_personal_data),
    ("pieces", encode_pieces),
]

#: No stage but the third can be told in SQL; the tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
