"""The corpus pipeline: documents through five operators of waymark.llm, one Parquet table per stage.

Each stage takes (spark, docs, sf_dir) and returns rows with the columns of `docs`, the last one the packed pieces.
Spark splits a scan by the cores alive, so a stage that needs row numbers saves the rows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import saved, table
from waymark.llm.decontamination import find_benchmark
from waymark.llm.language import UNKNOWN, identify_language
from waymark.llm.ngram_join import similar_groups
from waymark.llm.packing import pack_documents
from waymark.llm.pii import KEY_OPTION, pseudonymise
from waymark.llm.queries import TRIAL_KEY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# How far above an even share of all learned languages a text's own one must be, from this many letters on; shorter
# texts need less in proportion, since a few words say less.
LEAST_OVER_CHANCE = 0.2
FULL_LETTERS = 100
# Of the letters' bytes, this percentage may be ones that no learned text has.
MOST_STRANGE = 25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows; those without letters, between languages or in unseen letters go."""
    needed = LEAST_OVER_CHANCE * F.least(F.lit(1.0), F.col("n_letters") / FULL_LETTERS)
    sure = (F.col("over_chance") >= needed) & (100 * F.col("n_strange") <= MOST_STRANGE * F.col("n_letters"))
    return identify_language(docs, keep=True).where((F.col("lang_pred") != UNKNOWN) & sure).select("_doc.*")


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group of near copies (word shingles of five, similarity 0.8)."""
    row = "_row"
    while row in (c.lower() for c in docs.columns):
        row = f"_{row}"
    numbered = saved(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-numbered", "zstd")
    groups = similar_groups(numbered, id=row)
    copies = groups.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(row))
    return numbered.join(copies, row, "left_anti").drop(row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not fill to a twentieth or more."""
    found = find_benchmark(docs, table(spark, sf_dir, "benchmark"), keep=True)
    return found.where(~F.col("contaminated")).select("_doc.*")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in their texts; where n_chars was the text's length it follows the new text."""
    fresh = pseudonymise(docs, spark.conf.get(KEY_OPTION, TRIAL_KEY), keep=True)
    columns = {c: F.col(f"_doc.`{c}`") for c in docs.columns}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        same = columns["n_chars"] == F.length(columns["text"])
        columns["n_chars"] = F.when(same, F.length("text").cast(kind)).otherwise(columns["n_chars"])
    columns["text"] = F.col("text")
    return fresh.select(*[value.alias(c) for c, value in columns.items()])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]

# Models and trained state are not expressible in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
