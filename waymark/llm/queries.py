"""Registered queries of the corpus operators: each applies one operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import oracles
from waymark.llm.alignment import align_tokenizers, text_digest
from waymark.llm.common import table
from waymark.llm.decontamination import find_benchmark, items_digest
from waymark.llm.language import identify_language
from waymark.llm.language_model import score_documents
from waymark.llm.manifest import folded, leaf_digest, merkle_manifest
from waymark.llm.ngram_join import similar_groups
from waymark.llm.packing import pack_documents
from waymark.llm.pii import KEY_OPTION, pseudonymise
from waymark.llm.quality import clean_lines
from waymark.llm.sharding import shard_documents
from waymark.llm.substrings import remove_repeats
from waymark.llm.token_counts import token_counts
from waymark.llm.window_packing import pack_windows

Job = Callable[[SparkSession, str], DataFrame]

# For trial runs of the query on generated tables; a real run sets the option.
TRIAL_KEY = "trial"


def op1_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return similar_groups(table(spark, sf, "documents"), shingle=3, percent=90).drop("class_id")


def op2_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return shard_documents(table(spark, sf, "documents"))


def op3_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return score_documents(table(spark, sf, "documents"))


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    return clean_lines(table(spark, sf, "documents")).drop("clean_text")


def op5_language(spark: SparkSession, sf: str) -> DataFrame:
    return identify_language(table(spark, sf, "documents"))


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = find_benchmark(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", *items_digest(), "contaminated")


def op7_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pseudonymise(table(spark, sf, "documents"), spark.conf.get(KEY_OPTION, TRIAL_KEY))


def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(table(spark, sf, "documents"))


def op9_substrings(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeats(table(spark, sf, "documents"))


def op10_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(table(spark, sf, "documents"))


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return align_tokenizers(table(spark, sf, "documents"), groups=text_digest).withColumnRenamed("groups", "groups_sha256")


def op12_window_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_windows(table(spark, sf, "documents"))


def manifest_check(docs: DataFrame) -> DataFrame:
    """The manifest of documents, and the roots to which their leaves lead after every seventh id's n_chars was raised by one."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = [F.col("n_chars") + 1 if f == "n_chars" else f for f in fields]
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = F.when(chosen, leaf_digest(tampered)).otherwise(leaf_digest(fields))
    found = folded(merkle_manifest(docs, fields, keep=changed), "kept")
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return manifest_check(table(spark, sf, "documents"))


QUERIES: dict[str, Job] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_sharding": op2_sharding,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_quality": op4_quality,
    "op5_language": op5_language,
    "op6_decontamination": op6_decontamination,
    "op7_pii": op7_pii,
    "op8_token_counts": op8_token_counts,
    "op9_substrings": op9_substrings,
    "op10_packing": op10_packing,
    "op11_alignment": op11_alignment,
    "op12_window_packing": op12_window_packing,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op1_ngram_join": oracles.NGRAM_JOIN,
    "op4_quality": oracles.QUALITY,
    "op6_decontamination": oracles.DECONTAMINATION,
    "op13_merkle_manifest": oracles.MANIFEST,
}
