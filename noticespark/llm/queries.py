"""The registered queries of the operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticespark.llm import conversation_repair, document_fingerprints, embedding_near_dup, gru_language_model, language_id, quality_classifier, sentencepiece_codec, simhash_near_dedup, source_mix, spelling_variants, substring_dedup, toxicity, url_filters
from noticespark.llm.common import table


def op1_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of at least 0.93 cosine between vectors of one label: their number and the component of every vector."""
    return embedding_near_dup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the dated list on every page at the day it was fetched; list and days are derived from ``pages``."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.verdicts(url_filters.captures_of(pages), url_filters.events_of(pages))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document that loses text: the spans (bytes of the UTF-8 text) whose first copy stays in ``sources``."""
    return substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision for every document, learnt from ``labels.quality`` of the rows not held out."""
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learnt from ``lang`` of the rows not held out."""
    found = language_id.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("langs").alias("n_langs"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, sources weighing 5, 2, 1 in code point order."""
    return source_mix.mix(table(spark, sf_dir, "documents"))


def op7_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether they decode to it."""
    return sentencepiece_codec.encoded(table(spark, sf_dir, "documents"), ["doc_id"])


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its fingerprint and the smallest doc_id of its component (3-word shingles, 2 bits)."""
    found = simhash_near_dedup.near_dedup(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision for every document, learnt from ``labels.toxic`` of the rows not held out."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: fingerprints of its text and its edited text, and their likeness."""
    return document_fingerprints.fingerprint_report(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents, the frequent word it is a variant of and the last word of that chain."""
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation: faults after damage, the cheapest repair of its roles and the hash of the repaired turns."""
    return conversation_repair.report(table(spark, sf_dir, "conversations"))


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document by the recurrent model and by smoothed training counts."""
    return gru_language_model.score(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dup": op1_embedding_near_dup,
    "op2_url_filters": op2_url_filters,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_language_id": op5_language_id,
    "op6_source_mix": op6_source_mix,
    "op7_sentencepiece_codec": op7_sentencepiece_codec,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_document_fingerprints": op10_document_fingerprints,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_language_model": op13_language_model,
}

#: DuckDB SQL where it can express the query; the others are tested against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {"op2_url_filters": url_filters.ORACLE}
