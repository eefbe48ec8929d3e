"""The training-data pipeline: the dealt operators in order over ``documents``, each stage staged as Parquet.

Quality classifier, SimHash near-dedup, substring dedup, mixing sources to target weights, SentencePiece encoding.  Every
stage is judged on its own input: the classifier is learnt from the labels of the documents it is given, links, repeated
passages and source sizes are those of the documents that are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticespark.llm import quality_classifier, sentencepiece_codec, simhash_near_dedup, source_mix, substring_dedup
from noticespark.llm.common import staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents that score less are rejected; without labels every score is 0.5 and all documents stay.
REJECT_BELOW = 0.5


def _measured(docs: DataFrame) -> DataFrame:
    """The columns of documents, ``n_chars`` counted anew after a stage that changes texts."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    weights = quality_classifier.train(quality_classifier.labelled(docs, table(spark, sf_dir, "labels"), "quality", 4, 2, quality_classifier.MAX_TRAIN))
    return quality_classifier.scored(docs, weights, COLUMNS).where(F.col("score") >= REJECT_BELOW).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest doc_id."""
    return simhash_near_dedup.one_of_each(docs.select(*COLUMNS), shingle=3, radius=2)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated passages are cut out of the texts; every document stays."""
    return _measured(substring_dedup.remove_spans(docs.select(*COLUMNS), substring_dedup.repeated_spans(docs)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document; a last part is cut at a word's end."""
    return _measured(source_mix.mixed(docs.select(*COLUMNS)))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text of the mix."""
    return sentencepiece_codec.encoded(docs, ["doc_id", "source"])


STAGES = [
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("source_mix", mix_sources),
    ("sentencepiece_codec", encode),
]

#: No SQL form: training, hashing and encoding have none.  The pipeline is tested against brute force on a small fixture.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
