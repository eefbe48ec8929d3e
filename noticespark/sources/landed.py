"""Readers for landed data and the event store.

Landing is outside Spark (downloads); jobs start from files in a shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions.dates import parse_date

# M1: fields requested from the search API
API_RECORD = T.StructType([T.StructField(n, T.StringType()) for n in [
    "document_number", "title", "publication_date", "html_url", "pdf_url", "abstract", "type",
    "executive_order_number", "proclamation_number"]])
API_PAGE = T.StructType([T.StructField("results", T.ArrayType(API_RECORD)),
                         T.StructField("count", T.LongType()),
                         T.StructField("search_term", T.StringType())])


def read_api_records(spark: SparkSession, path: str) -> DataFrame:
    """Landed search-API JSON pages (one JSON object per line) -> one row per result.

    The schema is given, so nothing is inferred; position within the page and the
    file name keep the original result order for first-wins deduplication.
    """
    pages = spark.read.schema(API_PAGE).json(path).withColumn("_file", F.input_file_name())
    return pages.select("search_term", "_file", F.posexplode("results").alias("result_pos", "r")).select(
        "search_term", "_file", "result_pos", "r.*")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """S3: landed HTML pages as (url, html); whole files read as text rows."""
    return spark.read.option("wholetext", True).text(path).select(
        F.input_file_name().alias("url"), F.col("value").alias("html"))


def search_window(records: DataFrame, as_of: str, days: int) -> DataFrame:
    """publication date within [as_of - days, as_of] and the search term in title or abstract."""
    d = parse_date(F.col("publication_date"))
    end = F.to_date(F.lit(as_of))
    hay = F.lower(F.concat_ws(" ", F.col("title"), F.col("abstract")))
    return records.where(d.between(F.date_sub(end, days), end) & F.contains(hay, F.lower(F.col("search_term"))))


def keyword_union(records: DataFrame, as_of: str, days: int, per_term: int = K.FR_RESULTS_PER_TERM) -> DataFrame:
    """A1: UNION ALL of each term's first ``per_term`` results (newest first) — the API page is the feature."""
    w = Window.partitionBy("search_term").orderBy(parse_date(F.col("publication_date")).desc(), F.col("document_number"))
    return search_window(records, as_of, days).withColumn("result_pos", F.row_number().over(w)).where(
        F.col("result_pos") <= per_term)


def existing_hashes(events: DataFrame, source: str | None = None) -> DataFrame:
    """Distinct stored content hashes, optionally of one source (partition-pruned on ``source``)."""
    e = events if source is None else events.where(F.col("source") == source)
    return e.select("content_hash").distinct()


def scan_events(events: DataFrame, limit: int | None = None) -> DataFrame:
    """Events newest first, optional limit."""
    out = events.orderBy(F.col("ingestion_timestamp").desc(), F.col("ingest_seq").desc(), F.col("id"))   # the id settles ties, so a limit is reproducible
    return out.limit(limit) if limit else out


def event_by_hash(events: DataFrame, content_hash: str) -> DataFrame:
    """Point lookup (a pushed-down equality filter on the Parquet store)."""
    return events.where(F.col("content_hash") == content_hash)
