"""Per-source batch jobs (Q1-Q4): landed records -> events (+ edges, outcomes).

One Spark plan per batch.  Set-based execution equals the reference's
per-document loop because a run handles one source, links only to *other*
sources, and first-wins deduplication depends only on arrival order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import identity as I
from ..functions.lookups import source_priority
from ..functions.text import url_tail
from ..operators import enrich as E
from ..operators import parse as P
from ..operators.dedup import dedup_against_store, dedup_within_batch, distinct_by_docnum, edge_upsert_ignore, skip_seen_urls
from ..operators.link import link_documents
from .raw import with_raw_paths
from .sinks import append_events, append_relationships, read_table_or_empty, staged

DEFAULT_AS_OF = "2026-01-01 00:00:00"
ACTION_TYPES = {"federal_register": "unknown", "ustr": "unknown", "cbp_csms": "implementation"}
DATA_FIELDS = ["source", "document_type", "title", "publication_date", "effective_date", "expiration_date",
               "identifiers", "source_url", "pdf_url", "abstract", "tariff_action"]

#: What the envelope takes from a prepared document; only these go through the shuffle of the deduplication.
EVENT_FIELDS = ["arrival_seq", "content_hash", "confidence_raw", "validation_status", "raw_html_path", "raw_pdf_path", *DATA_FIELDS]


@dataclass
class BatchResult:
    events: DataFrame      # new rows for the events table
    edges: DataFrame       # new rows for the relationships table
    outcomes: DataFrame    # one row per landed document: processed / duplicate / failed
    quarantine: DataFrame | None = None   # documents whose page never landed, to be run again


def prepare_documents(parsed: DataFrame, source: str | None, pages: DataFrame | None, pdf_docs: DataFrame | None,
                      facts: DataFrame | None = None) -> DataFrame:
    """Page/PDF codes -> products -> normalise -> validate -> score -> hash.

    ``source=None`` prepares a mixed-source batch (per-row action type and CBP effective date); ``facts``: the pages'
    ``page_facts`` where they are made already.
    """
    docs = parsed
    if pages is not None:
        docs = E.attach_pages(docs, pages, source, facts)
    else:
        docs = docs.withColumn("html_hts_codes", F.lit(None).cast("array<string>")).withColumn(
            "raw_html_path", F.lit(None).cast("string"))
    if pdf_docs is not None:
        docs = E.attach_pdfs(docs, pdf_docs)
    else:
        docs = docs.withColumn("pdf_hts_codes", F.lit(None).cast("array<string>")).withColumn(
            "raw_pdf_path", F.lit(None).cast("string"))
    for c in ("effective_date", "expiration_date"):
        if c not in docs.columns:
            docs = docs.withColumn(c, F.lit(None).cast("string"))
    if source is None:
        action = F.when(F.col("source") == "cbp_csms", F.lit(ACTION_TYPES["cbp_csms"])).otherwise(F.lit("unknown"))
    else:
        action = ACTION_TYPES[source]
    docs = E.build_products(docs, action)
    docs = E.normalize_document(docs)
    docs = E.validate_and_score(docs)
    return E.with_content_hash(docs)


def event_envelope(docs: DataFrame, as_of=DEFAULT_AS_OF) -> DataFrame:
    """The events-table row (deterministic id from the hash; ingestion time = run time).

    ``as_of`` is a timestamp string or a Column (per-row run time).
    """
    data = F.struct(*[F.col(c) for c in DATA_FIELDS])
    ts = F.to_timestamp(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return docs.select(
        I.event_id(F.col("content_hash")).alias("id"), "content_hash",
        ts.alias("ingestion_timestamp"), F.col("arrival_seq").alias("ingest_seq"),
        F.lit(K.PARSER_VERSION).alias("parser_version"),
        F.col("confidence_raw").cast("decimal(3,2)").alias("confidence_score"), "confidence_raw",
        "validation_status", F.lit(None).cast("timestamp").alias("last_verified_date"),
        "source", source_priority(F.col("source")).alias("source_priority"), data.alias("data"),
        "raw_html_path", "raw_pdf_path", F.lit(None).cast("string").alias("raw_json_path"), F.lit("[]").alias("conflicts"),
    )


def link_projection(events: DataFrame) -> DataFrame:
    """The narrow shape used for linking — the abstract is dropped."""
    return events.select(
        "id", "source", F.col("data.title").alias("title"), F.col("data.publication_date").alias("publication_date"),
        F.col("data.identifiers.fr_document_number").alias("fr_document_number"),
        E.product_codes(F.col("data.tariff_action.products")).alias("codes"), "ingestion_timestamp", "ingest_seq")


def mark_failed(docs: DataFrame, source: str, has_pages: bool = True) -> DataFrame:
    """``_failed`` marks a Federal Register document with a URL whose page has not landed."""
    if source == "federal_register" and has_pages:
        return docs.withColumn("_failed", F.col("source_url").isNotNull() & F.col("raw_html_path").isNull())
    return docs.withColumn("_failed", F.lit(False))


def fresh_documents(docs: DataFrame, source: str, store: DataFrame | None) -> DataFrame:
    """Marked documents -> those that become events, for batch and stream alike.

    A7 before J1 (same result set): the partial min_by aggregate collapses a hot hash before the anti-join shuffles
    on it.  The store is filtered on its partition column, so only this source's hashes are read.
    """
    first = dedup_within_batch(docs.where(~F.col("_failed")).select(*EVENT_FIELDS))
    if store is None:
        return first
    return dedup_against_store(first, store.where(F.col("source") == source).select("source", "content_hash"))


def run_batch(parsed: DataFrame, source: str, store: DataFrame | None = None, pages: DataFrame | None = None,
              pdf_docs: DataFrame | None = None, as_of: str = DEFAULT_AS_OF, link: bool = True,
              link_limit: int | None = None, existing_edges: DataFrame | None = None,
              with_title: bool = True, skip_urls: bool = False, lineage: DataFrame | None = None) -> BatchResult:
    """Run one source's batch against the events store (``skip_urls``: the J2 check before any page is read).

    ``lineage``: the names under which ``raw.store_raw`` kept the batch's bodies; events then carry their raw paths.

    A7 keeps the first of equal hashes inside the batch, J1 drops hashes the store
    already holds for this source (the two commute), then new events are linked
    against stored events of the other sources (F5) and edges are upsert-ignored (A8).
    """
    if skip_urls and store is not None:
        parsed = skip_seen_urls(parsed, store.where(F.col("source") == source))
    docs = mark_failed(prepare_documents(parsed, source, pages, pdf_docs), source, pages is not None)
    if link and store is not None:
        docs = staged(docs, "documents")   # linking reads both sides many times: they start from files
    first = fresh_documents(docs, source, store)
    events = event_envelope(first, as_of)
    if lineage is not None:
        events = with_raw_paths(events, lineage)

    outcome = (docs.select("arrival_seq", "source", "content_hash", "_failed",
                           F.size("tariff_action.products").alias("product_count"))
               .join(first.select("arrival_seq", F.lit(True).alias("_kept")), "arrival_seq", "left")
               .select("arrival_seq", "source", "content_hash", F.when(F.col("_failed"), 0).otherwise(F.col("product_count")).alias("product_count"),
                       F.when(F.col("_failed"), F.lit("failed")).when(F.col("_kept"), F.lit("processed"))
                       .otherwise(F.lit("duplicate")).alias("outcome")))

    if link and store is not None:
        new = staged(link_projection(events), "new")
        others = staged(link_projection(store.where(F.col("source") != source)), "others")
        edges = link_documents(new, others, limit=link_limit, with_title=with_title)
        edges = edge_upsert_ignore(edges, existing_edges)
    else:
        edges = None
    quarantine = docs.where("_failed").select("arrival_seq", "source", "title", "source_url", F.lit("page not landed").alias("error"))
    return BatchResult(events=events, edges=edges, outcomes=outcome, quarantine=quarantine)


def store_batch(result: BatchResult, store: DataFrame, source: str, staging_path: str, events_path: str,
                edges_path: str, link_limit: int | None = None, with_title: bool = True) -> None:
    """K1 then K2: stage the batch's events once, append them, then link the staged rows.

    Linking from the staged rows (instead of the lazy event plan) runs the
    document preparation once per batch and cuts the lineage before the join work.
    """
    spark = result.events.sparkSession
    result.events.write.mode("overwrite").parquet(staging_path)
    own = spark.read.parquet(staging_path)
    append_events(own, events_path)
    others = staged(link_projection(store.where(F.col("source") != source)), "others")
    edges = link_documents(staged(link_projection(own), "new"), others, limit=link_limit, with_title=with_title)
    stored_edges = read_table_or_empty(spark, edges_path, edges)
    append_relationships(edge_upsert_ignore(edges, stored_edges), edges_path)


# ---------------------------------------------------------------- per-source entry points

def fr_pdf_codes(pdf_pages: DataFrame) -> DataFrame:
    """PDF codes per FR filing (key ``k`` of the extracted pages), skew-safe per-page extraction."""
    return E.pdf_doc_codes(pdf_pages.withColumnRenamed("k", "doc_id"), "doc_id", "text")


def fr_documents(raw_records: DataFrame) -> DataFrame:
    """S1 -> A2 -> P1: landed search results, first per document number, parsed."""
    return P.parse_fr(distinct_by_docnum(raw_records))


def fr_pipeline(raw_records: DataFrame, pages: DataFrame, pdf_pages: DataFrame | None, store: DataFrame | None,
                **kw) -> BatchResult:
    """Q1: Federal Register batch (HTML and PDF codes)."""
    pdf_docs = None
    if pdf_pages is not None:
        pdf_docs = fr_pdf_codes(pdf_pages)
    return run_batch(fr_documents(raw_records), "federal_register", store, pages, pdf_docs, **kw)


def ustr_pipeline(link_records: DataFrame, pages: DataFrame, pdf_pages: DataFrame | None, store: DataFrame | None,
                  pdfs_per_page: int | None = None, **kw) -> BatchResult:
    """Q2: USTR batch — page codes plus codes of the linked PDFs of each page (all, or the first ``pdfs_per_page``)."""
    parsed = P.parse_ustr(link_records)
    if "source" in pages.columns:
        pages = pages.where(F.col("source") == "ustr")
    pdf_docs = None
    if pdf_pages is not None:
        links = P.pdf_links(pages.select("url", "html"), per_page=pdfs_per_page).select(F.col("url").alias("page_url"), "pdf_links")
        per_pdf = E.pdf_doc_codes(pdf_pages, "pdf_url", "text")
        docs = (parsed.select("arrival_seq", "source_url")
                .join(links, F.col("source_url") == F.col("page_url"))
                .select("arrival_seq", F.explode("pdf_links").alias("pdf_url")).distinct()
                .join(per_pdf, "pdf_url"))
        pdf_docs = docs.groupBy("arrival_seq").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("pdf_hts_codes")))).alias("pdf_hts_codes"),
            F.sum("page_count").alias("page_count"))
        parsed = parsed.withColumn("pdf_url", F.lit(None).cast("string"))
    return run_batch(parsed, "ustr", store, pages, pdf_docs, **kw)


def ustr_fast_pipeline(link_records: DataFrame, pages: DataFrame, store: DataFrame | None, **kw) -> BatchResult:
    """Q3: USTR without PDFs and without linking."""
    kw["link"] = False
    return run_batch(P.parse_ustr(link_records), "ustr", store, pages, None, **kw)


def cbp_pipeline(link_records: DataFrame, pages: DataFrame, store: DataFrame | None, **kw) -> BatchResult:
    """Q4: CBP batch — page codes and the effective date from the bulletin content."""
    return run_batch(P.parse_cbp(link_records), "cbp_csms", store, pages, None, **kw)


def run_summary(outcomes: DataFrame) -> DataFrame:
    """A5: counts per source and outcome (failed included) and the products handled."""
    return outcomes.groupBy("source", "outcome").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("product_count").alias("products"))


__all__ = ["run_batch", "fr_pipeline", "ustr_pipeline", "ustr_fast_pipeline", "cbp_pipeline", "run_summary",
           "event_envelope", "link_projection", "prepare_documents", "url_tail"]
