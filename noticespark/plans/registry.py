"""Registered queries: one per inventory operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (directly or through the deterministic
projections in ``sources.fixtures``) over the whole tables, so its work grows
with them.  Computed columns carry the same aliases as the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import constants as K
from ..functions import dates as D
from ..functions import identity as I
from ..functions import scoring as S
from ..functions import text as T
from ..functions.lookups import country_code, source_priority, source_relationship
from ..functions.rates import normalize_rate, validate_rate
from ..functions.similarity import jaccard, title_ratio
from ..operators import aggregates as A
from ..operators import dedup as DD
from ..operators import enrich as E
from ..operators import link as L
from ..operators import parse as P
from ..operators import quality as Q
from ..operators.review import review_blocks
from ..session import staged
from ..sources import fixtures as X
from ..sources import landed as LD
from ..sources.tables import read_table
from . import pipelines as PL
from . import raw as RW
from . import scenario as SC

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ shared views

def _event_cols(ev: DataFrame) -> DataFrame:
    return ev.select("id", "content_hash", "source", "source_priority", "validation_status", "confidence_raw",
                     "ingest_seq", F.col("data.title").alias("title"), F.col("data.publication_date").alias("publication_date"),
                     F.size("data.tariff_action.products").alias("n_products"))


def _fr_new_events(spark, sf):
    return SC.fr_run(spark, sf, link=False).events


def _link_sides(spark, sf):
    """The run's new events and the stored events of the other sources in the linking shape (staged), and the store."""
    new, other = SC.link_sides(spark, sf)
    return new, other, SC.store_events(spark, sf)


# ------------------------------------------------------------------ Q: whole pipelines

@query("fr_pipeline")
def q_fr_pipeline(spark, sf):
    """Q1: events the FR run adds (after store and in-batch dedup)."""
    return _event_cols(_fr_new_events(spark, sf))


@query("ustr_pipeline")
def q_ustr_pipeline(spark, sf):
    """Q2: the USTR run's events (no PDFs landed for USTR pages)."""
    l = SC.landed(spark, sf)
    return _event_cols(PL.ustr_pipeline(l.ustr, l.pages, l.pdf_pages, None, as_of=SC.AS_OF["ustr"], link=False).events)


@query("ustr_fast_pipeline")
def q_ustr_fast(spark, sf):
    """Q3: USTR without PDFs and without linking."""
    l = SC.landed(spark, sf)
    return _event_cols(PL.ustr_fast_pipeline(l.ustr, l.pages, None, as_of=SC.AS_OF["ustr"]).events)


@query("cbp_pipeline")
def q_cbp(spark, sf):
    """Q4: the CBP run's events, effective date from the bulletin content."""
    l = SC.landed(spark, sf)
    ev = PL.cbp_pipeline(l.cbp, l.pages, None, as_of=SC.AS_OF["cbp_csms"], link=False).events
    return _event_cols(ev).join(ev.select("id", F.col("data.effective_date").alias("effective_date")), "id")


@query("fr_pipeline_links")
def q_fr_links(spark, sf):
    """Q1 tail: edges of the FR run (every stored event a candidate, title ratio via the Arrow UDF)."""
    e = SC.fr_run(spark, sf).edges
    return e.select("parent_event_id", "related_event_id", "relationship_type", "confidence_raw", "match_rank")


# ------------------------------------------------------------------ S: scans / sources

@query("scan_api_records")
def q_scan_api(spark, sf):
    """Landed FR search results (one per matching term)."""
    return X.fr_raw(spark, sf).select("search_term", "document_number", "title", "publication_date", "html_url",
                                      "pdf_url", "abstract", "type", "proclamation_number")


@query("scan_doc_details")
def q_doc_details(spark, sf):
    """FR document details for every number referenced by another source's title."""
    l = SC.landed(spark, sf)
    fr = PL.fr_documents(l.fr_raw)
    refs = (l.ustr.unionByName(l.cbp.select(*l.ustr.columns))
            .select(F.nullif(F.regexp_extract("title", r"FR Doc\. ([0-9]{4}-[0-9]+)", 1), F.lit("")).alias("ref"))
            .where(F.col("ref").isNotNull()).distinct())
    return fr.join(refs, F.col("identifiers.fr_document_number") == F.col("ref"), "left_semi").select(
        F.col("identifiers.fr_document_number").alias("document_number"), "title", "publication_date", "source_url", "pdf_url")


@query("scan_raw_html")
def q_scan_html(spark, sf):
    """S3: landed raw pages (driver pages) with their size."""
    return read_table(spark, sf, "pages", "page_id", "url", "html").select(
        "page_id", "url", F.octet_length("html").alias("n_bytes"))


@query("pdf_pages_to_doc")
def q_pdf_pages(spark, sf):
    """Pages (conversation turns) -> one document: non-empty texts joined by newline, page count."""
    conv = read_table(spark, sf, "conversations", "conv_id", "turn", "text")
    out = E.pdf_pages_to_doc(conv, "conv_id", "turn", "text", None)
    return out.select("conv_id", F.sha2("pdf_text", 256).alias("text_sha256"), F.length("pdf_text").alias("text_chars"),
                      "page_count")


@query("listing_links")
def q_listing_links(spark, sf):
    """Every anchor of the driver pages in document order."""
    pages = read_table(spark, sf, "pages", "page_id", "url", "html")
    return P.listing_links(pages).select("page_id", "pos", "href", "title")


@query("pdf_links")
def q_pdf_links(spark, sf):
    """Every '.pdf' link of the listing pages, resolved."""
    pages = X.listing_pages(spark, sf, "ustr")
    out = P.pdf_links(pages)
    return out.select("page_id", F.posexplode("pdf_links").alias("pdf_pos", "pdf_url"))


@query("scan_events")
def q_scan_events(spark, sf):
    """The stored events, newest first (order is not part of the compare)."""
    st = LD.scan_events(SC.store_events(spark, sf))   # range-partitioned global sort, no single-task window
    return st.select("id", "source", "content_hash", "ingest_seq")


@query("event_by_hash")
def q_event_by_hash(spark, sf):
    """Stored event for each landed FR document's hash (point lookups as one join)."""
    l = SC.landed(spark, sf)
    st = SC.store_events(spark, sf, l)
    docs = PL.prepare_documents(PL.fr_documents(l.fr_raw), "federal_register", l.pages,
                                PL.fr_pdf_codes(l.pdf_pages))
    return docs.select("arrival_seq", "content_hash").join(st.select("content_hash", "id", "source"), "content_hash").select(
        "arrival_seq", "id", "source")


@query("existing_hashes")
def q_existing_hashes(spark, sf):
    """Distinct stored hashes of one source."""
    return LD.existing_hashes(SC.store_events(spark, sf), "federal_register")


# ------------------------------------------------------------------ P: projections

@query("parse_fr")
def q_parse_fr(spark, sf):
    """P1 (+A2): FR records -> parsed documents."""
    d = PL.fr_documents(X.fr_raw(spark, sf))
    return d.select("source", "document_type", "title", "publication_date", "identifiers.*", "source_url", "pdf_url", "abstract")


@query("parse_ustr")
def q_parse_ustr(spark, sf):
    """P2."""
    d = P.parse_ustr(X.link_records(spark, sf, "ustr"))
    return d.select("source", "document_type", "title", "publication_date", "identifiers.*", "source_url", "abstract")


@query("parse_cbp")
def q_parse_cbp(spark, sf):
    """CSMS number from the title."""
    d = P.parse_cbp(X.link_records(spark, sf, "cbp_csms"))
    return d.select("source", "document_type", "title", "publication_date", "identifiers.*", "source_url", "abstract")


@query("resolve_url")
def q_resolve_url(spark, sf):
    """Every listing anchor resolved against the USTR base URL."""
    links = P.listing_links(X.listing_pages(spark, sf, "ustr"))
    return links.select("page_id", "pos", T.resolve_url(F.col("href"), K.USTR_BASE_URL).alias("url"))


@query("assemble_event")
def q_assemble(spark, sf):
    """P5: FR documents with their tariff action (codes and validation flags)."""
    l = SC.landed(spark, sf)
    docs = PL.prepare_documents(PL.fr_documents(l.fr_raw), "federal_register", l.pages,
                                PL.fr_pdf_codes(l.pdf_pages))
    prods = F.col("tariff_action.products")
    return docs.select("arrival_seq", F.col("tariff_action.type").alias("action_type"),
                       F.array_join(F.transform(prods, lambda p: p.getField("hts_code")), ",").alias("codes"),
                       F.size(F.filter(prods, lambda p: p.getField("hts_code_validated"))).alias("n_valid"))


@query("event_envelope")
def q_envelope(spark, sf):
    """Envelope fields of the FR run's events."""
    ev = _fr_new_events(spark, sf)
    return ev.select("id", "source", "source_priority", "parser_version", "validation_status",
                     F.col("confidence_score").cast("double").alias("confidence_score"), "conflicts")


@query("link_projection")
def q_link_projection(spark, sf):
    """The narrow link shape of all stored events."""
    lp = PL.link_projection(SC.store_events(spark, sf))
    return lp.select("id", "source", "title", "publication_date", "fr_document_number",
                     F.array_join("codes", ",").alias("codes"))


@query("outcome_status")
def q_outcomes(spark, sf):
    """Outcome of every FR document of a run while pages are missing."""
    return SC.fr_run(spark, sf, link=False, pages_missing=True).outcomes.select("arrival_seq", "outcome")


@query("url_tail")
def q_url_tail(spark, sf):
    """Document id from the URL tail."""
    return X.link_records(spark, sf, "ustr").select("url", T.url_tail(F.col("url")).alias("doc_id"))


# ------------------------------------------------------------------ F: filters

@query("fr_search_window")
def q_search_window(spark, sf):
    """FR records published in the 90 days up to the as-of date that match their term."""
    return LD.search_window(X.fr_raw(spark, sf), "1998-06-30", 90).select("search_term", "document_number", "publication_date")


@query("ustr_keyword_filter")
def q_ustr_filter(spark, sf):
    """F2 (no top-20 cut): tariff-related press-release links."""
    links = P.listing_links(X.listing_pages(spark, sf, "ustr"))
    return P.ustr_links(links, limit=None).select("page_id", "pos", "title", "url")


@query("cbp_keyword_filter")
def q_cbp_filter(spark, sf):
    """F3 (no top-20 cut): tariff-related CSMS links with their number."""
    links = P.listing_links(X.listing_pages(spark, sf, "cbp"))
    return P.cbp_links(links, limit=None).select("page_id", "pos", "title", "url", "csms_number")


@query("linkable_docs")
def q_linkable(spark, sf):
    """new FR events that may link (codes and a publication date)."""
    return L.linkable(PL.link_projection(_fr_new_events(spark, sf))).select("id", F.size("codes").alias("n_codes"))


@query("other_source")
def q_other_source(spark, sf):
    """pairs of linkable new FR events and stored events of another source, per stored source."""
    new, _, store = _link_sides(spark, sf)
    return L.other_source_counts(new, PL.link_projection(store))


@query("jsonb_containment")
def q_containment(spark, sf):
    """per linkable new FR event, whether an event of another source shares a code."""
    new, store, _ = _link_sides(spark, sf)
    return L.shares_code(new, store)


@query("date_band")
def q_date_band(spark, sf):
    """per linkable new FR event, the number of other-source events published < 30 days apart."""
    new, store, _ = _link_sides(spark, sf)
    return L.band_counts(new, store)


# ------------------------------------------------------------------ J: joins

@query("dedup_against_store")
def q_dedup_store(spark, sf):
    """FR documents whose hash is not yet stored for FR."""
    l = SC.landed(spark, sf)
    st = SC.store_events(spark, sf, l)
    docs = PL.prepare_documents(PL.fr_documents(l.fr_raw), "federal_register", l.pages,
                                PL.fr_pdf_codes(l.pdf_pages))
    st = st.where(F.col("source") == "federal_register")   # one partition of the store, as in the pipelines
    return DD.dedup_against_store(docs, st.select("source", "content_hash")).select("arrival_seq", "content_hash")


@query("pre_dedup_hash")
def q_pre_dedup(spark, sf):
    """Preliminary hash per USTR link and whether the store holds it (never: a constant per source)."""
    l = SC.landed(spark, sf)
    st = SC.store_events(spark, sf, l)
    pre = DD.pre_dedup_hash(P.parse_ustr(l.ustr)).select("arrival_seq", "preliminary_hash")
    # The hash is one constant per source: its distinct values are looked up, not every document.
    hit = pre.select("preliminary_hash").distinct().join(
        st.select(F.col("content_hash").alias("preliminary_hash")).distinct(), "preliminary_hash", "left_semi")
    return pre.join(hit.withColumn("stored", F.lit(True)), "preliminary_hash", "left").select(
        "arrival_seq", "preliminary_hash", F.coalesce("stored", F.lit(False)).alias("stored"))


@query("candidate_join")
def q_candidate_join(spark, sf):
    """Newest five candidates per new FR event (code OR date band, other source)."""
    new, store, _ = _link_sides(spark, sf)
    return L.candidate_pairs(new, store, K.LINK_CANDIDATE_LIMIT).select("new_id", "id")


@query("candidate_join_newest")
def q_candidate_newest(spark, sf):
    """J3 + W3 from newest-k tables that four runs have merged their events into (the last one replays a third of the store)."""
    from .newest import candidates, merge_newest
    new, other, _ = _link_sides(spark, sf)
    path = _scratch(spark, "newest")
    for run in (F.col("ingest_seq") % 2 == 0, F.col("source") == "ustr", F.col("source") == "cbp_csms", F.col("ingest_seq") % 3 == 1):
        merge_newest(spark, other.where(run), path)
    return candidates(spark, new, path).select("new_id", "id", "cand_rank")


@query("link_documents")
def q_link_documents(spark, sf):
    """Scored edges over the newest-five candidates (with the title ratio UDF)."""
    new, store, _ = _link_sides(spark, sf)
    e = L.link_documents(new, store, limit=K.LINK_CANDIDATE_LIMIT)
    return e.select("parent_event_id", "related_event_id", "relationship_type", "confidence_raw", F.array_join("matching_factors", ",").alias("factors"))


@query("link_documents_all")
def q_link_all(spark, sf):
    """J4 with every other-source document a candidate (prefix-filtered, exact)."""
    new, store, _ = _link_sides(spark, sf)
    e = L.link_documents(new, store, limit=None)
    return e.select("parent_event_id", "related_event_id", "relationship_type", "confidence_raw")


def _with_copies(docs: DataFrame) -> DataFrame:
    """Every seventh document three times, under ids of their own."""
    copies = F.explode(F.when(F.col("ingest_seq") % 7 == 0, F.array(F.lit(""), F.lit("#1"), F.lit("#2"))).otherwise(F.array(F.lit(""))))
    return docs.withColumn("_copy", copies).withColumn("id", F.concat("id", "_copy")).drop("_copy")


def _class_links(spark, sf):
    from ..operators.link_classes import link_classes
    new, store, _ = _link_sides(spark, sf)
    return link_classes(_with_copies(new), _with_copies(store))


@query("link_classes")
def q_link_classes(spark, sf):
    """J4 on classes of equal documents: one edge per pair of classes with the number of documents on either side."""
    return _class_links(spark, sf).edges.select("parent_class", "related_class", "n_parents", "n_related", "relationship_type", "confidence_raw")


@query("class_link_counts")
def q_class_counts(spark, sf):
    """Class and number of links of every linkable new document, from the edges between classes."""
    from ..operators.link_classes import link_counts
    return link_counts(_class_links(spark, sf))


@query("docnum_match")
def q_docnum(spark, sf):
    """Pairs with equal FR numbers or a number inside the other's title (n-gram equi-join)."""
    new, store, _ = _link_sides(spark, sf)
    return L.docnum_pairs(new, store)


def _dup_sides(spark, sf):
    """Landed FR documents with small changes (a longer title, one code fewer, another date) against the stored events."""
    l = SC.landed(spark, sf)
    st = SC.store_events(spark, sf, l)
    docs = PL.prepare_documents(PL.fr_documents(l.fr_raw), "federal_register", l.pages,
                                PL.fr_pdf_codes(l.pdf_pages))
    seq, codes = F.col("arrival_seq"), E.product_codes(F.col("tariff_action.products"))
    new = docs.select(
        seq.cast("string").alias("id"), F.col("identifiers.fr_document_number").alias("fr_document_number"),
        F.when(seq % 5 == 1, F.slice(F.array_sort(codes), 1, F.greatest(F.lit(1), F.size(codes) - 1))).otherwise(codes).alias("codes"),
        F.when(seq % 5 == 2, F.concat("title", F.lit(" corrected"))).when(seq % 5 == 3, F.lit("Other")).otherwise(F.col("title")).alias("title"),
        F.when(seq % 5 == 4, F.lit("1990-01-01")).otherwise(F.col("publication_date")).alias("publication_date"))
    return new, PL.link_projection(st)


@query("near_duplicates")
def q_near_dups(spark, sf):
    """Landed FR documents that nearly duplicate stored ones (>= 0.85, title via UDF)."""
    new, stored = _dup_sides(spark, sf)
    return DD.near_duplicates(new, stored).select("new_id", "existing_id", "similarity")


@query("chapter_info")
def q_chapter(spark, sf):
    """Chapter and description of every distinct code carried by a filing."""
    codes = X.filing_codes(spark, sf).select("code").distinct()
    ci = C.chapter_info(F.col("code"))
    return codes.select("code", ci.getField("chapter").alias("chapter"), ci.getField("description").alias("description"))


@query("country_lookup")
def q_country(spark, sf):
    """Supplier country names -> ISO2 (names from a fixed rule on s_suppkey)."""
    s = read_table(spark, sf, "supplier", "s_suppkey")
    return s.select("s_suppkey", X.supplier_country_name(F.col("s_suppkey")).alias("country_name")).select(
        "s_suppkey", "country_name", country_code(F.col("country_name")).alias("iso2"))


@query("source_relationship")
def q_source_rel(spark, sf):
    """Relationship name for every reachable pair's ordered source pair."""
    new, store, _ = _link_sides(spark, sf)
    c = SC.run_pairs(spark, sf)
    j = c.join(store.select("id", "source"), "id")
    return j.select("new_id", "id", source_relationship(F.lit("federal_register"), F.col("source")).alias("relationship"))


# ------------------------------------------------------------------ A: aggregations

@query("keyword_union")
def q_keyword_union(spark, sf):
    """A1: per search term, at most 100 results in the window (API page), concatenated."""
    return LD.keyword_union(X.fr_raw(spark, sf), "1998-06-30", 365).select("search_term", "document_number", "result_pos")


@query("distinct_by_docnum")
def q_distinct_docnum(spark, sf):
    """A2: first record per document number."""
    return DD.distinct_by_docnum(X.fr_raw(spark, sf)).select("document_number", "search_term", "arrival_seq")


@query("merge_codes")
def q_merge_codes(spark, sf):
    """A3: HTML codes, PDF codes and their union per FR document."""
    l = SC.landed(spark, sf)
    docs = E.attach_pages(PL.fr_documents(l.fr_raw), l.pages, "federal_register")
    docs = E.attach_pdfs(docs, PL.fr_pdf_codes(l.pdf_pages))
    return docs.select("arrival_seq", F.size("html_hts_codes").alias("n_html"), F.size("pdf_hts_codes").alias("n_pdf"),
                       F.size(C.merge_codes(F.col("html_hts_codes"), F.col("pdf_hts_codes"))).alias("n_merged"))


@query("hts_batch_summary")
def q_hts_batch(spark, sf):
    """A4: total / valid / invalid codes per source over all filings."""
    fc = X.filing_codes(spark, sf).join(X.filings(spark, sf).select("k", "source"), "k")
    return A.hts_batch_summary(fc, "code", ["source"])


@query("run_summary")
def q_run_summary(spark, sf):
    """A5: documents and products per outcome of an FR run while pages are missing."""
    return PL.run_summary(SC.fr_run(spark, sf, link=False, pages_missing=True).outcomes)


@query("jaccard_codes")
def q_jaccard(spark, sf):
    """Code Jaccard of every reachable pair."""
    new, store, _ = _link_sides(spark, sf)
    c = SC.run_pairs(spark, sf)
    j = (c.join(new.select(F.col("id").alias("new_id"), F.col("codes").alias("a")), "new_id")
         .join(store.select("id", F.col("codes").alias("b")), "id"))
    return j.select("new_id", "id", jaccard(F.col("a"), F.col("b")).alias("jaccard"))


@query("dedup_within_batch")
def q_dedup_batch(spark, sf):
    """Replayed landing (every filing, then filings k%20=0 again) -> first per hash wins."""
    l = SC.landed(spark, sf)
    rec = l.ustr.unionByName(l.ustr.where(F.col("arrival_seq") % 20 == 0).withColumn("arrival_seq", F.col("arrival_seq") + 10 ** 9))
    docs = PL.prepare_documents(P.parse_ustr(rec), "ustr", l.pages, None)
    return DD.dedup_within_batch(docs).select("arrival_seq", "content_hash")


@query("edge_upsert_ignore")
def q_edge_upsert(spark, sf):
    """All edges of the run, inserted twice -> one row per (parent, related)."""
    e = SC.run_edges(spark, sf)
    first = DD.edge_upsert_ignore(e)
    again = DD.edge_upsert_ignore(e, existing_edges=first)
    return first.unionByName(again).select("parent_event_id", "related_event_id", "relationship_type", "confidence_raw")


@query("quality_histogram")
def q_quality_hist(spark, sf):
    """Count of score cases per quality label."""
    sc = A.score_cases_scored(X.score_cases(spark, sf))
    return sc.groupBy(S.quality_label(F.col("confidence_raw")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ W: windows / top-k

@query("top20_links")
def q_top20(spark, sf):
    """First 20 tariff-related press-release links per listing page."""
    links = P.listing_links(X.listing_pages(spark, sf, "ustr"))
    return P.ustr_links(links, limit=K.LISTING_LINK_LIMIT).select("page_id", "pos", "url")


@query("top2_pdfs")
def q_top2(spark, sf):
    """First two PDF links per listing page."""
    return P.pdf_links(X.listing_pages(spark, sf, "ustr"), per_page=K.PDFS_PER_PAGE).select("page_id", F.array_join("pdf_links", " ").alias("pdfs"))


@query("top5_candidates")
def q_top5(spark, sf):
    """Candidate rank 1..5 per new FR event."""
    new, store, _ = _link_sides(spark, sf)
    return L.candidate_pairs(new, store, K.LINK_CANDIDATE_LIMIT).select("new_id", "id", "cand_rank")


@query("rank_matches")
def q_rank_matches(spark, sf):
    """All edges of the run ranked by confidence per parent."""
    return SC.run_edges(spark, sf).select("parent_event_id", "related_event_id", "confidence_raw", "match_rank")


@query("rank_duplicates")
def q_rank_dups(spark, sf):
    """Duplicates of at least 0.85 ranked per document by similarity."""
    new, stored = _dup_sides(spark, sf)
    return DD.rank_duplicates(DD.near_duplicates(new, stored)).select("new_id", "existing_id", "dup_rank")


@query("first5_sorted_codes")
def q_first5(spark, sf):
    """First five sorted 7-char code prefixes per filing."""
    fc = X.filing_codes(spark, sf).groupBy("k").agg(F.collect_list("code").alias("codes"))
    return fc.select("k", F.array_join(C.first5_sorted_codes(F.col("codes")), ",").alias("first5"))


# ------------------------------------------------------------------ X: text / regex / HTML

@query("html_text")
def q_html_text(spark, sf):
    """X1 on the driver pages."""
    p = read_table(spark, sf, "pages", "page_id", "html")
    t = T.html_text(F.col("html"))
    return p.select("page_id", F.sha2(t, 256).alias("text_sha256"), F.length(t).alias("text_chars"))


@query("html_tables")
def q_html_tables(spark, sf):
    """X2 on the notice pages: one row per table row, cells joined by ' | '."""
    p = X.notice_pages(spark, sf)
    t = p.select("k", F.posexplode_outer(T.html_tables(F.col("html"))).alias("t_idx", "tbl"))   # not outer would make the tables twice
    r = t.select("k", "t_idx", F.posexplode("tbl").alias("r_idx", "cells"))
    return r.select("k", "t_idx", "r_idx", F.array_join("cells", " | ").alias("row_text"))


@query("main_content")
def q_main_content(spark, sf):
    """Article text of the driver pages and bulletin text of the CBP notice pages."""
    p = read_table(spark, sf, "pages", "page_id", "html")
    a = p.select(F.concat(F.lit("page:"), F.col("page_id").cast("string")).alias("doc"),
                 F.sha2(T.main_content_article(F.col("html")), 256).alias("content_sha256"))
    n = X.notice_pages(spark, sf).where(F.col("k") % 3 == 2)
    b = n.select(F.concat(F.lit("notice:"), F.col("k").cast("string")).alias("doc"),
                 F.sha2(T.main_content_cbp(F.col("html")), 256).alias("content_sha256"))
    return a.unionByName(b)


@query("html_hts_codes")
def q_html_codes(spark, sf):
    """X4 on the notice pages (decoy nav table and footer are dropped)."""
    p = X.notice_pages(spark, sf)
    return p.select("k", F.array_join(C.html_hts_codes(T.html_text(F.col("html"))), ",").alias("codes"))


@query("pdf_hts_codes")
def q_pdf_codes(spark, sf):
    """X4 on extracted PDF pages: codes per FR filing (per-page extraction, set union)."""
    l = SC.landed(spark, sf)
    return PL.fr_pdf_codes(l.pdf_pages).select(F.col("doc_id").alias("k"), F.array_join("pdf_hts_codes", ",").alias("codes"))


@query("extract_hts_codes")
def q_extract_codes(spark, sf):
    """X5 on every notice sentence (dotted-10, dotted-6 inside it, bare-10)."""
    pl = X.parent_lines(spark, sf)
    return pl.select("l_orderkey", "l_linenumber", "l_partkey",
                     F.array_join(C.extract_hts_codes(F.col("sentence")), ",").alias("codes"))


@query("normalize_hts")
def q_normalize_hts(spark, sf):
    """X6 on three spellings per line: bare 10 digits, dotted 6, and a 9-digit fragment."""
    pl = X.parent_lines(spark, sf)
    return pl.select("l_orderkey", "l_linenumber", "l_partkey",
                     C.normalize_hts(F.col("g")).alias("from_bare"),
                     C.normalize_hts(X.dotted6(F.col("g"))).alias("from_dotted6"),
                     C.normalize_hts(F.substring("g", 1, 9)).alias("from_nine"))


@query("extract_rates")
def q_extract_rates(spark, sf):
    """Rate mentions with value and +/-100-char context in each page text."""
    pl = X.parent_lines(spark, sf)
    r = pl.select("l_orderkey", "l_linenumber", "l_partkey", F.posexplode(T.rate_mentions(F.col("sentence"))).alias("i", "m"))
    return r.select("l_orderkey", "l_linenumber", "l_partkey", "i", F.col("m.rate_text").alias("rate_text"),
                    F.col("m.value").alias("value"), F.col("m.context").alias("context"), F.col("m.start").alias("start"))


@query("products_from_tables")
def q_products_tables(spark, sf):
    """Products (codes per row, last long non-code cell as description) of the notice page tables."""
    p = X.notice_pages(spark, sf)
    pr = A.products_from_tables(p.select("k", T.html_tables(F.col("html")).alias("tables")), "k", "tables")
    return pr.select("k", "t_idx", "r_idx", F.array_join("hts_codes", ",").alias("codes"), "description")


@query("extract_countries")
def q_countries(spark, sf):
    """X9 on notice sentences."""
    pl = X.parent_lines(spark, sf)
    return pl.select("l_orderkey", "l_linenumber", "l_partkey",
                     F.array_join(T.extract_countries(F.col("sentence")), ",").alias("countries"))


@query("csms_number")
def q_csms(spark, sf):
    """X10 on CBP titles and listing anchors."""
    t = X.link_records(spark, sf, "cbp_csms").select(F.col("url").alias("key"), "title")
    a = P.listing_links(X.listing_pages(spark, sf, "cbp")).select(
        F.concat(F.col("page_id").cast("string"), F.lit(":"), F.col("pos").cast("string")).alias("key"), "title")
    return t.unionByName(a).select("key", T.csms_number(F.col("title")).alias("csms_number"))


@query("effective_date_html")
def q_eff_html(spark, sf):
    """X11 on notice sentences."""
    pl = X.parent_lines(spark, sf)
    return pl.select("l_orderkey", "l_linenumber", "l_partkey", T.effective_date_html(F.col("sentence")).alias("effective_date"))


@query("effective_date_cbp")
def q_eff_cbp(spark, sf):
    """X12 on notice sentences ('effective on ...' is not matched)."""
    pl = X.parent_lines(spark, sf)
    return pl.select("l_orderkey", "l_linenumber", "l_partkey", T.effective_date_cbp(F.col("sentence")).alias("effective_date"))


@query("normalize_text")
def q_normalize_text(spark, sf):
    """X13 on the whole driver documents."""
    d = read_table(spark, sf, "documents", "doc_id", "text")
    t = T.normalize_text(F.col("text"))
    return d.select("doc_id", F.sha2(t, 256).alias("text_sha256"), F.length(t).alias("text_chars"))


@query("title_ratio")
def q_title_ratio(spark, sf):
    """Difflib ratio of every reachable pair's titles (Arrow UDF)."""
    new, store, _ = _link_sides(spark, sf)
    c = SC.run_pairs(spark, sf)
    j = (c.join(new.select(F.col("id").alias("new_id"), F.col("title").alias("a")), "new_id")
         .join(store.select("id", F.col("title").alias("b")), "id"))
    return j.select("new_id", "id", title_ratio(F.col("a"), F.col("b")).alias("ratio"))


@query("pdf_cell_clean")
def q_cells(spark, sf):
    """PDF page tables with stripped cells, NULL -> ''."""
    pp = X.notice_pdf_pages(spark, sf)
    t = pp.select("k", "page_no", F.posexplode(T.clean_cells(F.col("tables_raw"))).alias("t_idx", "tbl"))
    r = t.select("k", "page_no", "t_idx", F.posexplode("tbl").alias("r_idx", "cells"))
    return r.select("k", "page_no", "t_idx", "r_idx", F.array_join("cells", "|").alias("row_text"))


# ------------------------------------------------------------------ D: dates

@query("parse_date")
def q_parse_date(spark, sf):
    """D1 on every filing's publication date string (five formats, junk, NULL)."""
    f = X.filings(spark, sf)
    return f.select("k", "publication_date", D.parse_date(F.col("publication_date")).alias("parsed"))


@query("normalize_date")
def q_normalize_date(spark, sf):
    """D2."""
    f = X.filings(spark, sf)
    return f.select("k", D.normalize_date(F.col("publication_date")).alias("iso"))


@query("rfc822_date")
def q_rfc822(spark, sf):
    """D3: RFC-822 feed dates (built from order dates with an hour offset) -> ISO date in their own offset."""
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", D.rfc822_date(X.rfc822_of(F.col("o_orderkey"), F.col("o_orderdate"))).alias("iso"))


@query("validate_dates")
def q_validate_dates(spark, sf):
    """D4 on the score cases."""
    sc = X.score_cases(spark, sf)
    v = D.validate_dates(F.col("publication_date"), F.col("effective_date"), F.col("expiration_date"))
    return sc.select("k", v.getField("valid").alias("valid"), F.size(v.getField("errors")).alias("n_errors"),
                     F.size(v.getField("warnings")).alias("n_warnings"),
                     F.array_join(F.concat(v.getField("errors"), v.getField("warnings")), "; ").alias("messages"))


@query("date_proximity")
def q_date_prox(spark, sf):
    """D5 for every reachable pair."""
    new, store, _ = _link_sides(spark, sf)
    c = SC.run_pairs(spark, sf)
    j = (c.join(new.select(F.col("id").alias("new_id"), F.col("publication_date").alias("a")), "new_id")
         .join(store.select("id", F.col("publication_date").alias("b")), "id"))
    return j.select("new_id", "id", D.date_proximity(F.col("a"), F.col("b")).alias("proximity"))


# ------------------------------------------------------------------ C: validation / scoring / hashing

@query("validate_hts")
def q_validate_hts(spark, sf):
    """C1 on every distinct filing code."""
    codes = X.filing_codes(spark, sf).select("code").distinct()
    v = C.validate_hts(F.col("code"))
    return codes.select("code", v.getField("valid").alias("valid"), F.array_join(v.getField("errors"), ";").alias("errors"),
                        v.getField("chapter").alias("chapter"), v.getField("heading").alias("heading"),
                        v.getField("subheading").alias("subheading"))


@query("validate_rate")
def q_validate_rate(spark, sf):
    """C2 on one rate string per line."""
    r = X.rate_strings(spark, sf)
    v = validate_rate(F.col("rate"))
    return r.select("l_orderkey", "l_linenumber", "l_partkey", "rate", v.getField("valid").alias("valid"),
                    v.getField("rate_type").alias("rate_type"), v.getField("normalized_value").alias("normalized_value"),
                    F.array_join(v.getField("errors"), ";").alias("errors"))


@query("normalize_rate")
def q_normalize_rate(spark, sf):
    """C3."""
    r = X.rate_strings(spark, sf)
    return r.select("l_orderkey", "l_linenumber", "l_partkey", normalize_rate(F.col("rate")).alias("value"))


@query("normalize_document")
def q_normalize_doc(spark, sf):
    """C4: normalised title, dates and product codes of every filing document."""
    l = SC.landed(spark, sf)
    docs = P.parse_cbp(l.cbp).unionByName(P.parse_ustr(l.ustr)).unionByName(PL.fr_documents(l.fr_raw))
    docs = E.build_products(E.attach_pages(docs, l.pages, None), "unknown")
    n = E.normalize_document(docs)
    return n.select("arrival_seq", "title", "publication_date", "effective_date",
                    F.array_join(E.product_codes(F.col("tariff_action.products")), ",").alias("codes"))


@query("confidence_score")
def q_confidence(spark, sf):
    """C5 with every part (C5a-f) on the score cases."""
    return A.score_cases_scored(X.score_cases(spark, sf)).select(
        "k", "required", "hts", "date_v", "date_basic", "rate", "quality", "confidence_raw")


@query("quality_label")
def q_quality_label(spark, sf):
    """C7."""
    sc = A.score_cases_scored(X.score_cases(spark, sf))
    return sc.select("k", S.quality_label(F.col("confidence_raw")).alias("label"))


@query("content_hash")
def q_content_hash(spark, sf):
    """C8 of every prepared filing document (all three sources)."""
    l = SC.landed(spark, sf)
    fr = PL.prepare_documents(PL.fr_documents(l.fr_raw), "federal_register", l.pages,
                              PL.fr_pdf_codes(l.pdf_pages))
    us = PL.prepare_documents(P.parse_ustr(l.ustr), "ustr", l.pages, None)
    cb = PL.prepare_documents(P.parse_cbp(l.cbp), "cbp_csms", l.pages, None)
    cols = ["arrival_seq", "content_hash", "confidence_raw", "validation_status"]
    return fr.select(*cols).unionByName(us.select(*cols)).unionByName(cb.select(*cols))


@query("fuzzy_hash")
def q_fuzzy(spark, sf):
    """C9 of every stored event; grouping by it gives near-duplicate review blocks."""
    lp = PL.link_projection(SC.store_events(spark, sf))
    return lp.select("id", I.fuzzy_hash(F.col("source"), F.col("publication_date"), F.col("codes")).alias("fuzzy_hash"))


@query("review_blocks")
def q_review_blocks(spark, sf):
    """Every stored event with the size and the representative of its fuzzy-hash block."""
    return review_blocks(PL.link_projection(SC.store_events(spark, sf)))


@query("doc_similarity")
def q_doc_sim(spark, sf):
    """Scores of all pairs with equal numbers, without the threshold."""
    new, stored = _dup_sides(spark, sf)
    return DD.near_duplicates(new, stored, threshold=0.0).select("new_id", "existing_id", "similarity")


@query("link_confidence")
def q_link_conf(spark, sf):
    """C11 for every reachable pair (threshold not applied)."""
    new, store, _ = _link_sides(spark, sf)
    s = L.score_pairs(SC.run_pairs(spark, sf), new, store, min_confidence=None)
    return s.select("parent_event_id", "related_event_id", "confidence_raw", "dn", "j", "dp", "title_ratio")


@query("relationship_type")
def q_rel_type(spark, sf):
    """C12 of all edges of the run."""
    return SC.run_edges(spark, sf).select("parent_event_id", "related_event_id", "relationship_type",
                    F.array_join("matching_factors", ",").alias("factors"))


# ------------------------------------------------------------------ K: sinks / constraints

def _all_events(spark, sf):
    """Store plus FR run events; the run's are staged, since every constraint reads the events again."""
    new = staged(_fr_new_events(spark, sf), "run_events")
    return SC.store_events(spark, sf).unionByName(new)


@query("check_constraints")
def q_constraints(spark, sf):
    """K5: violations of the table constraints: store plus FR run events, and all edges of the run."""
    return Q.check_constraints(_all_events(spark, sf), SC.run_edges(spark, sf))


@query("check_constraints_damaged")
def q_constraints_damaged(spark, sf):
    """K5 on damaged tables: every constraint is broken by some rows (values, missing values, lost and repeated rows)."""
    base = _all_events(spark, sf)
    kind = F.col("ingest_seq") % 40
    none = ["content_hash", "parser_version", "source", "source_priority", "data", "ingestion_timestamp"]   # kinds 2 to 7
    events = base.where(kind != 9).withColumns({
        "confidence_score": F.when(kind == 0, F.lit(1.25).cast("decimal(3,2)")).otherwise(F.col("confidence_score")),
        "validation_status": F.when(kind == 1, "unknown").otherwise(F.col("validation_status")),
        **{c: F.when(kind != n, F.col(c)) for n, c in enumerate(none, 2)}}).unionByName(base.where(kind == 8))
    edges = SC.run_edges(spark, sf).select("parent_event_id", "related_event_id", "relationship_type", "confidence")
    edges = edges.unionByName(edges.where("relationship_type = 'references'"))
    wrong = F.col("relationship_type") == "related_products"
    edges = edges.withColumn("confidence", F.when(wrong, F.lit(1.5).cast("decimal(3,2)")).otherwise(F.col("confidence")))
    return Q.check_constraints(events, edges)


@query("rule_table")
def q_rules(spark, sf):
    """K6: the declared validation rules applied to the stored events: violations per rule."""
    return Q.rule_violations(SC.store_events(spark, sf))


@query("rule_table_damaged")
def q_rules_damaged(spark, sf):
    """K6 on damaged events: every declared rule is broken by some of them, and every band is met."""
    kind, text = F.col("ingest_seq") % 20, lambda v: F.lit(v).cast("string")
    fields = ["source", "document_type", "title", "publication_date", "tariff_action.type", "source_url"]   # kinds 2 to 7
    rates = {8: ("7%", "ad_valorem"), 9: ("7 percent", "ad_valorem"), 10: ("$2.5 per kg", "specific"), 11: ("2 cents per kg", "specific"), 12: ("7%", "free")}
    longer = F.transform(F.col("data.tariff_action.products"), lambda p: p.withField("hts_code", F.concat(p.getField("hts_code"), F.lit("X"))))
    changes = [("tariff_action.products", 0, longer), ("expiration_date", 1, F.col("data.effective_date")), ("effective_date", 13, text("1900-01-01"))]
    changes += [(f, n, text(None)) for n, f in enumerate(fields, 2)]
    changes += [(f"tariff_action.{c}", n, text(v)) for n, pair in rates.items() for c, v in zip(("rate_original", "rate_type"), pair)]
    data = {}
    for path, n, value in changes:
        data[path] = F.when(kind == n, value).otherwise(data.get(path, F.col(f"data.{path}")))
    score = F.col("confidence_raw")
    for n, v in enumerate((0.95, 0.8, 0.65, 0.45, 0.1), 14):
        score = F.when(kind == n, v).otherwise(score)
    doc = F.col("data")
    for path, value in data.items():
        doc = doc.withField(path, value)
    return Q.rule_violations(SC.store_events(spark, sf).withColumns({"data": doc, "confidence_raw": score}))


# ------------------------------------------------------------------ T: streaming, K1-K4 sinks

def _scratch(spark, name: str) -> str:
    import uuid
    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/noticespark-runs/{name}-{uuid.uuid4().hex[:12]}"


@query("incremental_ingest")
def q_incremental(spark, sf):
    """The FR run as a file stream (availableNow, foreachBatch) into a copy of the events table."""
    from ..streaming.incremental import incremental_ingest
    l = SC.landed(spark, sf)
    base = _scratch(spark, "stream")
    l.fr_raw.repartition(4, "landed_date").write.option("compression", "zstd").parquet(base + "/landing")
    SC.store_events(spark, sf, l).write.option("compression", "zstd").partitionBy("source").parquet(base + "/events")
    incremental_ingest(spark, base + "/landing", l.fr_raw.schema, l.pages, l.pdf_pages, base + "/events",
                       base + "/edges", base + "/checkpoint", SC.AS_OF["federal_register"], max_files_per_trigger=2)
    ev = spark.read.parquet(base + "/events")
    new = ev.where((F.col("source") == "federal_register") &
                   (F.col("ingestion_timestamp") == F.to_timestamp(F.lit(SC.AS_OF["federal_register"]))))
    return _event_cols(new)


@query("late_page_events")
def q_late_events(spark, sf):
    """P8 + T1: the FR stream while pages are missing, then the stream of late pages: the events of both."""
    ev = spark.read.parquet(SC.late_pages_run(spark, sf) + "/events")
    ev = ev.where((F.col("source") == "federal_register") & (F.col("ingestion_timestamp") >= F.to_timestamp(F.lit(SC.AS_OF["federal_register"]))))
    return _event_cols(ev).join(ev.select("id", (F.col("ingestion_timestamp") == F.to_timestamp(F.lit(SC.LATE_AS_OF))).alias("late")), "id")


@query("pending_documents")
def q_pending(spark, sf):
    """Every FR document that waited for its page, and whether the page came."""
    from .pending import pending_documents
    d = pending_documents(spark, SC.late_pages_run(spark, sf) + "/pending")
    return d.select("arrival_seq", "source_url", F.col("resolved_at").isNotNull().alias("resolved"))


@query("append_events")
def q_append_events(spark, sf):
    """K1: the FR run's events appended to a copy of the events table, read back (new rows only)."""
    from .sinks import append_events
    l = SC.landed(spark, sf)
    base = _scratch(spark, "append")
    SC.store_events(spark, sf, l).write.partitionBy("source").parquet(base + "/events")
    append_events(_fr_new_events(spark, sf), base + "/events")
    ev = spark.read.parquet(base + "/events")
    return _event_cols(ev.where(F.col("ingestion_timestamp") == F.to_timestamp(F.lit(SC.AS_OF["federal_register"]))))


@query("append_relationships")
def q_append_edges(spark, sf):
    """K2: all edges of the run appended twice with upsert-ignore; read back."""
    from .sinks import append_relationships, read_table_or_empty
    edges = SC.run_edges(spark, sf).select(
        "parent_event_id", "related_event_id", "relationship_type", "confidence_raw", "confidence", "matching_factors")
    path = _scratch(spark, "edges")
    for _ in range(2):
        stored = read_table_or_empty(spark, path, edges)
        append_relationships(DD.edge_upsert_ignore(edges, stored), path)
    return spark.read.parquet(path).select("parent_event_id", "related_event_id", "relationship_type", "confidence_raw")


def _raw_pages(l) -> DataFrame:
    return l.pages.select("source", F.col("k").cast("string").alias("doc_id"), F.lit("html").alias("kind"), "url", F.col("html").alias("body"))


def _body_rows(back: DataFrame) -> DataFrame:
    return back.select("source", "doc_id", "name", F.length(F.col("body").cast("string")).alias("body_chars"))


@query("raw_zone")
def q_raw_zone(spark, sf):
    """K3 + K4: landed pages kept in the raw zone, each body once, then read back under all their names."""
    path = _scratch(spark, "raw")
    RW.store_raw(_raw_pages(SC.landed(spark, sf)), path, SC.AS_OF["federal_register"])
    return _body_rows(RW.read_raw(spark, path))


@query("read_raw")
def q_read_raw(spark, sf):
    """K4: raw bodies read back by path for reparsing — only the FR filings that carry a PDF."""
    l = SC.landed(spark, sf)
    path = _scratch(spark, "raw")
    lineage = RW.store_raw(_raw_pages(l), path, SC.AS_OF["federal_register"])
    wanted = l.fr_raw.where(F.col("pdf_url").isNotNull()).select(F.col("arrival_seq").cast("string").alias("doc_id"))
    paths = lineage.where(F.col("source") == "federal_register").join(wanted, "doc_id", "left_semi")
    return _body_rows(RW.read_raw(spark, path, paths))


@query("raw_lineage")
def q_raw_lineage(spark, sf):
    """P6 + K3 + K4: the raw paths on the FR run's events (page, PDF text, search record), and whether each leads to the landed bytes."""
    l = SC.landed(spark, sf)
    docs = PL.fr_documents(l.fr_raw).select(F.col("identifiers.fr_document_number").alias("doc_id"), "source_url", "pdf_url", "arrival_seq",
                                            F.to_json(F.struct("title", "publication_date", "source_url", "pdf_url", "abstract")).alias("record"))
    src = F.lit("federal_register").alias("source")
    pages = l.pages.where(F.col("source") == "federal_register").select("url", "html")
    html = docs.join(pages, docs.source_url == pages.url).select(src, "doc_id", F.lit("html").alias("kind"), "url", F.col("html").alias("body"))
    texts = E.pdf_pages_to_doc(l.pdf_pages, "k", "page_no", "text", None).select("k", "pdf_text")
    pdf = docs.join(texts, docs.arrival_seq == texts.k).select(src, "doc_id", F.lit("pdf").alias("kind"), F.col("pdf_url").alias("url"), F.col("pdf_text").alias("body"))
    json = docs.select(src, "doc_id", F.lit("json").alias("kind"), F.col("source_url").alias("url"), F.col("record").alias("body"))
    bodies = staged(html.unionByName(pdf).unionByName(json), "raw_bodies")   # read three times below
    path = _scratch(spark, "raw")
    lineage = RW.store_raw(bodies, path, SC.AS_OF["federal_register"])
    events = PL.fr_pipeline(l.fr_raw, l.pages, l.pdf_pages, SC.store_events(spark, sf, l), as_of=SC.AS_OF["federal_register"], link=False, lineage=lineage).events
    carried = events.select("id", F.explode(F.array(*[F.col(f"raw_{k}_path") for k in RW.KINDS])).alias("raw_path")).where(F.col("raw_path").isNotNull())
    carried = RW.staged(carried, "carried")
    back = RW.read_raw(spark, path, carried).select("raw_path", "doc_id", "kind", "name", F.sha2("body", 256).alias("read_hash"))
    was = bodies.select("doc_id", "kind", F.sha2(F.col("body").cast("binary"), 256).alias("landed_hash"))
    return carried.join(back, "raw_path", "left").join(was, ["doc_id", "kind"], "left").select(
        "id", "kind", "name", F.coalesce(F.col("read_hash") == F.col("landed_hash"), F.lit(False)).alias("is_landed"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


__all__ = ["all_queries", "source_priority"]
