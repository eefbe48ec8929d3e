"""Raw source records -> one unified parsed-document shape (P1-P3, P9, S1/S5/S6 helpers)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import anchors, csms_number, resolve_url

IDENTIFIERS = "struct<fr_document_number:string,proclamation_number:string,executive_order_number:string,cbp_csms_number:string>"

PARSED_COLUMNS = ["source", "document_type", "title", "publication_date", "identifiers", "source_url", "pdf_url",
                  "abstract", "arrival_seq"]


def _ident(fr=None, proc=None, eo=None, csms=None):
    n = F.lit(None).cast("string")
    return F.struct(
        (fr if fr is not None else n).alias("fr_document_number"),
        (proc if proc is not None else n).alias("proclamation_number"),
        (eo if eo is not None else n).alias("executive_order_number"),
        (csms if csms is not None else n).alias("cbp_csms_number"),
    )


def parse_fr(raw: DataFrame) -> DataFrame:
    """FR API record -> parsed document (type -> document_type, default 'Unknown')."""
    return raw.select(
        F.lit("federal_register").alias("source"),
        F.coalesce(F.col("type"), F.lit("Unknown")).alias("document_type"),
        "title", "publication_date",
        _ident(F.col("document_number"), F.col("proclamation_number"), F.col("executive_order_number")).alias("identifiers"),
        F.col("html_url").alias("source_url"), "pdf_url", "abstract", "arrival_seq",
    )


def parse_ustr(raw: DataFrame) -> DataFrame:
    """USTR link record -> parsed document."""
    return raw.select(
        F.lit("ustr").alias("source"), F.lit("Press Release").alias("document_type"), "title", "publication_date",
        _ident().alias("identifiers"), F.col("url").alias("source_url"), F.lit(None).cast("string").alias("pdf_url"),
        F.col("summary").alias("abstract"), "arrival_seq",
    )


def parse_cbp(raw: DataFrame) -> DataFrame:
    """CBP link record -> parsed document (CSMS number from the record or its title)."""
    csms = F.col("csms_number") if "csms_number" in raw.columns else csms_number(F.col("title"))
    return raw.select(
        F.lit("cbp_csms").alias("source"), F.lit("CSMS Message").alias("document_type"), "title", "publication_date",
        _ident(csms=csms).alias("identifiers"), F.col("url").alias("source_url"), F.lit(None).cast("string").alias("pdf_url"),
        F.col("summary").alias("abstract"), "arrival_seq",
    )


def listing_links(pages: DataFrame) -> DataFrame:
    """Every <a href> of each listing page with its position (document order)."""
    return pages.select("page_id", "url", F.posexplode(anchors(F.col("html"))).alias("pos", "a")).select(
        "page_id", "url", "pos", F.col("a.href").alias("href"), F.col("a.text").alias("title"))


def keyword_match(text, keywords):
    low = F.lower(F.coalesce(text, F.lit("")))
    cond = None
    for kw in keywords:
        c = F.contains(low, F.lit(kw))
        cond = c if cond is None else (cond | c)
    return cond


def ustr_links(links: DataFrame, base_url: str = K.USTR_BASE_URL, limit: int | None = None) -> DataFrame:
    """F2 + P4: tariff-related press-release links; W1 with a ``limit``: the first so many per page in document order."""
    m = links.where(keyword_match(F.col("title"), K.USTR_KEYWORDS) & F.contains(F.col("href"), F.lit("/press-releases/")))
    if limit is not None:
        w = Window.partitionBy("page_id").orderBy("pos")
        m = m.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit).drop("rank")
    return m.select("page_id", "pos", "title", resolve_url(F.col("href"), base_url).alias("url"),
                    F.lit(None).cast("string").alias("publication_date"), F.lit("").alias("summary"), F.lit("ustr").alias("source"))


def cbp_links(links: DataFrame, base_url: str = K.CBP_BASE_URL, limit: int | None = None) -> DataFrame:
    """F3 + X10 + P4: tariff-related CSMS links with their CSMS number; W1 with a ``limit``."""
    m = links.where(keyword_match(F.col("title"), K.CBP_KEYWORDS) & F.contains(F.lower(F.col("href")), F.lit("csms")))
    if limit is not None:
        w = Window.partitionBy("page_id").orderBy("pos")
        m = m.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit).drop("rank")
    return m.select("page_id", "pos", "title", resolve_url(F.col("href"), base_url).alias("url"),
                    F.lit(None).cast("string").alias("publication_date"), F.lit("").alias("summary"),
                    csms_number(F.col("title")).alias("csms_number"), F.lit("cbp_csms").alias("source"))


def pdf_links(pages: DataFrame, base_url: str = K.USTR_BASE_URL, per_page: int | None = None) -> DataFrame:
    """Hrefs ending exactly in '.pdf', resolved; W2 with ``per_page``: the first so many per page."""
    links = F.filter(anchors(F.col("html")), lambda a: a.getField("href").endswith(".pdf"))
    urls = F.transform(links, lambda a: resolve_url(a.getField("href"), base_url))
    if per_page is not None:
        urls = F.slice(urls, 1, per_page)
    return pages.select("*", urls.alias("pdf_links"))
