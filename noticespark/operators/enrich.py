"""Per-document stages: page text and codes, PDF pages, products, normalisation,
date validation, confidence and content hash.  All narrow except the two
equi-joins that attach landed pages (keyed by URL / document key)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import dates as D
from ..functions import identity as I
from ..functions import scoring as S
from ..functions.lookups import country_code
from ..functions.rates import validate_rate
from ..functions.text import main_content_cbp, effective_date_cbp, normalize_text, clean_cells

PRODUCT = "struct<hts_code:string,hts_code_validated:boolean,description:string,country_specific:array<string>>"


def page_facts(pages: DataFrame, source: str | None = None) -> DataFrame:
    """X1/X4 (+X3/X12 for CBP) on the pages side: (url, html_hts_codes, effective_date).

    Extracting before the join means the shuffle carries a few codes per page
    instead of the HTML, and a pages table partitioned by ``source`` is pruned to
    the run's source.
    """
    h = F.col("html")
    has_src = "source" in pages.columns
    if source is not None and has_src:
        pages = pages.where(F.col("source") == source)
    eff = effective_date_cbp(main_content_cbp(h))
    if source == "cbp_csms":
        eff_col = eff
    elif source is None and has_src:
        eff_col = F.when(F.col("source") == "cbp_csms", eff)
    elif source is None:
        eff_col = eff
    else:
        eff_col = F.lit(None).cast("string")
    # A URL may have landed more than once: its latest capture counts (the largest html hash where no time is kept).
    latest = F.struct(*[F.col(c) for c in ("captured_at",) if c in pages.columns], F.xxhash64(h))
    facts = pages.select(F.col("url").alias("_page_url"), C.page_hts_codes(h).alias("_codes"),
                         eff_col.alias("_eff"), latest.alias("_at"))
    best = facts.groupBy("_page_url").agg(F.max_by(F.struct("_codes", "_eff"), "_at").alias("_f"))   # narrow, partial
    return best.select("_page_url", "_f._codes", "_f._eff")


#: Largest list of batch URLs or keys that is broadcast to prune the landing zone.
MOST_BROADCAST_KEYS = 500_000


def of_batch(landed: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of a landed table whose ``column`` is in the one-column (staged) ``keys``, before anything is extracted.

    The list is counted first: up to ``MOST_BROADCAST_KEYS`` it is broadcast, so bodies outside the batch are neither
    parsed nor shuffled.  A longer list means a batch about as large as the zone; then the whole zone is extracted and
    the join that follows drops the rest.
    """
    if keys.count() > MOST_BROADCAST_KEYS:
        return landed
    listed = keys.select(F.col(keys.columns[0]).alias("_listed")).distinct()
    return landed.join(F.broadcast(listed), F.col(column) == F.col("_listed"), "left_semi")


def attach_pages(docs: DataFrame, pages: DataFrame, source: str | None = None, facts: DataFrame | None = None) -> DataFrame:
    """S3 + X1 + X4: join landed page facts on URL (codes; effective date for CBP); ``facts`` where they are made already.

    A document without a page keeps NULL codes (the reference continues without codes).
    """
    p = page_facts(pages, source) if facts is None else facts
    j = docs.join(p, docs.source_url == p._page_url, "left")
    out = j.withColumn("html_hts_codes", F.col("_codes"))
    if source == "cbp_csms" or source is None:
        out = out.withColumn("effective_date", F.col("_eff"))
    out = out.withColumn("raw_html_path", F.col("_page_url"))
    return out.drop("_page_url", "_codes", "_eff")


def pdf_pages_to_doc(pages: DataFrame, key: str = "doc_id", page_col: str = "page_no", text_col: str = "text",
                     tables_col: str | None = "tables") -> DataFrame:
    """Extracted PDF pages -> one row per document.

    text = non-empty page texts joined by newline in page order; tables cleaned
    (X15) and concatenated in page order; page_count; codes (X4) of the text.
    A group holds one document's pages (bounded by the document, not the data).
    """
    fields = [F.col(page_col).alias("p"), F.col(text_col).alias("t")]
    if tables_col:
        fields.append(F.col(tables_col).alias("tb"))
    g = pages.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_pages"), F.count(F.lit(1)).alias("page_count"))
    texts = F.transform(F.filter("_pages", lambda x: F.coalesce(F.length(x.getField("t")), F.lit(0)) > 0), lambda x: x.getField("t"))
    cols = [key, F.array_join(texts, "\n").alias("pdf_text"), "page_count"]
    if tables_col:
        cols.append(clean_cells(F.flatten(F.transform("_pages", lambda x: F.coalesce(x.getField("tb"), F.array().cast("array<array<array<string>>>"))))).alias("pdf_tables"))
    return g.select(*cols).withColumn("pdf_hts_codes", C.html_hts_codes(F.col("pdf_text")))


def pdf_doc_codes(pages: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Codes of a document's PDF pages without assembling its text.

    Pages are joined by newline, which is a word boundary, so the codes of the
    joined text are exactly the union of per-page codes.  Extracting per page and
    taking a set union is a partial (map-side) aggregation: a document with a huge
    number of pages never has to be concatenated inside one task.
    """
    per_page = pages.select(key, F.explode_outer(C.html_hts_codes(F.col(text_col))).alias("code"))
    return per_page.groupBy(key).agg(F.array_sort(F.collect_set("code")).alias("pdf_hts_codes"),
                                     F.count(F.lit(1)).alias("page_count"))


def attach_pdfs(docs: DataFrame, pdf_docs: DataFrame, key: str = "arrival_seq") -> DataFrame:
    """Join grouped PDF documents (from ``pdf_pages_to_doc``) by document key."""
    p = pdf_docs.select(F.col(pdf_docs.columns[0]).alias("_pdf_key"), "pdf_hts_codes", "page_count")
    # page_count of pdf_doc_codes counts code rows; only its presence is used here
    j = docs.join(p, docs[key] == p._pdf_key, "left").drop("_pdf_key")
    return j.withColumn("raw_pdf_path", F.when(F.col("page_count").isNotNull(), F.col("pdf_url"))).drop("page_count")


def build_products(docs: DataFrame, action_type) -> DataFrame:
    """A3 + C1 + P5: union of HTML and PDF codes -> validated products in the tariff action.

    ``action_type`` is a string or a Column (per-row type in a mixed-source batch).
    """
    html_c = F.col("html_hts_codes") if "html_hts_codes" in docs.columns else F.lit(None).cast("array<string>")
    pdf_c = F.col("pdf_hts_codes") if "pdf_hts_codes" in docs.columns else F.lit(None).cast("array<string>")
    codes = C.merge_codes(html_c, pdf_c)
    products = F.transform(codes, lambda c: F.struct(
        c.alias("hts_code"), C.hts_valid(c).alias("hts_code_validated"), F.lit("").alias("description"),
        F.array().cast("array<string>").alias("country_specific")))
    return docs.withColumn("tariff_action", F.struct(
        (F.lit(action_type) if isinstance(action_type, str) else action_type).alias("type"), products.alias("products"),
        F.lit(None).cast("string").alias("rate_original"), F.lit(None).cast("double").alias("rate_normalized"),
        F.lit(None).cast("string").alias("rate_type")))


def normalize_products(products):
    """C4 product part: X6 code, X13 description, J8 countries (NULL dropped)."""
    return F.transform(products, lambda p: F.struct(
        C.normalize_hts(p.getField("hts_code")).alias("hts_code"),
        p.getField("hts_code_validated").alias("hts_code_validated"),
        normalize_text(p.getField("description")).alias("description"),
        F.filter(F.transform(p.getField("country_specific"), country_code), lambda c: c.isNotNull()).alias("country_specific")))


def normalize_document(docs: DataFrame) -> DataFrame:
    """C4: dates -> ISO or NULL, rate -> C2, products, title -> X13."""
    out = docs
    for c in ("publication_date", "effective_date", "expiration_date"):
        if c in out.columns:
            out = out.withColumn(c, D.normalize_date(F.col(c)))
    if "tariff_action" in out.columns:
        ta = F.col("tariff_action")
        rate = validate_rate(ta.getField("rate_original"))
        has_rate = ta.getField("rate_original").isNotNull()
        out = out.withColumn("tariff_action", F.struct(
            ta.getField("type").alias("type"),
            normalize_products(ta.getField("products")).alias("products"),
            ta.getField("rate_original").alias("rate_original"),
            F.when(has_rate, rate.getField("normalized_value")).alias("rate_normalized"),
            F.when(has_rate, rate.getField("rate_type")).alias("rate_type")))
    if "title" in out.columns:
        out = out.withColumn("title", normalize_text(F.col("title")))
    return out


def validate_and_score(docs: DataFrame) -> DataFrame:
    """D4 + C5 (with the date validation result) + status."""
    eff = F.col("effective_date") if "effective_date" in docs.columns else F.lit(None).cast("string")
    exp = F.col("expiration_date") if "expiration_date" in docs.columns else F.lit(None).cast("string")
    out = docs.withColumn("date_validation", D.validate_dates(F.col("publication_date"), eff, exp))
    ta = F.col("tariff_action")
    conf = S.confidence(
        S.required_fields_score(F.col("source"), F.col("document_type"), F.col("title"), F.col("publication_date"), F.col("source_url")),
        S.hts_share(ta.getField("products")),
        S.date_score(F.col("date_validation")),
        S.rate_score(ta.getField("rate_original"), ta.getField("rate_normalized")),
        S.quality_score(F.lit(None).cast("boolean"), F.lit(None).cast("string"), F.lit(0)),
    )
    return out.withColumn("confidence_raw", conf).withColumn(
        "validation_status", F.when(F.col("date_validation.valid"), F.lit("verified")).otherwise(F.lit("failed")))


def product_codes(products):
    return F.transform(F.filter(products, lambda p: p.getField("hts_code").isNotNull() & (p.getField("hts_code") != "")),
                       lambda p: p.getField("hts_code"))


def with_content_hash(docs: DataFrame) -> DataFrame:
    """C8 on the normalised document."""
    return docs.withColumn("content_hash", I.content_hash(
        F.col("source"), F.col("document_type"), F.col("publication_date"),
        F.col("identifiers.fr_document_number"), product_codes(F.col("tariff_action.products"))))
