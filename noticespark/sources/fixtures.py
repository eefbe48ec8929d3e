"""Deterministic projections of the driver tables into notice-shaped data.

The driver tables are TPC-H-like; these projections turn them into landed
trade notices so that every operator runs over data whose size grows with the
tables.  The same rules are written as DuckDB SQL in ``notice_oracle/fixtures_sql.py``.

One filing per order ``k``; its parent order is ``pk = k - k % 3`` so each
Federal Register filing has a USTR and a CBP sibling that share its codes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.constants import FR_SEARCH_TERMS
from .tables import read_table

SOURCES = {0: "federal_register", 1: "ustr", 2: "cbp_csms"}
STORE_CUTOFF = "1998-01-01"   # filings landed before this date form the pre-existing store


def pad6(x: Column) -> Column:
    s = x.cast("string")
    return F.when(F.length(s) < 6, F.lpad(s, 6, "0")).otherwise(s)


def hts_of_part(partkey: Column) -> Column:
    """Ten-digit code string g of a part key, and its dotted form."""
    return F.lpad(((partkey * F.lit(4999999)) % F.lit(10 ** 10)).cast("string"), 10, "0")


def dotted10(g: Column) -> Column:
    return F.concat(F.substring(g, 1, 4), F.lit("."), F.substring(g, 5, 2), F.lit("."), F.substring(g, 7, 4))


def dotted6(g: Column) -> Column:
    return F.concat(F.substring(g, 1, 4), F.lit("."), F.substring(g, 5, 2))


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One filing per order with its parent's date/priority and derived fields."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    w = Window.partitionBy("pk").orderBy("k")
    base = (
        o.select(k.alias("k"), (k - k % 3).alias("pk"), F.to_date("o_orderdate").alias("odate"), "o_orderpriority")
        .withColumn("p_date", F.first("odate").over(w))
        .withColumn("p_prio", F.first("o_orderpriority").over(w))
    )
    kk = F.col("k")
    pd = F.date_add(F.col("p_date"), (kk % 3 * 7).cast("int"))
    no = F.concat(F.year("p_date").cast("string"), F.lit("-"), pad6(F.col("pk")))
    pub = (
        F.when(kk % 20 == 4, F.lit(None).cast("string"))
        .when(kk % 20 == 9, F.lit("to be announced"))
        .when(kk % 5 == 1, F.date_format(pd, "MM/dd/yyyy"))
        .when(kk % 5 == 2, F.date_format(pd, "MMMM d, yyyy"))
        .when(kk % 5 == 3, F.date_format(pd, "yyyyMMdd"))
        .otherwise(F.date_format(pd, "yyyy-MM-dd"))
    )
    src = F.when(kk % 3 == 0, F.lit(SOURCES[0])).when(kk % 3 == 1, F.lit(SOURCES[1])).otherwise(F.lit(SOURCES[2]))
    rule_title = (
        F.when(kk % 3 == 0, F.concat(F.lit("Notice of tariff action "), no))
        .when(kk % 4 == 1, F.concat(F.lit("Guidance on FR Doc. "), no))
        .otherwise(F.concat(F.lit("Notice of tariff action, guidance "), F.col("pk").cast("string")))
    )
    title = F.when(kk % 3 == 2, F.concat(F.lit("CSMS #"), (F.lit(50000000) + kk).cast("string"), F.lit(" "), rule_title)).otherwise(rule_title)
    url = (
        F.when(kk % 3 == 0, F.concat(F.lit("https://www.federalregister.gov/d/"), no))
        .when(kk % 3 == 1, F.concat(F.lit("https://ustr.gov/about-us/press-releases/"), kk.cast("string")))
        .otherwise(F.concat(F.lit("https://www.cbp.gov/csms/"), kk.cast("string")))
    )
    return base.select(
        "k", "pk", src.alias("source"), pd.alias("landed_date"), no.alias("no"), pub.alias("publication_date"),
        title.alias("title"), url.alias("url"), F.col("p_prio").alias("priority"),
        F.when((kk % 3 == 0) & (kk % 2 == 0), F.concat(F.lit("https://www.govinfo.gov/fr/"), no, F.lit(".pdf"))).alias("pdf_url"),
        F.when(kk % 3 == 0, F.concat(F.lit("Tariff changes for order "), F.col("pk").cast("string"), F.lit("; import duties")))
        .otherwise(F.lit("")).alias("abstract"),
        F.when(kk % 9 == 0, kk.cast("string")).alias("proclamation_number"),
    )


def fr_raw(spark: SparkSession, sf_dir: str, f: DataFrame | None = None) -> DataFrame:
    """M1 records as landed from the search API: one per matching search term (so duplicates)."""
    f = (f if f is not None else filings(spark, sf_dir)).where(F.col("source") == SOURCES[0])
    terms = F.array(*[F.lit(t) for t in FR_SEARCH_TERMS])
    f = f.withColumn("_hay", F.lower(F.concat_ws(" ", "title", "abstract")))   # once, not for every term
    return f.select(
        F.posexplode(F.filter(terms, lambda t: F.contains(F.col("_hay"), t))).alias("term_pos", "search_term"),
        F.col("no").alias("document_number"), "title", "publication_date",
        F.col("url").alias("html_url"), "pdf_url", "abstract", F.col("priority").alias("type"),
        F.lit(None).cast("string").alias("executive_order_number"), "proclamation_number",
        F.col("k").alias("arrival_seq"), "landed_date",
    )


def link_records(spark: SparkSession, sf_dir: str, source: str, f: DataFrame | None = None) -> DataFrame:
    """M2 records (USTR / CBP): title, url, publication_date, summary, source."""
    f = (f if f is not None else filings(spark, sf_dir)).where(F.col("source") == source)
    return f.select("title", "url", "publication_date", F.lit("").alias("summary"), F.lit(source).alias("source"),
                    F.col("k").alias("arrival_seq"), "landed_date")


def parent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every order with the code fields and the notice sentence."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    "l_quantity", "l_shipdate")
    g = hts_of_part(F.col("l_partkey"))
    q = F.col("l_quantity").cast("int").cast("string")
    variant = (F.col("l_orderkey") + F.col("l_linenumber")) % 3
    country = (F.when(F.col("l_suppkey") % 4 == 0, F.lit("CN")).when(F.col("l_suppkey") % 4 == 1, F.lit("MX"))
               .when(F.col("l_suppkey") % 4 == 2, F.lit("ZZ")).otherwise(F.lit("KR and CN")))
    sentence = F.concat(
        F.lit("Notice: effective "),
        F.when(variant == 0, F.lit("date is ")).when(variant == 1, F.lit("on ")).otherwise(F.lit("")),
        F.date_format("l_shipdate", "MMMM d, yyyy"), F.lit(" the duty on HTS "), dotted10(g), F.lit(" and "), dotted6(g),
        F.lit(" (ref "), g, F.lit(") from "), country, F.lit(" is "), q, F.lit("% plus $"),
        F.col("l_linenumber").cast("string"), F.lit(" per kg. CSMS #"), (F.lit(50000000) + F.col("l_orderkey")).cast("string"), F.lit("."),
    )
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", dotted10(g).alias("code"), g.alias("g"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string"), F.lit(" &amp; parts")).alias("descr_html"),
        sentence.alias("sentence"),
    )


def filing_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, code) distinct — the codes each filing's page carries."""
    f = filings(spark, sf_dir).select("k", "pk")
    pl = parent_lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "code")
    j = f.join(pl, f.pk == pl.l_orderkey)
    return j.where(~((F.col("k") % 7 == 0) & (F.col("l_linenumber") == 1))).select("k", "code").distinct()


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every parent order by (line number, part key): (l_orderkey, lines).

    Parent orders have keys divisible by 3, so the lines of the others are left out before they are built and shuffled.
    """
    pl = parent_lines(spark, sf_dir).where(F.col("l_orderkey") % 3 == 0)
    return pl.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "code", "descr_html", "sentence"))).alias("lines"))


def notice_pages(spark: SparkSession, sf_dir: str, f: DataFrame | None = None, per_order: DataFrame | None = None) -> DataFrame:
    """Landed HTML page per filing: decoy nav table, one sentence per line, a code table, a footer.

    Some code tables omit their end tags, some hold a table in each row.

    Lines are those of the parent order (line 1 left out when k % 7 = 0), ordered by
    (line number, part key) because line numbers repeat within an order.
    """
    f = (f if f is not None else filings(spark, sf_dir)).select("k", "pk", "title", "url", "source")
    per_order = per_order if per_order is not None else order_lines(spark, sf_dir)
    j = f.join(per_order, f.pk == per_order.l_orderkey, "left")
    lines = F.filter(F.coalesce(F.col("lines"), F.array()),
                     lambda ln: ~((F.col("k") % 7 == 0) & (ln.getField("l_linenumber") == 1)))
    paras = F.array_join(F.transform(lines, lambda ln: F.concat(F.lit("<p>"), ln.getField("sentence"), F.lit("</p>"))), "")
    omitted = F.col("k") % 11 == 4   # no end tags of cells and rows
    nested = F.col("k") % 13 == 5    # the second cell holds a table that names the code again
    ends = lambda tags: F.when(omitted, F.lit("")).otherwise(F.lit(tags))
    rows = F.array_join(F.transform(lines, lambda ln: F.concat(
        F.lit("<tr><td> "), ln.getField("code"), ends("</td>"), F.lit("<td>"), ln.getField("descr_html"),
        F.when(nested, F.concat(F.lit("<table><tr><td>see "), ln.getField("code"), ends("</td></tr>"), F.lit("</table>"))).otherwise(F.lit("")),
        ends("</td></tr>"))), "")
    cbp = F.col("k") % 3 == 2   # CBP messages carry their text in a bulletin-content div
    open_tag = F.when(cbp, F.lit('<div class="bulletin-content">')).otherwise(F.lit("<article>"))
    close_tag = F.when(cbp, F.lit("</div>")).otherwise(F.lit("</article>"))
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>"), F.col("title"), F.lit("</title><style>td{padding:0}</style></head><body>"),
        F.lit("<nav><table><tr><td>9999.99.9999</td><td>decoy navigation</td></tr></table></nav>"),
        open_tag, F.lit("<h1>"), F.col("title"), F.lit("</h1>"), paras,
        F.lit("<table><tr><th>HTS</th><th>Description</th></tr>"), rows, F.lit("</table>"), close_tag,
        F.lit("<footer>Contact 0000.00.0001 &copy; office</footer></body></html>"),
    )
    return j.select("k", "url", html.alias("html"), "source")


def notice_pdf_pages(spark: SparkSession, sf_dir: str, f: DataFrame | None = None, per_order: DataFrame | None = None) -> DataFrame:
    """Extracted PDF pages of FR filings with a pdf_url: one page per parent line (all lines).

    Filings with one key are alike; each of their lines gives a page for every one of them.
    """
    f = (f if f is not None else filings(spark, sf_dir)).where(F.col("pdf_url").isNotNull())
    f = f.groupBy("k", "pk", "pdf_url").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    per_order = per_order if per_order is not None else order_lines(spark, sf_dir)
    lines = F.flatten(F.transform("lines", lambda ln: F.array_repeat(ln, F.col("copies"))))
    j = f.join(per_order, f.pk == per_order.l_orderkey).select("k", "pdf_url", F.posexplode(lines).alias("pos", "ln"))
    return j.select(
        "k", "pdf_url", (F.col("pos") + 1).alias("page_no"), F.col("ln.sentence").alias("text"),
        F.array(F.array(F.array(F.lit("HTS"), F.lit("Description")),
                        F.array(F.concat(F.lit(" "), F.col("ln.code"), F.lit(" ")), F.lit(None).cast("string")))).alias("tables_raw"),
    )


def score_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order dates, extraction metadata and a rate string."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    rate = (li.where(F.col("l_linenumber") == 1)
            .groupBy("l_orderkey").agg(F.min(F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("%"))).alias("rate_original")))
    k = F.col("o_orderkey")
    pub = F.to_date("o_orderdate")
    eff = F.date_add(pub, (k % 13 - 2).cast("int"))
    exp = F.date_add(eff, (k % 9 - 1).cast("int"))
    base = o.select(
        k.alias("k"), F.date_format(pub, "yyyy-MM-dd").alias("publication_date"),
        F.date_format(eff, "yyyy-MM-dd").alias("effective_date"), F.date_format(exp, "yyyy-MM-dd").alias("expiration_date"),
        (k % 4 == 0).alias("ocr_used"), F.when(k % 6 == 0, F.lit("fallback")).otherwise(F.lit("native")).alias("table_extraction_method"),
        (k % 5 == 0).alias("has_related"),
    )
    return base.join(rate, base.k == rate.l_orderkey, "left").drop("l_orderkey")


def rate_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate string per line, six shapes."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    q = F.col("l_quantity").cast("int").cast("string")
    m = (F.col("l_orderkey") + F.col("l_linenumber")) % 6
    rate = (F.when(m == 0, F.concat(q, F.lit("%"))).when(m == 1, F.concat(F.lit("$"), q, F.lit(".5 per kg")))
            .when(m == 2, F.concat(q, F.lit(" cents per unit"))).when(m == 3, F.concat(q, F.lit("% + $2 per kg")))
            .when(m == 4, F.lit("Free")).otherwise(F.lit(None).cast("string")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", rate.alias("rate"))


def listing_pages(spark: SparkSession, sf_dir: str, variant: str = "ustr") -> DataFrame:
    """One listing page per 100 orders with anchors in key order."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey")
    k = F.col("o_orderkey")
    if variant == "ustr":
        path = F.when(k % 5 == 0, F.lit("/other/")).otherwise(F.lit("/press-releases/"))
        text = F.when(k % 4 == 0, F.concat(F.lit("Tariff action "), k.cast("string"))).otherwise(F.concat(F.lit("Museum opening "), k.cast("string")))
    else:
        path = F.when(k % 5 == 0, F.lit("/other/")).otherwise(F.lit("/csms/"))
        text = F.when(k % 4 == 0, F.concat(F.lit("CSMS #"), k.cast("string"), F.lit(" Import duties update")))\
            .otherwise(F.concat(F.lit("CSMS #"), k.cast("string"), F.lit(" Holiday hours")))
    href = F.concat(F.when(k % 3 == 0, F.lit("https://x.example")).otherwise(F.lit("")), path, k.cast("string"),
                    F.when(k % 7 == 0, F.lit(".pdf")).otherwise(F.lit("")))
    anchor = F.concat(F.lit('<a href="'), href, F.lit('">'), text, F.lit("</a>"))
    per_page = o.groupBy((k / 100).cast("long").alias("page_id")).agg(
        F.array_sort(F.collect_list(F.struct(k.alias("k"), anchor.alias("a")))).alias("items"))
    html = F.concat(F.lit("<html><body><ul>"),
                    F.array_join(F.transform("items", lambda it: F.concat(F.lit("<li>"), it.getField("a"), F.lit("</li>"))), ""),
                    F.lit("</ul></body></html>"))
    return per_page.select("page_id", F.concat(F.lit("https://listing.example/"), F.col("page_id").cast("string")).alias("url"), html.alias("html"))


# FIXED VALUES of the fixture: supplier country spellings (names, codes, junk), by s_suppkey % 8.
COUNTRY_SPELLINGS = ["China", "mexico", " Japan ", "ZZ", "Korea", "Atlantis", "U1", "United Kingdom"]


def supplier_country_name(suppkey: Column) -> Column:
    m = suppkey % len(COUNTRY_SPELLINGS)
    out = None
    for i, name in enumerate(COUNTRY_SPELLINGS):
        out = F.when(m == i, F.lit(name)) if out is None else out.when(m == i, F.lit(name))
    return out


def rfc822_of(key: Column, ts: Column) -> Column:
    """RFC-822 date of an order (weekday, day, month, year, 10:00:00, offset by key)."""
    offs = F.when(key % 3 == 0, F.lit("+0000")).when(key % 3 == 1, F.lit("-0500")).otherwise(F.lit("+0930"))
    return F.concat(F.date_format(ts, "EEE, dd MMM yyyy"), F.lit(" 10:00:00 "), offs)
