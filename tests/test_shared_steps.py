"""The steps that the registered queries share: landed pages, page text, dates; rows and patterns on odd input."""

import datetime as dt

from noticespark.functions import codes as C
from noticespark.functions import dates as D
from noticespark.functions import text as T
from noticespark.sources import fixtures as X
from pyspark.sql import functions as F


def values(spark, rows, fn):
    df = spark.createDataFrame(list(enumerate(rows)), "i int, s string").select("i", fn(F.col("s")).alias("v"))
    return [r.v for r in df.orderBy("i").collect()]


def _order_folder(spark, tmp_path):
    day = dt.datetime(1998, 2, 6)
    orders = [(0, day, "5-LOW"), (0, day, "5-LOW"), (1, day, "1-URGENT"), (2, day, None), (None, day, "5-LOW"), (6, day, "5-LOW")]
    lines = [(0, 7, 1, 2, 5.0, day), (0, 3, 2, 1, 6.0, day), (0, 3, 2, 1, 6.0, day), (1, 9, 1, 1, 7.0, day), (2, 8, 1, 1, 1.0, day), (None, 8, 1, 1, 1.0, day)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_only_lines_of_parent_orders_are_shuffled(spark, tmp_path):
    sf = _order_folder(spark, tmp_path)
    got = {r.l_orderkey: [(x.l_linenumber, x.l_partkey) for x in r.lines] for r in X.order_lines(spark, sf).collect()}
    assert got == {0: [(1, 3), (1, 3), (2, 7)]}
    pages = {r.k: (r.html or "").count("<p>") for r in X.notice_pages(spark, sf).collect()}
    assert pages == {0: 1, 1: 3, 2: 3, None: 0, 6: 0}   # k % 7 = 0 leaves line 1 out


def test_pdf_pages_of_repeated_filings(spark, tmp_path):
    sf = _order_folder(spark, tmp_path)
    pages = sorted((r.k, r.page_no, r.tables_raw[0][1][0].strip()) for r in X.notice_pdf_pages(spark, sf).collect())
    three, seven = "0014.99.9997", "0034.99.9993"
    assert pages == [(0, 1, three), (0, 2, three), (0, 3, three), (0, 4, three), (0, 5, seven), (0, 6, seven)]


def test_dates_of_all_formats(spark):
    rows = ["1998-2-06", "2/6/1998", "February 6, 1998", " Feb\t6,  1998 ", "19980206", "1998-02-31", "1/2/3/4", "a,b-c/d", "to be announced", "", " ", None]
    assert values(spark, rows, D.parse_date) == [dt.date(1998, 2, 6)] * 5 + [None] * 7
    checks = values(spark, ["1998-02-06", "", None], lambda s: D.validate_dates(s, F.lit("1998-02-05"), F.lit("1998-02-05")))
    assert [c.valid for c in checks] == [False, False, False]
    assert checks[0].errors == ["Effective date (1998-02-05) before publication date (1998-02-06)"] and len(checks[0].warnings) == 1


def test_page_text_and_codes(spark):
    assert values(spark, ["  a   b\x85", " ", "a b", "", None, "\n\n"], T.collapse_ws) == ["a b", "", "a b", "", None, ""]
    html = "<NAV a>x</nav ><header>y</HEADER><headers>z</headers><nav>u<footer>v</nav>w</footer>t&amp;&nbsp;&bogus;&#65;"
    assert values(spark, [html], T.html_text) == ["z w t& &bogus;A"]
    codes = "1234.56.7890 x1234.56.7891 51234.56.7892 .1234.56.7893, 1234.56.78945 \U00010400" + "1234.56.7896 1234.56.7897_"
    assert values(spark, [codes, None], C.html_hts_codes) == [["1234.56.7890", "1234.56.7893", "1234.56.7896"], []]


def test_table_rows_are_read_without_a_fold_of_expressions(spark):
    """Nodes as a fold of nested expressions took 3 ms a page; the plan has none, whatever the page holds."""
    df = spark.createDataFrame([("<table><tr><td>a</table>",), (None,)], "h string").select(T.html_tables(F.col("h")).alias("t"))
    assert [r.t for r in df.collect()] == [[[["a"]]], []]
    assert "aggregate(" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_page_codes_in_one_pass_are_those_of_the_stripped_text(spark):
    """The pass that every store query makes over all pages, on pages where one pass alone would go wrong."""
    a, b = "1234.56.7890", "2345.67.8901"
    pages = {f"<!DOCTYPE html><p>{b} {a}</p><p>{b}</p>": [a, b], f"x{a} &eacute;{a} {b}&eacute; &amp;{a}&amp;#49;{b}_": [a],
             "&#49;234.56.7890": [a], f"<a title='<nav>'>{a}</nav>{b}": [b], f"<!-- <nav> -->{a}</nav>": [a], f"<nav <b>>{a}</nav>{b}": [b],
             f"<a {a}": [a], f"<NAV>{a}</Nav >{b}": [b], f"<nav></nav<!DOCTYPE>>{a}</nav>": [a], f"<!DOCTYPE <nav>{a}</nav>{b}": [a, b],
             f"<script>if(a<b){{}}</script>{a}<style>{b}": [a, b], "1234.56<b>.7890": [], f"<header1>{a}</header1>": [a], f"<nav-x>{a}</nav>": [],
             f"<nav>{'<b>' + a + '</b>'}": [a], "<nav>" + f"<b>{a}</b>" * 30000 + f"</nav>{b}": [b], f"<{a}>": [a], f"1 < {a} > {b}": [a, b], "": [], None: []}
    assert values(spark, list(pages), C.page_hts_codes) == list(pages.values())
    assert values(spark, list(pages), lambda h: C.html_hts_codes(T.html_code_text(h))) == list(pages.values())


def test_frequent_cases_take_no_slow_path(spark):
    """Frequent entities, clean titles and dates with all their digits are read without taking the text apart."""
    rows = {"a&amp;lt;b": "a&lt;b", "&amp;amp;": "&amp;", "&&lt;": "&<", "&am&nbsp;p;": "&am\xa0p;", "&apos;&lt;": "'<", "&foo;&gt;&#65;": "&foo;>A", None: None}
    assert values(spark, list(rows), T.decode_entities) == list(rows.values())
    titles = {"Notice of tariff action 1998-000003": "Notice of tariff action 1998-000003", "CSMS #5  a": "CSMS 5 a", " a": "a", "a ": "a", "a\n": "a", "": "", None: ""}
    assert values(spark, list(titles), T.normalize_text) == list(titles.values())
    dates = {"1998-02-30": None, "1998-02-28": "1998-02-28", "02/29/2000": "2000-02-29", "02/30/2000": None, "13/01/1999": None, "19991231": "1999-12-31",
             "19991331": None, "9999-12-31": "9999-12-31", "0001-01-01": "0001-01-01", "2000-01-02\n": "2000-01-02", "0000-01-01": "0000-01-01"}
    assert values(spark, list(dates), D.normalize_date) == list(dates.values())
    assert values(spark, ["1998-02-28", "1998-2-28", "1998-02-30"], lambda d: D.date_proximity(d, F.lit("1998-02-28"))) == [1.0, 1.0, 0.0]
    day = spark.createDataFrame([("1998-02-28",)], "s string")
    plan = day.select(D.parse_date(F.col("s")))._jdf.queryExecution().optimizedPlan().toString()
    assert "AS DATE" in plan.upper()   # the cast stands before the formats


def test_only_event_fields_go_through_the_deduplication_and_staged_tables_are_compressed(spark):
    from noticespark.plans import pipelines as PL
    from noticespark.session import staged

    docs = spark.createDataFrame([(1, "h", "codes"), (2, "h", "codes")], "arrival_seq long, content_hash string, html_hts_codes string")
    rest = [c for c in PL.EVENT_FIELDS if c not in docs.columns]
    docs = docs.select("*", F.lit(False).alias("_failed"), *[F.lit(c).alias(c) for c in rest])
    first = PL.fresh_documents(docs, "ustr", None)
    assert "html_hts_codes" not in first.columns
    assert [(r.arrival_seq, r.title) for r in first.collect()] == [(1, "title")]
    assert all(".zstd." in f for f in staged(first, "test").inputFiles())
