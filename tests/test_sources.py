"""Landing-zone readers: search-API JSON pages and whole-file HTML pages, written from driver-derived data."""

import os
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from noticespark.operators.dedup import distinct_by_docnum
from noticespark.session import ensure_checkpoint_dir
from noticespark.sources import fixtures as X
from noticespark.sources import landed as LD


def test_api_json_pages_roundtrip(spark):
    raw = X.fr_raw(spark, SF_SMALL)
    base = os.path.join(ensure_checkpoint_dir(spark), "api-" + uuid.uuid4().hex[:8])
    # one JSON page per (search term, block of 100 results), as the API returns them
    rec = F.struct(*[F.col(c) for c in ["document_number", "title", "publication_date", "html_url", "pdf_url",
                                        "abstract", "type", "executive_order_number", "proclamation_number"]])
    pages = (raw.withColumn("blk", (F.col("arrival_seq") / 300).cast("long"))
             .groupBy("search_term", "blk")
             .agg(F.array_sort(F.collect_list(F.struct("arrival_seq", rec.alias("r")))).alias("items"))
             .select("search_term", F.transform("items", lambda x: x.getField("r")).alias("results"),
                     F.size("items").cast("long").alias("count")))
    pages.write.json(base)
    back = LD.read_api_records(spark, base)
    assert back.count() == raw.count()
    got = {(r.search_term, r.document_number) for r in back.select("search_term", "document_number").collect()}
    want = {(r.search_term, r.document_number) for r in raw.select("search_term", "document_number").collect()}
    assert got == want
    # A2 over the read-back records keeps one row per document number
    firsts = distinct_by_docnum(back.withColumn("term_pos", F.lit(0)).withColumn("arrival_seq", F.col("result_pos")))
    assert firsts.count() == raw.select("document_number").distinct().count()


def test_read_pages_wholetext(spark, tmp_path):
    pages = X.notice_pages(spark, SF_SMALL).where(F.col("k") < 5).select("k", "html").collect()
    for r in pages:
        (tmp_path / f"page_{r.k}.html").write_text(r.html, encoding="utf-8")
    back = LD.read_pages(spark, str(tmp_path))
    got = {os.path.basename(r.url): r.html for r in back.collect()}
    assert got == {f"page_{r.k}.html": r.html for r in pages}


def test_search_window_and_keyword_union(spark):
    raw = X.fr_raw(spark, SF_SMALL)
    win = LD.search_window(raw, "1998-06-30", 365)
    top = LD.keyword_union(raw, "1998-06-30", 365, per_term=3)
    per_term = {r.search_term: r.n for r in top.groupBy("search_term").agg(F.count("*").alias("n")).collect()}
    assert all(n <= 3 for n in per_term.values()) and per_term
    assert top.join(win, ["search_term", "document_number"], "left_anti").count() == 0
