"""The raw zone by path, and review blocks, against plain versions."""

import hashlib
import uuid
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from noticespark.operators.review import review_blocks
from noticespark.plans import raw
from noticespark.session import ensure_checkpoint_dir

BODIES = "source string, doc_id string, kind string, url string, body binary"
DAY1, DAY2 = "2026-01-01 06:15:00", "2026-01-02 06:15:00"


@pytest.fixture()
def zone(spark):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/raw-{uuid.uuid4().hex}"


def test_every_path_leads_to_its_bytes(spark, zone):
    page = "<p>é</p>".encode()
    first = [("federal_register", "2025-1", "html", "http://f/1", page), ("federal_register", "2025-2", "html", "http://f/2", page),
             ("federal_register", "2025-1", "pdf", "http://f/1.pdf", b"%PDF\x00\xff"), ("federal_register", "2025-1", "json", "http://f/1", b"{}"),
             ("ustr", "a.pdf", "pdf", "http://u/a.pdf", b"\x00one"), ("ustr", "page", "html", "http://u/page", page),
             ("ustr", None, "html", None, b""), ("cbp_csms", "c", "html", "http://c/c", None)]
    lineage = raw.store_raw(spark.createDataFrame(first, BODIES), zone, DAY1)
    path = {(r.source, r.doc_id, r.kind): r.raw_path for r in lineage.collect()}
    assert path["ustr", "a.pdf", "pdf"] == f"{zone}/source=ustr/ingest_date=2026-01-01/ustr_a.pdf_20260101_061500.pdf"
    want = {path[s, d or "", k]: b for s, d, k, _, b in first if b is not None}
    got = {r.raw_path: bytes(r.body) for r in raw.read_raw(spark, zone, lineage).collect()}
    assert got == want and ("cbp_csms", "c", "html") not in path
    assert spark.read.parquet(zone + "/bodies").count() == 6   # the page once for each of two sources, and four other bodies
    # the second day: a known body is not written again, its name leads to the first day's bytes
    second = [("ustr", "again", "html", "http://u/again", page), ("ustr", "new", "html", "http://u/new", b"new")]
    for _ in range(2):   # and a batch that is run again adds nothing
        more = raw.store_raw(spark.createDataFrame(second, BODIES), zone, DAY2)
    assert spark.read.parquet(zone + "/bodies").count() == 7 and spark.read.parquet(zone + "/names").count() == 9
    only = more.where("doc_id = 'again'").union(more.where("doc_id = 'again'"))
    read = raw.read_raw(spark, zone, only)
    assert [bytes(r.body) for r in read.collect()] == [page]
    lost = spark.createDataFrame([(zone + "/source=ustr/ingest_date=2026-01-01/none.html",), ("elsewhere",), (None,)], "raw_path string")
    assert raw.read_raw(spark, zone, lost).count() == 0 and raw.read_raw(spark, zone).count() == 9


def test_paths_prune_both_tables(spark, zone, tmp_path):
    for day in (DAY1, DAY2):
        lineage = raw.store_raw(spark.createDataFrame([(s, day[:10], "html", f"http://{s}/{day[:10]}", f"{s} {day}".encode()) for s in ("ustr", "cbp_csms")], BODIES), zone, day)
    read = raw.read_raw(spark, zone, lineage.where("source = 'ustr'"))
    files = {f for f in read.inputFiles() if "/bodies/" in f}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "source" in plan.split("PartitionFilters: [")[-1].split("]")[0]
    assert files and [r.source for r in read.collect()] == ["ustr"]


def test_a_crash_between_bodies_and_names(spark, zone):
    rows = spark.createDataFrame([("ustr", "x", "html", "http://u/x", b"x")], BODIES)
    named = rows.select("source", F.to_date(F.lit(DAY1[:10])).alias("ingest_date"), F.sha2("body", 256).alias("body_hash"), "body")
    named.write.partitionBy("source", "ingest_date").parquet(zone + "/bodies")   # what the lost run had written
    lineage = raw.store_raw(rows, zone, DAY2)
    assert spark.read.parquet(zone + "/bodies").count() == 1
    assert [bytes(r.body) for r in raw.read_raw(spark, zone, lineage).collect()] == [b"x"]


def test_events_carry_their_paths(spark):
    ev = "id string, source string, data struct<source_url:string,pdf_url:string>, raw_html_path string, raw_pdf_path string, raw_json_path string, _pu int"
    events = spark.createDataFrame([("1", "ustr", ("u1", "p1"), "u1", None, None, 7), ("2", "ustr", (None, None), None, None, None, 8),
                                    ("3", "cbp_csms", ("u1", "none"), "u1", None, None, 9)], ev).drop("_pu")
    lineage = spark.createDataFrame([("ustr", "d", "html", "u1", "z/2026-01-01"), ("ustr", "d", "html", "u1", "z/2026-01-02"), ("ustr", "d", "json", "u1", "j"),
                                     ("ustr", "d", "pdf", "p1", "p"), ("ustr", "e", "html", None, "n")], "source string, doc_id string, kind string, url string, raw_path string")
    out = raw.with_raw_paths(events, lineage)
    assert out.columns == events.columns
    assert {r.id: (r.raw_html_path, r.raw_pdf_path, r.raw_json_path) for r in out.collect()} == {
        "1": ("z/2026-01-02", "p", "j"), "2": (None, None, None), "3": (None, None, None)}


@pytest.mark.parametrize("share", [1, 50, 10**9])   # no block is hot, some are, all are
def test_review_blocks_equal_a_plain_grouping(spark, share):
    rows = [(f"n{i:05d}", "ustr", None, [], "2025-12-01", 5000 - i) for i in range(2_000)]   # one block of code-less notices
    rows += [(f"c{i:03d}", "cbp_csms", "2025-01-02", [f"{1000 + i % 40}.11.2222", "0101.21.0000"], "2025-12-02", i // 2) for i in range(200)]
    rows += [("z", "ustr", None, None, "2025-12-01", 1), ("y", "ustr", "", ["", None], "2025-12-01", 1)]
    events = spark.createDataFrame(rows, "id string, source string, publication_date string, codes array<string>, ingestion_timestamp string, ingest_seq long")
    groups = defaultdict(list)
    for i, source, date, codes, ts, seq in rows:
        short = sorted(c[:7] for c in codes or [] if c)[:5]
        groups[source, date, tuple(short)].append((ts, seq, i))
    want = {i: (len(g), min(g)[2]) for g in groups.values() for _, _, i in g}
    got = review_blocks(events, share).collect()
    assert {r.id: (r.block_size, r.representative) for r in got} == want and len(got) == len(rows)
    text = '{"hts_codes": [], "publication_date": null, "source": "ustr"}'
    assert {r.fuzzy_hash for r in got if r.id == "n00000"} == {hashlib.md5(text.encode()).hexdigest()}
    assert review_blocks(events.limit(0), share).count() == 0
