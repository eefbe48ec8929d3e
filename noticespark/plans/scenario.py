"""The ingestion scenario the registered queries run on, derived from the driver tables.

* Landed data: FR search results (one record per matching term), USTR and CBP
  link records, one HTML page per filing, extracted PDF pages for FR filings
  with a pdf_url (see ``sources.fixtures``).
* Store: the USTR and CBP runs already ingested all their notices (CBP ran
  last); an earlier FR run ingested the FR notices landed before the cutoff.
* New batch: the FR run over every landed FR search result.

Everything here is lazily planned; nothing is collected.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import parse as P
from ..operators.dedup import dedup_within_batch
from ..session import ensure_checkpoint_dir
from ..sources import fixtures as X
from ..operators.link import link_documents, reachable_pairs
from . import pipelines as PL

LAYOUT_VERSION = "v8"   # bump when a fixture or the store layout changes

AS_OF = {"federal_register_prior": "2025-11-30 06:15:00", "ustr": "2025-12-01 08:00:00",
         "cbp_csms": "2025-12-02 00:30:00", "federal_register": "2026-01-01 06:15:00"}


@dataclass
class Landed:
    fr_raw: DataFrame
    ustr: DataFrame
    cbp: DataFrame
    pages: DataFrame
    pdf_pages: DataFrame


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _input_key(spark: SparkSession, sf_dir: str) -> str:
    """Folder, layout version, and name, size and time of every input file: changed input gets new tables."""
    fs, p = _fs(spark, sf_dir)
    found = [f"{sf_dir}|{LAYOUT_VERSION}"]
    for s in fs.listStatus(p):
        parts = fs.listStatus(s.getPath()) if s.isDirectory() else [s]
        found += sorted(f"{s.getPath().getName()}/{x.getPath().getName()}:{x.getLen()}:{x.getModificationTime()}" for x in parts)
    return hashlib.md5("|".join(sorted(found)).encode()).hexdigest()[:16]


def materialized(spark: SparkSession, sf_dir: str, name: str, build, partition_by: list[str] | None = None) -> DataFrame:
    """Write a derived table once into the shared checkpoint folder and read it back.

    This is the landing zone / event store of the scenario: persisted Parquet,
    so later jobs start from files (no lineage back to the fixtures, and a lost
    executor only re-reads files).  Every writer writes a folder of its own, complete
    once it holds _SUCCESS; readers take the first complete one, so callers that race
    leave an unused copy and never touch each other's files.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/noticespark-tables/{_input_key(spark, sf_dir)}/{name}"
    fs, parent = _fs(spark, path)

    def complete() -> list[str]:
        found = [s.getPath().toString() for s in fs.listStatus(parent)] if fs.exists(parent) else []
        return sorted(x for x in found if _exists(spark, x + "/_SUCCESS"))

    if not complete():
        w = build().write.option("compression", "zstd")   # pages repeat their markup
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{path}/data-{uuid.uuid4().hex}")
    return spark.read.parquet(complete()[0])


def landed(spark: SparkSession, sf_dir: str) -> Landed:
    """The landing zone derived from the driver tables (materialised once per input folder)."""
    m = lambda name, fn: materialized(spark, sf_dir, name, fn)
    f = m("filings", lambda: X.filings(spark, sf_dir))          # shared inputs, computed once
    lines = m("order_lines", lambda: X.order_lines(spark, sf_dir))
    return Landed(
        fr_raw=m("fr_raw", lambda: X.fr_raw(spark, sf_dir, f)),
        ustr=m("ustr_links", lambda: X.link_records(spark, sf_dir, "ustr", f)),
        cbp=m("cbp_links", lambda: X.link_records(spark, sf_dir, "cbp_csms", f)),
        pages=materialized(spark, sf_dir, "pages", lambda: X.notice_pages(spark, sf_dir, f, lines), ["source"]),
        pdf_pages=m("pdf_pages", lambda: X.notice_pdf_pages(spark, sf_dir, f, lines)),
    )


def prior_fr_raw(l: Landed) -> DataFrame:
    return l.fr_raw.where(F.col("landed_date") < F.lit(X.STORE_CUTOFF).cast("date"))


def build_store_events(spark: SparkSession, sf_dir: str, l: Landed | None = None) -> DataFrame:
    """Events of the three earlier runs (no linking) in one pass over the landed pages.

    Same rows as running ``fr_pipeline`` (prior FR filings), ``ustr_pipeline`` and
    ``cbp_pipeline`` separately with an empty store: the pages are joined once for all
    three sources, and first-wins dedup is per (source, content_hash).
    """
    l = l or landed(spark, sf_dir)
    parsed = (PL.fr_documents(prior_fr_raw(l)).unionByName(P.parse_ustr(l.ustr))
              .unionByName(P.parse_cbp(l.cbp)))
    docs = PL.prepare_documents(parsed, None, l.pages, PL.fr_pdf_codes(l.pdf_pages))
    failed = (F.col("source") == "federal_register") & F.col("source_url").isNotNull() & F.col("raw_html_path").isNull()   # as mark_failed
    first = dedup_within_batch(docs.where(~failed).select(*PL.EVENT_FIELDS), keys=["source", "content_hash"])
    run_time = (F.when(F.col("source") == "federal_register", F.to_timestamp(F.lit(AS_OF["federal_register_prior"])))
                .when(F.col("source") == "ustr", F.to_timestamp(F.lit(AS_OF["ustr"])))
                .otherwise(F.to_timestamp(F.lit(AS_OF["cbp_csms"]))))
    return PL.event_envelope(first, run_time)


def store_events(spark: SparkSession, sf_dir: str, l: Landed | None = None) -> DataFrame:
    """The events table before the new FR run: Parquet partitioned by source (pruned on source filters)."""
    return materialized(spark, sf_dir, "events", lambda: build_store_events(spark, sf_dir, l), ["source"])


LATE_AS_OF = "2026-01-02 06:15:00"


def on_time(pages: DataFrame) -> DataFrame:
    """The landed pages less those of every fifth FR filing, which are late."""
    return pages.where((F.col("source") != "federal_register") | (F.col("k") % 15 != 0))


def late(pages: DataFrame) -> DataFrame:
    """The late pages that land at last: half of them; the others never do."""
    return pages.where((F.col("source") == "federal_register") & (F.col("k") % 30 == 0))


def fr_run(spark: SparkSession, sf_dir: str, link_limit: int | None = None, with_title: bool = True, link: bool = True,
           pages_missing: bool = False) -> PL.BatchResult:
    l = landed(spark, sf_dir)
    store = store_events(spark, sf_dir, l)
    return PL.fr_pipeline(l.fr_raw, on_time(l.pages) if pages_missing else l.pages, l.pdf_pages, store, as_of=AS_OF["federal_register"],
                          link_limit=link_limit, with_title=with_title, link=link)


def link_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The FR run's new events and the stored events of the other sources in the linking shape, both staged."""
    new = materialized(spark, sf_dir, "link_new", lambda: PL.link_projection(fr_run(spark, sf_dir, link=False).events))
    other = materialized(spark, sf_dir, "link_other", lambda: PL.link_projection(
        store_events(spark, sf_dir).where(F.col("source") != "federal_register")))
    return new, other


def late_pages_run(spark: SparkSession, sf_dir: str) -> str:
    """The FR run as a stream while pages are missing, then the stream of late pages; the folder of its tables."""
    from ..streaming.incremental import incremental_ingest, retry_on_arrival
    l = landed(spark, sf_dir)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/noticespark-runs/late-{uuid.uuid4().hex[:12]}"
    l.fr_raw.repartition(4, "landed_date").write.option("compression", "zstd").parquet(base + "/landing")
    late(l.pages).repartition(3, "url").write.option("compression", "zstd").parquet(base + "/pages")
    store_events(spark, sf_dir, l).write.option("compression", "zstd").partitionBy("source").parquet(base + "/events")
    tables = (base + "/events", base + "/edges")
    incremental_ingest(spark, base + "/landing", l.fr_raw.schema, on_time(l.pages), l.pdf_pages, *tables, base + "/ckpt-documents",
                       AS_OF["federal_register"], max_files_per_trigger=2, pending_path=base + "/pending")
    retry_on_arrival(spark, base + "/pages", l.pages.schema, l.pdf_pages, *tables, base + "/pending", base + "/ckpt-pages", LATE_AS_OF,
                     max_files_per_trigger=2)
    return base


def run_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reachable pairs of the FR run, staged."""
    return materialized(spark, sf_dir, "link_pairs", lambda: reachable_pairs(*link_sides(spark, sf_dir)))


def run_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All edges of the FR run (every stored event a candidate), staged."""
    return materialized(spark, sf_dir, "link_edges", lambda: link_documents(*link_sides(spark, sf_dir), limit=None))
