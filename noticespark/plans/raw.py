"""The raw zone: every body stored once per content, and names that lead to it.

Two tables below one folder, both partitioned by source and day:

* ``names``: name, document, kind (html, pdf, json), URL, the body's hash, the day its bytes were stored, and whether they
  stand under this very name (``own``);
* ``bodies``: hash and bytes, once per source and content, on the day they were first met, beside the name they came under.

A raw path is ``<folder>/source=<source>/ingest_date=<day>/<name>``: source and day, read from the path, prune the names,
and the names' body days prune the bodies.  Only hashes are compared to find new bodies; a body that many documents share
(an error page) is written once, whatever the number of its names.

Defined cases: a null body is not stored; a null document id is empty in the name; of several bodies under one name of a
batch the one with the largest hash stays, and a name that is stored already keeps its body.  Bodies are written before
names, so a batch that is run again after a crash adds what is missing and nothing twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged
from .sinks import table_exists

KINDS = ("html", "pdf", "json")
NAMES = "name string, doc_id string, kind string, url string, body_hash string, body_date date, own boolean, source string, ingest_date date"
BODIES = "name string, doc_id string, kind string, url string, body_hash string, body binary, source string, ingest_date date"

#: Largest list of names or hashes that need a look (repeated, known, without a name) that is broadcast: 24 MB or so.
MOST_LISTED = 200_000
_PATH = r"/source=([^/]*)/ingest_date=(\d{4}-\d{2}-\d{2})/(.*)$"


def _folder(path: str) -> str:
    return path.rstrip("/")


def _raw_path(path: str) -> Column:
    return F.concat(F.lit(_folder(path) + "/source="), F.col("source"), F.lit("/ingest_date="),
                    F.date_format("ingest_date", "yyyy-MM-dd"), F.lit("/"), F.col("name"))


def store_raw(bodies: DataFrame, path: str, ingest_ts: str) -> DataFrame:
    """K3: keep ``bodies`` (source, doc_id, kind, url, body); returns the lineage (source, doc_id, kind, url, raw_path)."""
    spark, folder = bodies.sparkSession, _folder(path)
    ts = F.to_timestamp(F.lit(ingest_ts))
    named = bodies.where(F.col("body").isNotNull()).select(
        "source", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "kind", "url",
        F.col("body").cast("binary").alias("body")).select(
        "*", F.sha2("body", 256).alias("body_hash"), F.to_date(ts).alias("ingest_date"),
        F.concat("source", F.lit("_"), "doc_id", F.lit("_"), F.date_format(ts, "yyyyMMdd_HHmmss"), F.lit("."), "kind").alias("name"))
    keys = ["source", "ingest_date", "name"]
    one = F.max_by(F.struct("doc_id", "kind", "url", "body_hash"), F.struct("body_hash", "url")).alias("_file")
    landed = named.groupBy(*keys).agg(one, F.count(F.lit(1)).alias("rows"))
    files = staged(landed.select(*keys, "_file.*", "rows"), "raw_names")   # no bodies in this shuffle

    body_key = ["source", "body_hash"]
    if table_exists(spark, folder + "/bodies"):
        stored = _bodies(spark, folder).groupBy(*body_key).agg(F.min(F.struct("ingest_date", "name")).alias("_first"))
        stored = stored.select(*body_key, F.col("_first.ingest_date").alias("body_date"), F.col("_first.name").alias("body_name"))
        files = staged(files.join(stored, body_key, "left"), "raw_names")
    else:
        files = files.withColumns({"body_date": F.lit(None).cast("date"), "body_name": F.lit(None).cast("string")})
    of_hash = files.groupBy(*body_key).agg(F.min("name").alias("first"), F.count(F.lit(1)).alias("files"), F.max("rows").alias("rows"), F.max("body_date").alias("body_date"))
    new = F.col("body_date").isNull()
    listed = staged(of_hash.where(~new | (F.col("files") > 1) | (F.col("rows") > 1)), "raw_listed")
    short = listed.count() <= MOST_LISTED
    several = listed.where(new).select(*body_key, "first")
    several = F.broadcast(several) if short else several
    if short:
        first = _first_bodies(named, files, listed, several)
    else:
        first = named.join(of_hash.where(new).select(*body_key, F.col("first").alias("name")), [*body_key, "name"]).dropDuplicates([*body_key, "name"])
    _write(first.select(*keys, "doc_id", "kind", "url", "body_hash", "body"), folder + "/bodies")

    name, met = F.col("name"), F.col("body_date")
    own = F.when(met.isNull(), F.coalesce(name == F.col("first"), F.col("first").isNull() & name.isNotNull())).otherwise((F.col("body_name") == name) & (met == F.col("ingest_date")))
    rows = files.join(several, body_key, "left").select(*keys, "doc_id", "kind", "url", "body_hash", F.coalesce(met, "ingest_date").alias("body_date"),
                                                        F.coalesce(own, F.lit(False)).alias("own"))
    if table_exists(spark, folder + "/names"):
        rows = rows.join(_names(spark, folder).select(*keys), keys, "left_anti")
    _write(rows, folder + "/names")
    return files.select("source", "doc_id", "kind", "url", _raw_path(path).alias("raw_path"))


def _names(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(NAMES).parquet(folder + "/names")


def _bodies(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BODIES).parquet(folder + "/bodies")


def _write(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("compression", "zstd").partitionBy("source", "ingest_date").parquet(path)


def _first_bodies(named: DataFrame, files: DataFrame, listed: DataFrame, several: DataFrame) -> DataFrame:
    """The landed rows whose body is stored: one for each hash that is new in the zone, under the smallest of its names.

    A body that one row alone brings is taken as it is.  ``listed`` has the hashes that are known or came several times
    (so also that of a name that came twice): the list is short and broadcast, and only listed bodies are shuffled.
    """
    body_key = ["source", "body_hash"]
    twice = files.where(F.col("rows") > 1).select("source", "name")
    alone = named.where(F.col("source").isNotNull() & F.col("name").isNotNull()).join(F.broadcast(twice), ["source", "name"], "left_anti")
    alone = alone.join(F.broadcast(listed.select(*body_key)), body_key, "left_anti")
    if several.isEmpty():
        return alone
    again = named.join(F.broadcast(several.withColumnRenamed("first", "name")), [*body_key, "name"]).dropDuplicates([*body_key, "name"])
    return alone.unionByName(again)


def _pruned(table: DataFrame, wanted: DataFrame, day: str, partition: str = "ingest_date") -> DataFrame:
    """``table`` less the partitions no row of ``wanted`` names; the list is at most one entry per source and day."""
    days: dict[str, list] = {}
    for r in wanted.select("source", day).distinct().collect():
        days.setdefault(r["source"], []).append(r[day])
    named = F.lit(False)
    for source, of in sorted(days.items()):
        named = named | ((F.col("source") == source) & F.col(partition).isin(of))
    return table.where(named)


def read_raw(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """K4: (raw_path, source, doc_id, kind, url, name, body) of all stored names, or of the paths in ``wanted.raw_path``.

    A path that leads nowhere has no row; a path that is wanted twice has one.
    """
    folder = _folder(path)
    names, bodies = _names(spark, folder), _bodies(spark, folder)
    columns = [_raw_path(path).alias("raw_path"), "source", "doc_id", "kind", "url", "name", "body"]
    by_hash = lambda some: some.join(bodies.select("source", F.col("ingest_date").alias("body_date"), "body_hash", "body"), ["source", "body_date", "body_hash"])
    if wanted is not None:
        part = lambda i: F.regexp_extract("raw_path", _PATH, i)
        here = wanted.where(F.startswith("raw_path", F.lit(folder + "/source=")) & (part(3) != ""))
        at = staged(here.select(part(1).alias("source"), part(2).cast("date").alias("ingest_date"), part(3).alias("name")).distinct(), "raw_wanted")
        names = staged(_pruned(names, at, "ingest_date").join(at, ["source", "ingest_date", "name"], "left_semi"), "raw_found")
        bodies = _pruned(bodies, names, "body_date", "ingest_date")
        return by_hash(names).select(*columns)
    # Most names stand beside their body; bodies that a lost run left without a name, and names of other bodies, are listed.
    keys = ["source", "ingest_date", "name"]
    own = F.coalesce("own", F.lit(False))
    nameless = staged(bodies.select(*keys).join(names.where(own).select(*keys), keys, "left_anti"), "raw_nameless")
    others = staged(names.where(~own), "raw_others")
    if nameless.count() + others.count() > MOST_LISTED:
        return by_hash(names).select(*columns)
    beside = bodies.where(F.col("name").isNotNull()).join(F.broadcast(nameless.where(F.col("name").isNotNull())), keys, "left_anti")
    return beside.select(*columns).unionByName(by_hash(F.broadcast(others)).select(*columns))


def with_raw_paths(events: DataFrame, lineage: DataFrame) -> DataFrame:
    """The raw paths of each event: page and record by its URL, PDF by its PDF URL; of several captures the latest.

    Events without such a URL are joined on their id, which is no URL, so they do not meet in one task.
    """
    latest = [F.max(F.when(F.col("kind") == k, F.col("raw_path"))).alias(f"_{k}") for k in KINDS]
    paths = lineage.where(F.col("url").isNotNull()).groupBy("source", "url").agg(*latest)
    pages = paths.select(F.col("source").alias("_ps"), F.col("url").alias("_pu"), "_html", "_json")
    pdfs = paths.where(F.col("_pdf").isNotNull()).select(F.col("source").alias("_ds"), F.col("url").alias("_du"), "_pdf")
    by = lambda field: F.coalesce(F.col(f"data.{field}"), F.col("id"))
    found = (events.join(pages, (F.col("source") == F.col("_ps")) & (by("source_url") == F.col("_pu")), "left")
             .join(pdfs, (F.col("source") == F.col("_ds")) & (by("pdf_url") == F.col("_du")), "left"))
    at = {f"raw_{k}_path": f"_{k}" for k in KINDS}
    return found.select(*[F.col(at.get(c, c)).alias(c) for c in events.columns])
