"""Newest-k tables: what the candidate join (J3 + W3) needs of the event store, kept up to date run by run.

``by_code`` holds the newest ``k`` events per (code, source), ``by_date`` those per (publication date, source).  A run merges
its own events into them: each key's old rows and the run's newest rows are ranked together, so the merge reads at most k
rows a key and the run, never the store; its size follows the distinct codes and dates, not the events.  The newest k of
two newest-k lists are the newest k of all, so candidates from the tables equal candidates from the whole store.

Every merge writes a new version of both tables and readers take the last complete one; a crash leaves the version before
it in force.  Merging events again changes nothing (rows are distinct by key and id), so a run can be replayed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators.link import candidate_pairs, newest_k

ROW = "id string, source string, ingestion_timestamp timestamp, ingest_seq long"
TABLES = {"by_code": "code", "by_date": "pub"}


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions under ``path``, ascending."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(p)] if fs.exists(p) else []
    done = lambda v: fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(v, "by_date/_SUCCESS"))  # noqa: E731  written last
    return sorted(int(v.getName()[1:]) for v in found if done(v))


def newest_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The last complete version of both tables; empty ones before the first merge."""
    versions = _versions(spark, path)
    if not versions:
        return {name: spark.createDataFrame([], f"{ROW}, {key} {'date' if key == 'pub' else 'string'}") for name, key in TABLES.items()}
    return {name: spark.read.parquet(f"{path}/v{versions[-1]}/{name}") for name in TABLES}


def merge_newest(spark: SparkSession, events: DataFrame, path: str, k: int = K.LINK_CANDIDATE_LIMIT) -> None:
    """Merge a run's events (linking shape) into the tables."""
    cols = ["id", "source", "ingestion_timestamp", "ingest_seq"]
    rows = {"by_code": events.select(*cols, F.explode(F.array_distinct("codes")).alias("code")),
            "by_date": events.select(*cols, F.to_date("publication_date").alias("pub")).where("pub is not null")}
    old = newest_tables(spark, path)
    version = (_versions(spark, path) or [0])[-1] + 1
    for name, key in TABLES.items():
        own = newest_k(rows[name], [key, "source"], k)   # at most k rows a key and map task are shuffled
        both = old[name].select(*cols, key).unionByName(own).dropDuplicates([key, "source", "id"])
        newest_k(both, [key, "source"], k).write.mode("overwrite").parquet(f"{path}/v{version}/{name}")


def candidates(spark: SparkSession, new: DataFrame, path: str, limit: int = K.LINK_CANDIDATE_LIMIT) -> DataFrame:
    """J3 + W3 from the tables alone: ``candidate_pairs`` of ``new`` and the whole store, for a limit up to their k."""
    tables = newest_tables(spark, path)
    cols = ["id", "source", "ingestion_timestamp", "ingest_seq"]
    codes = tables["by_code"].select(*cols, F.array("code").alias("codes"), F.lit(None).cast("string").alias("publication_date"))
    dates = tables["by_date"].select(*cols, F.array().cast("array<string>").alias("codes"), F.date_format("pub", "yyyy-MM-dd").alias("publication_date"))
    return candidate_pairs(new, codes.unionByName(dates), limit)
