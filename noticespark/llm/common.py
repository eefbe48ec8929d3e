"""Helpers shared by the operators: staged tables, global order, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticespark.session import ensure_checkpoint_dir

#: Word separators of the contracts: space and U+0009 to U+000D (what ``bytes.split()`` splits on).
SPACE = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def masked(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns c0, c1, ... and the new name of each old one, so that no extra column clashes with a helper's."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id's text leaves ``remainder``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def global_index(df: DataFrame, order: list[Column], rows_per_part: int = 20_000) -> DataFrame:
    """Append ``idx`` (0, 1, ...) in the global order of ``order``, without a single-task sort.

    Rows are range-partitioned; each part numbers its own rows and is shifted by the size of the parts before it
    (one count per part).  ``order`` must tell all rows apart for the result to be the same in each run.
    """
    n = df.count()
    parts = min(4096, max(8, n // rows_per_part))
    ranged = staged(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per part
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shift = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    numbered = ranged.withColumn("_rn", F.row_number().over(W.partitionBy("_part").orderBy(*order)))
    return numbered.join(shift, "_part").withColumn("idx", F.col("_shift") + F.col("_rn") - 1).drop("_part", "_rn", "_shift")


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of longs -> ``(node, component)``: for every node of an edge the smallest node it reaches.

    Each round hooks every component to its smallest neighbour, follows the hooks twice and keeps only edges between
    different components; the edge table shrinks by at least half of the components in it.  Every round is staged, so a
    lost executor costs one round.  Labels of one hot component are the probe side of joins with one row per label.
    """
    e = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    comp = None
    while not e.isEmpty():
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("r"), F.least("a", "m").alias("p"))
        for _ in range(2):
            up = hook.select(F.col("r").alias("p"), F.col("p").alias("pp"))
            hook = staged(hook.join(up, "p", "left").select("r", F.coalesce("pp", "p").alias("p")), "hooks")
        if comp is None:
            comp = hook.select(F.col("r").alias("node"), F.col("p").alias("component"))
        else:
            up = hook.select(F.col("r").alias("component"), "p")
            comp = staged(comp.join(up, "component", "left").select("node", F.coalesce("p", "component").alias("component")), "components")
        for c in ("a", "b"):
            up = hook.select(F.col("r").alias(c), "p")
            e = e.join(up, c).drop(c).withColumnRenamed("p", c)
        e = staged(e.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if comp is None:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    return comp
