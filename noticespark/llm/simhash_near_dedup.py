"""SimHash near-dedup over a Gray-order hierarchical index.

Distinct fingerprints are sorted by Gray rank (neighbours in that order share long bit patterns) and cut into range
parts.  A part's top node holds the bits on which all its fingerprints agree; inside a part the index groups
consecutive fingerprints into nodes, and a node stores only the agreed bits that its parent lacks, so a search adds up
differences on the way down and drops a whole group once they exceed the radius.  The same structure over the top
nodes routes each fingerprint to the parts it can match.

Defined cases: a null text has no words, its fingerprint is zero and links like any other; a null ``doc_id`` keeps its
row and takes the smallest id of its component (null if there is none); repeated rows are each returned; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticespark.llm.common import connected_components, masked, staged

#: Fingerprints to a range part, and the bounds of the number of parts (the top nodes are the only thing broadcast).
PART_ROWS, LEAST_PARTS, MOST_PARTS = 8_192, 64, 65_536
FAN_OUT = 16


def simhash64(text: str | None, shingle: int) -> int:
    """Unsigned fingerprint: a bit is 1 if it is set in over half of the shingles' XXH64 (seed 42)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: lower() maps A-Z alone
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    line, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0] + [x + 1 for x in ends]
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(words) - shingle + 1
    for lo in range(0, n, 1 << 16):  # a bounded block of hashes at a time, for very long texts
        hashes = np.array([digest(line[a:b], 42) for a, b in zip(starts[lo:min(n, lo + (1 << 16))], ends[lo + shingle - 1:])], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int((np.uint64(1) << np.arange(64, dtype=np.uint64))[2 * ones > n].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, text_hash, fp)`` of every whole text; ``fp`` holds the 64 bits as a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fps = np.array([simhash64(t, shingle) for t in b["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_hash": b["text_hash"], "fp": fps})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    return rows.mapInPandas(run, "doc_id long, text_hash long, fp long")


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def gray_rank(fp: Column) -> Column:
    """Position of the fingerprint in the reflected Gray sequence, as a long whose signed order is the rank's order."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))


class GrayIndex:
    """Nodes over consecutive items; an item is a (pattern, mask) pair and matches by its masked bits only."""

    def __init__(self, pattern: np.ndarray, mask: np.ndarray):
        self.levels = [(pattern, mask)]
        while len(pattern) > FAN_OUT:
            cuts = np.arange(0, len(pattern), FAN_OUT)
            both, any_, known = (f.reduceat(x, cuts) for f, x in ((np.bitwise_and, pattern & mask), (np.bitwise_or, pattern & mask), (np.bitwise_and, mask)))
            mask = known & ~(both ^ any_)  # bits known in all children and equal there
            pattern = both & mask
            self.levels.append((pattern, mask))
        self.levels.reverse()
        above = None
        for i, (p, m) in enumerate(self.levels):  # a child keeps only what its parent has not factored out
            own = m if above is None else m & ~np.repeat(above, FAN_OUT)[: len(m)]
            self.levels[i], above = (p, own), m

    def search(self, queries: np.ndarray, radius: int, block: int = 2_048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query position, item position) of all matches, in bounded blocks of queries."""
        for lo in range(0, len(queries), block):
            some = queries[lo : lo + block]
            p, m = self.levels[0]
            q, node = (x.ravel() for x in np.meshgrid(np.arange(len(some)), np.arange(len(p)), indexing="ij"))
            diff = np.zeros(len(q), np.uint8)
            for i, (p, m) in enumerate(self.levels):
                diff = diff + np.bitwise_count((some[q] ^ p[node]) & m[node])
                ok = diff <= radius
                q, node, diff = q[ok], node[ok], diff[ok]
                if i + 1 < len(self.levels):
                    below = len(self.levels[i + 1][0])
                    node = (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                    q, diff = np.repeat(q, FAN_OUT), np.repeat(diff, FAN_OUT)
                    ok = node < below
                    q, node, diff = q[ok], node[ok], diff[ok]
            yield q + lo, node


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that keep the components of the links (a, b) and are fewer than their nodes."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(p, p)
        return x

    kept = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        if (rx := find(x)) != (ry := find(y)):
            parent[ry] = rx
            kept.append(i)
    return a[kept], b[kept]


def links(fps: DataFrame, radius: int = 2, forest: bool = False) -> DataFrame:
    """All pairs ``(a, b)`` of different values in ``fps(fp)`` at most ``radius`` bits apart, each once.

    A value has at most C(64,1)+C(64,2) neighbours at radius 2, so pairs grow in proportion to values.  ``forest`` drops
    links that their task's other links already imply (enough for components).
    """
    spark = fps.sparkSession
    nodes = staged(fps.select("fp").distinct().withColumn("rank", gray_rank(F.col("fp"))), "fps")
    parts = int(min(MOST_PARTS, max(LEAST_PARTS, nodes.count() // PART_ROWS)))
    ranged = staged(nodes.repartitionByRange(parts, "rank").withColumn("part", F.spark_partition_id()).drop("rank"), "ranged")
    tops = ranged.groupBy("part").agg(F.bit_and("fp").alias("both"), F.bit_or("fp").alias("any")).orderBy("part").toPandas()
    if tops.empty:
        return spark.createDataFrame([], "a long, b long")
    part_ids = tops["part"].to_numpy(np.int64)
    both, any_ = (tops[c].to_numpy(np.int64).view(np.uint64) for c in ("both", "any"))
    router = spark.sparkContext.broadcast((part_ids, both, ~(both ^ any_)))  # at most MOST_PARTS rows

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, pattern, mask = router.value
        index = GrayIndex(pattern, mask)
        for b in batches:
            fp, own = b["fp"].to_numpy(np.int64), b["part"].to_numpy(np.int64)
            for q, item in index.search(fp.view(np.uint64), radius):
                to, ok = ids[item], ids[item] >= own[q]  # a pair is found from its lower part only
                yield pd.DataFrame({"part": to[ok], "own": own[q][ok], "fp": fp[q][ok]})

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, index = None, [], None
        for b in batches:
            for key, rows in b.groupby("part", sort=False):
                if key != part:
                    part, held, index = key, [], None
                fp, built = rows["fp"].to_numpy(np.int64), rows["own"].to_numpy(np.int64) == -1
                held += [fp[built]] if built.any() else []  # sorted: a part's own values come before its queries
                if built.all():
                    continue
                if index is None:
                    held = [np.concatenate(held)]
                    rank = held[0].view(np.uint64).copy()
                    for k in (1, 2, 4, 8, 16, 32):
                        rank ^= rank >> np.uint64(k)
                    held = [held[0][np.argsort(rank)]]
                    index = GrayIndex(held[0].view(np.uint64), np.full(len(held[0]), ~np.uint64(0)))
                queries, own = fp[~built], rows["own"].to_numpy(np.int64)[~built]
                for q, item in index.search(queries.view(np.uint64), radius):
                    a, c = queries[q], held[0][item]
                    ok = (own[q] < part) | (a < c)
                    a, c = (a[ok], c[ok]) if not forest else _forest(a[ok], c[ok])
                    if len(a):
                        yield pd.DataFrame({"a": a, "b": c})

    built = ranged.select(F.col("part").cast("long").alias("part"), F.lit(-1).cast("long").alias("own"), "fp")
    routed = ranged.mapInPandas(route, "part long, own long, fp long")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts // 8)
    return built.unionAll(routed).repartition(tasks, "part").sortWithinPartitions("part", "own").mapInPandas(match, "a long, b long")


def near_dedup(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``(doc_id, fingerprint, component_id, root, text_hash)`` for every row: components of links at most ``radius`` bits
    apart; ``root`` is a fingerprint that stands for the component."""
    fps = staged(fingerprints(docs, shingle), "simhash")
    groups = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    comp = connected_components(links(fps, radius, forest=True)).withColumnsRenamed({"node": "fp", "component": "root"})
    rooted = staged(groups.join(comp, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root")), "rooted")
    best = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_fp = rooted.select("fp", "root").join(best, "root").select("fp", "root", "component_id")
    return fps.join(of_fp, "fp").select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id", "root", "text_hash")


def one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the smallest ``doc_id`` (null last), of its rows the smallest text hash."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash"))
    kept = near_dedup(docs, shingle, radius).groupBy("root").agg(first.alias("k")).select("k.*")
    rows, at = masked(docs)
    rows = rows.withColumns({"_no_id": F.col(at["doc_id"]).isNull(), "_id": F.coalesce(F.col(at["doc_id"]).cast("long"), F.lit(0)), "_hash": F.xxhash64(F.coalesce(at["text"], F.lit("")))})
    rows = rows.join(kept, (F.col("_no_id") == F.col("no_id")) & (F.col("_id") == F.col("id")) & (F.col("_hash") == F.col("text_hash")), "left_semi")
    return rows.dropDuplicates(["_no_id", "_id", "_hash"]).select(*[F.col(c).alias(name) for name, c in at.items()])
