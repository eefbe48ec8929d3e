"""Embedding near-dedup with a robust-pruned flat graph.

1. Vectors that are equal in label and components become one representative with its number of copies.
2. Centroids are fitted to a bounded sample (``SAMPLE`` representatives); every representative is assigned to its
   ``overlap`` nearest clusters, so that clusters overlap; the nearest is its own.  A cluster of one label is dealt into
   blocks of about ``BLOCK_ROWS`` rows, so no task holds an unbounded group.
3. Each block builds a graph: candidates are robust-pruned (an edge is dropped if a kept neighbour is nearer to its end by
   the factor ALPHA), reverse edges are added.  The adjacency lists of a vector from all its blocks are united.
4. Every vector searches the blocks of its own cluster: a greedy beam search from the block's medoid, then the range is
   expanded along edges from every vector found at least ``threshold - SLACK``.  Pairs are verified by the cosine in
   double precision.  A vector's links are what its search finds: it searches one cluster, whose blocks share no vector,
   so no pair is met twice and counts add up.  The queries of a cluster are dealt into parts of about ``QUERY_ROWS``; a
   task takes one part and one block, and returns counts and a spanning forest of its links, never all pairs.
5. The recall is audited: up to ``AUDIT`` vectors are compared with all vectors of their label by brute force, and the
   recall is the mean over those that have links, so that a dense group does not hide the others.  Below
   ``LEAST_RECALL`` the overlap and the beam are doubled and the search repeated; at the end every vector is in all
   clusters and the beam as wide as a block.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label or
``vec_id``, link with nothing (0 links, their own component); vectors of different length link with nothing; repeated rows are vectors like any other; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticespark.llm.common import connected_components, global_index, staged

SAMPLE, CLUSTER_ROWS, MOST_CLUSTERS, BLOCK_ROWS, QUERY_ROWS = 20_000, 1_000, 4_096, 2_048, 4_096
OVERLAP, CANDIDATES, DEGREE, ALPHA, BEAM, SLACK = 3, 48, 24, 1.2, 24, 0.04
AUDIT, LEAST_RECALL = 512, 0.97
_PAIRS = 8_192  # (query, node) pairs expanded at a time


def _matrix(rows: pd.Series, width: int = 0) -> np.ndarray:
    """Unit vectors in double precision, cut or filled with zeros to ``width`` if it is given."""
    if width:
        v = np.zeros((len(rows), width))
        for i, x in enumerate(rows):
            v[i, : len(x)] = x[:width]
        v[~v.any(1)] = 1.0
    else:
        v = np.stack(rows.to_numpy()).astype(np.float64)
    v /= np.abs(v).max(1, keepdims=True)  # before squaring, against overflow
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def prune(v: np.ndarray, seed: int) -> list[np.ndarray]:
    """Robust-pruned adjacency of a block's unit vectors, with reverse edges."""
    n = len(v)
    near = (v @ v.T).astype(np.float32)
    np.fill_diagonal(near, -2)
    k = min(CANDIDATES, n - 1)
    if k < 1:
        return [np.empty(0, np.int64)] * n
    cand = np.argpartition(-near, k - 1, axis=1)[:, :k]
    far = np.random.default_rng(seed).integers(0, n, (n, 8))  # long edges keep the graph connected
    cand = np.concatenate([cand, far], axis=1)
    dist = 1 - np.take_along_axis(near, cand, axis=1)
    order = np.argsort(dist, axis=1, kind="stable")
    cand, dist = np.take_along_axis(cand, order, axis=1), np.take_along_axis(dist, order, axis=1)
    alive, rows = cand != np.arange(n)[:, None], np.arange(n)
    out: list[list] = [[] for _ in range(n)]
    for _ in range(DEGREE):
        pick = alive.argmax(1)
        has = alive[rows, pick]
        chosen = cand[rows, pick]
        for p in rows[has].tolist():
            c = int(chosen[p])
            out[p].append(c)
            out[c].append(p)
        to_chosen = 1 - near[chosen[:, None], cand]
        alive &= ~((ALPHA * to_chosen <= dist) | (cand == chosen[:, None])) & has[:, None]
        if not alive.any():
            break
    return [np.unique(x) for x in out]


def _expand(found: np.ndarray, hold: np.ndarray, seen: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unseen neighbours of the (query, node) pairs, each once; marks them as seen."""
    q, node = np.repeat(found, edges.shape[1]), edges[hold].ravel()
    ok = node >= 0
    q, node = q[ok], node[ok]
    ok = ~seen[q, node]
    key = np.unique(q[ok] * seen.shape[1] + node[ok])
    q, node = key // seen.shape[1], key % seen.shape[1]
    seen[q, node] = True
    return q, node


def search(queries: np.ndarray, v: np.ndarray, edges: np.ndarray, medoid: int, threshold: float, width: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs with a cosine of at least ``threshold``, found over the graph."""
    n = len(v)
    small, small_q = v.astype(np.float32), queries.astype(np.float32)
    seen = np.zeros((len(queries), n), bool)
    rows = np.arange(len(queries))
    beam = np.full((len(queries), width), -1)
    score = np.full((len(queries), width), -2, np.float32)
    done = np.ones((len(queries), width), bool)
    beam[:, 0], score[:, 0], done[:, 0] = medoid, small_q @ small[medoid], False
    seen[:, medoid] = True
    hits_q, hits_n = [], []

    def note(q: np.ndarray, node: np.ndarray, s: np.ndarray) -> None:
        ok = s >= threshold - SLACK
        hits_q.append(q[ok])
        hits_n.append(node[ok])

    note(rows, np.full(len(rows), medoid), score[:, 0])
    active = rows
    while len(active):  # each round opens the best node of every query that has one
        open_ = np.where(done[active], -3, score[active])
        at = open_.argmax(1)
        active, at = active[open_.max(1) > -3], at[open_.max(1) > -3]
        if not len(active):
            break
        done[active, at] = True
        q, node = _expand(active, beam[active, at], seen, edges)
        if not len(q):
            continue
        s = np.einsum("ij,ij->i", small_q[q], small[node])
        note(q, node, s)
        where = np.searchsorted(active, q)
        place = np.arange(len(q)) - np.searchsorted(q, active)[where]
        most = place.max() + 1
        new, new_s = np.full((len(active), most), -1), np.full((len(active), most), -2, np.float32)
        new[where, place], new_s[where, place] = node, s
        all_n, all_s = np.concatenate([beam[active], new], 1), np.concatenate([score[active], new_s], 1)
        all_d = np.concatenate([done[active], new < 0], 1)
        best = np.argsort(-all_s, axis=1, kind="stable")[:, :width]
        beam[active], score[active], done[active] = (np.take_along_axis(x, best, 1) for x in (all_n, all_s, all_d))
    todo = [(np.concatenate(hits_q), np.concatenate(hits_n))]
    hits = []
    while todo:  # range expansion, a bounded number of (query, node) pairs at a time
        q, node = todo.pop()
        if len(q) > _PAIRS:
            todo += [(q[i : i + _PAIRS], node[i : i + _PAIRS]) for i in range(0, len(q), _PAIRS)]
            continue
        exact = np.einsum("ij,ij->i", queries[q], v[node])
        hits.append((q[exact >= threshold], node[exact >= threshold]))
        q, node = _expand(q, node, seen, edges)
        parts = range(0, len(q), 65536)
        s = np.concatenate([np.einsum("ij,ij->i", small_q[q[i : i + 65536]], small[node[i : i + 65536]]) for i in parts] or [np.empty(0)])
        if (ok := s >= threshold - SLACK).any():
            todo.append((q[ok], node[ok]))
    return np.concatenate([q for q, _ in hits]), np.concatenate([x for _, x in hits])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list, list]:
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(p, p)
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        if (rx := find(x)) != (ry := find(y)):
            parent[ry] = rx
            kept.append((x, y))
    return [x for x, _ in kept], [y for _, y in kept]


def _centroids(reps: DataFrame, most: int) -> np.ndarray:
    """Spherical k-means over a bounded sample, on the driver; grows with the largest label up to ``MOST_CLUSTERS``."""
    sample = reps.orderBy(F.xxhash64(F.lit(3), "rep"), "rep").limit(SAMPLE).select("embedding").toPandas()
    v = _matrix(sample["embedding"], max(map(len, sample["embedding"])))
    k = max(1, min(MOST_CLUSTERS, len(v), -(-most // CLUSTER_ROWS)))
    c = v[:k].copy()
    for _ in range(6):
        own = (v @ c.T).argmax(1)
        for j in range(k):
            if (m := v[own == j].sum(0)).any():
                c[j] = m / np.linalg.norm(m)
    return c


def _found(reps: DataFrame, centroids: np.ndarray, threshold: float, overlap: int, width: int = BEAM) -> DataFrame:
    """``(a, b, n)`` rows: counts of links (b null) and a forest of links (n = 0) of the representatives."""
    spark = reps.sparkSession
    shared = spark.sparkContext.broadcast(centroids)  # at most MOST_CLUSTERS vectors

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                near = _matrix(b["embedding"], shared.value.shape[1]) @ shared.value.T
                clusters = np.argsort(-near, axis=1, kind="stable")[:, :overlap]  # nearest first
                yield b.assign(clusters=list(clusters.astype(np.int32)))

    assigned = reps.mapInPandas(assign, "label string, dims int, rep long, copies long, embedding array<float>, clusters array<int>")
    member = assigned.withColumn("own", F.col("clusters")[0]).withColumn("cluster", F.explode("clusters")).drop("clusters")
    member = staged(member.withColumn("own", F.col("own") == F.col("cluster")), "members")
    sizes = member.groupBy("label", "dims", "cluster").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"), F.ceil(F.count_if("own") / QUERY_ROWS).cast("int").alias("parts")
    )
    member = staged(member.join(sizes, ["label", "dims", "cluster"]).withColumn("block", F.expr("cast(pmod(xxhash64(rep), blocks) as int)")), "blocks")
    key = ["label", "dims", "cluster", "block"]

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        v, ids = _matrix(rows["embedding"]), rows["rep"].to_numpy()
        lists = prune(v, int(rows["cluster"].iloc[0]))
        return pd.DataFrame({"rep": ids, "edges": [ids[x] for x in lists]})

    graph = member.groupBy(*key).applyInPandas(build, "rep long, edges array<long>")
    graph = staged(graph.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("edges"))).alias("edges")), "graph")  # united lists
    # Every part of a cluster's queries meets every block of its vectors; a cluster that is nobody's own has no part.
    node = member.where("parts > 0").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).join(graph, "rep")
    asked = member.where("own").withColumn("part", F.expr("cast(pmod(xxhash64(7, rep), parts) as int)")).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    fields = [*key, "part", "rep", "copies", "embedding"]
    both = node.select(*fields, "edges", F.lit(True).alias("node")).unionByName(asked.select(*fields, F.lit(None).cast("array<long>").alias("edges"), F.lit(False).alias("node")))

    def look(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", kind="stable")
        node, asked = rows[rows["node"]], rows[~rows["node"]]
        none = pd.DataFrame({"a": [], "b": [], "n": []}, dtype="Int64")
        if node.empty or asked.empty:
            return none
        v, ids, copies = _matrix(node["embedding"]), node["rep"].to_numpy(), node["copies"].to_numpy()
        edges = np.full((len(ids), max(1, max(len(e) for e in node["edges"]))), -1)
        for i, e in enumerate(node["edges"]):  # the united list's vectors of this block
            at = np.minimum(np.searchsorted(ids, e), len(ids) - 1)
            at = at[ids[at] == np.asarray(e)]
            edges[i, : len(at)] = at
        medoid, out = int((v @ v.mean(0)).argmax()), [none]
        for start in range(0, len(asked), 512):
            part = asked.iloc[start : start + 512]
            part_ids = part["rep"].to_numpy()
            q, hit = search(_matrix(part["embedding"]), v, edges, medoid, threshold, width)
            other = part_ids[q] != ids[hit]
            q, hit = q[other], hit[other]
            total = np.bincount(q, weights=copies[hit], minlength=len(part)).astype(np.int64)
            a, b = _forest(part_ids[q], ids[hit])
            out.append(pd.DataFrame({"a": part_ids[total > 0], "b": pd.array([None] * int((total > 0).sum()), dtype="Int64"), "n": total[total > 0]}))
            out.append(pd.DataFrame({"a": np.asarray(a, np.int64), "b": pd.array(b, dtype="Int64"), "n": np.zeros(len(a), np.int64)}))
        return pd.concat(out)

    return staged(both.groupBy(*key, "part").applyInPandas(look, "a long, b long, n long"), "links")


def _audit(reps: DataFrame, counts: DataFrame, threshold: float) -> float:
    """Share of its true links that was found, as a mean over up to ``AUDIT`` representatives that have any."""
    asked = reps.orderBy(F.xxhash64(F.lit(5), "rep"), "rep").limit(AUDIT).toPandas()
    queries = {key: (g["rep"].to_numpy(), _matrix(g["embedding"])) for key, g in asked.groupby(["label", "dims"])}
    shared = reps.sparkSession.sparkContext.broadcast(queries)  # at most AUDIT vectors

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for key, g in b.groupby(["label", "dims"]):
                if key in shared.value:
                    ids, q = shared.value[key]
                    near = (q @ _matrix(g["embedding"]).T >= threshold) & (ids[:, None] != g["rep"].to_numpy())
                    yield pd.DataFrame({"rep": ids, "n": near @ g["copies"].to_numpy()})

    true = reps.mapInPandas(run, "rep long, n long").groupBy("rep").agg(F.sum("n").alias("n"))
    both = true.where("n > 0").join(counts.withColumnRenamed("n", "found"), "rep", "left")
    mean = both.agg(F.avg(F.coalesce("found", F.lit(0)) / F.col("n"))).first()[0]
    return 1.0 if mean is None else mean


def near_duplicates(embeddings: DataFrame, threshold: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept, recall`` for every row; ``recall`` is the audited one."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<float>").alias("embedding"))
    fine = F.expr("vec_id is not null and label is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)")
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    same = rows.where("fine").groupBy("label", "embedding").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    same = global_index(same, [F.asc("first_id"), F.asc("label"), F.asc("embedding")]).withColumnRenamed("idx", "rep")
    same = staged(same.withColumn("dims", F.size("embedding")), "vectors")
    reps = same.select("label", "dims", "rep", "copies", "embedding")
    most = reps.groupBy("label", "dims").count().agg(F.max("count")).first()[0]
    if most is None:
        alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return alone.select("*", F.lit(True).alias("kept"), F.lit(1.0).alias("recall"))
    centroids, overlap, width = _centroids(reps, most), OVERLAP, BEAM
    while True:
        found = _found(reps, centroids, threshold, min(overlap, len(centroids)), width)
        counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
        recall = _audit(reps, counts, threshold)
        if recall >= LEAST_RECALL or overlap >= len(centroids) and width >= BLOCK_ROWS:
            break
        overlap, width = 2 * overlap, 2 * width
    comp = connected_components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    info = same.join(counts, "rep", "left").join(comp, "rep", "left").withColumn("root", F.coalesce("component", "rep"))
    info = staged(info.select("label", "embedding", "first_id", "root", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "linked")
    first = info.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = rows.where("fine").join(info.join(first, "root"), ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"), F.lit(recall).alias("recall"))
