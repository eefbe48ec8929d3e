"""Exact and near duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import identity as I
from ..functions.similarity import doc_similarity, dup_code_overlap, jaccard, ratio_upper_bound, title_ratio


def first_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """First row per key by ``order_cols`` as a ``min_by`` aggregate.

    Unlike a row_number window, the aggregate is partial before the shuffle: a hot
    key (a third of all rows sharing one hash) collapses to one row per map task,
    so no single task ever sorts the hot group.  It is one pass over the input
    (a semi-join with the per-key minimum would evaluate the input twice).
    """
    cols = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols]) if len(order_cols) > 1 else F.col(order_cols[0])
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_first"))
    return agg.select(*keys, "_first.*").select(*df.columns)


def distinct_by_docnum(records: DataFrame, order_cols=("term_pos", "arrival_seq")) -> DataFrame:
    """A2: first record per document_number in result order; NULL/'' numbers dropped."""
    valid = records.where(F.col("document_number").isNotNull() & (F.col("document_number") != ""))
    return first_per_key(valid, ["document_number"], list(order_cols))


def dedup_against_store(new: DataFrame, store_hashes: DataFrame, same_source: bool = True) -> DataFrame:
    """Left-anti equi-join on content_hash (per source when ``same_source``).

    The store side is only (source, content_hash); Spark broadcasts it when its
    measured size is under the broadcast threshold and sort-merges otherwise.
    """
    keys = ["source", "content_hash"] if same_source else ["content_hash"]
    return new.join(store_hashes.select(*keys), keys, "left_anti")   # duplicates on the right do not matter


def pre_dedup_hash(docs: DataFrame) -> DataFrame:
    """J2 key: the 'preliminary' hash of (source, source_url) through the C8 layout (off by default)."""
    return docs.withColumn("preliminary_hash", I.content_hash(
        F.col("source"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string"),
        F.array().cast("array<string>")))


def skip_seen_urls(docs: DataFrame, store: DataFrame) -> DataFrame:
    """J2 as it is meant: drop documents whose (source, url) a stored event of the source already has.

    Off by default in the pipelines; placed before any page is read.  Documents without a URL are kept.
    """
    key = lambda source, url: F.sha2(F.concat_ws("\x1f", source, url), 256)
    seen = store.select(key(F.col("source"), F.col("data.source_url")).alias("_seen")).where(F.col("data.source_url").isNotNull()).distinct()
    fresh = docs.join(seen, key(F.col("source"), F.col("source_url")) == F.col("_seen"), "left_anti")
    return fresh


def dedup_within_batch(docs: DataFrame, order_col: str = "arrival_seq", keys: list[str] | None = None) -> DataFrame:
    """First document per content_hash in arrival order wins (skew-safe ``min_by``)."""
    return first_per_key(docs, keys or ["content_hash"], [order_col])


def edge_upsert_ignore(new_edges: DataFrame, existing_edges: DataFrame | None = None, arrival: str = "match_rank") -> DataFrame:
    """ON CONFLICT (parent, related) DO NOTHING — a stored edge wins, then the new row that arrives first.

    ``arrival`` is the order of insertion (the match rank within a parent); the other columns break ties, so the
    result does not depend on the partitioning.
    """
    keys = ["parent_event_id", "related_event_id"]
    cols = [c for c in new_edges.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in [*[c for c in cols if c == arrival], *sorted(c for c in cols if c != arrival)]])
    out = (new_edges.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_b"))
           .select(*keys, "_b.*").select(*new_edges.columns))
    if existing_edges is not None:
        out = out.join(existing_edges.select(*keys), keys, "left_anti")
    return out


def _prefix_tokens(codes, least: float):
    """The codes of a sorted set of which one at least is shared by every set with an overlap of ``least`` or more."""
    toks = F.array_sort(F.array_distinct(F.transform(F.coalesce(codes, F.array().cast("array<string>")),
                                                     lambda c: F.coalesce(c, F.lit("\u0000null")))))
    n = F.size(toks)
    return F.slice(toks, 1, F.greatest(F.lit(0), n - F.ceil(n * F.lit(least)).cast("int") + 1))


def near_duplicates(new: DataFrame, existing: DataFrame, with_title: bool = True,
                    threshold: float = K.DUPLICATE_THRESHOLD) -> DataFrame:
    """J6 + C10 + W5: pairs with equal FR numbers and a similarity >= ``threshold`` (0.85).

    Without equal FR numbers the score is at most 0.6, so above that an equi-join on
    fr_document_number is lossless blocking; no all-pairs comparison is needed.  With them
    the code overlap must be >= (threshold - 0.7) / 0.3 (0.5 for 0.85); where that is not
    positive, all pairs of a number are scored.  Inputs have columns
    (id, fr_document_number, codes, title, publication_date).
    """
    a = new.where(F.col("fr_document_number").isNotNull() & (F.col("fr_document_number") != "")).select(
        F.col("id").alias("new_id"), "fr_document_number", F.col("codes").alias("a_codes"),
        F.col("title").alias("a_title"), F.col("publication_date").alias("a_date"))
    b = existing.select(F.col("id").alias("existing_id"), "fr_document_number", F.col("codes").alias("b_codes"),
                        F.col("title").alias("b_title"), F.col("publication_date").alias("b_date"))
    # A pair can reach the threshold only with overlap >= least, so both sides share one of the first
    # n - ceil(n * least) + 1 codes of each sorted token set (prefix filter): join on (number, token).
    least = (threshold - K.LINK_W_DOCNUM - K.LINK_W_TITLE - K.LINK_W_DATE) / K.LINK_W_HTS - 1e-9
    keys = ["fr_document_number"]
    if least > 0:
        keys.append("_tok")
        a = a.withColumn("_tok", F.explode(_prefix_tokens(F.col("a_codes"), least)))
        b = b.withColumn("_tok", F.explode(_prefix_tokens(F.col("b_codes"), least)))
    pairs = (a.join(b, keys).where(F.col("new_id") != F.col("existing_id"))
             .drop("_tok").dropDuplicates(["new_id", "existing_id"]))
    pairs = pairs.withColumn("overlap", dup_code_overlap(F.col("a_codes"), F.col("b_codes")))
    if with_title:
        # The UDF sees only titles that differ and whose length bound can still lift the pair to the threshold.
        la, lb = F.lower("a_title"), F.lower("b_title")
        has_t = F.coalesce((F.length("a_title") > 0) & (F.length("b_title") > 0), F.lit(False))
        best = doc_similarity(F.col("fr_document_number"), F.col("fr_document_number"), F.col("overlap"), ratio_upper_bound(la, lb), F.col("a_date"), F.col("b_date"))
        need = has_t & (la != lb) & (best >= threshold - 1e-9)
        ratio = F.when(la == lb, F.lit(1.0)).when(need, title_ratio(F.col("a_title"), F.col("b_title"), need)).otherwise(F.lit(0.0))
        pairs = pairs.withColumn("title_ratio", F.when(has_t, ratio))
    else:
        pairs = pairs.withColumn("title_ratio", F.lit(None).cast("double"))
    sim = doc_similarity(F.col("fr_document_number"), F.col("fr_document_number"), F.col("overlap"),
                         F.col("title_ratio"), F.col("a_date"), F.col("b_date"))
    return pairs.withColumn("similarity", sim).where(F.col("similarity") >= threshold).select(
        "new_id", "existing_id", "fr_document_number", "overlap", "similarity")


def rank_duplicates(dups: DataFrame) -> DataFrame:
    """Per new document, duplicates by similarity descending (stable on id)."""
    w = Window.partitionBy("new_id").orderBy(F.col("similarity").desc(), "existing_id")
    return dups.withColumn("dup_rank", F.row_number().over(w))


__all__ = ["distinct_by_docnum", "dedup_against_store", "pre_dedup_hash", "dedup_within_batch", "edge_upsert_ignore",
           "near_duplicates", "rank_duplicates", "jaccard"]
