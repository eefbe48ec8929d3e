"""SimHash document fingerprints and their search by permuted block tables, in DataFrame functions only.

Terms are a text's lower-cased words joined with the word after them (the last word stands alone).  A term's hash is
XXH64 of its first word (seed 42) continued over its second; its weight is its length in code points, at most 32, so
that rare long terms outvote pairs of function words.  Every occurrence votes with its weight for the set bits of its
hash and against the others; a fingerprint bit is 1 if the votes for it are more than half of all.

Votes are summed by a partially aggregated ``groupBy`` over exploded terms: two 32-bit counters share a long, which
holds for every text whose words Spark can split (more than 67 million terms would be needed to overflow).

Defined cases: null counts as the empty text; a text without words has fingerprint zero; rows that agree in ``doc_id``
and text are one document with as many result rows as it has rows; a null ``doc_id`` comes after all others in
descending order and has a fingerprint too; rows with one ``doc_id`` and different texts are ordered by the hash of the
text; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticespark.llm.common import SPACE, global_index, staged

BITS, MOST_WEIGHT = 64, 32
LANE = 0x0000000100000001  # the lowest bit of both 32-bit counters of a long


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine that the share of differing bits estimates, negative values as 0; equal fingerprints give 1."""
    return F.greatest(F.lit(0.0), F.cos(F.lit(3.141592653589793) * F.bit_count(a.bitwiseXOR(b)) / BITS))


def simhash(texts: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """``keys`` and ``fp`` (a long) of the texts of each key; a text without words is one term of weight 0 and gives 0."""
    clean = F.btrim(F.lower(text), F.lit(" \t\n\x0b\f\r"))
    words = texts.select(*keys, F.split(clean, SPACE).alias("_w"))
    terms = words.select(*keys, "_w", F.posexplode("_w").alias("_i", "_a")).withColumn("_b", F.expr("get(_w, _i + 1)"))
    votes = terms.select(
        *keys,
        F.xxhash64("_a", "_b").alias("_h"),
        F.least(F.lit(MOST_WEIGHT), F.length("_a") + F.coalesce(F.length("_b") + 1, F.lit(0))).cast("long").alias("_weight"),
    )
    sums = [F.sum(F.shiftrightunsigned("_h", k).bitwiseAND(F.lit(LANE)) * F.col("_weight")).alias(f"_s{k}") for k in range(32)]
    lanes = votes.groupBy(*keys).agg(F.sum("_weight").alias("_all"), *sums)
    low = 0xFFFFFFFF

    def bit(i: int) -> Column:
        count = F.col(f"_s{i}").bitwiseAND(F.lit(low)) if i < 32 else F.shiftrightunsigned(f"_s{i - 32}", 32)
        one = F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")
        return F.when(count * 2 > F.col("_all"), one).otherwise(F.lit(0).cast("long"))

    return lanes.select(*keys, reduce(Column.bitwiseOR, map(bit, range(BITS))).alias("fp"))


def rows(docs: DataFrame) -> DataFrame:
    """Every row with a key that is never null: ``no_id, id`` and the hash ``h`` of the text."""
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return whole.select(
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"),
        F.xxhash64("text").alias("h"),
        "text",
        F.length("text").cast("long").alias("n_chars"),
    )


def edited_pairs(docs: DataFrame) -> DataFrame:
    """``doc_id, h, text, n_chars, edited, next_id, next_h``: one row per row of ``docs``.

    ``edited`` is the text whose last third is replaced by the beginning of the next document's text, in descending
    order of ``doc_id``; the document after the last one is the first.
    """
    whole = rows(docs)
    ids = whole.groupBy("no_id", "id", "h").agg(F.max("n_chars").alias("n_chars"))
    order = [F.asc("no_id"), F.desc("id"), F.asc("h")]
    placed = staged(global_index(ids, order), "placed")
    n = placed.count()
    after = placed.select(((F.col("idx") + (n - 1)) % max(n, 1)).alias("idx"), F.col("no_id").alias("next_no_id"), F.col("id").alias("next_id"), F.col("h").alias("next_h"))
    pairs = staged(placed.join(after, "idx").drop("idx"), "pairs")
    third = F.floor(F.col("n_chars") / 3).cast("int")
    # The texts are shuffled once: both joins below read the same exchange of (no_id, id, h, text).
    texts = whole.select("no_id", "id", "h", "text")
    of_next = pairs.withColumnsRenamed({"no_id": "prev_no_id", "id": "prev_id", "h": "prev_h"}).withColumnsRenamed({"next_no_id": "no_id", "next_id": "id", "next_h": "h"})
    heads = texts.join(of_next, ["no_id", "id", "h"]).withColumnsRenamed({"no_id": "next_no_id", "id": "next_id", "h": "next_h"})
    heads = heads.withColumnsRenamed({"prev_no_id": "no_id", "prev_id": "id", "prev_h": "h"})
    heads = heads.groupBy("no_id", "id", "h", "n_chars", "next_no_id", "next_id", "next_h").agg(F.min(F.substring("text", F.lit(1), third)).alias("head"))
    both = texts.join(heads, ["no_id", "id", "h"])
    cut = F.substring("text", F.lit(1), (F.col("n_chars") - third).cast("int"))
    return both.withColumn("edited", F.concat(cut, "head")).drop("head")


def block_search(fps: DataFrame, queries: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """``query_fp, fp`` for all distinct fingerprints at most ``radius`` bits from a query's, each pair once.

    The bits are cut into ``blocks`` blocks.  Two fingerprints within the radius agree on at least ``blocks - radius``
    blocks, so one of the tables (one for each choice of that many blocks, moved to the front as the key) holds both.
    Equal fingerprints are one row here, so a group of copies is one entry.
    """
    edge = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [sum(((1 << edge[b + 1]) - 1) ^ ((1 << edge[b]) - 1) for b in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    masks = [m - (1 << 64) if m >> 63 else m for m in masks]

    def entries(df: DataFrame, name: str) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for t, m in enumerate(masks)])
        return df.select("fp").where("fp is not null").distinct().select(F.col("fp").alias(name), F.inline(keys))

    near = entries(fps, "fp").join(entries(queries, "query_fp"), ["t", "key"])
    return near.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("query_fp"))) <= radius).select("query_fp", "fp").distinct()


def fingerprint_report(docs: DataFrame, radius: int = 3, query_modulus: int = 100) -> DataFrame:
    """One row per document: fingerprints of its text and of its edited text, their likeness, and for each document
    whose id is divisible by ``query_modulus`` the number of other documents within ``radius`` bits (else null)."""
    key, after = ["no_id", "id", "h"], ["next_no_id", "next_id", "next_h"]
    both = edited_pairs(docs).withColumn("sha", F.sha2("edited", 256))
    first = F.struct(F.lit(False).alias("is_edit"), F.lit(None).cast("string").alias("sha"), F.col("text").alias("t"))
    second = F.struct(F.lit(True).alias("is_edit"), F.col("sha").alias("sha"), F.col("edited").alias("t"))
    texts = both.select(*key, *after, "n_chars", F.inline(F.array(first, second)))
    found = simhash(texts, "t", [*key, *after, "n_chars", "is_edit", "sha"]).groupBy(*key, *after, "n_chars").agg(
        F.max(F.when(~F.col("is_edit"), F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("is_edit"), F.col("fp"))).alias("edited_fp"),
        F.max("sha").alias("edited_sha256"),
    )
    found = staged(found, "fingerprints")
    next_fp = found.select(*[F.col(k).alias(n) for k, n in zip(key, after)], F.col("fp").alias("next_fp"))
    asked = found.where(~F.col("no_id") & (F.col("id") % query_modulus == 0)).select("fp")
    sizes = rows(docs).select(*key).join(found.select(*key, "fp"), key).groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    near = block_search(found, asked, radius).join(sizes, "fp").groupBy(F.col("query_fp").alias("fp")).agg((F.sum("n") - 1).alias("n_near"))
    report = found.join(next_fp, after).join(near, "fp", "left")
    # Each row of the input has its own result row.
    return rows(docs).select(*key).join(report, key).select(
        F.when(~F.col("no_id"), F.col("id")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        hex16(F.col("fp")).alias("fingerprint"),
        hex16(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(~F.col("no_id") & (F.col("id") % query_modulus == 0), F.coalesce("n_near", F.lit(0))).alias("n_near"),
    )
