"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document has an exponential key -ln(u) / w: u in (0, 1) comes from a seeded hash of its id and text, w is its
quality weight.  Within a source, documents in ascending key order are a weighted sample without replacement; the
source's word budget is spent on complete epochs first (every document once), the rest on documents in key order until
the prefix sum of sizes reaches it.  The document at the border is taken in part, so the budget is met to the word.

No task sees a whole source: sizes are summed per (source, key bucket), a source's prefix runs over its at most
``BUCKETS`` bucket sums, and only documents of the one bucket that holds the border are ordered.  Each source then has
one border row, and every document decides by comparing its key with it, so reruns and lost executors change nothing.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and share ``share`` times all sizes; a target
stops at ``most`` times its source's size and the excess is shared again until none is above.

Defined cases: null and empty texts have size 0 and are taken 0 times; the null source is a source; rows equal in key,
id and text that meet the border share what is left equally, rounded down; a null ``doc_id`` counts as a value of its
own; an empty table gives an empty result; other columns are ignored (``mixed`` passes them through).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticespark.llm.common import global_index, masked, staged

WEIGHTS, SHARE, MOST, SEED = (5, 2, 1), 1.5, 2.0, 7
BUCKETS = 4_096
_PUNCT = bytes(i for i in range(33, 127) if not chr(i).isalnum())


@F.pandas_udf(T.StructType().add("size", T.LongType()).add("quality", T.DoubleType()))
def _measured(text: pd.Series) -> pd.DataFrame:
    """Words of the whole text, and a quality weight from 0.1 to 1: the share of its bytes that are not punctuation or space."""
    size, quality = np.zeros(len(text), np.int64), np.full(len(text), 0.1)
    for i, t in enumerate(text):
        if t:
            data = t.encode("utf-8", "surrogatepass")
            size[i] = len(data.split())
            quality[i] = max(0.1, len(data.translate(None, _PUNCT + b" \t\n\x0b\x0c\r")) / len(data))
    return pd.DataFrame({"size": size, "quality": quality})


def keyed(docs: DataFrame, seed: int = SEED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``_size``, the sampling key ``_key``, the tie ``_tie`` and the key's ``_bucket``."""
    measured = docs.withColumn("_m", _measured(F.col(text)))
    tie = F.xxhash64(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.coalesce(text, F.lit("")))
    u = (F.shiftrightunsigned(F.col("_tie"), 11).cast("double") + 0.5) / float(1 << 53)
    bucket = F.least(F.lit(BUCKETS - 1), F.floor((1 - F.exp(-F.col("_key") / 2)) * BUCKETS)).cast("int")  # rises with the key
    return measured.withColumn("_tie", tie).select(*docs.columns, F.col("_m.size").alias("_size"), "_tie", (-F.log(u) / F.col("_m.quality")).alias("_key")).withColumn("_bucket", bucket)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sizes(source, source_size)`` -> the same with ``target``; one row per source, two sums to the driver a round."""
    order = [F.asc_nulls_last("source")]
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    weighed = staged(global_index(sizes, order).withColumn("weight", F.get(wheel, (F.col("idx") % len(weights)).cast("int"))), "sources")
    cap = F.col("source_size") * most
    total = share * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:  # the level only rises, so the set of sources at their limit only grows
        at_cap = cap <= F.col("weight") * level
        r = weighed.agg(
            F.sum(F.when(at_cap, cap)).alias("capped"),
            F.count(F.when(at_cap, 1)).alias("n"),
            F.sum(F.when(~at_cap, F.col("weight"))).alias("open"),
        ).first()
        if r["n"] == full or not r["open"]:
            break
        full, level = r["n"], (total - (r["capped"] or 0.0)) / r["open"]
    return weighed.select("source", "source_size", F.least(cap, F.col("weight") * level).alias("target"))


def border(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``source, source_size, target, epochs, b_key, b_tie, b_take``: what each source takes, one row each.

    ``rows`` are keyed documents.  Documents before (b_key, b_tie) are taken once more, one at it gives ``b_take`` words.
    """
    plan = sources.withColumn("budget", F.round("target").cast("long"))
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    plan = staged(plan.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size")).withColumn("_s", F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))), "plan")
    narrow = rows.where("_size > 0").select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("_s"), "_bucket", "_key", "_tie", "_size")
    sums = narrow.groupBy("_s", "_bucket").agg(F.sum("_size").alias("words"))
    before = F.coalesce(F.sum("words").over(W.partitionBy("_s").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    hit = sums.withColumn("before", before).join(plan.where("rest > 0").select("_s", "rest"), "_s")
    hit = staged(hit.where("before < rest and rest <= before + words").select("_s", "_bucket", (F.col("rest") - F.col("before")).alias("left")), "border")
    ordered = narrow.join(hit, ["_s", "_bucket"]).groupBy("_s", "left", "_key", "_tie").agg(F.sum("_size").alias("words"), F.count(F.lit(1)).alias("n"))
    upto = F.sum("words").over(W.partitionBy("_s").orderBy("_key", "_tie"))
    at = ordered.withColumn("upto", upto).where("left <= upto and left > upto - words")
    at = at.select("_s", F.col("_key").alias("b_key"), F.col("_tie").alias("b_tie"), F.expr("(left - (upto - words)) div n").alias("b_take"))
    return plan.join(at, "_s", "left").drop("_s", "rest", "budget")


def _taken() -> Column:
    """Words that the mix takes of a document beside its source's border."""
    before = (F.col("_key") < F.col("b_key")) | ((F.col("_key") == F.col("b_key")) & (F.col("_tie") < F.col("b_tie")))
    more = F.when(before, F.col("_size")).when((F.col("_key") == F.col("b_key")) & (F.col("_tie") == F.col("b_tie")), F.col("b_take")).otherwise(F.lit(0))
    return F.when(F.col("_size") > 0, F.col("epochs") * F.col("_size") + more).otherwise(F.lit(0)).cast("long")


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``."""
    rows = staged(keyed(docs.select("doc_id", "source", "text"), seed).drop("text"), "keyed")
    plan = staged(border(rows, targets(rows.groupBy("source").agg(F.sum("_size").alias("source_size")))), "borders")
    both = rows.join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    return both.select("doc_id", F.col("_size").alias("size"), "source_size", "target", _taken().alias("taken"))


def _first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word: n separators (the first may be empty) and n words."""
    word = "[^\\x20\\x09-\\x0D]+"
    total = lambda parts: F.aggregate(F.transform(F.slice(parts, 1, n.cast("int")), F.length), F.lit(0), lambda a, b: a + b)
    return F.substring(text, F.lit(1), total(F.regexp_extract_all(text, F.lit(word), F.lit(0))) + total(F.split(text, word, -1)))


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row for each time a document is taken, a last part cut at a word's end."""
    plain, at = masked(docs)
    rows = keyed(plain, seed, at["doc_id"], at["text"])
    narrow = staged(rows.select(F.col(at["source"]).alias("source"), "_size", "_key", "_tie", "_bucket"), "keyed")
    plan = staged(border(narrow, targets(narrow.groupBy("source").agg(F.sum("_size").alias("source_size")))), "borders")
    both = rows.join(plan.withColumnRenamed("source", "_source"), F.col(at["source"]).eqNullSafe(F.col("_source")))
    both = both.withColumn("_taken", _taken()).where("_taken > 0")
    both = both.withColumn("_part", F.expr("_taken % _size")).withColumn("_times", F.expr("cast(_taken div _size + if(_taken % _size > 0, 1, 0) as int)"))
    each = both.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    text = F.col(at["text"])
    cut = F.when((F.col("_i") == F.col("_times")) & (F.col("_part") > 0), _first_words(text, F.col("_part"))).otherwise(text)
    return each.select(*[(cut if name == "text" else F.col(c)).alias(name) for name, c in at.items()])
