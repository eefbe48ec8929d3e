"""Cross-source linking: candidate join (J3 + W3), scoring (J4, J5, A6, D5, C11, C12, X14), ranking.

Input shape for both sides (the P7 link projection):
    id, source, title, publication_date (ISO string), fr_document_number, codes array<string>,
    ingestion_timestamp, ingest_seq
``ingestion_timestamp desc, ingest_seq desc, id`` is the "newest first" order.

The candidate predicate "other source AND (shares a code OR |date diff| < 30 days)"
would plan as a nested loop.  It is split into two equi-joins whose newest-k
lists are pre-cut before the join (top-k of a union is the top-k of the
per-branch top-k lists):

* code branch: store codes exploded, newest k per (code, source), then an
  equi-join on code;
* band branch: newest k per (publication date, source) — a table bounded by
  the number of distinct dates, not by the data — expanded to the 59 query
  dates it can serve, then an equi-join on date.

So no step holds more than k rows per key, and a hot code or a hot date never
becomes a quadratic group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.dates import date_proximity
from ..functions.similarity import (docnum_match, jaccard, link_confidence, matching_factors, ratio_upper_bound,
                                    relationship_type, title_ratio)

def _newest(id_col: str = "id"):
    return [F.col("ingestion_timestamp").desc(), F.col("ingest_seq").desc(), F.col(id_col)]


BAND = K.DATE_WINDOW_DAYS - 1   # |diff| < 30 days  <=>  |diff| <= 29 whole days


def linkable(docs: DataFrame) -> DataFrame:
    """a document links only with at least one code and a publication date."""
    return docs.where((F.size(F.col("codes")) > 0) & F.col("publication_date").isNotNull())


def newest_k(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The newest ``k`` rows of each key (planned as a limit per map task before the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(*_newest())
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def _newest_distinct(pairs: DataFrame, limit: int | None) -> DataFrame:
    """Distinct (new_id, id) pairs, newest ``limit`` per new_id, with their rank.

    A pair found twice has the same (timestamp, seq, id), so ``dense_rank`` gives
    both copies one rank; the later de-duplication runs on the same new_id
    partitioning, so one shuffle serves both steps.
    """
    w = Window.partitionBy("new_id").orderBy(*_newest())
    ranked = pairs.withColumn("_rank", F.dense_rank().over(w))
    if limit is not None:
        ranked = ranked.where(F.col("_rank") <= limit)
    return ranked.dropDuplicates(["new_id", "id"])


def _sides(new: DataFrame, store: DataFrame):
    n = linkable(new).select(F.col("id").alias("new_id"), F.col("source").alias("new_source"), "codes",
                             F.to_date("publication_date").alias("new_date"))
    s = store.select("id", "source", "ingestion_timestamp", "ingest_seq", "codes",
                     F.to_date("publication_date").alias("pub"))
    return n, s


def code_branch(new: DataFrame, store: DataFrame, limit: int | None = K.LINK_CANDIDATE_LIMIT) -> DataFrame:
    """F5 + F6: other-source store documents sharing a code; newest ``limit`` per new document.

    The store side is cut to the newest ``limit`` per (code, source) before the
    join (Spark plans the filtered row_number as a partial WindowGroupLimit, so a
    hot code contributes at most ``limit`` rows per map task to the shuffle).
    """
    n, s = _sides(new, store)
    s_codes = s.select("id", "source", "ingestion_timestamp", "ingest_seq", F.explode(F.array_distinct("codes")).alias("code"))
    if limit is not None:
        s_codes = newest_k(s_codes, ["code", "source"], limit)
    n_codes = n.select("new_id", "new_source", F.explode(F.array_distinct("codes")).alias("code"))
    by_code = (n_codes.join(s_codes, "code").where(F.col("source") != F.col("new_source"))
               .select("new_id", "new_source", "id", "ingestion_timestamp", "ingest_seq"))
    if limit is None:
        return by_code.dropDuplicates(["new_id", "id"])
    return _newest_distinct(by_code, limit).drop("_rank")


def band_branch(new: DataFrame, store: DataFrame, limit: int | None = K.LINK_CANDIDATE_LIMIT) -> DataFrame:
    """F5 + F7: other-source store documents published less than 30 days apart; newest ``limit`` each.

    Newest ``limit`` per (publication date, source) is a table bounded by the
    number of distinct dates; each row is expanded to the 59 query dates it can
    serve and equi-joined with the distinct (source, date) of the new documents.
    """
    n, s = _sides(new, store)
    s_dates = s.where(F.col("pub").isNotNull()).select("id", "source", "ingestion_timestamp", "ingest_seq", "pub")
    if limit is not None:
        s_dates = newest_k(s_dates, ["pub", "source"], limit)
    served = s_dates.select("id", "source", "ingestion_timestamp", "ingest_seq",
                            F.explode(F.sequence(F.date_sub("pub", BAND), F.date_add("pub", BAND))).alias("qdate"))
    qdates = n.where(F.col("new_date").isNotNull()).select("new_source", F.col("new_date").alias("qdate")).distinct()
    per_date = qdates.join(served, "qdate").where(F.col("source") != F.col("new_source"))
    if limit is not None:
        w = Window.partitionBy("new_source", "qdate").orderBy(*_newest())
        per_date = per_date.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= limit).drop("_r")
    return (n.select("new_id", "new_source", F.col("new_date").alias("qdate"))
            .join(per_date, ["new_source", "qdate"])
            .select("new_id", "new_source", "id", "ingestion_timestamp", "ingest_seq"))


def candidate_pairs(new: DataFrame, store: DataFrame, limit: int | None = K.LINK_CANDIDATE_LIMIT) -> DataFrame:
    """J3 + W3: per new document, the newest ``limit`` store documents of another source
    that share a code or were published less than 30 days apart.

    Returns (new_id, id, ingestion_timestamp, ingest_seq, cand_rank).  ``limit=None`` returns
    every candidate (no cut; still two equi-joins, no nested loop).
    """
    cands = _newest_distinct(code_branch(new, store, limit).unionByName(band_branch(new, store, limit)), limit)
    return cands.withColumnRenamed("_rank", "cand_rank").drop("new_source")


def score_pairs(pairs: DataFrame, new: DataFrame, store: DataFrame, with_title: bool = True,
                min_confidence: float | None = K.LINK_MIN_CONFIDENCE) -> DataFrame:
    """Score (new, store) pairs; keep confidence >= 0.5 (on the unrounded double).

    Docnum (J5), Jaccard (A6) and date (D5) parts are native.  A pair whose best
    possible title part cannot lift it to the threshold is dropped before the
    title UDF, and the UDF runs only where 2*min(len)/(sum len) > 0.7 (otherwise
    the ratio cannot pass the 0.7 gate).  Link text is title + ' ' (the link
    projection carries no abstract).
    """
    a = new.select(F.col("id").alias("new_id"), F.col("source").alias("new_source"), F.col("title").alias("a_title"),
                   F.col("publication_date").alias("a_date"), F.col("fr_document_number").alias("a_fr"),
                   F.col("codes").alias("a_codes"))
    b = store.select("id", "source", F.col("title").alias("b_title"), F.col("publication_date").alias("b_date"),
                     F.col("fr_document_number").alias("b_fr"), F.col("codes").alias("b_codes"), "ingestion_timestamp", "ingest_seq")
    p = pairs.select("new_id", "id").join(a, "new_id").join(b, "id").where(F.col("new_source") != F.col("source"))
    ta = F.lower(F.concat(F.coalesce("a_title", F.lit("")), F.lit(" ")))
    tb = F.lower(F.concat(F.coalesce("b_title", F.lit("")), F.lit(" ")))
    p = p.select("*",
                 docnum_match(F.col("a_fr"), F.col("b_fr"), ta, tb).alias("dn"),
                 jaccard(F.col("a_codes"), F.col("b_codes")).alias("j"),
                 date_proximity(F.col("a_date"), F.col("b_date")).alias("dp"))
    base = link_confidence(F.col("dn"), F.col("j"), F.lit(0.0), F.col("dp"))
    if min_confidence is not None:
        p = p.where(base + F.lit(K.LINK_W_TITLE) >= F.lit(min_confidence - 1e-9))
    la, lb = F.lower(F.coalesce("a_title", F.lit(""))), F.lower(F.coalesce("b_title", F.lit("")))
    if with_title:
        need = (ratio_upper_bound(la, lb) > K.LINK_TITLE_THRESHOLD - 1e-9) & (F.length(la) > 0) & (F.length(lb) > 0)
        p = p.withColumn("title_ratio", title_ratio(F.col("a_title"), F.col("b_title"), need))
    else:
        p = p.withColumn("title_ratio", F.lit(0.0))
    conf = link_confidence(F.col("dn"), F.col("j"), F.col("title_ratio"), F.col("dp"))
    p = p.withColumn("confidence_raw", conf)
    if min_confidence is not None:
        p = p.where(F.col("confidence_raw") >= min_confidence)
    return p.select(
        F.col("new_id").alias("parent_event_id"), F.col("id").alias("related_event_id"), F.col("source").alias("related_source"),
        relationship_type(F.col("dn"), F.col("j"), F.col("title_ratio")).alias("relationship_type"),
        F.col("confidence_raw"), F.bround("confidence_raw", 2).cast("decimal(3,2)").alias("confidence"),
        matching_factors(F.col("dn"), F.col("j"), F.col("title_ratio"), F.col("dp")).alias("matching_factors"),
        "dn", "j", "dp", "title_ratio", "ingestion_timestamp", "ingest_seq",
    )


def link_documents(new: DataFrame, store: DataFrame, limit: int | None = None, with_title: bool = True, few: bool = False) -> DataFrame:
    """J3 -> W3 -> J4 -> W4: edges from new documents to store documents of other sources.

    Without a limit every store document is a candidate: only pairs of ``reachable_pairs`` can
    reach 0.5, and without the title part only pairs with a number match can.
    """
    if limit is not None:
        pairs = candidate_pairs(new, store, limit)
    elif with_title:
        pairs = reachable_pairs(new, store, few)
    else:
        pairs = docnum_pairs(new, store)
    edges = score_pairs(pairs, new, store, with_title=with_title)
    return rank_matches(edges)


def rank_matches(edges: DataFrame) -> DataFrame:
    """Per parent, matches by the rounded confidence descending; equal ones stay in candidate order (newest first)."""
    w = Window.partitionBy("parent_event_id").orderBy(F.col("confidence").desc(), *_newest("related_event_id"))
    return edges.withColumn("match_rank", F.row_number().over(w)).drop("ingestion_timestamp", "ingest_seq")


def shares_code(new: DataFrame, store: DataFrame) -> DataFrame:
    """F5 + F6: (id, shares) per linkable new document: does a document of another source carry one of its codes?

    The store side is its distinct (code, source) pairs, whatever the number of documents behind a code.
    """
    n = linkable(new).select("id", "source", F.explode(F.array_distinct("codes")).alias("code"))
    s = store.select(F.col("source").alias("o_source"), F.explode("codes").alias("o_code")).distinct()
    hit = n.join(s, (F.col("code") == F.col("o_code")) & (F.col("source") != F.col("o_source")), "left_semi").select("id").distinct()
    return linkable(new).select("id").join(hit.withColumn("_hit", F.lit(True)), "id", "left").select(
        "id", F.coalesce("_hit", F.lit(False)).alias("shares"))


def band_counts(new: DataFrame, store: DataFrame) -> DataFrame:
    """F5 + F7: (id, near) per linkable new document: documents of other sources published less than 30 days apart.

    Exact without pairs: counts per (date, source) are spread to the 59 dates they serve.
    """
    per_day = store.where(F.col("publication_date").isNotNull()).groupBy(
        F.to_date("publication_date").alias("pub"), F.col("source").alias("o_source")).agg(F.count(F.lit(1)).alias("n"))
    served = per_day.select("o_source", "n", F.explode(F.sequence(F.date_sub("pub", BAND), F.date_add("pub", BAND))).alias("day"))
    served = served.groupBy("day", "o_source").agg(F.sum("n").alias("n"))
    n = linkable(new).select("id", "source", F.to_date("publication_date").alias("day"))
    asked = n.select("source", "day").distinct()
    near = asked.join(served, "day").where(F.col("o_source") != F.col("source")).groupBy("source", "day").agg(F.sum("n").alias("near"))
    return n.join(near, ["source", "day"], "left").select("id", F.coalesce("near", F.lit(0)).cast("long").alias("near"))


def other_source_counts(new: DataFrame, store: DataFrame) -> DataFrame:
    """per store source, the number of (linkable new, store) pairs of different sources, from counts per source."""
    n = linkable(new).groupBy("source").agg(F.count(F.lit(1)).alias("n_new"))
    s = store.groupBy("source").agg(F.count(F.lit(1)).alias("n_store"))
    everyone = Window.partitionBy(F.lit(0))   # one row per source
    both = s.join(n, "source", "full").withColumn("others", F.coalesce(F.sum("n_new").over(everyone), F.lit(0)) - F.coalesce("n_new", F.lit(0)))
    return both.select("source", (F.col("n_store") * F.col("others")).alias("pairs")).where("pairs > 0")


#: Most characters of a number on either side of its first dash that make its signature.
SIGNATURE = 8


def docnum_pairs(new: DataFrame, store: DataFrame) -> DataFrame:
    """J5 as joins: equal FR numbers (equi-join) union number-inside-title (signature join, then ``contains``).

    The signature of a number is its first dash with up to ``SIGNATURE`` characters of the pieces on either side of it.
    A title that holds the number has that dash too, with pieces that end and begin alike, so the keys of a title are those
    around its own dashes, one for each pair of side lengths that some number of the other side has.  Numbers without a dash are looked up
    among the title's substrings of their length.  Both are exact; candidates are verified on the whole number.
    """
    def side(df, pre):
        return df.select(F.col("id").alias(f"{pre}id"), F.col("source").alias(f"{pre}source"),
                         F.lower(F.col("fr_document_number")).alias(f"{pre}fr"),
                         F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "))).alias(f"{pre}text"))

    a, b = side(linkable(new), "a_"), side(store, "b_")
    eq = (a.where(F.col("a_fr").isNotNull() & (F.col("a_fr") != ""))
          .join(b, F.col("a_fr") == F.col("b_fr")).select(F.col("a_id").alias("new_id"), F.col("b_id").alias("id"),
                                                         "a_source", "b_source"))

    def around(before, after, lengths):
        """The key of a dash: ``lengths`` characters of the pieces before and after it."""
        ends = F.when(lengths.getField("l") == 0, F.lit("")).otherwise(F.substring(before, F.length(before) - lengths.getField("l") + 1, lengths.getField("l")))
        return F.concat(ends, F.lit("-"), F.substring(after, F.lit(1), lengths.getField("r")))

    def of_number(number):
        pieces = F.split(number, "-", -1)
        before, after = F.get(pieces, F.lit(0)), F.get(pieces, F.lit(1))
        sides = F.struct(F.least(F.length(before), F.lit(SIGNATURE)).alias("l"), F.least(F.length(after), F.lit(SIGNATURE)).alias("r"))
        return sides, around(before, after, sides)

    def shapes(numbered, n):
        """The shapes of a side's numbers are a handful of integers: a scalar subquery of the same plan, nothing on the driver."""
        fr = F.col(f"{n}_fr")
        dashed = fr.contains("-")
        return numbered.where(fr != "").agg(F.struct(
            F.sort_array(F.collect_set(F.when(~dashed, F.length(fr)))).alias("lengths"),
            F.sort_array(F.collect_set(F.when(dashed, of_number(fr)[0]))).alias("sides")).alias("shapes")).scalar()

    def keys_of_text(text):
        pieces = F.split(text, "-", -1)
        dashes = F.zip_with(F.slice(pieces, F.lit(1), F.size(pieces) - 1), F.slice(pieces, F.lit(2), F.size(pieces) - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
        around_dashes = F.flatten(F.transform(F.col("_shapes.sides"), lambda s: F.transform(
            F.filter(dashes, lambda d: (F.length(d.getField("p")) >= s.getField("l")) & (F.length(d.getField("q")) >= s.getField("r"))),
            lambda d: around(d.getField("p"), d.getField("q"), s))))
        substrings = F.flatten(F.transform(F.col("_shapes.lengths"), lambda n: F.transform(
            F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - n + 1)), lambda st: F.substring(text, st, n))))
        return F.array_distinct(F.concat(around_dashes, substrings))

    def mentions(numbered, n, titled, t):
        """Pairs whose title (of ``titled``) holds the number (of ``numbered``)."""
        fr, text = F.col(f"{n}_fr"), F.col(f"{t}_text")
        key = F.when(fr.contains("-"), of_number(fr)[1]).otherwise(fr)
        titles = titled.withColumn("_shapes", shapes(numbered, n)).select(f"{t}_id", f"{t}_source", text, F.explode_outer(keys_of_text(text)).alias("key"))
        found = numbered.where(fr.isNotNull() & (fr != "")).select(f"{n}_id", f"{n}_source", fr, key.alias("key")).join(titles, "key")
        return found.where(F.contains(text, fr)).select(F.col("a_id").alias("new_id"), F.col("b_id").alias("id"), "a_source", "b_source")

    return (eq.unionByName(mentions(a, "a", b, "b")).unionByName(mentions(b, "b", a, "a")).where(F.col("a_source") != F.col("b_source"))
            .select("new_id", "id").distinct())


#: Codes are ordered by how often the codes of their hash bucket occur; the levels of all buckets are one value of 4 KB.
CODE_BUCKETS = 4096


def _codes(codes: Column) -> Column:
    """The distinct codes of a document, without missing ones."""
    return F.array_distinct(F.filter(codes, lambda c: c.isNotNull() & (c != "")))


def _code_bucket(code: Column) -> Column:
    return F.pmod(F.xxhash64(code), F.lit(CODE_BUCKETS)).cast("int")


def _code_levels(*sides: DataFrame) -> Column:
    """A byte per bucket, growing with the logarithm of the number of its codes in ``sides``: a scalar subquery of the same plan."""
    spark = sides[0].sparkSession
    counts = spark.range(CODE_BUCKETS).select(F.col("id").cast("int").alias("b"), F.lit(0).cast("long").alias("n"))
    for side in sides:
        counts = counts.unionByName(side.select(F.explode(_codes(F.col("codes"))).alias("tok")).groupBy(_code_bucket(F.col("tok")).alias("b")).agg(F.count(F.lit(1)).alias("n")))
    level = F.lpad(F.hex(F.least(F.lit(255), F.floor(F.log2(F.sum("n") + 1) * 4)).cast("long")), 2, "0")
    per_bucket = counts.groupBy("b").agg(level.alias("level"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("b", "level"))), lambda x: x.getField("level"))
    return per_bucket.agg(F.unhex(F.array_join(in_order, "")).alias("levels")).scalar()


def _rare_first_prefix(codes: Column, levels: Column) -> Column:
    """The prefix of a set of codes in a global order that has the codes of rare buckets first.

    Jaccard >= 2/3 between A and B requires them to share one of the first
    n - ceil(2n/3) + 1 codes of each set under any fixed global order (prefix
    filtering, exact).  Ordering by frequency puts a hot code last, so it
    only joins for documents whose sets are almost entirely that code; with the
    frequencies of hash buckets every document finds its prefix by itself, without a join.
    """
    ranked = F.sort_array(F.transform(codes, lambda c: F.struct(F.substring(levels, _code_bucket(c) + 1, F.lit(1)).alias("level"), c.alias("tok"))))
    n = F.size(codes)
    keep = n - F.ceil(n * F.lit(2) / F.lit(3)).cast("int") + 1
    return F.transform(F.slice(ranked, F.lit(1), F.when(n > 0, keep).otherwise(F.lit(0))), lambda x: x.getField("tok"))


#: Most new documents whose prefix codes are broadcast, to leave out the store's documents without one: some 30 MB.
FEW_DOCUMENTS = 150_000


def reachable_pairs(new: DataFrame, store: DataFrame, few: bool = False) -> DataFrame:
    """All (new_id, id) of different sources with a number match, or with Jaccard >= 2/3 and equal titles or
    publication dates less than 30 days apart.  Only these can reach a confidence of 0.5.

    Without a number match 0.3 j + 0.2 r + 0.1 d >= 0.5 needs j >= 2/3 and r > 0.7, and r < 1 needs d > 0.  So the
    prefix codes are joined with a second key, the title or the 30-day bucket of the date (a new document asks for its
    own bucket and both neighbours): a code that a third of all documents carry is split by date and by title.

    ``few``: the caller has counted at most ``FEW_DOCUMENTS`` new documents.
    """
    levels = _code_levels(linkable(new), store)

    def keyed(docs: DataFrame, pre: str, buckets: tuple[int, ...]) -> DataFrame:
        """A row per prefix code and second key, with what decides whether a pair that meets is reachable."""
        title, day = F.lower(F.coalesce("title", F.lit(""))), F.to_date("publication_date")
        facts = docs.select(F.col("id").alias(f"{pre}id"), F.col("source").alias(f"{pre}source"), title.alias("title"), day.alias(f"{pre}day"),
                            _codes(F.col("codes")).alias(f"{pre}codes"), levels.alias("_levels"))
        bucket = F.floor(F.datediff(f"{pre}day", F.lit("1970-01-01").cast("date")) / (BAND + 1))
        keys = F.array(F.when(F.col("title") != "", F.concat(F.lit("t"), "title")), *[F.concat(F.lit("d"), (bucket + i).cast("string")) for i in buckets])
        # The outer form, since the other makes its array twice (to leave out empty ones first); the join drops missing keys.
        facts = facts.select(f"{pre}id", f"{pre}source", f"{pre}day", f"{pre}codes", keys.alias("keys"),
                             F.explode_outer(_rare_first_prefix(F.col(f"{pre}codes"), F.col("_levels"))).alias("tok"))
        return facts.select(f"{pre}id", f"{pre}source", f"{pre}day", f"{pre}codes", "tok", F.explode_outer("keys").alias("key"))

    asked, held = keyed(linkable(new), "a_", (-1, 0, 1)), keyed(store, "b_", (0,))
    if few:
        held = held.join(F.broadcast(asked.select("tok").distinct()), "tok", "left_semi")
    # Sizes are guessed from files before the keys are listed, so neither side may be broadcast on that guess.
    met = asked.join(held.hint("merge"), ["tok", "key"]).where(F.col("a_source") != F.col("b_source"))
    met = met.where(F.col("key").startswith("t") | (F.abs(F.datediff("a_day", "b_day")) <= BAND))
    by_code = met.where(jaccard(F.col("a_codes"), F.col("b_codes")) >= F.lit(2 / 3 - 1e-9)).select(F.col("a_id").alias("new_id"), F.col("b_id").alias("id"))
    return by_code.unionByName(docnum_pairs(new, store)).distinct()
