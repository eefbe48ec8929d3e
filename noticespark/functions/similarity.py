"""Pairwise similarity parts.

Everything is a built-in expression except ``title_ratio``: the
Ratcliff/Obershelp ratio of Python's ``difflib`` (asymmetric, with autojunk)
has no JVM equivalent, so it is the one Arrow-batched pandas UDF.  Callers
prune pairs natively first so only pairs whose title can still change the
outcome reach it.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from . import constants as K


#: From this length of the second text on, difflib leaves out popular characters.
POPULAR_FROM = 200


def _matched(a: str, b: str) -> int:
    """Characters in difflib's matching blocks of two texts without popular characters.

    The longest common block (of equal ones the first in ``a``, then in ``b``), then the parts left and right of it.  A
    block that begins at ``i`` is longer than the longest so far only if its first ``size + 1`` characters occur in ``b``.
    """
    total, parts = 0, [(a, b)]
    while parts:
        x, y = parts.pop()
        at = size = 0
        for i in range(len(x)):
            if i + size >= len(x):
                break
            while i + size < len(x) and x[i:i + size + 1] in y:
                at, size = i, size + 1
        if size:
            total += size
            to = y.find(x[at:at + size])
            if at and to:
                parts.append((x[:at], y[:to]))
            if at + size < len(x) and to + size < len(y):
                parts.append((x[at + size:], y[to + size:]))
    return total


def ratio_of(a: str, b: str) -> float:
    """``difflib.SequenceMatcher(None, a, b).ratio()``."""
    if len(b) >= POPULAR_FROM:
        return difflib.SequenceMatcher(None, a, b).ratio()
    return 2.0 * _matched(a, b) / (len(a) + len(b)) if a or b else 1.0


@pandas_udf(DoubleType())
def _ratio_udf(a: pd.Series, b: pd.Series, need: pd.Series) -> pd.Series:
    out = []
    for x, y, n in zip(a, b, need):
        if not n or x is None or y is None or x == "" or y == "":
            out.append(0.0)
        else:
            out.append(ratio_of(x, y))
    return pd.Series(out, dtype="float64")


def title_ratio(current_title: Column, other_title: Column, need: Column | None = None) -> Column:
    """Difflib ratio of the lower-cased titles, (current, other) order; 0 if either empty.

    ``need`` (boolean) lets callers skip rows whose ratio cannot matter without
    splitting the plan: those rows return 0.0 without calling difflib.
    """
    flag = F.lit(True) if need is None else F.coalesce(need, F.lit(False))
    return _ratio_udf(F.lower(F.coalesce(current_title, F.lit(""))), F.lower(F.coalesce(other_title, F.lit(""))), flag)


def ratio_upper_bound(a: Column, b: Column) -> Column:
    """2*min(len)/(len_a+len_b): no ratio can exceed it."""
    la, lb = F.length(a), F.length(b)
    return F.when((la + lb) > 0, F.lit(2.0) * F.least(la, lb) / (la + lb)).otherwise(F.lit(0.0))


def jaccard(codes_a: Column, codes_b: Column) -> Column:
    """|A n B| / |A u B| over non-empty code sets, 0 if either is empty."""
    a = F.array_distinct(F.filter(F.coalesce(codes_a, F.array().cast("array<string>")), lambda c: c.isNotNull() & (c != "")))
    b = F.array_distinct(F.filter(F.coalesce(codes_b, F.array().cast("array<string>")), lambda c: c.isNotNull() & (c != "")))
    inter = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0) & (union > 0), inter / union.cast("double")).otherwise(F.lit(0.0))


def docnum_match(fr_a: Column, fr_b: Column, text_a: Column, text_b: Column) -> Column:
    """Equal FR numbers, or one number inside the other's lower-cased title+' '+abstract."""
    eq = fr_a.isNotNull() & (fr_a != "") & fr_b.isNotNull() & (fr_a == fr_b)
    a_in_b = fr_a.isNotNull() & (fr_a != "") & F.contains(F.lower(text_b), F.lower(fr_a))
    b_in_a = fr_b.isNotNull() & (fr_b != "") & F.contains(F.lower(text_a), F.lower(fr_b))
    return F.coalesce(eq | a_in_b | b_in_a, F.lit(False))


def link_confidence(dn: Column, j: Column, ratio: Column, date_prox: Column) -> Column:
    """C11 (unrounded): .4 docnum + .3 J + .2 ratio (only if > .7) + .1 date, added in that order."""
    s = F.lit(0.0)
    s = F.when(dn, s + F.lit(K.LINK_W_DOCNUM)).otherwise(s)
    s = F.when(j > 0, s + j * F.lit(K.LINK_W_HTS)).otherwise(s)
    s = F.when(ratio > K.LINK_TITLE_THRESHOLD, s + ratio * F.lit(K.LINK_W_TITLE)).otherwise(s)
    s = F.when(date_prox > 0, s + date_prox * F.lit(K.LINK_W_DATE)).otherwise(s)
    return s


def relationship_type(dn: Column, j: Column, ratio: Column) -> Column:
    """References > related_products > similar_topic > NULL."""
    return (F.when(dn, F.lit("references")).when(j > 0, F.lit("related_products"))
            .when(ratio > K.LINK_TITLE_THRESHOLD, F.lit("similar_topic")).otherwise(F.lit(None).cast("string")))


def matching_factors(dn: Column, j: Column, ratio: Column, date_prox: Column) -> Column:
    """C12 factors, in the order document_number, hts_codes, title, date_proximity."""
    return F.filter(F.array(
        F.when(dn, F.lit("document_number")),
        F.when(j > 0, F.lit("hts_codes")),
        F.when(ratio > K.LINK_TITLE_THRESHOLD, F.lit("title")),
        F.when(date_prox > 0, F.lit("date_proximity")),
    ), lambda x: x.isNotNull())


def dup_code_overlap(codes_a: Column, codes_b: Column) -> Column:
    """C10 code part: products' codes as sets (a missing code counts as one NULL member)."""
    a = F.array_distinct(F.coalesce(codes_a, F.array().cast("array<string>")))
    b = F.array_distinct(F.coalesce(codes_b, F.array().cast("array<string>")))
    inter = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), inter / union.cast("double")).otherwise(F.lit(None).cast("double"))


def doc_similarity(fr_a: Column, fr_b: Column, overlap: Column, ratio: Column, date_a: Column, date_b: Column) -> Column:
    """.4 docnum-equal + .3 overlap + .2 title ratio + .1 equal dates (NULL == NULL counts)."""
    s = F.lit(0.0)
    s = F.when(fr_a.isNotNull() & (fr_a != "") & fr_b.isNotNull() & (fr_a == fr_b), s + F.lit(K.LINK_W_DOCNUM)).otherwise(s)
    s = F.when(overlap.isNotNull(), s + F.lit(K.LINK_W_HTS) * overlap).otherwise(s)
    s = F.when(ratio.isNotNull(), s + F.lit(K.LINK_W_TITLE) * ratio).otherwise(s)
    s = F.when(date_a.eqNullSafe(date_b), s + F.lit(K.LINK_W_DATE)).otherwise(s)
    return s
