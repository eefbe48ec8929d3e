"""Confidence score parts (Column -> Column); double arithmetic in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def _truthy(c: Column) -> Column:
    return F.coalesce((F.length(c.cast("string")) > 0), F.lit(False))


def required_fields_score(*fields: Column) -> Column:
    """Share of truthy required fields."""
    present = None
    for f in fields:
        x = _truthy(f).cast("int")
        present = x if present is None else present + x
    return present / F.lit(float(len(fields)))


def hts_share(products: Column) -> Column:
    """Validated / all products, 0 when none."""
    n = F.coalesce(F.size(products), F.lit(0))
    ok = F.size(F.filter(products, lambda p: F.coalesce(p.getField("hts_code_validated"), F.lit(False))))
    return F.when(n > 0, ok / n.cast("double")).otherwise(F.lit(0.0))


def date_score(validation: Column) -> Column:
    """0 if invalid, else max(0, 1 - 0.1 * warnings)."""
    pen = F.size(validation.getField("warnings")) * F.lit(0.1)
    return F.when(~F.coalesce(validation.getField("valid"), F.lit(False)), F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.lit(1.0) - pen))


def date_score_basic(pub: Column, eff: Column) -> Column:
    """C5d: 1 - .5 (no publication date) - .3 (no effective date)."""
    s = F.lit(1.0)
    s = F.when(~_truthy(pub), s - F.lit(0.5)).otherwise(s)
    s = F.when(~_truthy(eff), s - F.lit(0.3)).otherwise(s)
    return F.greatest(F.lit(0.0), s)


def rate_score(rate_original: Column, rate_normalized: Column) -> Column:
    """C5e: 0 without a rate string, 1 when normalised, else 0.5."""
    return F.when(~_truthy(rate_original), F.lit(0.0)).when(rate_normalized.isNotNull(), F.lit(1.0)).otherwise(F.lit(0.5))


def quality_score(ocr_used: Column, method: Column, n_related: Column) -> Column:
    """C5f: 1 - .3 ocr - .2 fallback + .1 related, clamped to [0, 1]."""
    s = F.lit(1.0)
    s = F.when(F.coalesce(ocr_used, F.lit(False)), s - F.lit(0.3)).otherwise(s)
    s = F.when(F.coalesce(method == "fallback", F.lit(False)), s - F.lit(0.2)).otherwise(s)
    s = F.when(F.coalesce(n_related, F.lit(0)) > 0, s + F.lit(0.1)).otherwise(s)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), s))


def confidence(required: Column, hts: Column, date: Column, rate: Column, quality: Column) -> Column:
    """clamp01(((((0 + r*.25) + h*.25) + d*.15) + rt*.15) + q*.20)."""
    s = F.lit(0.0) + required * F.lit(K.W_REQUIRED)
    s = s + hts * F.lit(K.W_HTS)
    s = s + date * F.lit(K.W_DATE)
    s = s + rate * F.lit(K.W_RATE)
    s = s + quality * F.lit(K.W_QUALITY)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), s))


def quality_label(score: Column) -> Column:
    """Excellent / good / fair / poor / very_poor."""
    out = None
    for thr, label in K.QUALITY_LABELS:
        out = F.when(score >= thr, F.lit(label)) if out is None else out.when(score >= thr, F.lit(label))
    return out.otherwise(F.lit(K.QUALITY_LABEL_ELSE))


def to_decimal_score(score: Column) -> Column:
    """Display column decimal(3,2); thresholds always use the unrounded double."""
    return score.cast("decimal(3,2)")
