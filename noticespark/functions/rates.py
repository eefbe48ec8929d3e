"""Duty-rate validation (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .text import strip_ws


def validate_rate(rate: Column) -> Column:
    """struct<valid, rate_type, normalized_value, errors>.

    Ordered tests: ad valorem 'n%' -> n/100; specific '$n per' / 'n/' -> n;
    cents 'n cents per' -> n/100; else an error.  'compound' is never produced.
    """
    r = strip_ws(rate)
    empty = rate.isNull() | (F.length(rate) == 0)
    adv = r.rlike(K.RATE_AD_VALOREM)
    spec = r.rlike(K.RATE_SPECIFIC)
    cents = r.rlike(K.RATE_CENTS)
    adv_v = F.regexp_extract(r, K.RATE_AD_VALOREM, 1).cast("double") / F.lit(100.0)
    spec_v = F.regexp_extract(r, K.RATE_SPECIFIC, 1).cast("double")
    cents_v = F.regexp_extract(r, K.RATE_CENTS, 1).cast("double") / F.lit(100.0)
    valid = ~empty & (adv | spec | cents)
    rtype = F.when(empty, F.lit(None)).when(adv | spec | cents, F.when(adv, F.lit("ad_valorem")).otherwise(F.lit("specific")))
    value = F.when(empty, F.lit(None)).when(adv, adv_v).when(spec, spec_v).when(cents, cents_v)
    errors = (
        F.when(empty, F.array(F.lit("Rate string is empty")))
        .when(~valid, F.array(F.concat(F.lit("Unrecognized rate format: "), rate)))
        .otherwise(F.array().cast("array<string>"))
    )
    return F.struct(
        F.coalesce(valid, F.lit(False)).alias("valid"),
        rtype.cast("string").alias("rate_type"),
        value.cast("double").alias("normalized_value"),
        errors.alias("errors"),
    )


def normalize_rate(rate: Column) -> Column:
    """The normalised value only."""
    return validate_rate(rate).getField("normalized_value")
