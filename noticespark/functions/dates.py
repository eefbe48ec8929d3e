"""Date parsing, normalisation and validation (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .text import bound, collapse_ws


def parse_date(s: Column) -> Column:
    """First of the five accepted formats that parses -> DATE, else NULL.

    Whitespace is collapsed first; compact dates need exactly eight digits (documented deviation).
    """
    def parsed(t: Column) -> Column:
        tries = []
        for fmt in K.DATE_FORMATS:
            # A format is tried where its separator occurs: a failed parse raises inside, which costs more than a parse.
            fits = t.rlike(r"^[0-9]{8}$") if fmt == "yyyyMMdd" else F.contains(t, F.lit(next(c for c in "-/," if c in fmt)))
            tries.append(F.when(fits, F.to_date(F.try_to_timestamp(t, F.lit(fmt)))))
        return F.coalesce(*tries)

    slow = F.when(F.coalesce(F.length(s), F.lit(0)) > 0, bound(collapse_ws(s), parsed))
    # Dates with all their digits need no format: they are read by a cast.
    digits = lambda at, n: F.substring(s, at, n)
    iso = lambda y, m, d: F.concat_ws("-", digits(y, 4), digits(m, 2), digits(d, 2)).try_cast("date")
    return (F.when(s.rlike(ISO), s.try_cast("date")).when(s.rlike(r"\A(?!0000)[0-9]{8}\z"), iso(1, 5, 7))
            .when(s.rlike(r"\A[0-9]{2}/[0-9]{2}/(?!0000)[0-9]{4}\z"), iso(7, 1, 4)).otherwise(slow))


#: A date as ``normalize_date`` writes it; the year 0 is left to the formats.
ISO = r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def normalize_date(s: Column) -> Column:
    """ISO yyyy-MM-dd string or NULL."""
    return F.when(s.rlike(ISO), s.try_cast("date").cast("string")).otherwise(F.date_format(parse_date(s), "yyyy-MM-dd"))


def rfc822_date(s: Column) -> Column:
    """D3: 'Tue, 04 Mar 2025 10:00:00 +0500' -> '2025-03-04' in the message's own offset."""
    m = F.regexp_extract(s, r"^[A-Za-z]{3}, ([0-9]{1,2} [A-Za-z]{3} [0-9]{4}) [0-9]{2}:[0-9]{2}:[0-9]{2} [+-][0-9]{4}$", 1)
    return F.date_format(F.to_date(F.try_to_timestamp(F.nullif(m, F.lit("")), F.lit("d MMM yyyy"))), "yyyy-MM-dd")


def validate_dates(pub: Column, eff: Column, exp: Column) -> Column:
    """struct<valid, errors, warnings> over three date strings."""
    return bound(F.struct(parse_date(pub).alias("p"), parse_date(eff).alias("e"), parse_date(exp).alias("x")), _date_checks)


def _date_checks(d: Column) -> Column:
    p, e, x = (d.getField(c) for c in "pex")
    missing = p.isNull()
    eff_before = p.isNotNull() & e.isNotNull() & (e < p)
    exp_not_after = e.isNotNull() & x.isNotNull() & (x <= e)
    errors = F.filter(
        F.array(
            F.when(missing, F.lit("Missing or invalid publication_date")),
            F.when(eff_before, F.concat(F.lit("Effective date ("), F.date_format(e, "yyyy-MM-dd"),
                                        F.lit(") before publication date ("), F.date_format(p, "yyyy-MM-dd"), F.lit(")"))),
        ),
        lambda m: m.isNotNull(),
    )
    warnings = F.filter(
        F.array(
            F.when(exp_not_after, F.concat(F.lit("Expiration date ("), F.date_format(x, "yyyy-MM-dd"),
                                           F.lit(") not after effective date ("), F.date_format(e, "yyyy-MM-dd"), F.lit(")"))),
        ),
        lambda m: m.isNotNull(),
    )
    return F.struct((~(missing | eff_before)).alias("valid"), errors.alias("errors"), warnings.alias("warnings"))


def date_proximity(d1: Column, d2: Column) -> Column:
    """ISO strings only (exact yyyy-MM-dd); |days| <= 30 -> 1 - days/30 else 0."""
    def iso(d: Column) -> Column:
        return F.when(d.rlike(ISO), d.try_cast("date")).when(
            d.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.to_date(F.try_to_timestamp(d, F.lit("yyyy-M-d"))))

    days = F.abs(F.datediff(iso(d1), iso(d2)))
    return F.when(days.isNotNull() & (days <= K.DATE_WINDOW_DAYS), F.lit(1.0) - days / F.lit(float(K.DATE_WINDOW_DAYS))).otherwise(F.lit(0.0))
