"""HTS commodity codes: extraction, normalisation, validation (Column -> Column).

All built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .text import found_in_text


def _lit_re(p: str) -> Column:
    return F.lit(p)


def html_hts_codes(text: Column) -> Column:
    """Sorted distinct dotted-10 codes found in text (the pipelines' extractor)."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), _lit_re(K.HTS_DOTTED10), 0)
    return F.array_sort(F.array_distinct(found))


def page_hts_codes(html: Column) -> Column:
    """X4 on a page: ``html_hts_codes`` of its ``html_code_text``."""
    return F.array_sort(found_in_text(html, K.HTS_DOTTED10, "0-9"))


def normalize_hts(code: Column) -> Column:
    """Strip non-digits; 10 digits -> XXXX.XX.XXXX, 6 -> XXXX.XX.0000, else NULL."""
    d = F.regexp_replace(code, r"[^0-9]", "")
    n = F.length(d)
    return (
        F.when(code.rlike(r"\A[0-9]{4}\.[0-9]{2}\.[0-9]{4}\z"), code)   # as it should be
        .when(n == 10, F.concat(F.substring(d, 1, 4), F.lit("."), F.substring(d, 5, 2), F.lit("."), F.substring(d, 7, 4)))
        .when(n == 6, F.concat(F.substring(d, 1, 4), F.lit("."), F.substring(d, 5, 2), F.lit(".0000")))
    )


def _normalize_hts_expr(c: Column) -> Column:
    d = F.regexp_replace(c, r"[^0-9]", "")
    n = F.length(d)
    return (
        F.when(n == 10, F.concat(F.substring(d, 1, 4), F.lit("."), F.substring(d, 5, 2), F.lit("."), F.substring(d, 7, 4)))
        .when(n == 6, F.concat(F.substring(d, 1, 4), F.lit("."), F.substring(d, 5, 2), F.lit(".0000")))
    )


def extract_hts_codes(text: Column) -> Column:
    """Dotted-10, dotted-6 and bare-10 matches, normalised, sorted set.

    The dotted-6 pattern also fires inside a dotted-10 code (kept on purpose).
    """
    t = F.coalesce(text, F.lit(""))
    raw = F.concat(
        F.regexp_extract_all(t, _lit_re(K.HTS_DOTTED10), 0),
        F.regexp_extract_all(t, _lit_re(K.HTS_DOTTED6), 0),
        F.regexp_extract_all(t, _lit_re(K.HTS_BARE10), 0),
    )
    normed = F.transform(raw, _normalize_hts_expr)
    return F.array_sort(F.array_distinct(F.filter(normed, lambda c: c.isNotNull())))


def hts_format_ok(code: Column) -> Column:
    return F.coalesce(code.rlike(K.HTS_VALID_FORMAT), F.lit(False))


def validate_hts(code: Column) -> Column:
    """struct<code, valid, errors, chapter, heading, subheading>."""
    fmt = hts_format_ok(code)
    chapter = F.substring(code, 1, 2).cast("int")
    chap_ok = (chapter >= 1) & (chapter <= 99)
    valid = fmt & chap_ok
    errors = (
        F.when(~fmt, F.array(F.lit("Invalid format. Expected: XXXX.XX.XXXX")))
        .when(~chap_ok, F.array(F.concat(F.lit("Invalid chapter: "), chapter.cast("string"), F.lit(". Must be 01-99"))))
        .otherwise(F.array().cast("array<string>"))
    )
    return F.struct(
        code.alias("code"),
        valid.alias("valid"),
        errors.alias("errors"),
        F.when(valid, chapter).alias("chapter"),
        F.when(valid, F.substring(code, 1, 4)).alias("heading"),
        F.when(valid, F.substring(code, 1, 7)).alias("subheading"),
    )


def hts_valid(code: Column) -> Column:
    """Boolean part of C1 only (cheap; used inside products)."""
    chapter = F.substring(code, 1, 2).cast("int")
    return hts_format_ok(code) & F.coalesce((chapter >= 1) & (chapter <= 99), F.lit(False))


def chapter_info(code: Column) -> Column:
    """struct<chapter, description> or NULL for a malformed code.

    The six-entry chapter map is a literal map (a broadcast-free lookup).
    """
    m = F.create_map(*[x for k, v in K.CHAPTER_DESCRIPTIONS.items() for x in (F.lit(k), F.lit(v))])
    chapter = F.substring(code, 1, 2).cast("int")
    return F.when(
        hts_format_ok(code),
        F.struct(chapter.alias("chapter"), F.coalesce(F.try_element_at(m, chapter), F.lit("Unknown")).alias("description")),
    )


def first5_sorted_codes(codes: Column) -> Column:
    """First five of the sorted 7-char code prefixes (not distinct)."""
    pref = F.transform(F.filter(codes, lambda c: c.isNotNull() & (c != "")), lambda c: F.substring(c, 1, 7))
    return F.slice(F.array_sort(pref), 1, 5)


def merge_codes(*arrays: Column) -> Column:
    """A3: set union of code lists (NULL lists count as empty), sorted."""
    parts = [F.coalesce(a, F.array().cast("array<string>")) for a in arrays]
    return F.array_sort(F.array_distinct(F.flatten(F.array(*parts))))
