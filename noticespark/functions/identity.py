"""Content identity: canonical JSON text, sha256 content hash, md5 fuzzy hash.

The canonical text is the default Python ``json.dumps(..., sort_keys=True)``
layout: keys in alphabetical order, separators ``", "`` and ``": "``, ``null``
for missing values and ASCII-only escaping (``\\uXXXX`` with surrogate pairs).
Built from expressions so hashing stays JVM-side; the per-character escape path
runs only for strings that actually need escaping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: JSON short escapes for code units below 0x20 and the two specials.
_SHORT_ESCAPES = {0x22: '\\"', 0x5C: "\\\\", 0x0A: "\\n", 0x0D: "\\r", 0x09: "\\t", 0x08: "\\b", 0x0C: "\\f"}


def _escape_unit(hex4: Column) -> Column:
    v = F.conv(hex4, 16, 10).cast("int")
    e = None
    for code, rep in _SHORT_ESCAPES.items():
        e = F.when(v == code, F.lit(rep)) if e is None else e.when(v == code, F.lit(rep))
    return (
        e.when(v < 0x20, F.concat(F.lit("\\u"), F.lower(hex4)))
        .when(v < 0x7F, F.chr(v))
        .otherwise(F.concat(F.lit("\\u"), F.lower(hex4)))
    )


def json_escape_body(s: Column) -> Column:
    """Escaped string body (without quotes), exactly like ``json.dumps`` with ensure_ascii."""
    units = F.regexp_extract_all(F.hex(F.encode(s, "UTF-16BE")), F.lit("([0-9A-F]{4})"), 1)
    slow = F.array_join(F.transform(units, _escape_unit), "")
    return F.when(s.rlike(r'[^\x20-\x7e]|["\\]'), slow).otherwise(s)


def json_string(s: Column) -> Column:
    """A JSON value: quoted escaped string or ``null``."""
    return F.when(s.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), json_escape_body(s), F.lit('"')))


def json_string_list(arr: Column) -> Column:
    return F.concat(F.lit("["), F.coalesce(F.array_join(F.transform(arr, json_string), ", "), F.lit("")), F.lit("]"))


def canonical_content(source: Column, document_type: Column, publication_date: Column,
                      fr_document_number: Column, hts_codes: Column) -> Column:
    """C8 text: the five hashed fields; codes sorted, NULL/'' codes dropped."""
    codes = F.array_sort(F.filter(F.coalesce(hts_codes, F.array().cast("array<string>")),
                                  lambda c: c.isNotNull() & (c != "")))
    return F.concat(
        F.lit('{"document_type": '), json_string(document_type),
        F.lit(', "fr_document_number": '), json_string(fr_document_number),
        F.lit(', "hts_codes": '), json_string_list(codes),
        F.lit(', "publication_date": '), json_string(publication_date),
        F.lit(', "source": '), json_string(source),
        F.lit("}"),
    )


def content_hash(source: Column, document_type: Column, publication_date: Column,
                 fr_document_number: Column, hts_codes: Column) -> Column:
    """sha256 hex of the canonical content."""
    return F.sha2(canonical_content(source, document_type, publication_date, fr_document_number, hts_codes), 256)


def fuzzy_content(source: Column, publication_date: Column, hts_codes: Column) -> Column:
    codes = F.slice(F.array_sort(F.transform(
        F.filter(F.coalesce(hts_codes, F.array().cast("array<string>")), lambda c: c.isNotNull() & (c != "")),
        lambda c: F.substring(c, 1, 7))), 1, 5)
    return F.concat(
        F.lit('{"hts_codes": '), json_string_list(codes),
        F.lit(', "publication_date": '), json_string(publication_date),
        F.lit(', "source": '), json_string(source),
        F.lit("}"),
    )


def fuzzy_hash(source: Column, publication_date: Column, hts_codes: Column) -> Column:
    """md5 hex of source, publication date and the first five sorted 7-char codes."""
    return F.md5(fuzzy_content(source, publication_date, hts_codes))


def event_id(content_hash_col: Column) -> Column:
    """Deterministic UUID-shaped id derived from the content hash (replaces uuid4)."""
    h = F.substring(content_hash_col, 1, 32)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))
