"""Text, regex and HTML expressions (Column -> Column).

HTML handling has no DOM parser: markup is found by regular expressions, divs in divs by a
fold over the tags; tables, their nesting and their omitted end tags by patterns and a small
stack in an Arrow-batched UDF (a fold of nested expressions took 3 ms a page).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Sequence
from html.entities import name2codepoint

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, StringType

from . import constants as K

#: A tag starts with a letter, '/', '!' or '?'; any other '<' is text.
TAG = r"(?s)<[a-zA-Z/!?][^>]*>"

DROPPED_SUBTREES = ["script", "style", "nav", "header", "footer"]


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` evaluated once, however often ``f`` uses it (a lambda variable is not expanded)."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def collapse_ws(s: Column) -> Column:
    """``' '.join(s.split())``."""
    return F.trim(F.regexp_replace(s, K.WS_RUN, " "))


#: The characters of ``K.WS``, one by one.
_WS = "".join(c for c in map(chr, range(0x10000)) if c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85" or unicodedata.category(c)[0] == "Z")


def strip_ws(s: Column) -> Column:
    return F.btrim(s, F.lit(_WS))


def _decode_entity(e: Column) -> Column:
    """One piece of text; ``&name;``, ``&#n;`` and ``&#xh;`` become their character, anything else stays."""
    # A map is searched from its start: the frequent names come first.
    first = [n for n in ("amp", "nbsp", "lt", "gt", "quot", "copy") if n in name2codepoint]
    order = first + sorted(n for n in name2codepoint if n not in first)
    names = F.create_map(*[F.lit(x) for n in order for x in (f"&{n};", chr(name2codepoint[n]))], F.lit("&apos;"), F.lit("'"))
    digits = F.when(e.rlike("^&#[0-9]{1,7};$"), F.conv(F.regexp_extract(e, "([0-9]+)", 1), 10, 16)).when(
        e.rlike("^&#[xX][0-9a-fA-F]{1,6};$"), F.regexp_extract(e, "[xX]([0-9a-fA-F]+)", 1))
    point = F.conv(digits, 16, 10).cast("int")
    known = (point > 0) & (point < 0x110000) & ~point.between(0xD800, 0xDFFF)
    char = F.when(known, F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32"))
    return F.when(~e.startswith("&"), e).otherwise(F.coalesce(F.try_element_at(names, e), char, e))


#: Entities that most texts hold at most, replaced without taking a text apart; the ampersand's comes last, so nothing is decoded twice.
_COMMON_ENTITIES = ("nbsp", "lt", "gt", "quot", "copy", "amp")
_OTHER_ENTITY = rf"&(?!(?:{'|'.join(_COMMON_ENTITIES)});)#?[a-zA-Z0-9]+;"


def decode_entities(s: Column) -> Column:
    """Named (the standard library's table) and numeric character references; texts without '&' are left alone."""
    def decoded(v: Column) -> Column:
        pieces = F.regexp_extract_all(v, F.lit("&#?[a-zA-Z0-9]+;|[^&]+|&"), 0)
        common = v
        for n in _COMMON_ENTITIES:
            common = F.replace(common, F.lit(f"&{n};"), F.lit(chr(name2codepoint[n])))
        return F.when(~F.contains(v, F.lit("&")), v).when(v.rlike(_OTHER_ENTITY), F.array_join(F.transform(pieces, _decode_entity), "")).otherwise(common)

    return bound(s, decoded)


#: The first letters of the dropped subtrees, in both cases: other tags are passed over by their first letter.
_DROPPED_FIRST = "".join(sorted({c for n in DROPPED_SUBTREES for c in (n[0], n[0].upper())}))


def _drop_markup(html: Column) -> Column:
    h = bound(html, lambda v: F.when(F.contains(v, F.lit("<!--")), F.regexp_replace(v, r"(?s)<!--.*?-->", " ")).otherwise(v))
    h = bound(h, lambda v: F.when(F.contains(v, F.lit("<!")), F.regexp_replace(v, r"(?is)<!DOCTYPE[^>]*>", " ")).otherwise(v))
    return F.regexp_replace(h, rf"<(?=[{_DROPPED_FIRST}])(?is:({'|'.join(DROPPED_SUBTREES)})\b[^>]*>.*?</\1\s*>)", " ")


def strip_tags_text(fragment: Column) -> Column:
    """get_text(separator=' ', strip=True) of a fragment, whitespace collapsed."""
    return collapse_ws(decode_entities(F.regexp_replace(fragment, TAG, " ")))


def joined_text(fragment: Column) -> Column:
    """get_text(strip=True) of a fragment: every text node stripped, joined without a separator."""
    def joined(v: Column) -> Column:
        nodes = F.transform(F.split(v, TAG, -1), lambda x: strip_ws(decode_entities(x)))
        return F.when(F.contains(v, F.lit("<")), F.array_join(nodes, "")).otherwise(strip_ws(decode_entities(v)))

    return bound(fragment, joined)


def html_text(html: Column) -> Column:
    """Drop script/style/nav/header/footer subtrees, strip tags, decode, collapse."""
    return strip_tags_text(_drop_markup(F.coalesce(html, F.lit(""))))


def html_code_text(html: Column) -> Column:
    """Text for code extraction only: like ``html_text`` without collapsing (a whitespace run is one boundary either way)."""
    return decode_entities(F.regexp_replace(_drop_markup(F.coalesce(html, F.lit(""))), TAG, " "))


#: What a pass over a page without comments skips: dropped subtrees, tags, and entities that are no part of a word.
_SKIPPED = (rf"<(?=[{_DROPPED_FIRST}])"
            rf"(?is:({'|'.join(DROPPED_SUBTREES)})\b[^>]*>[^<]*+(?:<(?!/\1\s*>)[^<]*+)*+</\1\s*>)"
            rf"|<[a-zA-Z/!?][^<>]*>|&(?:{'|'.join(_COMMON_ENTITIES)});")


def found_in_text(html: Column, pattern: str, first: str) -> Column:
    """The distinct strings that ``pattern`` finds in ``html_code_text``, in order, the page being read once.

    Every string starts with a character of the class ``first``; the pattern has no group, takes neither '<' nor '&', and sees
    a boundary at a tag as at a blank.  Where a tag holds a '<' (found as '<') or an entity may be part of a word (found as
    '&'), the page is stripped step by step instead.
    """
    unsure = "<(?=[a-zA-Z/!?][^<>]*<)|&(?=#?[a-zA-Z0-9]+;)"
    searched = rf"(?=[<&{first}])(?:{_SKIPPED}|({pattern}|{unsure}))"
    h = F.coalesce(html, F.lit(""))
    h = F.when(F.contains(h, F.lit("<!--")), F.regexp_replace(h, r"(?s)<!--.*?-->", " ")).otherwise(h)
    # Only a document type at the very start is known to stand outside all subtrees.
    h = bound(h, lambda v: F.when(F.locate("<!", v, 2) > 0, F.regexp_replace(v, r"(?is)<!DOCTYPE[^>]*>", " ")).otherwise(v))

    def strings(v: Column) -> Column:
        plain = F.regexp_extract_all(decode_entities(F.regexp_replace(_drop_markup(html), TAG, " ")), F.lit(pattern), 0)
        return F.when(F.array_contains(v, "<") | F.array_contains(v, "&"), F.array_distinct(plain)).otherwise(F.array_remove(v, ""))

    return bound(F.array_distinct(F.regexp_extract_all(h, F.lit(searched), 2)), strings)


# Tags of tables: for each, the elements whose end a start tag implies while they are innermost, and a rank: an end tag
# is ignored where an open element of higher rank stands between it and its start tag.
_ENDS_BEFORE = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "tbody": ("td", "th", "tr", "thead", "tbody", "tfoot"),
                "tfoot": ("td", "th", "tr", "thead", "tbody"), "thead": (), "table": ()}
_RANK = {"td": 1, "th": 1, "tr": 2, "thead": 3, "tbody": 3, "tfoot": 3, "table": 4}
_TABLE_NAME = r"(?=[tT])(?i:table|thead|tbody|tfoot|tr|td|th)\b"
_TABLE_TAG = rf"</?+{_TABLE_NAME}[^>]*>"
_TAG_NAME = re.compile("[a-zA-Z]+")
_TABLES = ArrayType(ArrayType(ArrayType(StringType())))


def _table_nodes(tags: Sequence[str]) -> list[tuple[str, int, int, int]]:
    """All table elements of a page in document order: ``(name, at, end, size)``.

    A start tag first ends the innermost elements whose end it implies; an end tag ends everything up to its start tag; the
    end of the page ends the rest.  An element spans the tags ``at`` .. ``end`` - 1; the ``size`` elements within it are the
    next nodes.
    """
    nodes, stack = [], []   # the stack holds numbers of open elements

    def close(keep: int, end: int) -> None:
        for i in stack[keep:]:
            name, at, *_ = nodes[i]
            nodes[i] = (name, at, end, len(nodes) - i - 1)
        del stack[keep:]

    for at, tag in enumerate(tags):
        name = _TAG_NAME.search(tag).group().lower()
        keep = len(stack)
        if tag.startswith("</"):
            while keep and nodes[stack[keep - 1]][0] != name and _RANK[nodes[stack[keep - 1]][0]] <= _RANK[name]:
                keep -= 1
            if keep and nodes[stack[keep - 1]][0] == name:
                close(keep - 1, at)
        else:
            while keep and nodes[stack[keep - 1]][0] in _ENDS_BEFORE[name]:
                keep -= 1
            close(keep, at)
            stack.append(len(nodes))
            nodes.append((name, at, at, 0))
    close(0, len(tags))
    return nodes


def _page_tables(tags: Sequence[str], texts: Sequence[str]) -> list[list[list[str]]]:
    """Tables, rows and cells of one page; ``texts`` holds the text after each tag."""
    nodes = _table_nodes(tags)

    def rows(first: int, size: int) -> list[list[str]]:
        found = []
        for i in range(first + 1, first + 1 + size):
            if nodes[i][0] == "tr":
                inner = nodes[i + 1:i + 1 + nodes[i][3]]
                found.append(["".join(texts[at:end]) for name, at, end, _ in inner if name in ("td", "th")])
        return [r for r in found if r]

    tables = [rows(i, n[3]) for i, n in enumerate(nodes) if n[0] == "table"]
    return [t for t in tables if t]


_BY_NAME = {f"&{n};": chr(c) for n, c in name2codepoint.items()} | {"&apos;": "'"}
_ENTITY_IN, _TAG_IN = re.compile("&#?[a-zA-Z0-9]+;"), re.compile(TAG)
_COMMENT_IN, _DOCTYPE_IN, _TABLE_TAG_IN = re.compile(r"(?s)<!--.*?-->"), re.compile(r"(?i)<!DOCTYPE[^>]*>"), re.compile(f"({_TABLE_TAG})")
_DROPPED_IN = re.compile("(?s)" + "|".join(rf"<{n}\b[^>]*>.*?</{n}[ \t\n\x0b\f\r]*>" for n in ("".join(f"[{c}{c.upper()}]" for c in x) for x in DROPPED_SUBTREES)))


def _character(entity: re.Match) -> str:
    """What ``decode_entities`` makes of one reference."""
    e = entity.group()
    if e in _BY_NAME:
        return _BY_NAME[e]
    digits = re.fullmatch(r"&#(?:([0-9]{1,7})|[xX]([0-9a-fA-F]{1,6}));", e)
    point = int(digits[1] or digits[2], 10 if digits[1] else 16) if digits else 0
    return chr(point) if 0 < point < 0x110000 and not 0xD800 <= point <= 0xDFFF else e


def _node(text: str) -> str:
    return (_ENTITY_IN.sub(_character, text) if "&" in text else text).strip(_WS)


def _tables_in(page: str) -> list[list[list[str]]]:
    """The tables of one page: dropped subtrees out, then the text after each table tag, node by node."""
    body = _DROPPED_IN.sub(" ", _DOCTYPE_IN.sub(" ", _COMMENT_IN.sub(" ", page)))
    parts = _TABLE_TAG_IN.split(body)
    return _page_tables(parts[1::2], ["".join(map(_node, _TAG_IN.split(p))) if "<" in p else _node(p) for p in parts[2::2]])


@arrow_udf(_TABLES)
def _tables_udf(pages: pa.Array) -> pa.Array:
    return pa.array([_tables_in(p) if p else [] for p in pages.to_pylist()], pa.list_(pa.list_(pa.list_(pa.string()))))


def html_tables(html: Column) -> Column:
    """array<array<array<string>>>: every table, its rows and the text of their cells, in document order.

    Nested tables count as the tree has them: a table's rows and a row's cells include those of the tables within, a cell's
    text includes theirs, and each nested table follows as a table of its own.  Omitted end tags of cells, rows and sections
    are implied.  Rows without cells and tables without rows are left out.  Pages with a table are read in an Arrow-batched
    UDF, with the patterns of the expressions (a fifth of the time of a dozen expressions over each page and its pieces).
    """
    return _tables_udf(F.when(html.rlike("<[tT](?i:able)\\b"), html).otherwise(F.lit("")))


def main_content_article(html: Column) -> Column:
    """X3 (article variant): text of the first <article>, '' when absent."""
    art = F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<article\b[^>]*>(.*?)</article\s*>", 1)
    inner = _drop_markup(art)
    return strip_tags_text(inner)


_DIV = r"(?is)<(?:div\b[^>]*|/div\s*)>"


def _div_text(html: Column, opening: str) -> Column:
    """Text of the first div whose start tag matches ``opening``, up to its own end tag; NULL without one.

    The end is found by nesting depth over the div tags that follow; an unclosed div reaches to the end.
    """
    def step(acc, tag):
        deeper = F.struct((acc.getField("depth") + F.when(tag.startswith("</"), -1).otherwise(1)).alias("depth"), (acc.getField("n") + 1).alias("n"))
        return F.when(acc.getField("depth") == 0, acc).otherwise(deeper)

    def inner(rest: Column) -> Column:
        walked = F.aggregate(F.regexp_extract_all(rest, F.lit(_DIV), 0), F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n")), step)
        pieces = F.split(rest, _DIV, -1)
        return bound(F.struct(walked.alias("w"), pieces.alias("p")), lambda v: strip_tags_text(F.array_join(F.slice(
            v.getField("p"), F.lit(1), F.when(v.getField("w").getField("depth") == 0, v.getField("w").getField("n")).otherwise(F.size(v.getField("p")))), " ")))

    # The start tag and the rest of the page in one match; '' stands for no match, since a match has the start tag.
    found = F.regexp_extract(html, f"(?is){opening}.*$", 0)
    return bound(found, lambda m: F.when(m != "", inner(F.regexp_replace(m, r"^<[^>]*>", ""))))


def _div_class(name: str) -> str:
    return rf"<div\b[^>]*\bclass\s*=\s*[\"'](?:[^\"']*\s)?{name}(?:\s[^\"']*)?[\"'][^>]*>"


def main_content_ustr(html: Column) -> Column:
    """X3 (USTR): first div.field-item, else first article, else ''."""
    h = F.coalesce(html, F.lit(""))
    return F.coalesce(_div_text(h, _div_class("field-item")), main_content_article(h))


def main_content_cbp(html: Column) -> Column:
    """X3 (CBP): first div.bulletin-content, else div#content, else ''."""
    h = F.coalesce(html, F.lit(""))
    by_id = r"<div\b[^>]*\bid\s*=\s*[\"']?content[\"']?(?:\s[^>]*)?>"
    return F.coalesce(_div_text(h, _div_class("bulletin-content")), _div_text(h, by_id), F.lit(""))


_LINK = r"""<a\b[^>]*?\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>"""


def anchors(html: Column) -> Column:
    """S5 helper: array<struct<href, text>> of all <a href> (quoted either way or bare) in document order."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(f"(?is){_LINK}.*?</a\\s*>"), 0)

    def one(x):
        href = F.concat(*[F.regexp_extract(x, f"(?is)^{_LINK}", i) for i in (1, 2, 3)])
        return F.struct(decode_entities(href).alias("href"), joined_text(F.regexp_extract(x, r"(?is)^<a\b[^>]*>(.*)</a\s*>$", 1)).alias("text"))

    return F.transform(found, one)


def resolve_url(href: Column, base_url: str) -> Column:
    """P4: '/path' -> base_url + '/path'; anything else unchanged."""
    return F.when(href.startswith("/"), F.concat(F.lit(base_url), href)).otherwise(href)


def url_tail(url: Column) -> Column:
    """Last '/' segment."""
    return F.element_at(F.split(url, "/"), -1)


def csms_number(title: Column) -> Column:
    """First CSMS number (case-insensitive) or NULL."""
    return F.nullif(F.regexp_extract(title, K.CSMS_NUMBER, 1), F.lit(""))


def _first_pattern(text: Column, patterns: list[str]) -> Column:
    return bound(F.coalesce(text, F.lit("")), lambda t: F.coalesce(*[F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for p in patterns]))


def effective_date_html(text: Column) -> Column:
    """X11: first of two patterns that hits."""
    return _first_pattern(text, K.EFFECTIVE_DATE_HTML)


def effective_date_cbp(text: Column) -> Column:
    """The CBP message patterns."""
    return _first_pattern(text, K.EFFECTIVE_DATE_CBP)


def normalize_text(s: Column) -> Column:
    """Collapse whitespace, keep word chars, whitespace and - . , ; : ( ) [ ] /, strip; NULL -> ''."""
    given = F.coalesce(s, F.lit(""))
    t = F.regexp_replace(collapse_ws(given), r"[^\p{L}\p{N}_" + K.WS_CHARS + r"\-.,;:()\[\]/]", "")
    return F.when(given.rlike(K.NORMAL_TEXT), given).otherwise(strip_ws(t))


def extract_countries(text: Column) -> Column:
    """Distinct two-capital-letter words that are common trade country codes (sorted)."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?<![\p{L}\p{N}_])([A-Z]{2})(?![\p{L}\p{N}_])"), 1)
    common = F.array(*[F.lit(c) for c in K.COMMON_COUNTRY_CODES])
    return F.array_sort(F.array_intersect(found, common))


def clean_cells(tables: Column) -> Column:
    """Strip every cell, NULL -> ''."""
    return F.transform(tables, lambda t: F.transform(t, lambda r: F.transform(r, lambda c: F.coalesce(strip_ws(c), F.lit("")))))


_MENTIONS = "array<struct<rate_text:string,value:string,context:string,start:int>>"


def rate_mentions(text: Column) -> Column:
    """array<struct<rate_text, value, context, start>> in pattern order.

    The text is searched once for every pattern whose sign it holds; matches are then located one after the other, so
    context is a plain substring.  The value is the number that a match begins with.
    """
    def mentions(t: Column) -> Column:
        return F.concat(*[F.when(F.contains(t, F.lit(sign)), _of_pattern(t, p)).otherwise(F.array().cast(_MENTIONS)) for p, sign in zip(K.RATE_PATTERNS, K.RATE_SIGNS)])

    return bound(F.coalesce(text, F.lit("")), mentions)


def _of_pattern(t: Column, pattern: str) -> Column:
    """A match is where its characters first occur after the match before: the pattern would have found an earlier place."""
    def of_matches(m: Column) -> Column:
        end = lambda after, x: F.position(x, t, after + 1) - 1 + F.length(x)
        ends = F.aggregate(m, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(end(F.element_at(acc, -1), x))))
        ended = F.arrays_zip(m.alias("m"), F.slice(ends, F.lit(2), F.size(m)).alias("e"))
        return F.transform(ended, lambda z: _mention(t, z.getField("m"), z.getField("e") - F.length(z.getField("m")), F.regexp_extract(z.getField("m"), r"[0-9]+(?:\.[0-9]+)?", 0)))

    return bound(F.regexp_extract_all(t, F.lit(pattern), 0), of_matches)


def _mention(t, m, start0, value):
    """One match and up to ``RATE_CONTEXT_CHARS`` characters on either side."""
    cs = F.greatest(F.lit(0), start0 - K.RATE_CONTEXT_CHARS)
    ce = F.least(F.length(t), start0 + F.length(m) + K.RATE_CONTEXT_CHARS)
    return F.struct(m.alias("rate_text"), value.alias("value"), strip_ws(F.substring(t, cs + 1, ce - cs)).alias("context"), start0.alias("start"))
