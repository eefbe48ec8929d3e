"""Rate mentions, stripped texts and table products against plain versions, and what their plans do once only."""

import random
import re

from noticespark.functions import constants as K
from noticespark.functions import text as T
from noticespark.operators import aggregates as A
from pyspark.sql import functions as F

NUMBER, WS = r"([0-9]+(?:\.[0-9]+)?)", "[" + re.escape(T._WS) + "]"
PATTERNS = [NUMBER + WS + "*%", r"\$" + NUMBER + WS + "*per", NUMBER + WS + "*cents?" + WS + "*per"]


def _mentions(text):
    found = [(m, m.start(), m.end()) for p in PATTERNS for m in re.finditer(p, text)]
    around = K.RATE_CONTEXT_CHARS
    return [(m.group(0), m.group(1), text[max(0, a - around):b + around].strip(T._WS), a) for m, a, b in found]


def test_rate_mentions_equal_a_plain_search(spark):
    """the text was searched three times a pattern, once by a pattern compiled for every row."""
    r = random.Random(5)
    parts = ["1", "12", ".", ".5", "%", " ", " ", "\n", "$", "per", " per ", "cent", "cents", "é", "x" * 120, "𐐀"]
    texts = ["", None, "1.2.3%", "12.%", "$1.2.3 per", "5 cents per 6%", "1 .5%", "7%8%", "5 per cent"] + ["".join(r.choice(parts) for _ in range(r.randint(1, 25))) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, s string").select("i", T.rate_mentions(F.col("s")).alias("m"))
    got = {x.i: [tuple(m) for m in x.m] for x in rows.collect()}
    assert got == {i: _mentions(s or "") for i, s in enumerate(texts)}
    assert "split(" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_no_long_text_is_searched_again_from_every_character(spark):
    text = "duty of 5% " + "no rate here " * 20_000
    rows = spark.createDataFrame([(text,)], "s string").select(F.explode(T.rate_mentions(F.col("s"))).alias("m")).collect()
    assert [(x.m.rate_text, x.m.start) for x in rows] == [("5%", 8)]


def test_strip_ws_takes_off_every_kind_of_blank(spark):
    rows = [c + "a" + c + "b" + c for c in T._WS] + [T._WS, T._WS + "x", "​x​", "", "  é \x85", None]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, s string")
    got = df.select("i", T.strip_ws(F.col("s")).alias("t"), F.regexp_replace("s", "^" + K.WS + "+|" + K.WS + "+$", "").alias("u")).orderBy("i").collect()
    assert [x.t for x in got] == [x.u for x in got] == [s if s is None else s.strip(T._WS) for s in rows]


def test_tables_of_a_page_are_made_once(spark):
    """the rows' filter of empty lists made every page and its tables a second time."""
    html = ["<TABLE><tr><td> 7208.10.1500<td>Hot &amp; rolled <b> steel</b> <!-- x --><tr><th>none</table>", "<p>none", None, "<nav><table><tr><td>0101.21.0000</table></nav>"]
    df = spark.createDataFrame(list(enumerate(html)), "k int, h string").select("k", T.html_tables(F.col("h")).alias("t"))
    out = A.products_from_tables(df, "k", "t")
    assert [tuple(r) for r in out.collect()] == [(0, 0, 0, ["7208.10.0000", "7208.10.1500"], "Hot & rolledsteel")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
