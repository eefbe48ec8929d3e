"""The keys of the candidate search against all pairs, and the title ratio against difflib."""

import datetime as dt
import difflib
import random

import pytest

from noticespark.functions.similarity import POPULAR_FROM, ratio_of
from noticespark.operators import link as L

SHAPE = "id string, source string, title string, publication_date string, fr_document_number string, codes array<string>, ingestion_timestamp timestamp, ingest_seq long"


def _side(source, n, seed):
    """Documents with few and many codes, hot and rare ones, repeated, missing and empty ones, and few titles and dates."""
    r = random.Random(seed)
    codes = [f"{c:04}" for c in range(12)]
    def some():
        return [r.choice(codes[:3] if r.random() < 0.5 else codes) for _ in range(r.randint(1, 5))] + r.choice([[], [None], [""]])
    days = [None, None] + [str(dt.date(2001, 1, 1) + dt.timedelta(days=13 * i)) for i in range(12)]
    return [(f"{source}{i}", r.choice([source, "c"]), r.choice(["One", "two", "", None, "Three"]), r.choice(days), None, some(), dt.datetime(2025, 1, 1), i) for i in range(n)]


def _reachable(a, b):
    x, y = ({c for c in d[5] if c} for d in (a, b))
    if a[1] == b[1] or not x or not y or 3 * len(x & y) < 2 * len(x | y):
        return False
    day = lambda d: dt.date.fromisoformat(d[3]) if d[3] and d[3][0] == "2" else None
    near = day(a) is not None and day(b) is not None and abs((day(a) - day(b)).days) < 30
    return near or bool(a[2]) and a[2].lower() == (b[2] or "").lower()


@pytest.mark.parametrize("few", [False, True])
def test_reachable_pairs_equal_all_pairs(spark, few):
    new, store = _side("a", 120, 1), _side("b", 150, 2)
    got = L.reachable_pairs(spark.createDataFrame(new, SHAPE), spark.createDataFrame(store, SHAPE), few)
    want = {(a[0], b[0]) for a in new for b in store if a[3] is not None and _reachable(a, b)}
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want) > 100


def test_documents_find_their_prefix_without_a_join(spark):
    """Each side was exploded, joined with all codes, collected and joined again."""
    new, store = (spark.createDataFrame(_side(s, 5, 3), SHAPE) for s in "ab")
    plan = L.reachable_pairs(new, store)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 4   # the keys, equal numbers, a number in a title either way


def test_titles_have_keys_for_the_numbers_of_the_other_side_only(spark):
    row = lambda i, s, title, number: (i, s, title, "2001-01-01", number, ["0101"], dt.datetime(2025, 1, 1), 0)
    new = spark.createDataFrame([row("n1", "a", "Notice 2001-000001", "2001-000001"), row("n2", "a", "On 7-12", None)], SHAPE)
    store = spark.createDataFrame([row("s1", "b", "About 2001-000001.", None), row("s2", "b", "x", "7-1"), row("s3", "b", "2001-00001", None)], SHAPE)
    assert sorted(map(tuple, L.docnum_pairs(new, store).collect())) == [("n1", "s1"), ("n2", "s2")]


def test_ratio_equals_difflib():
    r = random.Random(4)
    for i in range(4000):
        letters = r.choice(["ab", "abc ", "abcdef -", "0123456789 é", "notice of tariff"])
        word = lambda most: "".join(r.choice(letters) for _ in range(r.randint(0, most)))
        a, b = word(40), word(40 if i % 50 else POPULAR_FROM + 40)
        assert ratio_of(a, b) == difflib.SequenceMatcher(None, a, b).ratio(), (a, b)
