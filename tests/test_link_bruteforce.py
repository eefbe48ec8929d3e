"""Linking and near-duplicate operators against a brute-force all-pairs Python model on sf0.001.

The Python side is an independent, naive implementation of the semantics
(every pair scored, difflib for titles); the Spark side uses the split
candidate join, pruning and the Arrow UDF.
"""

import difflib
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from noticespark.operators import dedup as DD
from noticespark.operators import link as L
from noticespark.plans import pipelines as PL
from noticespark.plans import scenario as SC
from noticespark.plans.registry import _dup_sides


@pytest.fixture(scope="module")
def sides(spark):
    l = SC.landed(spark, SF_SMALL)
    store = SC.store_events(spark, SF_SMALL, l)
    new = PL.link_projection(PL.fr_pipeline(l.fr_raw, l.pages, l.pdf_pages, store, as_of=SC.AS_OF["federal_register"],
                                            link=False).events)
    other = PL.link_projection(store.where(F.col("source") != "federal_register"))
    return new, other, l, store


def rows(df):
    return [r.asDict() for r in df.collect()]


def _d(s):
    try:
        y, m, d = s.split("-")
        return date(int(y), int(m), int(d))
    except Exception:  # noqa: BLE001
        return None


#: Weight of each part, and the value it has to exceed to count.
LINK_PARTS = {"number": (0.4, 0.0), "codes": (0.3, 0.0), "title": (0.2, 0.7), "date": (0.1, 0.0)}
DUP_PARTS = {"number": 0.4, "codes": 0.3, "title": 0.2, "date": 0.1}


def overlap(a, b):
    x, y = set(a["codes"]), set(b["codes"])
    return len(x & y) / len(x | y) if x and y else 0.0


def ratio(a, b):
    x, y = (a["title"] or "").lower(), (b["title"] or "").lower()
    return difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0


def score(a, b, with_title=True):
    numbers = [x["fr_document_number"] or None for x in (a, b)]
    texts = [(x["title"] or "").lower() + " " for x in (b, a)]
    days = [_d(x["publication_date"] or "") for x in (a, b)]
    parts = {
        "number": float(any(n and n.lower() in t for n, t in zip(numbers, texts)) or (numbers[0] is not None and numbers[0] == numbers[1])),
        "codes": overlap(a, b),
        "title": ratio(a, b) if with_title else 0.0,
        "date": max(0.0, 1 - abs((days[0] - days[1]).days) / 30) if None not in days else 0.0,
    }
    return sum(w * parts[k] for k, (w, over) in LINK_PARTS.items() if parts[k] > over)


def similarity(a, b):
    same = lambda k: float(a[k] == b[k])
    parts = {"number": same("fr_document_number") if a["fr_document_number"] and b["fr_document_number"] else 0.0,
             "codes": overlap(a, b), "title": ratio(a, b), "date": same("publication_date")}
    return sum(DUP_PARTS[k] * v for k, v in parts.items())


def brute_links(new, other, limit, with_title=True):
    out = {}
    for a in new:
        if not a["codes"] or not a["publication_date"]:
            continue
        cands = []
        for b in other:
            if b["source"] == a["source"]:
                continue
            share = bool(set(a["codes"]) & set(b["codes"]))
            da, db = _d(a["publication_date"]), _d(b["publication_date"] or "")
            near = da is not None and db is not None and abs((da - db).days) < 30
            if limit is None or share or near:
                cands.append(b)
        cands.sort(key=lambda b: (-b["ingestion_timestamp"].timestamp(), -b["ingest_seq"], b["id"]))
        if limit is not None:
            cands = cands[:limit]
        for b in cands:
            c = score(a, b, with_title)
            if c >= 0.5:
                out[(a["id"], b["id"])] = c
    return out


def test_candidate_join_matches_brute_force(spark, sides):
    new, other, _, _ = sides
    got = {(r["new_id"], r["id"]) for r in rows(L.candidate_pairs(new, other, 5))}
    nr, orows = rows(new), rows(other)
    want = set()
    for a in nr:
        if not a["codes"] or not a["publication_date"]:
            continue
        c = []
        for b in orows:
            share = bool(set(a["codes"]) & set(b["codes"]))
            da, db = _d(a["publication_date"]), _d(b["publication_date"] or "")
            if share or (db is not None and abs((da - db).days) < 30):
                c.append(b)
        c.sort(key=lambda b: (-b["ingestion_timestamp"].timestamp(), -b["ingest_seq"], b["id"]))
        want |= {(a["id"], b["id"]) for b in c[:5]}
    assert got == want


@pytest.mark.parametrize("limit", [5, None])
def test_links_match_brute_force(spark, sides, limit):
    new, other, _, _ = sides
    got = {(r["parent_event_id"], r["related_event_id"]): r["confidence_raw"] for r in rows(L.link_documents(new, other, limit=limit))}
    want = brute_links(rows(new), rows(other), limit)
    assert set(got) == set(want)
    for k, v in want.items():
        assert abs(got[k] - v) < 1e-9


def test_near_duplicates_match_brute_force(spark, sides):
    new, stored = _dup_sides(spark, SF_SMALL)   # copies with a longer title, a code fewer or another date
    rows_of_store = rows(stored)
    got = {(r["new_id"], r["existing_id"]): r["similarity"] for r in rows(DD.near_duplicates(new, stored))}
    want = {(a["id"], b["id"]): x for a in rows(new) for b in rows_of_store if (x := similarity(a, b)) >= 0.85}
    assert set(got) == set(want) and len(want) > 0
    for k, v in want.items():
        assert abs(got[k] - v) < 1e-9


@pytest.mark.parametrize("threshold", [0.0, 0.75])
def test_near_duplicates_of_lower_thresholds_match_brute_force(spark, threshold):
    """Pairs with little or no code overlap, or without codes, are scored when the threshold lets them pass."""
    schema = "id string, fr_document_number string, codes array<string>, title string, publication_date string"
    lists = [[], ["b"], ["a"], ["a", "b", "c", "d", "e", "f"], ["e", "f", "g"], ["x", "y"], ["f", "x", "y", "z"]]
    new = spark.createDataFrame([(f"n{i}", f"N{i % 2}", c, "Notice of change", "2025-01-01") for i, c in enumerate(lists)], schema)
    stored = spark.createDataFrame([(f"s{i}", f"N{j}", c, "Notice of change", "2025-01-01") for j in (0, 1) for i, c in enumerate(lists, 10 * j)], schema)
    got = {(r["new_id"], r["existing_id"]): r["similarity"] for r in rows(DD.near_duplicates(new, stored, threshold=threshold))}
    pairs = [(a, b) for a in rows(new) for b in rows(stored) if a["fr_document_number"] == b["fr_document_number"]]
    want = {(a["id"], b["id"]): x for a, b in pairs if (x := similarity(a, b)) >= threshold}
    assert set(got) == set(want) and (len(want) == 49 or threshold > 0)
    for k, v in want.items():
        assert abs(got[k] - v) < 1e-9


def test_no_nested_loop_in_link_plans(spark, sides):
    new, other, _, _ = sides
    for lim in (5, None):
        plan = L.link_documents(new, other, limit=lim)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, plan


def test_candidate_cut_before_shuffle(spark, sides):
    """The newest-k cuts plan as WindowGroupLimit (a partial one runs before the shuffle)."""
    new, other, _, _ = sides
    c = L.candidate_pairs(new, other, 5)
    c.write.format("noop").mode("overwrite").save()
    plan = c._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_hot_code_is_split_by_date_and_title(spark):
    """A code held by a third of all documents joins only documents with an equal title or close dates."""
    import datetime as dt

    def side(source, n, shift):
        day = lambda i: str(dt.date(2000, 1, 1) + dt.timedelta(days=(i * 31 + shift) % 9000))
        return [(f"{source}{i}", source, f"{source} title {i}", day(i), None, ["9999.99.9999"] if i % 3 == 0 else [f"{i:04}.11.2222"], dt.datetime(2025, 1, 1), i)
                for i in range(n)]

    schema = "id string, source string, title string, publication_date string, fr_document_number string, codes array<string>, ingestion_timestamp timestamp, ingest_seq long"
    new, store = spark.createDataFrame(side("a", 300, 0), schema), spark.createDataFrame(side("b", 300, 7), schema)
    pairs = L.reachable_pairs(new, store).count()
    assert 0 < pairs <= 3 * 300 < 100 * 100   # 100 x 100 documents carry the hot code


def test_store_reads_one_source_only(spark, sides):
    _, _, l, store = sides
    docs = PL.mark_failed(PL.prepare_documents(PL.fr_documents(l.fr_raw), "federal_register", l.pages, None), "federal_register")
    plan = PL.fresh_documents(docs, "federal_register", store)._jdf.queryExecution().executedPlan().toString()
    assert "(source" in plan and "= federal_register)" in plan
