"""Source mixing, URL filters and the pipeline."""

import datetime
import os
import re
from fractions import Fraction

import duckdb
import pytest

import corpus_pipeline
from noticespark.llm import queries, quality_classifier, simhash_near_dedup, source_mix, substring_dedup, url_filters

SMALL = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def water_fill(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = Fraction(3, 2) * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * sizes[s] <= weight[s] * level}
        if not full:
            return out | {s: weight[s] * level for s in open_}
        for s in full:
            out[s] = Fraction(2 * sizes[s])
            left -= 2 * sizes[s]
        open_ -= full
    return out


@pytest.fixture(scope="module")
def mix_docs(spark):
    rows = [(i, " ".join(["w%d" % j for j in range(i % 37)]), "src%d" % (i % 5) if i % 7 else "big") for i in range(400)]
    rows += [(1000, None, "src1"), (1001, "", "src1"), (1002, "one two\x0bthree", None), (None, "a b c d", "src2"), (3, " ".join(["w0", "w1", "w2"]), "src3"), (1003, "only", "ä"), (1004, "", "empty")]
    rows += [(1005, "same row again", "src0")] * 3
    return rows, spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, source string, _key string, _size int")


def test_mix_meets_targets(spark, mix_docs):
    rows, docs = mix_docs
    got = source_mix.mix(docs).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want = water_fill(sizes)
    assert len(got) == len(rows)
    source = {}
    for r in docs.collect():
        source.setdefault((r.doc_id, len(words(r.text))), r.source)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source[(r.doc_id, r.size)]
        assert r.source_size == sizes[s] and r.target == pytest.approx(float(want[s])) and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - float(want[s])) <= 3
    again = source_mix.mix(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_takes_whole_epochs_first(spark, mix_docs):
    _, docs = mix_docs
    for r in source_mix.mix(docs).collect():
        epochs = int((r.target + 0.5) // r.source_size) if r.source_size else 0
        assert r.taken >= epochs * r.size


def test_mixed_rows_hold_the_taken_words(spark, mix_docs):
    _, docs = mix_docs
    mixed = source_mix.mixed(docs)
    assert mixed.columns == docs.columns
    have = {}
    for r in mixed.collect():
        have[r.doc_id] = have.get(r.doc_id, 0) + len(words(r.text))
    want = {}
    for r in source_mix.mix(docs).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
    assert have == {k: v for k, v in want.items() if v}


def test_mix_of_nothing(spark, mix_docs):
    assert source_mix.mix(mix_docs[1].limit(0)).count() == 0 and source_mix.mixed(mix_docs[1].limit(0)).count() == 0


def test_heavier_documents_come_first_more_often(spark):
    """Efraimidis-Spirakis: a document of twice the weight is the first of two in about 2/3 of the seeds."""
    docs = spark.createDataFrame([(i * 2 + j, "word " * 9 + ("word" if j else "!!!!"), f"s{i:04}") for i in range(1500) for j in (0, 1)], "doc_id long, text string, source string")
    keys = source_mix.keyed(docs).select("source", "doc_id", "_key").collect()
    pairs = {}
    for r in keys:
        pairs.setdefault(r.source, {})[r.doc_id % 2] = r._key
    first = sum(p[1] < p[0] for p in pairs.values()) / len(pairs)
    light = (49 - 13) / 49  # 49 bytes: 9 spaces and 4 marks are not counted
    heavy = (49 - 9) / 49
    assert first == pytest.approx(heavy / (heavy + light), abs=0.04)


# --- URL filters ---


def test_url_verdicts_follow_the_dates(spark):
    d = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    events = [("host", "a.example.com", "spam", "add", d(10)), ("host", "a.example.com", "spam", "remove", d(20)), ("host", "a.example.com", "spam", "add", d(30)),
              ("domain", "example.com", "adult", "add", d(0)), ("prefix", "a.example.com/ok", "allow", "add", d(15)), ("domain", "other.org", "spam", "add", d(5)),
              ("domain", "other.org", "spam", "remove", d(5)), ("host", None, "spam", "add", d(1))]
    captures = [(1, "http://A.example.com:80/x", d(9)), (2, "http://a.example.com/x", d(10)), (3, "http://a.example.com/x", d(20)), (4, "https://u:p@a.example.com./ok/deep?q=1", d(15)),
                (5, "http://b.a.example.com", d(0)), (6, "http://sub.other.org/", d(6)), (7, None, d(1)), (8, "no url", d(1)), (9, "http://a.example.com/x", None),
                (10, "http://a.example.com/x", d(40)), (10, "http://a.example.com/x", d(40)), (11, "http://unlisted.net/ok", d(3))]
    got = url_filters.verdicts(spark.createDataFrame(captures, "page_id long, url string, fetch_day date"), spark.createDataFrame(events, "kind string, key string, category string, action string, day date"))
    rows = sorted((r.page_id, r.verdict, r.kind, r.category, r.n_active) for r in got.collect() if r.kind)
    assert rows == [(1, "block", "domain", "adult", 1), (2, "block", "host", "spam", 2), (3, "block", "domain", "adult", 1), (4, "allow", "prefix", "allow", 3),
                    (5, "block", "domain", "adult", 1), (10, "block", "host", "spam", 2), (10, "block", "host", "spam", 2)]
    assert sorted(r.page_id for r in got.collect() if r.verdict == "none") == [6, 7, 8, 9, 11]


def test_url_query_equals_its_sql(spark):
    got = queries.QUERIES["op2_url_filters"](spark, SMALL).collect()
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{SMALL}/pages.parquet'")
    want = con.sql(queries.ORACLE_SQL["op2_url_filters"])
    names = [c for c in want.columns]
    assert sorted(str([str(r[c]) for c in names]) for r in got) == sorted(str([str(x) for x in r]) for r in want.fetchall())


def test_url_empty(spark):
    captures = spark.createDataFrame([(1, "http://a.b", datetime.date(2024, 1, 1))], "page_id long, url string, fetch_day date")
    events = spark.createDataFrame([], "kind string, key string, category string, action string, day date")
    assert [r.verdict for r in url_filters.verdicts(captures, events).collect()] == ["none"]
    assert url_filters.verdicts(captures.limit(0), events).count() == 0


# --- pipeline ---


def test_stages_take_effect(spark):
    """Each stage against a plain version of what it decides."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.staged(stage(spark, docs, SMALL), name)
        seen.append((docs.toPandas(), out.toPandas()))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == corpus_pipeline.COLUMNS
            assert out.where("n_chars <> length(text)").count() == 0
        docs = out
    before, good = seen[0]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas().set_index("doc_id").quality
    bad = [i for i in before.doc_id if i in labels and labels[i] == 0]
    kept_good = [i for i in before.doc_id if i in labels and labels[i] == 1]
    assert len(set(bad) & set(good.doc_id)) <= 0.35 * len(bad) and len(set(kept_good) & set(good.doc_id)) >= 0.97 * len(kept_good)
    before, unique = seen[1]
    fps = [simhash_near_dedup.simhash64(t, 3) for t in before.text]
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = root[i], root[j]
                root = [b if x == a else x for x in root]
    smallest = {}
    for r, i in zip(root, before.doc_id):
        smallest[r] = min(i, smallest.get(r, i))
    assert sorted(unique.doc_id) == sorted(smallest.values())
    before, cut = seen[2]
    assert sorted(before.doc_id) == sorted(cut.doc_id) and cut.text.str.len().sum() < before.text.str.len().sum()
    before, mixed = seen[3]
    sizes = before.assign(n=[len(words(t)) for t in before.text]).groupby("source").n.sum().to_dict()
    target = water_fill(sizes)
    got = mixed.assign(n=[len(words(t)) for t in mixed.text]).groupby("source").n.sum().to_dict()
    assert all(abs(got.get(s, 0) - float(target[s])) <= 1 for s in sizes)
    before, encoded = seen[4]
    assert len(before) == len(encoded) and encoded.round_trip.all() and list(encoded.columns) == ["doc_id", "source", "n_tokens", "token_ids", "round_trip"]


def test_pipeline_of_edge_rows(spark, tmp_path):
    """Nulls, repeated rows, empty texts and extra columns pass; an empty table gives none."""
    rows = [(1, "a fine text of a few words", "en", "s", 26), (1, "a fine text of a few words", "en", "s", 26), (None, None, None, None, None), (2, "", "en", None, 0)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, _id string, idx int")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(os.path.join(tmp_path, "labels.parquet"))
    for table in (docs, docs.limit(0)):
        out = table
        counts = []
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.staged(stage(spark, out, str(tmp_path)), name)
            counts.append(out.count())
        assert counts == ([4, 2, 2, 2, 2] if table is docs else [0] * 5)


def test_thresholds_are_those_of_the_modules():
    assert corpus_pipeline.REJECT_BELOW <= quality_classifier.KEEP and substring_dedup.MIN_WORDS < 50
