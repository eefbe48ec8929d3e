"""the raw zone without a shuffle of its bodies, against a plain model, whatever repeats."""

import hashlib
import random
import uuid

import pytest

from noticespark.plans import raw
from noticespark.session import ensure_checkpoint_dir

LANDED = "source string, doc_id string, kind string, url string, body binary"


def _batch(seed, n):
    """Repeated names, shared and known bodies, rows that come twice, missing documents, bodies, kinds and sources."""
    r = random.Random(seed)
    rows = [(r.choice(["a", "a", "b", None] if i % 9 == 0 else ["a", "b"]), r.choice([None, *map(str, range(2 * n))]), r.choice(["html", "pdf", None] if i % 7 == 0 else ["html"]),
             f"u{i}", None if i % 11 == 0 else f"body {r.choice(range(n)) if i % 2 else i}".encode()) for i in range(n)]
    return rows + rows[::5]


@pytest.mark.parametrize("most", [raw.MOST_LISTED, 0])   # the list of repeated hashes is short, or too long to broadcast
def test_zone_equals_a_plain_model(spark, monkeypatch, most):
    monkeypatch.setattr(raw, "MOST_LISTED", most)
    zone = f"{ensure_checkpoint_dir(spark).rstrip('/')}/raw-{uuid.uuid4().hex}"
    want, bodies = {}, set()
    for day, seed in enumerate((1, 2, 1), 1):   # the third batch brings the first one's bodies on another day
        rows, named = _batch(seed, 40), {}
        for source, doc, kind, url, body in rows:
            if None not in (source, kind, body):
                name = f"{source}_{doc or ''}_2026010{day}_061500.{kind}"
                named[source, name] = max(named.get((source, name), b""), body, key=lambda b: (b != b"", hashlib.sha256(b).hexdigest()))
        want |= named
        bodies |= {(source, body) for (source, _), body in named.items()}
        for _ in range(2 if day == 2 else 1):   # a batch that is run again adds nothing
            raw.store_raw(spark.createDataFrame(rows, LANDED), zone, f"2026-01-0{day} 06:15:00")
    read = [(r.source, r.name, bytes(r.body)) for r in raw.read_raw(spark, zone).collect() if r.name is not None]
    assert {(s, n): b for s, n, b in read} == want and len(read) == len(want)
    stored = [(r.source, bytes(r.body)) for r in spark.read.parquet(zone + "/bodies").collect()]
    assert set(stored) == bodies and len(stored) == len(bodies)


def test_bodies_are_not_shuffled_and_a_lost_run_leaves_no_name(spark):
    zone = f"{ensure_checkpoint_dir(spark).rstrip('/')}/raw-{uuid.uuid4().hex}"
    rows = [("a", str(i), "html", f"u{i}", b"x%d" % i) for i in range(20)]
    raw.store_raw(spark.createDataFrame(rows, LANDED), zone, "2026-01-01 06:15:00")
    plan = raw.read_raw(spark, zone)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan, plan
    assert all(".zstd." in f for f in spark.read.parquet(zone + "/bodies").inputFiles())
    lost = spark.read.parquet(zone + "/bodies").where("doc_id = '3'").selectExpr("'gone' name", "doc_id", "kind", "url", "'h' body_hash", "body", "source", "ingest_date")
    lost.write.mode("append").partitionBy("source", "ingest_date").parquet(zone + "/bodies")
    assert {r.doc_id: bytes(r.body) for r in raw.read_raw(spark, zone).collect()} == {str(i): b"x%d" % i for i in range(20)}
    assert raw.read_raw(spark, zone).count() == 20
