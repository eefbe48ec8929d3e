"""what the batches of one stream share is made once, and the tables stay the same."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from noticespark.operators import enrich as E
from noticespark.plans import scenario as SC
from noticespark.session import ensure_checkpoint_dir
from noticespark.streaming import incremental as I


@pytest.mark.parametrize("most, made", [(E.MOST_BROADCAST_KEYS, 2), (0, 1)])   # each batch picks its pages, or is too large for that
def test_two_batches_share_their_tables(spark, monkeypatch, most, made):
    monkeypatch.setattr(E, "MOST_BROADCAST_KEYS", most)
    calls, names = [], []
    SC.store_events(spark, SF_SMALL)   # made before pages are counted
    facts, stage = E.page_facts, I.staged
    monkeypatch.setattr(E, "page_facts", lambda *a: calls.append(a) or facts(*a))
    monkeypatch.setattr(I, "staged", lambda df, name: names.append(name) or stage(df, name))
    l = SC.landed(spark, SF_SMALL)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shared-{uuid.uuid4().hex[:8]}"
    l.fr_raw.repartition(2, "landed_date").write.parquet(base + "/landing")
    SC.store_events(spark, SF_SMALL, l).write.partitionBy("source").parquet(base + "/events")
    I.incremental_ingest(spark, base + "/landing", l.fr_raw.schema, l.pages, l.pdf_pages, base + "/events", base + "/edges", base + "/ckpt",
                         SC.AS_OF["federal_register"], max_files_per_trigger=1)
    assert names.count("documents") == 2 and len(calls) == made and names.count("others") == 1
    added = spark.read.parquet(base + "/events").where(F.col("ingestion_timestamp") == F.to_timestamp(F.lit(SC.AS_OF["federal_register"])))
    batch = SC.fr_run(spark, SF_SMALL)
    rows = lambda df: sorted(map(str, df.select("id", "ingest_seq", "data", "confidence_score").collect()))
    assert rows(added) == rows(batch.events)
    edges = lambda df: sorted(map(str, df.select("parent_event_id", "related_event_id", "confidence").collect()))
    assert edges(spark.read.parquet(base + "/edges")) == edges(batch.edges)


def test_other_events_are_staged_again_when_their_files_change(spark):
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/others-{uuid.uuid4().hex[:8]}"
    store, kept = SC.store_events(spark, SF_SMALL), {}
    def others():
        return I._others(spark.read.parquet(base), "federal_register", kept).count()
    for source, n in (("ustr", 1), ("federal_register", 1), ("cbp_csms", 2)):
        store.where(F.col("source") == source).write.mode("append").partitionBy("source").parquet(base)
        assert others() == spark.read.parquet(base).where("source <> 'federal_register'").count() and len(kept) == n
