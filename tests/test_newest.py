"""Newest-k tables: the same candidates as from the whole store, after any number of runs, replays and crashes."""

import os
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from noticespark.operators.link import candidate_pairs
from noticespark.plans import newest as N
from noticespark.plans import scenario as SC
from noticespark.session import ensure_checkpoint_dir


def pairs(df):
    return sorted(tuple(r) for r in df.select("new_id", "id", "cand_rank").collect())


def test_candidates_after_each_run(spark):
    new, other = SC.link_sides(spark, SF_SMALL)
    path = os.path.join(ensure_checkpoint_dir(spark), "newest-" + uuid.uuid4().hex[:8])
    assert N.candidates(spark, new, path).isEmpty()
    stored = other.limit(0)
    for n in range(3):
        run = other.where(F.pmod(F.crc32("id"), F.lit(3)) == n)
        stored = stored.unionByName(run)
        N.merge_newest(spark, run, path)
        N.merge_newest(spark, run, path)   # a replay
        assert pairs(N.candidates(spark, new, path)) == pairs(candidate_pairs(new, stored, 5))
    for name, key in N.TABLES.items():
        table = N.newest_tables(spark, path)[name]
        assert table.groupBy(key, "source").count().where("count > 5").isEmpty()
        assert table.count() == table.dropDuplicates([key, "source", "id"]).count()


def test_a_merge_that_stops_half_way_counts_for_nothing(spark):
    new, other = SC.link_sides(spark, SF_SMALL)
    path = os.path.join(ensure_checkpoint_dir(spark), "newest-" + uuid.uuid4().hex[:8])
    N.merge_newest(spark, other.where("source = 'ustr'"), path)
    before = pairs(N.candidates(spark, new, path))
    tables = N.newest_tables(spark, path)
    tables["by_code"].limit(0).write.parquet(path + "/v2/by_code")   # version 2 lost its second table
    assert pairs(N.candidates(spark, new, path)) == before
    N.merge_newest(spark, other.where("source = 'cbp_csms'"), path)
    assert pairs(N.candidates(spark, new, path)) == pairs(candidate_pairs(new, other, 5))
