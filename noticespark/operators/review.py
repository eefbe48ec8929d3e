"""Review blocks: events that share a fuzzy hash (C9), each with its block's size and representative.

A block's row is a partial aggregate, so a block of any size (all code-less notices of a day, say) is one row per map
task.  Membership joins the blocks back to the events: a block of more than one event in ``HOT_SHARE`` is hot; fewer than
``HOT_SHARE`` blocks can be, so they are broadcast and their events marked where they lie; the others are joined by
shuffle.  Nothing is compared in pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import identity as I
from ..session import staged

HOT_SHARE = 10_000


def block_rows(hashed: DataFrame) -> DataFrame:
    """(fuzzy_hash, block_size, representative): the representative is the event stored first (ties: smallest id)."""
    return hashed.groupBy("fuzzy_hash").agg(
        F.count(F.lit(1)).alias("block_size"),
        F.min_by("id", F.struct("ingestion_timestamp", "ingest_seq", "id")).alias("representative"))


def review_blocks(events: DataFrame, hot_share: int = HOT_SHARE) -> DataFrame:
    """(id, fuzzy_hash, block_size, representative) of every event in the linking shape.

    Null dates and empty or null code lists are values of the hash; an empty table gives an empty result.
    """
    key = I.fuzzy_hash(F.col("source"), F.col("publication_date"), F.col("codes"))
    hashed = staged(events.select("id", key.alias("fuzzy_hash"), "ingestion_timestamp", "ingest_seq"), "hashed")
    blocks = staged(block_rows(hashed), "blocks")
    total = hashed.count()   # from the files' footers
    hot = blocks.where(F.col("block_size") * hot_share > total)
    cold = blocks.where(F.col("block_size") * hot_share <= total)
    members = hashed.select("id", "fuzzy_hash")
    rest = members.join(F.broadcast(hot.select("fuzzy_hash")), "fuzzy_hash", "left_anti")
    both = members.join(F.broadcast(hot), "fuzzy_hash").unionByName(rest.join(cold, "fuzzy_hash"))
    return both.select("id", "fuzzy_hash", "block_size", "representative")
