"""Small fixed dictionaries as literal maps (no join, no broadcast needed)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .text import strip_ws


def _map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs for x in kv])


def country_code(name: Column) -> Column:
    """Two alphabetic letters pass through upper-cased; known names map to ISO2; else NULL."""
    u = F.upper(strip_ws(name))
    return F.when(F.coalesce(F.length(name), F.lit(0)) == 0, F.lit(None).cast("string")).when(
        (F.length(u) == 2) & u.rlike(r"^\p{L}\p{L}$"), u).otherwise(F.try_element_at(_map(K.COUNTRY_NAME_TO_ISO2.items()), u))


def source_priority(source: Column) -> Column:
    """Source -> priority."""
    return F.try_element_at(_map(K.SOURCE_PRIORITIES.items()), source)


def source_relationship(source1: Column, source2: Column) -> Column:
    """Ordered source pair -> relationship name, default 'related'."""
    m = _map([(f"{a}|{b}", r) for a, b, r in K.SOURCE_PAIR_RELATIONSHIP])
    return F.coalesce(F.try_element_at(m, F.concat_ws("|", source1, source2)), F.lit(K.DEFAULT_RELATIONSHIP))
