"""Aggregations and the score-case scoring (A4, A9 input, X8, C5 with parts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import dates as D
from ..functions import scoring as S
from ..functions.rates import validate_rate
from ..functions.text import bound


def hts_batch_summary(df: DataFrame, code_col: str = "code", keys: list[str] | None = None) -> DataFrame:
    """A4: total / valid / invalid per group (partial aggregation before the shuffle)."""
    valid = C.hts_valid(F.col(code_col))
    g = df.groupBy(*(keys or []))
    return g.agg(F.count(F.lit(1)).alias("total"), F.count_if(valid).alias("valid"), F.count_if(~valid).alias("invalid"))


def score_cases_scored(sc: DataFrame) -> DataFrame:
    """C5 and its parts on score cases (dates, extraction metadata, rate, related flag)."""
    v = D.validate_dates(F.col("publication_date"), F.col("effective_date"), F.col("expiration_date"))
    rate = validate_rate(F.col("rate_original"))
    rate_norm = F.when(F.col("rate_original").isNotNull(), rate.getField("normalized_value"))
    required = S.required_fields_score(F.lit("score_case"), F.lit("Notice"), F.lit("Score case"),
                                       F.col("publication_date"), F.lit("https://example.invalid/case"))
    out = sc.select(
        "*",
        required.alias("required"),
        F.lit(0.0).alias("hts"),
        S.date_score(v).alias("date_v"),
        S.date_score_basic(F.col("publication_date"), F.col("effective_date")).alias("date_basic"),
        S.rate_score(F.col("rate_original"), rate_norm).alias("rate"),
        S.quality_score(F.col("ocr_used"), F.col("table_extraction_method"),
                        F.when(F.col("has_related"), F.lit(1)).otherwise(F.lit(0))).alias("quality"),
    )
    return out.withColumn("confidence_raw", S.confidence(F.col("required"), F.col("hts"), F.col("date_v"),
                                                         F.col("rate"), F.col("quality")))


def products_from_tables(df: DataFrame, key: str, tables_col: str) -> DataFrame:
    """Per table row, codes of all cells (concatenated, not deduplicated) and the last
    cell without a code longer than 10 characters as description; rows with codes only."""
    # The outer form: the other filters empty lists first, and makes the tables of every page twice for that.
    t = df.select(key, F.posexplode_outer(tables_col).alias("t_idx", "tbl"))
    r = t.select(key, "t_idx", F.posexplode("tbl").alias("r_idx", "cells"))
    zipped = F.transform("cells", lambda c: F.struct(c.alias("c"), C.extract_hts_codes(c).alias("k")))

    def product(z):
        """The row's codes and description; cells are searched once for both, and for the choice of rows."""
        codes = F.flatten(F.transform(z, lambda x: x.getField("k")))
        desc_cells = F.filter(z, lambda x: (F.size(x.getField("k")) == 0) & (F.length(x.getField("c")) > 10))
        desc = F.coalesce(F.try_element_at(F.transform(desc_cells, lambda x: x.getField("c")), F.lit(-1)), F.lit(""))
        return F.struct(codes.alias("hts_codes"), desc.alias("description"))

    found = F.filter(F.array(bound(zipped, product)), lambda x: F.size(x.getField("hts_codes")) > 0)
    return r.select(key, "t_idx", "r_idx", F.inline(found))
