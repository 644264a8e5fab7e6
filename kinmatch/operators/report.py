"""Exports, summaries and diagnostics of matches."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .matching import CATEGORIES, category_rank

EXPORT = """catalog_mpn asin Category confidence_score fuzzy_score match_reason catalog_title keepa_title catalog_qty keepa_qty
catalog_manufacturer keepa_brand catalog_color keepa_color catalog_size keepa_size matched_code code_frequency flag_code_match
flag_brand_match flag_code_in_title flag_qty_match flag_color_match flag_size_match flag_qty_mismatch flag_color_mismatch flag_size_mismatch
positive_flags negative_flags score_ratio ai_match_score ai_reasoning asin_cases buy_box_current buy_box_30d_avg bought_past_month
break_even_cost_now break_even_cost_30day estimate_revenue""".split()
MINIMAL = "catalog_mpn asin Category confidence_score fuzzy_score match_reason catalog_title keepa_title catalog_qty keepa_qty matched_code catalog_manufacturer keepa_brand".split()
#: Rows beyond which the sheet of all matches is left out.
ALL_ROWS = 100_000


def arranged(df: DataFrame, first: Iterable[str] = EXPORT) -> DataFrame:
    """The named columns first, the others after them; none is dropped."""
    first = [c for c in first if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def filtered(best: DataFrame, *, categories: Iterable[str] | None = None, min_confidence: float | None = None) -> DataFrame:
    out = best.where(F.col("Category").isin(*categories)) if categories is not None else best
    return out.where(F.col("confidence_score") >= min_confidence) if min_confidence is not None else out


def sheets(best: DataFrame, min_fuzzy: dict[str, float] | None = None) -> dict[str, DataFrame]:
    """A table for each category, best scores first; a category's least fuzzy score holds for its own table only."""
    order = [F.desc("confidence_score"), F.asc("asin")]
    own = lambda c: best.where((F.col("Category") == c) & (F.col("fuzzy_score") >= (min_fuzzy or {}).get(c, float("-inf"))))
    return {c: own(c).orderBy(*order) for c in CATEGORIES} | {"All Matches": best.orderBy(*order)}


def export_summary(best: DataFrame, min_fuzzy: dict[str, float] | None = None) -> DataFrame:
    floor = F.lit(float("-inf"))
    for c, least in (min_fuzzy or {}).items():
        floor = F.when(F.col("Category") == c, F.lit(float(least))).otherwise(floor)
    kept = best.where(F.col("fuzzy_score") >= floor)
    scored = F.count("ai_match_score") if "ai_match_score" in best.columns else F.lit(0).cast("long")
    sums = kept.groupBy("Category").agg(F.count(F.lit(1)).alias("count"), F.round(F.avg("confidence_score"), 1).alias("avg_confidence"), F.round(F.avg("fuzzy_score"), 1).alias("avg_fuzzy"), scored.alias("with_ai_score"))
    return sums.orderBy(F.desc(category_rank()))


# Diagnostics


def contested_listings(matches: DataFrame, least: float = 85.0, limit: int | None = 10) -> DataFrame:
    """Listings with several matches, one above the fuzzy score and one in the weakest category."""
    per = matches.groupBy("asin").agg(F.count(F.lit(1)).alias("match_count"), F.max("fuzzy_score").alias("max_fuzzy"), F.array_join(F.sort_array(F.collect_set("Category")), ",").alias("categories"))
    out = per.where((F.col("match_count") > 1) & (F.col("max_fuzzy") > least) & F.col("categories").contains("Verify")).orderBy("asin")
    return out.limit(limit) if limit else out


def doubtful_examples(matches: DataFrame, best: DataFrame, least: float = 85.0, listings: int = 3) -> DataFrame:
    """All matches of the first few listings whose best match is similar and yet isn't certain."""
    few = best.where((F.col("fuzzy_score") > least) & (F.col("Category") != "Certain")).select("asin").orderBy("asin").limit(listings)
    names = "asin catalog_mpn fuzzy_score score_ratio flag_code_match flag_brand_match Category matched_code".split()
    return matches.join(few, "asin", "left_semi").select(*names).orderBy("asin", F.desc("fuzzy_score"), "catalog_mpn")


def distribution(best: DataFrame) -> DataFrame:
    return best.groupBy("Category").agg(F.count(F.lit(1)).alias("count"), F.avg("fuzzy_score").alias("avg_fuzzy"), F.min("fuzzy_score").alias("min_fuzzy"), F.max("fuzzy_score").alias("max_fuzzy"))


def similar_by_category(best: DataFrame, least: float = 85.0) -> DataFrame:
    return best.where(F.col("fuzzy_score") > least).groupBy("Category").agg(F.count(F.lit(1)).alias("count"))


def near_threshold(best: DataFrame, category: str, limit: int = 10) -> DataFrame:
    names = "asin catalog_mpn fuzzy_score Category flag_code_match flag_brand_match".split()
    return best.where(F.col("Category") == category).select(*names).orderBy(F.desc("fuzzy_score"), "asin").limit(limit)


def describe_tables(spark: SparkSession, names: Iterable[str] | None = None) -> list[dict]:
    """Name, columns with types, row count and five rows of each table or view of the session's catalog."""
    out = []
    for name in names if names is not None else sorted(t.name for t in spark.catalog.listTables()):
        df = spark.table(name)
        out.append({"name": name, "columns": df.dtypes, "rows": df.count(), "sample": df.limit(5).collect()})
    return out
