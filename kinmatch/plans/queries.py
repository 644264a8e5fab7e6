"""Registered queries of the matching engine over the driver's tables, and SQL for the same rows.

The driver's tables have no catalog and no listings; both are derived by SQL that Spark and DuckDB read alike. Queries of single operators run
on those views or, from flags on, on a view of pairs that holds every case of the flags (`PAIRS`).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dealing import once_a_value, parts
from ..functions import color, quantity, similarity, size, text
from ..operators import feedback, matching, report, standardize
from ..shipping import ship
from ..sources.files import combined
from . import match as plan

CATALOG_RAW = """
SELECT concat('PN-', lpad(CAST(p_partkey AS STRING), 6, '0')) AS mpn, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS manufacturer,
       concat(CASE WHEN p_partkey % 7 = 0 THEN 'Acme ' ELSE '' END, p_name, ' ', p_type,
              CASE p_partkey % 6 WHEN 0 THEN concat(' pack of ', CAST(p_size AS STRING)) WHEN 1 THEN concat(', ', CAST(p_size AS STRING), '/pk, 6pk/cs')
                WHEN 2 THEN ' 4x6 in' WHEN 3 THEN concat(' 4 1/2 x 3 wipes ', CAST(p_size AS STRING), '/bx')
                WHEN 4 THEN concat(' X-Large ', CAST(p_size AS STRING), '-count') ELSE '' END) AS title,
       CASE p_partkey % 5 WHEN 0 THEN 'EA' WHEN 1 THEN 'CS' WHEN 2 THEN 'Pair' WHEN 3 THEN '' ELSE NULL END AS uom_unit,
       CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS STRING) WHEN p_partkey % 3 = 1 THEN NULL ELSE 'n/a' END AS uom_quantity
FROM {part}
"""
LISTING_RAW = """
WITH offer AS (SELECT l_partkey, l_suppkey, COUNT(*) AS n_lines, MIN(l_extendedprice) AS px_min, MAX(l_extendedprice) AS px_max FROM {lineitem} GROUP BY l_partkey, l_suppkey)
SELECT concat('B', lpad(CAST(l_partkey AS STRING), 6, '0'), lpad(CAST(l_suppkey AS STRING), 4, '0')) AS asin,
       concat(CASE l_suppkey % 5 WHEN 0 THEN concat(p_brand, ' ') ELSE '' END, p_type, ' ', p_name,
              CASE l_suppkey % 6 WHEN 0 THEN concat(' (Pack of ', CAST(p_size AS STRING), ')') WHEN 1 THEN concat(', 4 Boxes of ', CAST(p_size AS STRING))
                WHEN 2 THEN concat(' 4 x 6.1 in PN-', lpad(CAST(l_partkey AS STRING), 6, '0')) WHEN 3 THEN ' 3" Width, 8" Length'
                WHEN 4 THEN ' extra large unrelated listing words here' ELSE ', Royal Blue' END) AS title,
       CASE WHEN l_suppkey % 3 = 0 THEN p_brand WHEN l_suppkey % 3 = 1 THEN concat(p_brand, ' Inc') ELSE NULL END AS brand,
       CASE WHEN l_suppkey % 13 = 0 THEN concat('PN-', lpad(CAST(l_partkey + 1 AS STRING), 6, '0'), ' / TBD') ELSE NULL END AS model,
       CASE l_suppkey % 8 WHEN 0 THEN 'Grey' WHEN 1 THEN 'blue' WHEN 2 THEN 'Off-White' ELSE NULL END AS color,
       CASE l_suppkey % 10 WHEN 0 THEN '24 count' WHEN 1 THEN '4" X 6"' WHEN 2 THEN '4 inch x4 IN' ELSE NULL END AS size,
       CASE l_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(p_size AS STRING) WHEN 2 THEN CAST(p_size * 10 AS STRING) ELSE '1' END AS number_of_items,
       CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE concat('pn', lpad(CAST(l_partkey AS STRING), 6, '0')) END AS partnumber,
       concat('0', lpad(CAST(l_partkey AS STRING), 11, '7')) AS upc, CAST(px_min AS DOUBLE) AS buy_box_current, CAST(px_max AS DOUBLE) AS buy_box_30d_avg,
       CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE 3.5E0 END AS pick_pack_fee, CASE WHEN l_suppkey % 9 = 1 THEN NULL ELSE 2.25E0 END AS referral_fee,
       CASE l_suppkey % 3 WHEN 0 THEN '15%' WHEN 1 THEN '8.5 %' ELSE '0.12' END AS referral_fee_pct, n_lines AS bought_past_month
FROM offer JOIN {part} ON p_partkey = l_partkey
"""
#: Pairs with all that flags look at; every flag has each of its values, and scores and counts run over the decision list's limits.
PAIRS = """
WITH offer AS (SELECT l_partkey, l_suppkey, COUNT(*) AS n_lines, MIN(l_extendedprice) AS px_min, MAX(l_extendedprice) AS px_max FROM {lineitem} GROUP BY l_partkey, l_suppkey),
x AS (SELECT l_partkey, l_suppkey, n_lines, px_min, px_max, p_name, p_type, p_brand, p_size, l_partkey * 7 + l_suppkey * 13 AS m,
             concat('PN-', lpad(CAST(l_partkey AS STRING), 6, '0')) AS mpn FROM offer JOIN {part} ON p_partkey = l_partkey)
SELECT CASE WHEN l_partkey = 1 THEN 'P-1' ELSE mpn END AS catalog_mpn, concat('B', lpad(CAST((l_partkey * 31 + l_suppkey) % 9000 AS STRING), 6, '0')) AS asin,
       CASE WHEN m % 17 = 0 THEN NULL WHEN m % 19 = 0 THEN '' ELSE p_brand END AS catalog_manufacturer,
       CASE WHEN m % 17 = 0 OR m % 19 = 0 THEN '' WHEN m % 23 = 0 THEN 'bd' ELSE lower(p_brand) END AS manufacturer_lc,
       p_name AS catalog_title, p_name AS catalog_title2, CASE m % 5 WHEN 0 THEN NULL WHEN 1 THEN 1.0E0 WHEN 2 THEN 0.0E0 ELSE CAST(p_size AS DOUBLE) END AS catalog_qty,
       CASE m % 4 WHEN 0 THEN 'EA' WHEN 1 THEN ' Pair ' WHEN 2 THEN 'CS' ELSE NULL END AS catalog_uom_unit, 'Blue' AS catalog_color, '4' AS catalog_size,
       CASE m % 3 WHEN 0 THEN NULL WHEN 1 THEN 'blue' ELSE 'gray' END AS catalog_color_norm,
       CASE m % 6 WHEN 0 THEN NULL WHEN 1 THEN '4 X 6' WHEN 2 THEN '4' WHEN 3 THEN '4.5 X 4.1 YD' WHEN 4 THEN 'XL' ELSE '3 X 8 IN' END AS catalog_size_norm,
       p_type AS keepa_title, p_type AS keepa_title2, p_brand AS keepa_brand, 'Blue' AS keepa_color, '4' AS keepa_size,
       CASE m % 7 WHEN 0 THEN NULL WHEN 1 THEN 'blue' WHEN 2 THEN 'blue' WHEN 3 THEN 'gray' ELSE 'red' END AS keepa_color_norm,
       CASE m % 11 WHEN 0 THEN NULL WHEN 1 THEN '4 X 6.1' WHEN 2 THEN '4 X 75' WHEN 3 THEN '4.5 X 4.125YD' WHEN 4 THEN 'XL' WHEN 5 THEN '4.5 X 4.125 CM' WHEN 6 THEN '4 X 0' ELSE '3 X 8' END AS keepa_size_norm,
       CASE m % 13 WHEN 0 THEN NULL WHEN 1 THEN 0.0E0 WHEN 2 THEN CAST(p_size * 10 AS DOUBLE) WHEN 3 THEN 12.0E0 ELSE CAST(p_size AS DOUBLE) END AS keepa_qty,
       mpn AS keepa_codescombined, CASE m % 3 WHEN 0 THEN lower(p_brand) WHEN 1 THEN concat(lower(p_brand), ' inc') ELSE 'other' END AS brand_lc,
       CASE m % 8 WHEN 0 THEN concat('x ', lower(mpn)) WHEN 1 THEN concat(lower(p_brand), ' thing') ELSE 'plain listing' END AS title_lc,
       CASE WHEN m % 31 = 0 THEN NULL ELSE concat('PN', CAST(l_partkey AS STRING)) END AS matched_code, m % 40 + 1 AS code_frequency,
       CASE WHEN m % 29 = 0 THEN NULL ELSE least(1.0E0, 1.0E0 / log10(m % 40 + 2)) END AS code_rarity_score, CAST(CASE WHEN m % 10 = 9 THEN 0 ELSE 1 END AS INT) AS flag_code_match,
       CAST(m * 37 % 1011 AS DOUBLE) / 10 AS fuzzy_score, px_min AS buy_box_current, CASE WHEN m % 14 = 0 THEN NULL ELSE px_max END AS buy_box_30d_avg, n_lines AS bought_past_month,
       CASE WHEN m % 9 = 0 THEN NULL ELSE 3.5E0 END AS pick_pack_fee, CASE WHEN m % 9 = 1 THEN NULL ELSE 2.25E0 END AS referral_fee, CASE WHEN m % 9 = 2 THEN NULL ELSE 0.15E0 END AS referral_fee_pct
FROM x
"""


#: What the tables are dealt by: groups of lines and joins with parts need no other exchange, and a few files or row groups keep no core idle.
KEYS = {"part": "p_partkey", "lineitem": "l_partkey"}


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    ship(spark)
    names = [t for t in ("part", "lineitem") if "{" + t + "}" in sql]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in names}
    n = parts(*tables.values())
    return spark.sql(sql, **{t: df.repartition(n, KEYS[t]) for t, df in tables.items()})


def _on(sql: str, body: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: body(view(spark, d, sql))


def _listing_code_table(spark: SparkSession, d: str, by: tuple[str, ...] = ("asin", "code")) -> DataFrame:
    raw = view(spark, d, LISTING_RAW)
    return standardize.listing_codes(raw.select("asin", F.col("model").alias("keepa_model"), "partnumber", "upc", F.lit(None).cast("string").alias("ean"), F.lit(None).cast("string").alias("gtin")), parts(raw), by)


def _catalog_code_table(spark: SparkSession, d: str) -> DataFrame:
    return standardize.catalog_codes(view(spark, d, CATALOG_RAW).select("mpn", text.norm_code(F.col("mpn")).alias("mpn_code")))


def _candidate_table(spark: SparkSession, d: str) -> DataFrame:
    return matching.candidates(_catalog_code_table(spark, d), codes := _listing_code_table(spark, d, ("code",)), parts(codes))


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    return matching.validated(view(spark, d, PAIRS))


def _all(spark: SparkSession, d: str) -> DataFrame:
    return matching.categorized(matching.scored(_flagged(spark, d)))


def _best(spark: SparkSession, d: str) -> DataFrame:
    return matching.best_per_listing(_all(spark, d))


#: Scores that depend on the pair alone: a first run's and a second run's.
def _scores(every: DataFrame) -> tuple[DataFrame, DataFrame]:
    n = F.substring("catalog_mpn", -3, 3).try_cast("int")
    row = lambda of, s, why: every.where(of).select(F.col("catalog_mpn").alias("mpn"), "asin", s.alias("ai_match_score"), F.lit(why).alias("ai_reasoning"), F.lit("High").alias("original_category")).distinct()
    return row(n % 3 == 0, (n % 11) / 10.0, "first"), row(n % 6 == 0, F.when(n % 12 == 0, (n % 10) / 10.0), "second")


def _upserted(every: DataFrame) -> DataFrame:
    return feedback.upsert_scores(*_scores(every))


FLAG_COLUMNS = ["catalog_mpn", "asin", *[c for c in matching.VALIDATED if c.startswith("flag_")]]
METRIC_COLUMNS = ["asin_cases", "break_even_cost_now", "break_even_cost_30day", "estimate_revenue"]
SCORE_COLUMNS = ["catalog_mpn", "asin", "positive_flags", "negative_flags", "available_flags", "score_ratio", "confidence_score"]
BEST_COLUMNS = ["catalog_mpn", "asin", "Category", "match_reason", "confidence_score", "fuzzy_score", "cat_rank", "rn"]


def _neighbours(spark: SparkSession, d: str) -> DataFrame:
    part = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("t"))
    ship(spark)
    part = part.repartition(parts(part), "p_partkey")
    other = part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("t").alias("u"))
    return part.join(other, "p_partkey")


def _fuzzy(measure) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: _neighbours(spark, d).select("p_partkey", measure(F.col("t"), F.col("u")).alias("score"))


def _listing_sheet(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, LISTING_RAW).withColumnRenamed("number_of_items", "Number of Items").withColumnsRenamed(
        {"partnumber": "Product Codes: PartNumber", "upc": "Product Codes: UPC", "buy_box_current": "Buy Box: Current", "buy_box_30d_avg": "Buy Box: 30 days avg.", "pick_pack_fee": "FBA Pick&Pack Fee", "referral_fee": "Referral Fee based on current Buy Box price", "referral_fee_pct": "Referral Fee %", "bought_past_month": "Bought in past month"}
    )


def _title_read(name: str, read) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        titles = view(spark, d, LISTING_RAW).select("asin", "title")
        return once_a_value(titles, "title", {name: read(F.col("_value"))}, parts(titles)).select("asin", name)

    return run


def _pipeline(spark: SparkSession, d: str) -> plan.Matches:
    return plan.match(view(spark, d, CATALOG_RAW), _listing_sheet(spark, d))


def _sheets(spark: SparkSession, d: str) -> DataFrame:
    part = spark.read.parquet(f"{d}/part.parquet")
    return combined([part.select("p_partkey", "p_name"), part.select("p_partkey", "p_size"), part.select("p_brand")])


def _updated_category(spark: SparkSession, d: str) -> DataFrame:
    every = _all(spark, d)
    return feedback.apply_scores(every, _upserted(every)).select("catalog_mpn", "asin", "Category")


def _rescored(spark: SparkSession, d: str) -> DataFrame:
    every = _all(spark, d)
    return feedback.rescored(every, _upserted(every))[1].select(*BEST_COLUMNS)


def _verification_summary(spark: SparkSession, d: str) -> DataFrame:
    every = _all(spark, d)
    scores = _upserted(every)
    return feedback.verification_summary(scores, every, feedback.apply_scores(every, scores))


def _quantity_sources(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    raw = view(spark, d, CATALOG_RAW)
    std = raw.select("mpn", F.col("title").alias("catalog_title"), text.to_number(F.col("uom_quantity")).alias("catalog_qty"))
    return std, _best(spark, d)


def _filled(spark: SparkSession, d: str) -> DataFrame:
    std, best = _quantity_sources(spark, d)
    wanted = feedback.without_quantity(best, std, ["Certain", "High"], "catalog")
    found = wanted.select("id", (F.length("title") % 40 - 3).cast("double").alias("quantity"))
    return feedback.fill_quantity(std, found, "catalog").select("mpn", "catalog_qty")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    c = F.col
    parsed = lambda q: [q["quantity"].alias("quantity"), q["unit_type"].alias("unit_type"), q["confidence"].alias("confidence")]
    own = lambda body, *columns: lambda spark, d: body(spark, d).select(*columns)
    return {
        "pipeline_full": own(lambda s, d: _pipeline(s, d).best, "catalog_mpn", "asin", "Category", "match_reason", "fuzzy_score", "confidence_score", "positive_flags", "negative_flags", "catalog_qty", "keepa_qty"),
        "std_catalog": lambda s, d: standardize.standard_catalog(view(s, d, CATALOG_RAW)),
        "std_listing": lambda s, d: standardize.standard_listing(_listing_sheet(s, d)),
        "norm_codes": _on(LISTING_RAW, lambda df: df.select("asin", text.norm_code(c("partnumber")).alias("code"), text.norm_code(c("model")).alias("model_code"))),
        "code_explode": _listing_code_table,
        "joined_codes": _on(LISTING_RAW, lambda df: df.select("asin", text.joined_codes(c("model"), c("partnumber"), c("upc")).alias("codes"))),
        "code_rarity": lambda s, d: matching.code_rarity(_listing_code_table(s, d, ("code",))),
        "candidates": _candidate_table,
        "numbers": _on(CATALOG_RAW, lambda df: df.select("mpn", text.to_number(c("uom_quantity")).alias("number"))),
        "percents": _on(LISTING_RAW, lambda df: df.select("asin", text.to_percent(c("referral_fee_pct")).alias("share"))),
        "search_text": _on(LISTING_RAW, lambda df: df.select("asin", text.search_text(c("title")).alias("words"))),
        "clean_title": _on(CATALOG_RAW, lambda df: df.select("mpn", text.clean_title(c("title")).alias("title"))),
        "clean_title_listing": _on(LISTING_RAW, lambda df: df.select("asin", text.clean_title(c("title")).alias("title"))),
        "maker_from_title": _on(CATALOG_RAW, lambda df: df.select("mpn", text.maker_from_title(c("title")).alias("maker"))),
        "qty_extract": _on(CATALOG_RAW, lambda df: df.select("mpn", quantity.extract_quantity(c("title")).alias("q")).select("mpn", *parsed(c("q")))),
        "qty_extract_listing": _on(LISTING_RAW, lambda df: df.select("asin", quantity.extract_quantity(c("title")).alias("q")).select("asin", *parsed(c("q")))),
        "qty_levels": _on(CATALOG_RAW, lambda df: df.select("mpn", quantity.levels_quantity(c("title")).alias("quantity"))),
        "qty_field": _on(LISTING_RAW, lambda df: df.select("asin", quantity.is_quantity_field(c("size")).alias("is_quantity"))),
        "color_norm": _on(LISTING_RAW, lambda df: df.select("asin", color.norm_color(c("color")).alias("color"))),
        "color_extract": _title_read("color", color.extract_color),
        "size_norm": _on(LISTING_RAW, lambda df: df.select("asin", size.norm_size(c("size")).alias("size"))),
        "size_extract": _title_read("size", size.extract_size),
        "size_extract_catalog": _on(CATALOG_RAW, lambda df: df.select("mpn", size.extract_size(c("title")).alias("size"))),
        "size_approx": _on(PAIRS, lambda df: df.select("catalog_mpn", "asin", similarity.size_approx_match(c("catalog_size_norm"), c("keepa_size_norm")).alias("same"))),
        "contains_text": _on(LISTING_RAW, lambda df: df.select("asin", similarity.contains_text(c("title"), c("brand")).alias("found"))),
        "fuzzy_token_set": _fuzzy(similarity.fuzzy_ratio),
        "fuzzy_token_sort": _fuzzy(similarity.fuzzy_token_sort),
        "fuzzy_partial": _fuzzy(similarity.fuzzy_partial),
        "std_flags": lambda s, d: _pipeline(s, d).pairs.select(*FLAG_COLUMNS, "fuzzy_score", "catalog_qty", "keepa_qty", F.round("asin_cases", 6).alias("asin_cases")),
        "flags": own(_flagged, *FLAG_COLUMNS),
        "metrics": lambda s, d: _flagged(s, d).select("catalog_mpn", "asin", *[F.round(n, 6).alias(n) for n in METRIC_COLUMNS]),
        "score": own(lambda s, d: matching.scored(_flagged(s, d)), *SCORE_COLUMNS),
        "categorize": own(_all, "catalog_mpn", "asin", "Category", "match_reason"),
        "dedup_best": own(_best, *BEST_COLUMNS),
        "category_summary": lambda s, d: matching.category_summary(_best(s, d)),
        "export_filter": lambda s, d: report.sheets(report.filtered(_best(s, d), categories=["Certain", "High"], min_confidence=40), {"High": 50})["High"].select("catalog_mpn", "asin", "confidence_score", "fuzzy_score"),
        "export_summary": lambda s, d: report.export_summary(_best(s, d), {"Certain": 60, "Medium": 40}),
        "sheet_union": _sheets,
        "verify_candidates": lambda s, d: feedback.to_verify(_best(s, d), ["High", "Medium", "Certain"], floors={"Certain": 50}),
        "upsert_scores": lambda s, d: _upserted(_all(s, d)),
        "score_update": _updated_category,
        "rescored_best": _rescored,
        "verify_summary": _verification_summary,
        "titles_without_quantity": lambda s, d: feedback.without_quantity(*reversed(_quantity_sources(s, d)), ["Certain", "High"], "catalog"),
        "qty_fill": _filled,
        "diag_contested": lambda s, d: report.contested_listings(_all(s, d), limit=None),
        "diag_examples": lambda s, d: report.doubtful_examples(_all(s, d), _best(s, d)),
        "diag_distribution": lambda s, d: report.distribution(_best(s, d)).select("Category", "count", F.round("avg_fuzzy", 6).alias("avg_fuzzy"), "min_fuzzy", "max_fuzzy"),
        "diag_similar": lambda s, d: report.similar_by_category(_best(s, d)),
        "diag_near": lambda s, d: report.near_threshold(_best(s, d), "High"),
    }


# SQL for DuckDB


def _catalog_sql() -> str:
    return CATALOG_RAW.format(part="part")


def _listing_sql() -> str:
    return LISTING_RAW.format(part="part", lineitem="lineitem")


def _pairs_sql() -> str:
    return PAIRS.format(part="part", lineitem="lineitem")


def _quoted(items) -> str:
    return ", ".join("'" + i.replace("'", "''") + "'" for i in items)


def _s(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _d_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _d_code(x: str) -> str:
    s = f"upper(regexp_replace(coalesce({x}, ''), '[^A-Za-z0-9]', '', 'g'))"
    return f"CASE WHEN length({s}) >= 4 AND regexp_matches({s}, '[0-9]') AND NOT regexp_full_match({s}, '0+') THEN {s} END"


def _d_squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def _d_quotes(x: str) -> str:
    return f"translate({x}, {_s('×“”″′')}, {_s('x' + chr(34) * 3 + chr(39))})"


def _d_search(x: str) -> str:
    plain = _d_quotes(f"coalesce({x}, '')")
    return _d_squeeze(rf"regexp_replace(regexp_replace(lower({plain}), '[-_]+', ' ', 'g'), '[^\w\s]', ' ', 'g')")


def _d_number(x: str) -> str:
    return rf"CASE WHEN regexp_full_match(trim({x}), '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?') THEN TRY_CAST(trim({x}) AS DOUBLE) END"


def _d_title(x: str) -> str:
    inch = _s(rf'\b({text.NUMBER})\s*"')
    s = _d_quotes(f"coalesce({x}, '')")
    s = rf"regexp_replace(regexp_replace({s}, '\([^)]*\)', ' ', 'g'), {inch}, '\1', 'g')"
    s = rf"regexp_replace(lower({s}), '[-,;:()\[\]{{}}|]', ' ', 'g')"
    s = rf"regexp_replace(regexp_replace(replace({s}, '/', ' / '), '[^a-z0-9\s.\-/x]+', ' ', 'g'), '\bx\b', ' ', 'g')"
    spelled = "CASE w " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in text.ABBREVIATIONS.items()) + " ELSE w END"
    words = rf"list_transform(list_filter(regexp_split_to_array({s}, '\s+'), lambda w: w <> ''), lambda w: {spelled})"
    kept = f"list_filter({words}, lambda w: w NOT IN ({_quoted(text.STOPWORDS + text.UNIT_WORDS)}))"
    return f"nullif(array_to_string(list_transform({kept}, lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN w ELSE upper(w[1:1]) || w[2:] END), ' '), '')"


def _d_quantity(x: str) -> tuple[str, str, str]:
    t = _d_strip(f"coalesce({x}, '')")
    whole = lambda p, i: f"TRY_CAST(nullif(regexp_extract(t, {_s(p)}, {i}), '') AS BIGINT)"
    rules = [(f"{whole(quantity.COMPOUND, 1)} * {whole(quantity.COMPOUND, 2)}", "{q} BETWEEN 2 AND 100000", "compound", "high")]
    rules += [(whole(p, 1), f"{{q}} BETWEEN 1 AND 100000 AND NOT regexp_matches(regexp_extract(t, {_s(p)}, 0), {_s(quantity.VETO)})", unit, "high") for p, unit in quantity.PATTERNS]
    rules += [(whole(r"\b(\d+)\s*$", 1), "{q} BETWEEN 2 AND 1000", None, "low")]
    case = lambda value, other: "CASE " + " ".join(f"WHEN {test.replace('{q}', q)} THEN {value(q, unit, sure)}" for q, test, unit, sure in rules) + f" ELSE {other} END"
    return t, case(lambda q, u, s: q, "NULL"), f"{case(lambda q, u, s: _s(u) if u else 'NULL', 'NULL')} AS unit_type, {case(lambda q, u, s: _s(s), _s('none'))} AS confidence"


def _d_levels() -> str:
    u = quantity.LEVEL_UNIT
    step = rf"\s*[,;]\s*(\d+)\s*{u}\s*/\s*{u}"
    two, three = rf"(?i)(\d+)\s*/\s*{u}{step}", rf"(?i)(\d+)\s*/\s*{u}{step}{step}"
    part = lambda p, i: f"TRY_CAST(nullif(regexp_extract(title, {_s(p)}, {i}), '') AS BIGINT)"
    inner = lambda p: f"(CASE WHEN regexp_matches(title, {_s(quantity.SHEETS)}) THEN 1 ELSE {part(p, 1)} END)"
    return f"CASE WHEN regexp_matches(title, {_s(three)}) THEN {inner(three)} * {part(three, 2)} * {part(three, 3)} WHEN regexp_matches(title, {_s(two)}) THEN {inner(two)} * {part(two, 2)} END"


def _d_canonical(x: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {_s(a)} THEN {_s(b)}" for a, b in color.ALIASES.items()) + f" ELSE {x} END"


def _color_ctes(source: str, key: str, name: str = "co") -> str:
    """CTEs that end in name(key, color), from a source with key and title."""
    label = color.LABEL
    words = _d_search("raw")
    last = "list_filter(list_transform(string_split(raw, ','), lambda p: trim(p)), lambda p: p <> '')[-1]"
    joined = f"array_to_string(list_filter(string_split({_d_search(last)}, ' '), lambda w: regexp_full_match(w, '[a-z]+')), ' ')"
    return f"""{name}_r AS (SELECT {key}, {_d_strip("coalesce(title, '')")} AS raw FROM {source}),
    {name}_p AS (SELECT {key}, {_d_search(f"regexp_extract(raw, {_s(label)}, 1)")} AS label, ' ' || {words} || ' ' AS padded, {joined} AS last FROM {name}_r),
    {name} AS (SELECT {key}, coalesce(nullif({_d_canonical('label')}, ''), list_filter([{_quoted(color.WANTED)}], lambda c: contains(padded, ' ' || c || ' '))[1],
                          CASE WHEN {_d_canonical('last')} IN ({_quoted(color.WANTED)}) THEN {_d_canonical('last')} END) AS color FROM {name}_p)"""


def _d_value(x: str) -> str:
    part = lambda p: f"TRY_CAST(nullif(regexp_extract({x}, {_s(p)}, 1), '') AS DOUBLE)"
    over = part(r"/\s*(\d+)")
    whole = part(r"^\s*(\d+)(?:\s*-\s*|\s+)\d+\s*/")
    return f"CASE WHEN {over} IS NULL THEN TRY_CAST({x} AS DOUBLE) ELSE coalesce({whole}, 0) + {part('([0-9]+)' + chr(92) + 's*/')} / nullif({over}, 0) END"


def _d_decimal(x: str) -> str:
    return f"regexp_replace(printf('%.4f', {x}), '\\.?0+$', '')"


def _size_ctes(source: str, key: str, name: str = "si") -> str:
    """CTEs that end in name(key, size), from a source with key and title."""
    t = f"lower({_d_quotes(_d_strip('title'))})"
    for _ in range(3):  # no look-around: hyphens next to each other take turns
        t = rf"regexp_replace({t}, '(^|[^0-9])-([^0-9]|$)', '\1 \2', 'g')"
    t = f"nullif({_d_squeeze(f"regexp_replace({t}, '[^a-z0-9{chr(92)}s.{chr(92)}-/{chr(34)}]+', ' ', 'g')")}, '')"
    mixed = r"\d+\s+\d+\s*/\s*\d+"
    turns = f"list_transform(range(1, len(m) + 2), lambda i: p[i] || coalesce(CASE WHEN i <= len(m) THEN coalesce({_d_decimal('CASE WHEN ' + _d_value('m[i]') + ' IS NOT NULL THEN ' + _d_value('m[i]') + ' END')}, m[i]) END, ''))"
    wide, number, unit, end = size.WIDE, text.NUMBER, size.UNIT, size.LONG
    own = rf"regexp_replace(t, {_s(f'{wide}({number}){chr(92)}s*({unit}){end}')}, '\1\2 x \3\4', 'g')"
    own = rf"regexp_replace({own}, {_s(f'{wide}({number}){end}')}, '\1\2 x \3\2', 'g')"
    taken = rf"string_split(regexp_replace(t, {_s(f'^.*?{size.PRODUCT}.*$')}, '\1|\2|\3|\4|\5|\6|\7'), '|')"
    names = "CASE {x} " + " ".join(f"WHEN {_s(u)} THEN {_s(n)}" for u, n in size.UNIT_NAMES.items()) + " END"
    said = lambda *at: "list_filter([" + ", ".join(f"d[{i}]" for i in at) + "], lambda x: x <> '')"
    product = f"upper(trim(array_to_string(list_transform({said(1, 3, 5)}, lambda x: replace(x, ' ', '')), ' x ') || ' ' || coalesce({names.replace('{x}', said(2, 4, 6, 7) + '[1]')}, '')))"

    def measure(pattern: str, named: str) -> str:
        written = r"""regexp_replace(x, '\s*([a-z]+|")$', '')"""
        return f"list_filter(list_transform(regexp_extract_all(t, {_s(pattern)}), lambda x: CASE WHEN {_d_value(written)} IS NOT NULL THEN {_d_decimal(_d_value(written))} || ' ' || {named} END), lambda x: x IS NOT NULL)[1]"

    inches = measure(rf'\b{number}\s*"', "'IN'")
    others = measure(rf"\b{number}\s*(?:cm|mm|in|inch|inches|ft|feet|yd|yard|yards|m|meter|meters)\b", names.replace("{x}", "regexp_extract(x, '[a-z]+$')"))
    words = "[" + ", ".join(f"{{'s': {_s(f' {a} ')}, 'n': {_s(b)}}}" for a, b in size.SPELLINGS) + "]"
    return f"""{name}_t AS (SELECT {key}, {t} AS t FROM {source}), {name}_m AS (SELECT {key}, t, regexp_extract_all(t, {_s(mixed)}) AS m, regexp_split_to_array(t, {_s(mixed)}) AS p FROM {name}_t),
      {name}_f AS (SELECT {key}, CASE WHEN len(m) > 0 THEN array_to_string({turns}, '') ELSE t END AS t FROM {name}_m), {name}_w AS (SELECT {key}, {own} AS t FROM {name}_f), {name}_d AS (SELECT {key}, t, {taken} AS d FROM {name}_w),
      {name} AS (SELECT {key}, coalesce(CASE WHEN len(d) > 1 THEN {product} END, {inches}, {others}, list_filter({words}, lambda w: contains(' ' || t || ' ', w.s))[1].n) AS size FROM {name}_d)"""


def _quantity_ctes(source: str, key: str, name: str = "qu") -> str:
    t, q, rest = _d_quantity("title")
    return f"{name}_s AS (SELECT {key}, {t} AS t FROM {source}), {name} AS (SELECT {key}, {q} AS quantity, {rest} FROM {name}_s)"


def _d_color_norm(x: str) -> str:
    return f"CASE WHEN trim(coalesce({x}, '')) <> '' THEN {_d_canonical(_d_search(x))} END"


def _d_maker(x: str) -> str:
    return rf"list_filter(list_transform(regexp_split_to_array(lower({_d_strip(x)}), '\s+'), lambda w: regexp_replace(w, '[^a-z]', '', 'g')), lambda w: length(w) >= 4 AND w NOT IN ({_quoted(text.MANUFACTURER_SKIP)}))[1]"


def _std_catalog_ctes() -> str:
    """CTEs that end in cat(...), the standard catalog; mpn is unique in the source."""
    maker = f"coalesce(nullif(trim(manufacturer), ''), {_d_maker('title')})"
    return f"""ca AS ({_catalog_sql()}), {_quantity_ctes('ca', 'mpn', 'cq')}, {_color_ctes('ca', 'mpn', 'cc')}, {_size_ctes('ca', 'mpn', 'cs')},
      c1 AS (SELECT ca.mpn, {maker} AS manufacturer, trim(title) AS catalog_title, trim(uom_unit) AS uom_unit, {_d_number('uom_quantity')} AS uom_quantity, {_d_title('title')} AS catalog_title2, cc.color AS catalog_color, cs.size AS catalog_size,
             cq.quantity AS catalog_title_qty, cq.unit_type AS catalog_title_qty_unit, cq.confidence AS catalog_title_qty_confidence, {_d_levels()} AS catalog_title_hier_qty, {_d_code('ca.mpn')} AS mpn_code
             FROM ca JOIN cq ON cq.mpn = ca.mpn JOIN cc ON cc.mpn = ca.mpn JOIN cs ON cs.mpn = ca.mpn),
      c2 AS (SELECT *, coalesce(uom_quantity, CAST(catalog_title_hier_qty AS DOUBLE), CAST(catalog_title_qty AS DOUBLE)) AS stated FROM c1),
      cat AS (SELECT * EXCLUDE (stated), coalesce(stated, CASE WHEN lower(trim(uom_unit)) IN ('ea', 'each', 'pr', 'pair') THEN 1.0E0 END) AS catalog_qty, lower(coalesce(catalog_title2, '')) AS catalog_title2_lc,
             lower(coalesce(manufacturer, '')) AS manufacturer_lc, {_d_color_norm('catalog_color')} AS catalog_color_norm, {_d_size_norm('catalog_size')} AS catalog_size_norm FROM c2)"""


def _std_listing_ctes() -> str:
    """CTEs that end in lst(...), the standard listings; asin is unique in the source."""
    field = f"regexp_matches(lower(trim(coalesce(li.size, ''))), {_s(quantity.FIELD)})"
    percent = _d_number("replace(trim(referral_fee_pct), '%', '')")
    return f"""li AS ({_listing_sql()}), lf AS (SELECT asin, size AS title FROM li), {_quantity_ctes('li', 'asin', 'lq')}, {_quantity_ctes('lf', 'asin', 'fq')}, {_color_ctes('li', 'asin', 'lc')}, {_size_ctes('li', 'asin', 'ls')},
      l1 AS (SELECT li.asin, trim(title) AS keepa_title, brand AS keepa_brand, model AS keepa_model, CAST(NULL AS VARCHAR) AS variation_attributes, coalesce(nullif(li.color, ''), lc.color) AS keepa_color,
             coalesce(CASE WHEN NOT {field} THEN nullif(li.size, '') END, ls.size) AS keepa_size, CAST(NULL AS VARCHAR) AS keepa_scent,
             coalesce({_d_number('number_of_items')}, CASE WHEN {field} THEN CAST(fq.quantity AS DOUBLE) END) AS keepa_number_of_items, CAST(NULL AS DOUBLE) AS keepa_package_qty, pick_pack_fee, referral_fee,
             CASE WHEN {percent} > 1 THEN {percent} / 100 ELSE {percent} END AS referral_fee_pct, buy_box_current, buy_box_30d_avg, CAST(bought_past_month AS DOUBLE) AS bought_past_month, upc,
             CAST(NULL AS VARCHAR) AS ean, CAST(NULL AS VARCHAR) AS gtin, partnumber, {_d_title('title')} AS keepa_title2, lq.quantity AS keepa_title_qty, lq.unit_type AS keepa_title_qty_unit,
             lq.confidence AS keepa_title_qty_confidence, nullif({_d_squeeze("coalesce(model, '') || ' ' || coalesce(partnumber, '') || ' ' || coalesce(upc, '')")}, '') AS codescombined
             FROM li JOIN lq ON lq.asin = li.asin JOIN fq ON fq.asin = li.asin JOIN lc ON lc.asin = li.asin JOIN ls ON ls.asin = li.asin),
      lst AS (SELECT *, CASE WHEN keepa_number_of_items = 1 AND keepa_title_qty > 1 AND keepa_title_qty_confidence = 'high' THEN CAST(keepa_title_qty AS DOUBLE)
             ELSE coalesce(keepa_number_of_items, CAST(keepa_title_qty AS DOUBLE)) END AS keepa_qty, lower(coalesce(keepa_title2, '')) AS keepa_title2_lc, lower(coalesce(keepa_brand, '')) AS brand_lc,
             lower(coalesce(keepa_title, '')) AS title_lc, {_d_color_norm('keepa_color')} AS keepa_color_norm, {_d_size_norm('keepa_size')} AS keepa_size_norm FROM l1)"""


def _d_size_norm(x: str) -> str:
    whole = _d_strip(f"coalesce({x}, '')")
    s = f"upper({_d_quotes(whole)})"
    s = rf"""regexp_replace(regexp_replace({s}, '(\d)"', '\1', 'g'), '(\d)\s*(?:INCHES|INCH|IN)\b', '\1', 'g')"""
    return f"nullif({_d_squeeze(rf'''regexp_replace({s}, '(\d)\s*X\s*(\d)', '\1 X \2', 'g')''')}, '')"


def _d_approx(a: str, b: str) -> str:
    n = lambda x: rf"list_transform(regexp_extract_all(trim({x}), '\d+(?:\.\d+)?'), lambda v: CAST(v AS DOUBLE))"
    u = lambda x: f"regexp_extract(trim({x}), '[A-Z]{{2,}}$')"
    p, q = f"{n(a)}[i]", f"{n(b)}[i]"
    near = f"CASE WHEN {p} = 0 AND {q} = 0 THEN true WHEN {p} = 0 OR {q} = 0 THEN false ELSE abs({p} - {q}) / greatest({p}, {q}) <= 0.03 END"
    return (
        f"CASE WHEN {a} IS NULL OR {b} IS NULL OR len({n(a)}) = 0 OR len({n(a)}) <> len({n(b)}) THEN 0"
        f" WHEN len(list_filter(range(1, len({n(a)}) + 1), lambda i: NOT ({near}))) > 0 THEN 0 WHEN {u(a)} <> '' AND {u(b)} <> '' AND {u(a)} <> {u(b)} THEN 0 ELSE 1 END"
    )


def _std_pairs() -> str:
    """WITH ... pairs: the candidates of the standard tables with both sides' columns and the similarity of their titles, by longest common subsequences."""
    split = ", ".join(rf"regexp_split_to_array(coalesce({c}, ''), '[,\s;/|]+')" for c in ("keepa_model", "partnumber", "upc"))
    own = lambda x, y: f"array_to_string(list_sort(list_filter(list_distinct(string_split({x}, ' ')), lambda w: NOT list_contains(string_split({y}, ' '), w))), ' ')"
    shared = "array_to_string(list_sort(list_filter(list_distinct(string_split(a, ' ')), lambda w: list_contains(string_split(b, ' '), w))), ' ')"
    g = "list_transform(range(1, len(x) + 1), lambda i: greatest(v[i + 1], v[i] + CASE WHEN x[i:i] = y[j + 1:j + 1] THEN 1 ELSE 0 END))"
    return f"""WITH RECURSIVE {_std_catalog_ctes()}, {_std_listing_ctes()},
      ck AS (SELECT DISTINCT asin, code FROM (SELECT asin, {_d_code('x')} AS code FROM (SELECT asin, unnest(list_concat({split})) AS x FROM lst)) WHERE code IS NOT NULL),
      rare AS (SELECT code, count(*) AS code_frequency, least(1.0E0, 1 / log10(count(*) + 1)) AS code_rarity_score FROM ck GROUP BY code),
      p0 AS (SELECT mpn AS catalog_mpn, lst.asin, manufacturer AS catalog_manufacturer, uom_unit AS catalog_uom_unit, 1 AS flag_code_match, ck.code AS matched_code, code_frequency, code_rarity_score,
                    lower(coalesce(catalog_title2, '')) AS ta, lower(coalesce(keepa_title2, '')) AS tb, cat.*, lst.* EXCLUDE (asin)
             FROM cat JOIN ck ON ck.code = cat.mpn_code JOIN rare ON rare.code = ck.code JOIN lst ON lst.asin = ck.asin),
      tt AS (SELECT a, b, {own('a', 'b')} AS x, {own('b', 'a')} AS y, {shared} AS c FROM (SELECT DISTINCT ta AS a, tb AS b FROM p0)),
      lr AS (SELECT x, y, 0 AS j, list_transform(range(0, len(x) + 1), lambda i: CAST(0 AS BIGINT)) AS v FROM (SELECT DISTINCT x, y FROM tt)
             UNION ALL SELECT x, y, j + 1, list_concat([CAST(0 AS BIGINT)], list_transform(range(1, len(x) + 1), lambda k: list_max(({g})[1:k]))) FROM lr WHERE j < len(y)),
      ln AS (SELECT x, y, v[len(x) + 1] AS n FROM lr WHERE j = len(y)),
      k AS (SELECT a, b, len(c) AS c, CASE WHEN len(c) > 0 THEN 1 ELSE 0 END AS g, len(tt.x) AS p, len(tt.y) AS q, len(tt.x) + len(tt.y) - 2 * n AS e FROM tt JOIN ln ON ln.x = tt.x AND ln.y = tt.y),
      fz AS (SELECT a, b, CASE WHEN a = '' OR b = '' THEN 0.0E0 ELSE round_even(CASE WHEN c > 0 AND (p = 0 OR q = 0) THEN 100.0E0 ELSE greatest(100.0E0 * (1 - e * 1.0E0 / (2 * c + 2 * g + p + q)),
        CASE WHEN c > 0 THEN 100.0E0 * (1 - (g + p) * 1.0E0 / (2 * c + g + p)) ELSE 0 END, CASE WHEN c > 0 THEN 100.0E0 * (1 - (g + q) * 1.0E0 / (2 * c + g + q)) ELSE 0 END) END, 2) END AS fuzzy_score FROM k),
      pairs AS (SELECT p0.*, fuzzy_score FROM p0 JOIN fz ON fz.a = ta AND fz.b = tb)"""


def _flag_ctes(pairs: str | None = None) -> str:
    """WITH ... f: the pairs with flags."""
    ratio = """catalog_qty > 0 AND keepa_qty > 0 AND (
        (CAST(catalog_qty AS BIGINT) % nullif(CAST(keepa_qty AS BIGINT), 0) = 0 AND catalog_qty / nullif(keepa_qty, 0) BETWEEN 2 AND 100)
        OR (CAST(keepa_qty AS BIGINT) % nullif(CAST(catalog_qty AS BIGINT), 0) = 0 AND keepa_qty / nullif(catalog_qty, 0) BETWEEN 2 AND 100))"""
    return f"""
    {pairs or f"WITH pairs AS ({_pairs_sql()})"}, a AS (SELECT *, {_d_approx('catalog_size_norm', 'keepa_size_norm')} AS approx FROM pairs),
    f AS (SELECT *,
      CASE WHEN catalog_manufacturer IS NULL OR catalog_manufacturer = '' OR length(manufacturer_lc) < 3 THEN NULL
           WHEN strpos(brand_lc, manufacturer_lc) > 0 OR strpos(title_lc, manufacturer_lc) > 0 THEN 1 ELSE 0 END AS flag_brand_match,
      CASE WHEN catalog_mpn IS NULL OR length(catalog_mpn) < 4 THEN NULL WHEN strpos(title_lc, lower(catalog_mpn)) > 0 THEN 1 ELSE 0 END AS flag_code_in_title,
      CASE WHEN catalog_qty IS NULL OR keepa_qty IS NULL THEN NULL WHEN catalog_qty = keepa_qty THEN 1 ELSE 0 END AS flag_qty_match,
      CASE WHEN catalog_qty IS NULL OR keepa_qty IS NULL OR catalog_qty = keepa_qty THEN 0 WHEN {ratio} THEN 0 ELSE 1 END AS flag_qty_mismatch,
      CASE WHEN catalog_qty IS NULL OR keepa_qty IS NULL OR catalog_qty = keepa_qty THEN 0 WHEN {ratio} THEN 1 ELSE 0 END AS flag_qty_ratio_match,
      CASE WHEN catalog_qty IS NULL AND keepa_qty IS NULL THEN 1 ELSE 0 END AS flag_qty_both_null,
      CASE WHEN catalog_uom_unit IS NULL OR keepa_qty IS NULL THEN 0 WHEN length(catalog_mpn) >= 4 AND strpos(title_lc, lower(catalog_mpn)) > 0 THEN 0
           WHEN lower(trim(catalog_uom_unit)) IN ('ea', 'each', 'pr', 'pair') AND keepa_qty > 10 THEN 1 ELSE 0 END AS flag_unit_type_mismatch,
      CASE WHEN catalog_color_norm IS NULL OR keepa_color_norm IS NULL THEN NULL WHEN catalog_color_norm = keepa_color_norm THEN 1 ELSE 0 END AS flag_color_match,
      CASE WHEN catalog_color_norm <> keepa_color_norm THEN 1 ELSE 0 END AS flag_color_mismatch,
      CASE WHEN catalog_size_norm IS NULL OR keepa_size_norm IS NULL THEN NULL WHEN catalog_size_norm = keepa_size_norm OR approx = 1 THEN 1 ELSE 0 END AS flag_size_match,
      CASE WHEN catalog_size_norm IS NULL OR keepa_size_norm IS NULL OR catalog_size_norm = keepa_size_norm OR approx = 1 THEN 0
           WHEN starts_with(keepa_size_norm, catalog_size_norm || ' ') OR starts_with(catalog_size_norm, keepa_size_norm || ' ') THEN 0 ELSE 1 END AS flag_size_mismatch,
      CASE WHEN catalog_qty = 0 THEN NULL ELSE keepa_qty / catalog_qty END AS asin_cases FROM a)"""


def _score_ctes(pairs: str | None = None) -> str:
    one = lambda *names: " + ".join(f"(CASE WHEN flag_{n} = 1 THEN 1 ELSE 0 END)" for n in names)
    known = " + ".join(f"(CASE WHEN flag_{n} IS NOT NULL THEN 1 ELSE 0 END)" for n in matching.ASSESSED)
    points = lambda n, k: f"(CASE WHEN flag_{n} = 1 THEN {k} ELSE 0 END)"
    plus = " + ".join(points(n, k) for n, k in (("brand_match", 15), ("code_in_title", 10), ("qty_match", 25), ("qty_both_null", 10), ("qty_ratio_match", 10), ("color_match", 15), ("size_match", 15)))
    minus = " - ".join(points(n, k) for n, k in (("unit_type_mismatch", 20), ("color_mismatch", 15), ("size_mismatch", 15)))
    return f"""{_flag_ctes(pairs)}, sc AS (SELECT *, {one(*matching.POSITIVE)} AS positive_flags, {one(*matching.NEGATIVE)} AS negative_flags, {known} AS available_flags,
      CASE WHEN {known} = 0 THEN 0.0 ELSE ({one(*matching.ASSESSED)}) * 1.0E0 / ({known}) END AS score_ratio,
      CAST((CASE WHEN flag_code_match = 1 THEN (CASE WHEN code_rarity_score IS NULL THEN NULL ELSE round(20 * least(1.0E0, code_rarity_score * 1.2E0)) END) ELSE 0 END) + {plus}
       + (CASE WHEN fuzzy_score >= 80 THEN 15 WHEN fuzzy_score >= 60 THEN 10 WHEN fuzzy_score >= 40 THEN 5 ELSE 0 END)
       - (CASE WHEN flag_qty_mismatch = 1 THEN (CASE WHEN fuzzy_score >= 70 THEN 15 WHEN fuzzy_score >= 40 THEN 30 ELSE 45 END) ELSE 0 END) - {minus} AS DOUBLE) AS confidence_score FROM f)"""


def _all_ctes(pairs: str | None = None) -> str:
    return f"""{_score_ctes(pairs)}, m AS (SELECT *, CASE
      WHEN fuzzy_score >= 90 AND negative_flags = 0 THEN 'Certain'
      WHEN fuzzy_score >= 85 AND confidence_score >= 60 AND negative_flags = 0 THEN 'Certain'
      WHEN fuzzy_score >= 85 AND flag_code_match = 1 AND negative_flags = 0 THEN 'Certain'
      WHEN fuzzy_score >= 75 AND confidence_score >= 65 AND negative_flags = 0 THEN 'Certain'
      WHEN fuzzy_score >= 40 AND flag_code_match = 1 AND flag_brand_match = 1 AND (flag_qty_match = 1 OR flag_qty_both_null = 1 OR flag_qty_ratio_match = 1 OR fuzzy_score >= 70) AND negative_flags = 0 THEN 'Certain'
      WHEN fuzzy_score >= 40 AND confidence_score >= 70 AND negative_flags = 0 THEN 'Certain'
      WHEN fuzzy_score >= 90 AND confidence_score >= 50 AND flag_qty_mismatch = 1 AND flag_size_mismatch = 0 AND flag_color_mismatch = 0 AND flag_unit_type_mismatch = 0 THEN 'Certain'
      WHEN flag_code_match = 1 AND flag_brand_match = 1 AND flag_qty_match = 1 AND negative_flags = 0 AND confidence_score >= 55 THEN 'Certain'
      WHEN flag_code_match = 1 AND flag_brand_match = 1 AND (flag_size_match = 1 OR flag_color_match = 1) AND flag_qty_mismatch = 0 AND flag_unit_type_mismatch = 0 AND negative_flags = 0 AND fuzzy_score >= 25 THEN 'Certain'
      WHEN fuzzy_score >= 85 AND negative_flags <= 1 AND flag_unit_type_mismatch = 0 THEN 'High'
      WHEN fuzzy_score >= 75 AND negative_flags <= 1 AND flag_qty_mismatch = 0 AND flag_unit_type_mismatch = 0 THEN 'High'
      WHEN fuzzy_score >= 60 AND flag_code_match = 1 AND flag_qty_mismatch = 0 AND flag_unit_type_mismatch = 0 THEN 'High'
      WHEN fuzzy_score >= 25 AND flag_code_match = 1 AND flag_brand_match = 1 AND flag_qty_mismatch = 0 AND flag_unit_type_mismatch = 0 THEN 'High'
      WHEN fuzzy_score >= 25 AND confidence_score >= 50 AND flag_qty_mismatch = 0 AND flag_unit_type_mismatch = 0 THEN 'High'
      WHEN fuzzy_score >= 40 AND flag_code_match = 1 AND positive_flags >= 2 THEN 'Medium'
      WHEN confidence_score >= 30 AND positive_flags >= 2 THEN 'Medium'
      WHEN flag_code_match = 1 AND flag_brand_match = 1 AND fuzzy_score >= 25 AND negative_flags <= 1 THEN 'Medium'
      WHEN flag_code_match = 1 AND negative_flags = 0 AND fuzzy_score >= 15 AND confidence_score >= 20 THEN 'Medium'
      WHEN fuzzy_score < 30 OR negative_flags >= 2 OR flag_qty_mismatch = 1 OR flag_unit_type_mismatch = 1 OR confidence_score < 20 OR (positive_flags < 2 AND fuzzy_score < 40) OR (flag_brand_match = 0 AND fuzzy_score < 40) THEN 'Verify'
      ELSE 'Medium' END AS Category,
      CASE WHEN flag_code_match = 1 AND flag_brand_match = 1 AND flag_qty_match = 1 THEN 'Code + Brand + Qty match'
           WHEN flag_code_match = 1 AND flag_brand_match = 1 AND flag_qty_ratio_match = 1 THEN 'Code + Brand + Qty ratio match'
           WHEN flag_code_match = 1 AND flag_brand_match = 1 THEN 'Code + Brand match' WHEN flag_code_match = 1 AND fuzzy_score >= 70 THEN 'Code match + High title similarity'
           WHEN flag_unit_type_mismatch = 1 THEN 'Unit type mismatch (single vs bulk)' WHEN flag_code_match = 1 THEN 'Code match only'
           WHEN fuzzy_score >= 80 THEN 'High title similarity' ELSE 'Weak signals' END AS match_reason FROM sc)"""


_RANK = "CASE Category WHEN 'Certain' THEN 4 WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END"


def _best_cte(source: str, name: str) -> str:
    return f"""{name} AS (SELECT * FROM (SELECT *, {_RANK} AS cat_rank, row_number() OVER (PARTITION BY asin ORDER BY {_RANK} DESC, confidence_score DESC NULLS LAST, fuzzy_score DESC,
      length(coalesce(matched_code, '')) DESC, positive_flags DESC, negative_flags, catalog_mpn, matched_code NULLS FIRST) AS rn FROM {source})
      WHERE rn = 1 AND fuzzy_score >= 15 AND NOT (fuzzy_score < 25 AND negative_flags >= 2 AND confidence_score < -10))"""


def _scores_ctes() -> str:
    n = "TRY_CAST(right(catalog_mpn, 3) AS INT)"
    return f"""old AS (SELECT DISTINCT catalog_mpn AS mpn, asin, ({n} % 11) / 10.0E0 AS ai_match_score, 'first' AS ai_reasoning, 'High' AS original_category FROM m WHERE {n} % 3 = 0),
      new AS (SELECT DISTINCT catalog_mpn AS mpn, asin, CASE WHEN {n} % 12 = 0 THEN ({n} % 10) / 10.0E0 END AS ai_match_score, 'second' AS ai_reasoning, 'High' AS original_category FROM m WHERE {n} % 6 = 0),
      scores AS (SELECT * FROM new UNION ALL SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.mpn = old.mpn AND new.asin = old.asin)),
      u AS (SELECT m.* REPLACE (CASE WHEN s.mpn IS NULL THEN m.Category WHEN s.ai_match_score >= 0.9 AND fuzzy_score >= 40 THEN 'Certain' WHEN s.ai_match_score >= 0.7 THEN 'High'
        WHEN s.ai_match_score >= 0.3 THEN 'Medium' WHEN fuzzy_score >= 90 THEN 'High' WHEN fuzzy_score >= 75 AND confidence_score >= 40 THEN 'High' WHEN confidence_score >= 50 THEN 'Medium'
        WHEN fuzzy_score >= 50 THEN 'Medium' ELSE 'Verify' END AS Category) FROM m LEFT JOIN scores s ON s.mpn = m.catalog_mpn AND s.asin = m.asin)"""


def _lcs_sql(first: str, select: str) -> str:
    """Longest common subsequences of columns x and y, a row of the table a step. `first`: CTEs that end in s(id, x, y, ...)."""
    g = "list_transform(range(1, len(x) + 1), lambda i: greatest(v[i + 1], v[i] + CASE WHEN x[i:i] = y[j + 1:j + 1] THEN 1 ELSE 0 END))"
    return f"""WITH RECURSIVE {first},
      r AS (SELECT id, x, y, 0 AS j, list_transform(range(0, len(x) + 1), lambda i: CAST(0 AS BIGINT)) AS v FROM s
            UNION ALL SELECT id, x, y, j + 1, list_concat([CAST(0 AS BIGINT)], list_transform(range(1, len(x) + 1), lambda k: list_max(({g})[1:k]))) FROM r WHERE j < len(y)),
      l AS (SELECT id, v[len(x) + 1] AS n FROM r WHERE j = len(y)) {select}"""


def _neighbours_sql() -> str:
    return "t AS (SELECT a.p_partkey AS id, lower(a.p_name || ' ' || a.p_type) AS a, lower(b.p_name || ' ' || b.p_type) AS b FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1)"


def _token_sort_sql() -> str:
    words = lambda x: f"array_to_string(list_sort(string_split({x}, ' ')), ' ')"
    return _lcs_sql(f"{_neighbours_sql()}, s AS (SELECT id, {words('a')} AS x, {words('b')} AS y FROM t)", "SELECT s.id AS p_partkey, round(200.0E0 * n / (len(x) + len(y)), 2) AS score FROM s JOIN l ON s.id = l.id")


def _token_set_sql() -> str:
    own = lambda x, y: f"array_to_string(list_sort(list_filter(list_distinct(string_split({x}, ' ')), lambda w: NOT list_contains(string_split({y}, ' '), w))), ' ')"
    shared = "array_to_string(list_sort(list_filter(list_distinct(string_split(a, ' ')), lambda w: list_contains(string_split(b, ' '), w))), ' ')"
    select = """, k AS (SELECT s.id, len(c) AS c, CASE WHEN len(c) > 0 THEN 1 ELSE 0 END AS g, len(x) AS p, len(y) AS q, len(x) + len(y) - 2 * n AS e FROM s JOIN l ON s.id = l.id)
      SELECT id AS p_partkey, round(CASE WHEN c > 0 AND (p = 0 OR q = 0) THEN 100.0E0 ELSE greatest(100.0E0 * (1 - e * 1.0E0 / (2 * c + 2 * g + p + q)),
        CASE WHEN c > 0 THEN 100.0E0 * (1 - (g + p) * 1.0E0 / (2 * c + g + p)) ELSE 0 END, CASE WHEN c > 0 THEN 100.0E0 * (1 - (g + q) * 1.0E0 / (2 * c + g + q)) ELSE 0 END) END, 2) AS score FROM k"""
    return _lcs_sql(f"{_neighbours_sql()}, s AS (SELECT id, {own('a', 'b')} AS x, {own('b', 'a')} AS y, {shared} AS c FROM t)", select)


def oracle_sql() -> dict[str, str]:
    listing, catalog, every = _listing_sql(), _catalog_sql(), _all_ctes()
    best = f"{every}, {_best_cte('m', 'best')}"
    codes = rf"c AS (SELECT DISTINCT asin, code FROM (SELECT asin, {_d_code('x')} AS code FROM (SELECT asin, unnest(list_concat(regexp_split_to_array(coalesce(model, ''), '[,\s;/|]+'), regexp_split_to_array(coalesce(partnumber, ''), '[,\s;/|]+'), regexp_split_to_array(coalesce(upc, ''), '[,\s;/|]+'))) AS x FROM li)) WHERE code IS NOT NULL)"
    df = "df AS (SELECT code, count(*) AS asin_count, least(1.0E0, 1 / log10(count(*) + 1)) AS code_rarity_score FROM c GROUP BY code)"
    on = lambda source, select: f"WITH src AS ({source}) SELECT {select} FROM src"
    rest = "catalog_mpn, asin, Category, match_reason, confidence_score, fuzzy_score, cat_rank, rn"
    percent = _d_number("replace(trim(referral_fee_pct), '%', '')")
    maker = _d_maker("title")
    wanted = f"""std AS (SELECT mpn, title AS catalog_title, {_d_number('uom_quantity')} AS catalog_qty FROM ({catalog})),
      w AS (SELECT DISTINCT mpn AS id, catalog_title AS title FROM std WHERE catalog_qty IS NULL AND mpn IN (SELECT catalog_mpn FROM best WHERE Category IN ('Certain', 'High')))"""
    counted = "CAST(count(*) AS BIGINT) AS count"
    return {
        "norm_codes": on(listing, f"asin, {_d_code('partnumber')} AS code, {_d_code('model')} AS model_code"),
        "code_explode": f"WITH li AS ({listing}), {codes} SELECT asin, code FROM c",
        "joined_codes": on(listing, f"asin, nullif({_d_squeeze("coalesce(model, '') || ' ' || coalesce(partnumber, '') || ' ' || coalesce(upc, '')")}, '') AS codes"),
        "code_rarity": f"WITH li AS ({listing}), {codes}, {df} SELECT code, asin_count, code_rarity_score FROM df",
        "candidates": f"WITH li AS ({listing}), ca AS ({catalog}), {codes}, {df}, cc AS (SELECT DISTINCT mpn, {_d_code('mpn')} AS code FROM ca) SELECT cc.mpn, c.asin, c.code AS matched_code, df.asin_count AS code_frequency, df.code_rarity_score, 1 AS flag_code_match FROM cc JOIN df ON cc.code = df.code JOIN c ON c.code = cc.code",
        "numbers": on(catalog, f"mpn, {_d_number('uom_quantity')} AS number"),
        "percents": on(listing, f"asin, CASE WHEN {percent} > 1 THEN {percent} / 100 ELSE {percent} END AS share"),
        "search_text": on(listing, f"asin, {_d_search('title')} AS words"),
        "clean_title": on(catalog, f"mpn, {_d_title('title')} AS title"),
        "clean_title_listing": on(listing, f"asin, {_d_title('title')} AS title"),
        "maker_from_title": on(catalog, f"mpn, {maker} AS maker"),
        "qty_extract": f"WITH src AS ({catalog}), {_quantity_ctes('src', 'mpn')} SELECT * FROM qu",
        "qty_extract_listing": f"WITH src AS ({listing}), {_quantity_ctes('src', 'asin')} SELECT * FROM qu",
        "qty_levels": on(catalog, f"mpn, {_d_levels()} AS quantity"),
        "qty_field": on(listing, f"asin, regexp_matches(lower(trim(coalesce(size, ''))), {_s(quantity.FIELD)}) AS is_quantity"),
        "color_norm": on(listing, f"asin, CASE WHEN trim(coalesce(color, '')) <> '' THEN {_d_canonical(_d_search('color'))} END AS color"),
        "color_extract": f"WITH src AS ({listing}), {_color_ctes('src', 'asin')} SELECT asin, color FROM co",
        "size_extract": f"WITH src AS ({listing}), {_size_ctes('src', 'asin')} SELECT asin, size FROM si",
        "size_extract_catalog": f"WITH src AS ({catalog}), {_size_ctes('src', 'mpn')} SELECT mpn, size FROM si",
        "std_catalog": f"WITH {_std_catalog_ctes()} SELECT {', '.join(standardize.CATALOG_COLUMNS)} FROM cat",
        "std_listing": f"WITH {_std_listing_ctes()} SELECT {', '.join(standardize.LISTING_COLUMNS)} FROM lst",
        "size_norm": on(listing, f"asin, {_d_size_norm('size')} AS size"),
        "size_approx": on(_pairs_sql(), f"catalog_mpn, asin, {_d_approx('catalog_size_norm', 'keepa_size_norm')} AS same"),
        "contains_text": on(listing, "asin, CASE WHEN coalesce(brand, '') <> '' AND contains(lower(title), lower(brand)) THEN 1 ELSE 0 END AS found"),
        "fuzzy_token_set": _token_set_sql(),
        "fuzzy_token_sort": _token_sort_sql(),
        "std_flags": f"{_flag_ctes(_std_pairs())} SELECT {', '.join(FLAG_COLUMNS)}, fuzzy_score, catalog_qty, keepa_qty, round(asin_cases, 6) AS asin_cases FROM f",
        "pipeline_full": f"{_all_ctes(_std_pairs())}, {_best_cte('m', 'best')} SELECT catalog_mpn, asin, Category, match_reason, fuzzy_score, confidence_score, positive_flags, negative_flags, catalog_qty, keepa_qty FROM best",
        "flags": f"{_flag_ctes()} SELECT {', '.join(FLAG_COLUMNS)} FROM f",
        "metrics": f"""{_flag_ctes()} SELECT catalog_mpn, asin, round(asin_cases, 6) AS asin_cases, round((buy_box_current - pick_pack_fee - referral_fee - 0.22E0) / nullif(asin_cases, 0), 6) AS break_even_cost_now,
          round((buy_box_30d_avg - pick_pack_fee - referral_fee_pct * buy_box_30d_avg - 0.22E0) / nullif(asin_cases, 0), 6) AS break_even_cost_30day, round(bought_past_month * buy_box_30d_avg, 6) AS estimate_revenue FROM f""",
        "score": f"{_score_ctes()} SELECT {', '.join(SCORE_COLUMNS)} FROM sc",
        "categorize": f"{every} SELECT catalog_mpn, asin, Category, match_reason FROM m",
        "dedup_best": f"{best} SELECT {rest} FROM best",
        "category_summary": f"{best} SELECT Category, {counted}, round(avg(fuzzy_score), 1) AS avg_fuzzy, round(avg(confidence_score), 1) AS avg_confidence FROM best GROUP BY Category",
        "export_filter": f"{best} SELECT catalog_mpn, asin, confidence_score, fuzzy_score FROM best WHERE Category = 'High' AND confidence_score >= 40 AND fuzzy_score >= 50",
        "export_summary": f"""{best} SELECT Category, {counted}, round(avg(confidence_score), 1) AS avg_confidence, round(avg(fuzzy_score), 1) AS avg_fuzzy, CAST(0 AS BIGINT) AS with_ai_score FROM best
          WHERE fuzzy_score >= CASE Category WHEN 'Certain' THEN 60 WHEN 'Medium' THEN 40 ELSE -1 END GROUP BY Category""",
        "sheet_union": "SELECT p_partkey, p_name, NULL AS p_size, NULL AS p_brand FROM part UNION ALL SELECT p_partkey, NULL, p_size, NULL FROM part UNION ALL SELECT NULL, NULL, NULL, p_brand FROM part",
        "verify_candidates": f"""{best} SELECT catalog_mpn, asin, catalog_title, keepa_title, catalog_qty, keepa_qty, matched_code, fuzzy_score, confidence_score, positive_flags, negative_flags, match_reason, Category FROM best
          WHERE (Category = 'High' AND fuzzy_score >= 30 AND fuzzy_score < 85) OR (Category = 'Medium' AND fuzzy_score >= 50 AND fuzzy_score < 90) OR (Category = 'Certain' AND fuzzy_score >= 50)""",
        "upsert_scores": f"{every}, {_scores_ctes()} SELECT mpn, asin, ai_match_score, ai_reasoning, original_category FROM scores",
        "score_update": f"{every}, {_scores_ctes()} SELECT catalog_mpn, asin, Category FROM u",
        "rescored_best": f"{every}, {_scores_ctes()}, {_best_cte('u', 'best2')} SELECT {rest} FROM best2",
        "verify_summary": f"""{every}, {_scores_ctes()}, z AS (SELECT s.ai_match_score AS s, {_RANK.replace('Category', 'm.Category')} AS b, {_RANK.replace('Category', 'u.Category')} AS a FROM scores s
          JOIN m ON m.catalog_mpn = s.mpn AND m.asin = s.asin JOIN u ON u.catalog_mpn = s.mpn AND u.asin = s.asin)
          SELECT CAST(count(*) AS BIGINT) AS scored, count_if(s >= 0.7) AS sure, count_if(s >= 0.3 AND s < 0.7) AS unsure, count_if(s < 0.3) AS unlikely, count_if(a > b) AS upgraded, count_if(a < b) AS downgraded, count_if(a = b) AS unchanged FROM z""",
        "titles_without_quantity": f"{best}, {wanted} SELECT id, title FROM w",
        "qty_fill": f"{best}, {wanted} SELECT mpn, coalesce(catalog_qty, CASE WHEN w.id IS NOT NULL AND length(title) % 40 - 3 > 0 THEN CAST(length(title) % 40 - 3 AS DOUBLE) END) AS catalog_qty FROM std LEFT JOIN w ON w.id = std.mpn",
        "diag_contested": f"""{every}, g AS (SELECT asin, CAST(count(*) AS BIGINT) AS match_count, max(fuzzy_score) AS max_fuzzy, string_agg(DISTINCT Category, ',' ORDER BY Category) AS categories FROM m GROUP BY asin)
          SELECT * FROM g WHERE match_count > 1 AND max_fuzzy > 85 AND contains(categories, 'Verify')""",
        "diag_examples": f"""{best} SELECT asin, catalog_mpn, fuzzy_score, score_ratio, flag_code_match, flag_brand_match, Category, matched_code FROM m
          WHERE asin IN (SELECT asin FROM best WHERE fuzzy_score > 85 AND Category <> 'Certain' ORDER BY asin LIMIT 3)""",
        "diag_distribution": f"{best} SELECT Category, {counted}, round(avg(fuzzy_score), 6) AS avg_fuzzy, min(fuzzy_score) AS min_fuzzy, max(fuzzy_score) AS max_fuzzy FROM best GROUP BY Category",
        "diag_similar": f"{best} SELECT Category, {counted} FROM best WHERE fuzzy_score > 85 GROUP BY Category",
        "diag_near": f"{best} SELECT asin, catalog_mpn, fuzzy_score, Category, flag_code_match, flag_brand_match FROM best WHERE Category = 'High' ORDER BY fuzzy_score DESC, asin LIMIT 10",
    }
