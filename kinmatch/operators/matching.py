"""Blocking on codes, agreement and contradiction flags, score, category, and the best match of each listing."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import fuzzy_ratio, size_approx_match

CATEGORIES = ("Certain", "High", "Medium", "Verify")
SINGLE_UNITS = ("ea", "each", "pr", "pair")
POSITIVE = ("code_match", "brand_match", "code_in_title", "qty_match", "qty_both_null", "qty_ratio_match", "color_match", "size_match")
NEGATIVE = ("qty_mismatch", "unit_type_mismatch", "color_mismatch", "size_mismatch")
ASSESSED = ("code_match", "brand_match", "code_in_title", "qty_match", "color_match", "size_match")


def rarity(n: Column) -> Column:
    return F.least(F.lit(1.0), 1 / F.log10(n + 1))


def code_rarity(codes: DataFrame) -> DataFrame:
    """code, asin_count, code_rarity_score. codes: distinct (asin, code), so rows are counted and no distinct count is needed; dealt by code, in the parts they are in."""
    n = F.count(F.lit(1))
    return codes.groupBy("code").agg(n.alias("asin_count"), rarity(n).alias("code_rarity_score"))


def candidates(catalog_codes: DataFrame, listing_codes: DataFrame, n: int | None = None) -> DataFrame:
    """All pairs with a common code; they are distinct as both inputs are. A listing's codes are dealt and sorted once, for the count and the join.

    With n, both are dealt by code into so many parts (listing_codes comes dealt so): AQE's partitions would hold ever more rows as the tables grow.
    """
    counted = listing_codes.withColumn("code_frequency", F.count(F.lit(1)).over(Window.partitionBy("code")))
    pairs = (catalog_codes.repartition(n, "code") if n else catalog_codes).join(counted, "code")
    return pairs.select("mpn", "asin", F.col("code").alias("matched_code"), "code_frequency", rarity(F.col("code_frequency")).alias("code_rarity_score"), F.lit(1).alias("flag_code_match"))


def paired(cand: DataFrame, catalog: DataFrame, listing: DataFrame) -> DataFrame:
    """Candidates with the columns of both sides that flags, metrics and reports need, and the fuzzy score of the cleaned titles."""
    c = catalog.select("mpn", F.col("manufacturer").alias("catalog_manufacturer"), "manufacturer_lc", "catalog_title", "catalog_title2", "catalog_qty", F.col("uom_unit").alias("catalog_uom_unit"), "catalog_color", "catalog_size", "catalog_color_norm", "catalog_size_norm")
    k = listing.select("asin", "keepa_title", "keepa_title2", "keepa_brand", "keepa_color", "keepa_size", "keepa_color_norm", "keepa_size_norm", "keepa_qty", F.col("codescombined").alias("keepa_codescombined"), "brand_lc", "title_lc", "buy_box_current", "buy_box_30d_avg", "bought_past_month", "pick_pack_fee", "referral_fee", "referral_fee_pct")
    both = cand.join(c, "mpn").join(k, "asin").withColumnRenamed("mpn", "catalog_mpn")
    return both.withColumn("fuzzy_score", fuzzy_ratio(F.col("catalog_title2"), F.col("keepa_title2")))


def flags() -> dict[str, Column]:
    """All flags over the columns of `paired`: null not assessable, 0 assessed and false, 1 true."""
    c = F.col
    maker, mpn, title = c("manufacturer_lc"), c("catalog_mpn"), c("title_lc")
    a, b = c("catalog_qty"), c("keepa_qty")
    code_in_title = F.contains(title, F.lower(mpn))
    no_qty = a.isNull() | b.isNull()
    clean = lambda x, y: (F.try_mod(x.cast("bigint"), y.cast("bigint")) == 0) & F.try_divide(x, y).between(2, 100)
    multiple = (a > 0) & (b > 0) & (clean(a, b) | clean(b, a))
    color, keepa_color = c("catalog_color_norm"), c("keepa_color_norm")
    size, keepa_size = c("catalog_size_norm"), c("keepa_size_norm")
    same_size = (size == keepa_size) | (size_approx_match(size, keepa_size) == 1)
    yes = lambda x: F.when(x, 1).otherwise(0)
    unless = lambda missing, x, then=None: F.when(missing, F.lit(then)).otherwise(yes(x)).cast("int")
    return {
        "flag_brand_match": unless(F.coalesce(c("catalog_manufacturer"), F.lit("")).eqNullSafe("") | (F.length(maker) < 3), F.contains(c("brand_lc"), maker) | F.contains(title, maker)),
        "flag_code_in_title": unless(mpn.isNull() | (F.length(mpn) < 4), code_in_title),
        "flag_qty_match": unless(no_qty, a == b),
        "flag_qty_mismatch": unless(no_qty, (a != b) & ~multiple, 0),
        "flag_qty_ratio_match": unless(no_qty, (a != b) & multiple, 0),
        "flag_qty_both_null": yes(a.isNull() & b.isNull()),
        "flag_unit_type_mismatch": yes((b > 10) & F.lower(F.trim(c("catalog_uom_unit"))).isin(*SINGLE_UNITS) & ~F.coalesce((F.length(mpn) >= 4) & code_in_title, F.lit(False))),
        "flag_color_match": unless(color.isNull() | keepa_color.isNull(), color == keepa_color),
        "flag_color_mismatch": unless(color.isNull() | keepa_color.isNull(), color != keepa_color, 0),
        "flag_size_match": unless(size.isNull() | keepa_size.isNull(), same_size),
        "flag_size_mismatch": unless(size.isNull() | keepa_size.isNull(), ~same_size & ~F.startswith(keepa_size, F.concat(size, F.lit(" "))) & ~F.startswith(size, F.concat(keepa_size, F.lit(" "))), 0),
    }


def metrics() -> dict[str, Column]:
    c = F.col
    cases = F.when(c("catalog_qty") != 0, c("keepa_qty") / c("catalog_qty"))
    bb, bb30 = c("buy_box_current"), c("buy_box_30d_avg")
    return {
        "asin_cases": cases,
        "break_even_cost_now": F.try_divide(bb - c("pick_pack_fee") - c("referral_fee") - F.lit(0.22), cases),
        "break_even_cost_30day": F.try_divide(bb30 - c("pick_pack_fee") - c("referral_fee_pct") * bb30 - F.lit(0.22), cases),
        "estimate_revenue": c("bought_past_month") * bb30,
    }


#: The columns of the table of flags, in order.
VALIDATED = """catalog_mpn asin catalog_manufacturer catalog_title catalog_title2 catalog_qty catalog_uom_unit catalog_color catalog_size
catalog_color_norm catalog_size_norm keepa_title keepa_title2 keepa_brand keepa_color keepa_size keepa_color_norm keepa_size_norm keepa_qty
keepa_codescombined fuzzy_score matched_code code_frequency code_rarity_score flag_code_match flag_brand_match flag_code_in_title
flag_qty_match flag_qty_mismatch flag_qty_ratio_match flag_qty_both_null flag_unit_type_mismatch flag_color_match flag_color_mismatch
flag_size_match flag_size_mismatch asin_cases buy_box_current buy_box_30d_avg bought_past_month break_even_cost_now break_even_cost_30day
estimate_revenue""".split()


def validated(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns(flags() | metrics()).select(*VALIDATED)


def _is(flag: str) -> Column:
    return F.coalesce(F.col(f"flag_{flag}") == 1, F.lit(False))


def _many(names, test) -> Column:
    total = F.lit(0)
    for n in names:
        total = total + F.when(test(n), 1).otherwise(0)
    return total


def _steps(value: Column, *steps: tuple[float, float], otherwise: float = 0) -> Column:
    out = F.when(value >= steps[0][0], steps[0][1])
    for at, points in steps[1:]:
        out = out.when(value >= at, points)
    return out.otherwise(otherwise)


def scored(flagged: DataFrame) -> DataFrame:
    """With the counts of positive, negative and available flags, their ratio, and the weighted confidence score."""
    fuzzy, rarity = F.col("fuzzy_score"), F.col("code_rarity_score")
    available, agreeing = _many(ASSESSED, lambda n: F.col(f"flag_{n}").isNotNull()), _many(ASSESSED, _is)
    points = lambda flag, n: F.when(_is(flag), n).otherwise(0)
    code = F.when(_is("code_match"), F.round(20 * F.when(rarity.isNotNull(), F.least(F.lit(1.0), rarity * 1.2)))).otherwise(0.0)
    confidence = (
        code
        + points("brand_match", 15)
        + points("code_in_title", 10)
        + points("qty_match", 25)
        + points("qty_both_null", 10)
        + points("qty_ratio_match", 10)
        + points("color_match", 15)
        + points("size_match", 15)
        + _steps(fuzzy, (80, 15), (60, 10), (40, 5))
        - F.when(_is("qty_mismatch"), _steps(fuzzy, (70, 15), (40, 30), otherwise=45)).otherwise(0)
        - points("unit_type_mismatch", 20)
        - points("color_mismatch", 15)
        - points("size_mismatch", 15)
    )
    return flagged.withColumns(
        {
            "positive_flags": _many(POSITIVE, _is),
            "negative_flags": _many(NEGATIVE, _is),
            "available_flags": available,
            "score_ratio": F.coalesce(F.try_divide(agreeing.cast("double"), available.cast("double")), F.lit(0.0)),
            "confidence_score": confidence.cast("double"),
        }
    )


def category_rules() -> list[tuple[Column, str]]:
    """The decision list; the first rule that holds decides, and a comparison with null doesn't hold."""
    f, c, n, p = (F.col(x) for x in ("fuzzy_score", "confidence_score", "negative_flags", "positive_flags"))
    code, brand, qty = _is("code_match"), _is("brand_match"), _is("qty_match")
    qty_off, unit_off = _is("qty_mismatch"), _is("unit_type_mismatch")
    any_qty = qty | _is("qty_both_null") | _is("qty_ratio_match")
    clear, fits = n == 0, ~qty_off & ~unit_off
    rules = {
        "Certain": [
            (f >= 90) & clear,
            (f >= 85) & (c >= 60) & clear,
            (f >= 85) & code & clear,
            (f >= 75) & (c >= 65) & clear,
            (f >= 40) & code & brand & (any_qty | (f >= 70)) & clear,
            (f >= 40) & (c >= 70) & clear,
            (f >= 90) & (c >= 50) & qty_off & ~_is("size_mismatch") & ~_is("color_mismatch") & ~unit_off,
            code & brand & qty & clear & (c >= 55),
            code & brand & (_is("size_match") | _is("color_match")) & fits & clear & (f >= 25),
        ],
        "High": [
            (f >= 85) & (n <= 1) & ~unit_off,
            (f >= 75) & (n <= 1) & fits,
            (f >= 60) & code & fits,
            (f >= 25) & code & brand & fits,
            (f >= 25) & (c >= 50) & fits,
        ],
        "Medium": [(f >= 40) & code & (p >= 2), (c >= 30) & (p >= 2), code & brand & (f >= 25) & (n <= 1), code & clear & (f >= 15) & (c >= 20)],
        "Verify": [f < 30, n >= 2, qty_off, unit_off, c < 20, (p < 2) & (f < 40), (F.col("flag_brand_match") == 0) & (f < 40)],
    }
    return [(rule, category) for category, own in rules.items() for rule in own]


def reason_rules() -> list[tuple[Column, str]]:
    code, brand, f = _is("code_match"), _is("brand_match"), F.col("fuzzy_score")
    return [
        (code & brand & _is("qty_match"), "Code + Brand + Qty match"),
        (code & brand & _is("qty_ratio_match"), "Code + Brand + Qty ratio match"),
        (code & brand, "Code + Brand match"),
        (code & (f >= 70), "Code match + High title similarity"),
        (_is("unit_type_mismatch"), "Unit type mismatch (single vs bulk)"),
        (code, "Code match only"),
        (f >= 80, "High title similarity"),
    ]


def decide(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    out = F.when(rules[0][0], rules[0][1])
    for rule, label in rules[1:]:
        out = out.when(rule, label)
    return out.otherwise(otherwise)


def categorized(scores: DataFrame) -> DataFrame:
    return scores.withColumns({"Category": decide(category_rules(), "Medium"), "match_reason": decide(reason_rules(), "Weak signals")})


def category_rank(category: Column | str = "Category") -> Column:
    """4 for the surest category down to 1."""
    c = F.col(category) if isinstance(category, str) else category
    return F.when(c == "Certain", 4).when(c == "High", 3).when(c == "Medium", 2).otherwise(1)


def best_per_listing(matches: DataFrame) -> DataFrame:
    """The best match of each listing with cat_rank and rn, unless it is below the floor; a better match below it isn't replaced by a lesser one.

    Ties are broken by catalog number and code, so the result does not depend on how rows are dealt.
    """
    order = [F.desc("cat_rank"), F.desc("confidence_score"), F.desc("fuzzy_score"), F.desc(F.length(F.coalesce("matched_code", F.lit("")))), F.desc("positive_flags"), F.asc("negative_flags"), F.asc("catalog_mpn"), F.asc("matched_code")]
    ranked = matches.withColumn("cat_rank", category_rank()).withColumn("rn", F.row_number().over(Window.partitionBy("asin").orderBy(*order)))
    hopeless = (F.col("fuzzy_score") < 25) & (F.col("negative_flags") >= 2) & (F.col("confidence_score") < -10)
    return ranked.where((F.col("rn") == 1) & (F.col("fuzzy_score") >= 15) & ~hopeless)


def category_summary(matches: DataFrame) -> DataFrame:
    """Count and mean scores of each category, the surest first."""
    sums = matches.groupBy("Category").agg(F.count(F.lit(1)).alias("count"), F.round(F.avg("fuzzy_score"), 1).alias("avg_fuzzy"), F.round(F.avg("confidence_score"), 1).alias("avg_confidence"))
    return sums.orderBy(F.desc(category_rank()))
