"""Raw catalog and listing sheets as standard tables, one projection each, and their code tables."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dealing import once_a_value, parts
from ..functions.color import extract_color, norm_color
from ..functions.quantity import extract_quantity, is_quantity_field, levels_quantity
from ..functions.size import extract_size, norm_size
from ..functions.text import clean_title, empty_to_null, joined_codes, lower_key, maker_from_title, norm_code, split_codes, strip, to_number, to_percent

REQUIRED = {"catalog": ("mpn", "title"), "listing": ("asin", "title")}
SINGLE_UNITS = ("ea", "each", "pr", "pair")
CATALOG_COLUMNS = """mpn manufacturer catalog_title uom_unit uom_quantity catalog_title2 catalog_title2_lc catalog_color catalog_size
catalog_title_qty catalog_title_qty_unit catalog_title_qty_confidence catalog_title_hier_qty catalog_qty manufacturer_lc mpn_code
catalog_color_norm catalog_size_norm""".split()
LISTING_COLUMNS = """asin keepa_title keepa_brand keepa_model variation_attributes keepa_color keepa_size keepa_scent keepa_number_of_items
keepa_package_qty pick_pack_fee referral_fee referral_fee_pct buy_box_current buy_box_30d_avg bought_past_month upc ean gtin partnumber
keepa_title2 keepa_title2_lc keepa_title_qty keepa_title_qty_unit keepa_title_qty_confidence keepa_qty brand_lc title_lc keepa_color_norm
keepa_size_norm codescombined""".split()
#: Standard name, header in the sheet, and whether it is text, a number or a percentage.
LISTING_FIELDS = [
    ("asin", "ASIN", "text"), ("keepa_title", "Title", "text"), ("keepa_brand", "Brand", "text"), ("keepa_model", "Model", "text"),
    ("variation_attributes", "Variation Attributes", "text"), ("keepa_color", "Color", "text"), ("keepa_size", "Size", "text"), ("keepa_scent", "Scent", "text"),
    ("keepa_number_of_items", "Number of Items", "number"), ("keepa_package_qty", "Package: Quantity", "number"), ("pick_pack_fee", "FBA Pick&Pack Fee", "number"),
    ("referral_fee", "Referral Fee based on current Buy Box price", "number"), ("referral_fee_pct", "Referral Fee %", "percent"),
    ("buy_box_current", "Buy Box: Current", "number"), ("buy_box_30d_avg", "Buy Box: 30 days avg.", "number"), ("bought_past_month", "Bought in past month", "number"),
    ("upc", "Product Codes: UPC", "text"), ("ean", "Product Codes: EAN", "text"), ("gtin", "Product Codes: GTIN", "text"), ("partnumber", "Product Codes: PartNumber", "text"),
]


def _key(header: str) -> str:
    return header.strip().lower().replace(" ", "_")


def column(df: DataFrame, header: str) -> Column:
    """The first column whose header is the same but for case, blanks at its ends and underscores for blanks; a null column if there is none."""
    for c in df.columns:
        if _key(c) == _key(header):
            return df[f"`{c}`"].cast("string")
    return F.lit(None).cast("string")


def missing_columns(df: DataFrame, kind: str) -> list[str]:
    """Required headers that the sheet lacks; reads no rows."""
    have = {c.strip().lower() for c in df.columns}
    return [c for c in REQUIRED[kind] if c not in have]


_KINDS = {"text": strip, "number": to_number, "percent": to_percent}


def standard_catalog(raw: DataFrame) -> DataFrame:
    number = to_number(column(raw, "uom_quantity"))
    df = raw.select(*[strip(column(raw, h)).alias(n) for n, h in (("mpn", "MPN"), ("manufacturer", "Manufacturer"), ("catalog_title", "Title"), ("uom_unit", "uom_unit"))], number.alias("uom_quantity"))
    df = df.where(F.coalesce(F.col("mpn"), F.lit("")) != "")
    title = F.col("catalog_title")
    df = df.withColumns({"_q": extract_quantity(title), "catalog_title_hier_qty": levels_quantity(title), "catalog_title2": clean_title(title), "catalog_color": extract_color(title), "catalog_size": extract_size(title)})
    df = df.withColumns({"catalog_title_qty": F.col("_q.quantity"), "catalog_title_qty_unit": F.col("_q.unit_type"), "catalog_title_qty_confidence": F.col("_q.confidence")})
    stated = F.coalesce("uom_quantity", F.col("catalog_title_hier_qty").cast("double"), F.col("catalog_title_qty").cast("double"))
    single = stated.isNull() & lower_key(F.col("uom_unit")).isin(*SINGLE_UNITS)
    maker = F.coalesce(empty_to_null(F.col("manufacturer")), maker_from_title(title))
    df = df.withColumns({"catalog_qty": F.when(single, F.lit(1.0)).otherwise(stated), "manufacturer": maker})
    df = df.withColumns({"catalog_title2_lc": lower_key(F.col("catalog_title2")), "manufacturer_lc": lower_key(F.col("manufacturer")), "mpn_code": norm_code(F.col("mpn")), "catalog_color_norm": norm_color(F.col("catalog_color")), "catalog_size_norm": norm_size(F.col("catalog_size"))})
    return df.select(*CATALOG_COLUMNS)


def catalog_codes(std: DataFrame) -> DataFrame:
    return std.select("mpn", F.col("mpn_code").alias("code")).where("code IS NOT NULL").distinct()


def standard_listing(raw: DataFrame) -> DataFrame:
    df = raw.select(*[_KINDS[kind](column(raw, header)).alias(name) for name, header, kind in LISTING_FIELDS])
    df = df.where(F.coalesce(F.col("asin"), F.lit("")) != "")
    title, size = F.col("keepa_title"), empty_to_null(F.col("keepa_size"))
    # A size field that states a quantity fills a missing number of items, and is then no size.
    is_qty = size.isNotNull() & is_quantity_field(size)
    df = df.withColumns({"_is_qty": is_qty, "_size_q": F.when(is_qty, extract_quantity(size)["quantity"].cast("double"))})
    read = F.col("_value")
    df = once_a_value(df, "keepa_title", {"_q": extract_quantity(read), "_color": extract_color(read), "_size": extract_size(read), "keepa_title2": clean_title(read)}, parts(raw))
    df = df.withColumns(
        {
            "keepa_number_of_items": F.coalesce("keepa_number_of_items", "_size_q"),
            "keepa_color": F.coalesce(empty_to_null(F.col("keepa_color")), "_color"),
            "keepa_size": F.coalesce(F.when(~F.col("_is_qty"), empty_to_null(F.col("keepa_size"))), "_size"),
            "keepa_title_qty": F.col("_q.quantity"),
            "keepa_title_qty_unit": F.col("_q.unit_type"),
            "keepa_title_qty_confidence": F.col("_q.confidence"),
        }
    )
    in_title = F.col("keepa_title_qty").cast("double")
    # One item next to a sure higher quantity in the title means one pack.
    one_pack = (F.col("keepa_number_of_items") == 1) & (in_title > 1) & (F.col("keepa_title_qty_confidence") == "high")
    df = df.withColumns(
        {
            "keepa_qty": F.when(one_pack, in_title).otherwise(F.coalesce("keepa_number_of_items", in_title)),
            "keepa_title2_lc": lower_key(F.col("keepa_title2")),
            "brand_lc": lower_key(F.col("keepa_brand")),
            "title_lc": lower_key(title),
            "keepa_color_norm": norm_color(F.col("keepa_color")),
            "keepa_size_norm": norm_size(F.col("keepa_size")),
            "codescombined": joined_codes(*map(F.col, ("keepa_model", "partnumber", "upc", "ean", "gtin"))),
        }
    )
    return df.select(*LISTING_COLUMNS)


def listing_codes(std: DataFrame, n: int | None = None, by: tuple[str, ...] = ("asin", "code")) -> DataFrame:
    """Distinct (asin, code) of all code fields; junk codes are dropped before the rows are multiplied. With n they are made distinct in so many parts,
    dealt by both or by the code alone, where codes are joined next.

    explode_outer, as for explode the optimizer tests the array in a filter of its own and so works it out again.
    """
    codes = F.flatten(F.array(*[split_codes(F.col(c)) for c in ("keepa_model", "partnumber", "upc", "ean", "gtin")]))
    every = std.select("asin", F.explode_outer(F.array_distinct(codes)).alias("code")).where("code IS NOT NULL")
    return (every.repartition(n, *by) if n else every).distinct()
