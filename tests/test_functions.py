"""Unit goldens of the scalar functions; columns are worked out in one job a test."""
import pytest
from pyspark.sql import functions as F

from kinmatch.functions import color, quantity, similarity, size, text


def values(spark, rows, expression):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r[1] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_quantities(spark):
    goldens = [
        ("Pack of 12", (12, "pack", "high")),
        ("4 Boxes of 60", (240, "compound", "high")),
        ("4 Pack of 20", (80, "compound", "high")),
        ("BGof10", (10, "compact_of", "high")),
        ("50/cs", (50, "case", "high")),
        ("12-pack", (12, "pack", "high")),
        ("24ct", (24, "count", "high")),
        ("2 Per Case", (2, "case", "high")),
        ("50 Per Box", (50, "box", "high")),
        ("Each, PRof2", (2, "compact_of", "high")),
        ("50,box", (50, "box", "high")),
        ("Product Name 12", (12, None, "low")),
        ("99999999999999999999 pack", (None, None, "none")),
        ("", (None, None, "none")),
        (None, (None, None, "none")),
    ]
    assert [tuple(g) for g in values(spark, [t for t, _ in goldens], quantity.extract_quantity)] == [q for _, q in goldens]


def test_quantity_of_every_shape_and_unit(spark):
    """One title for each shape and unit, written out by hand."""
    goldens = {
        "pack": ["pack of 7", "7 per pk", "x ,7,pk", "7,pack", "7/pk", "pk/7", "7-pack", "7pk"], "case": ["case of 7", "7 per cs", "7 bottle/case", "x ,7,cs", "7,case", "7 / case", "cs/7", "7-cs", "7 case"],
        "box": ["box of 7", "7 per bx", "(7 boxes)", "x ,7,box", "7,bx", "7/box", "box / 7", "7-bx", "7bx"], "bag": ["bag of 7", "7 per bg", "7 sponges/bag", "(7 bags)", "x ,7,bg", "7/bag", "bg/7", "7-bag", "7 bags"],
        "set": ["set of 7"], "roll": ["rolls of 7", "7/rl", "7-roll", "7 rolls"], "carton": ["carton of 7", "7 per ctn", "7/ctn", "ctn/7", "7-carton", "7 ctn"], "bandage": ["7 bandages"],
        "compact_of": ["BGof7", "gauze, PRof7"], "each": ["7/ea", "ea/7", "7 each"], "count": ["7/ct", "7-cnt", "7ct"], "spool": ["7/spool", "sp/7", "7-sp", "7 spool"], "strip": ["7 strips/box", "7 strip / cs"], "test": ["7 tests"],
        "piece": ["7-pcs", "7 pieces"], "pair": ["7 pairs", "7pr"], "dozen": ["7 dz"], "qty": ["qty: 7", "quantity 7"], "paren": ["(7)"], "unit": ["7 units"], "item": ["7 items"],
    }
    titles = [(t, unit) for unit, all_ in goldens.items() for t in all_]
    got = values(spark, [t for t, _ in titles], quantity.extract_quantity)
    assert [(t, *g) for (t, _), g in zip(titles, got, strict=True)] == [(t, 7, unit, "high") for t, unit in titles]
    none = ["7 in", "7 ml", "7 oz box of gauze", "7 x 9", "pack of 0", "pack of 100001", "7%", "gauze"]
    assert [g.unit_type for g in values(spark, none, quantity.extract_quantity)] == [None] * len(none)
    assert [tuple(g) for g in values(spark, ["7 x 9 pack", "wrap 1", "wrap 1001"], quantity.extract_quantity)] == [(9, "pack", "high"), (None, None, "none"), (None, None, "none")]


def test_every_colour_alias(spark):
    aliases = {"grey": "gray", "transparent": "clear", "off white": "white", "off-white": "white", "offwhite": "white", "multicolor": "multi", "multi color": "multi", "multi-color": "multi", "multicolored": "multi", "assorted colors": "assorted", "various": "assorted"}
    assert values(spark, list(aliases), color.norm_color) == list(aliases.values())
    known = ["black", "white", "silver", "charcoal", "navy", "sky blue", "turquoise", "hunter green", "burgundy", "hot pink", "lavender", "amber", "khaki", "mocha", "eggshell", "clear", "translucent", "rainbow", "nude", "almond", "slate"]
    assert values(spark, [f"gown {c} xl" for c in known], color.extract_color) == known


def test_quantity_patterns_are_all_there():
    assert len(quantity.PATTERNS) == 70


def test_quantity_column(spark):
    got = values(spark, ["Pack of 12", "plain", None, ""], quantity.extract_quantity)
    assert [tuple(g) for g in got] == [(12, "pack", "high"), (None, None, "none"), (None, None, "none"), (None, None, "none")]


def test_levels(spark):
    rows = ["2/pk, 6pk/cs", "4/pk, 10 pk/bg, 1 bg/cs", "soft wipes 100/pk, 5pk/cs", "none", None]
    assert values(spark, rows, quantity.levels_quantity) == [12, 40, 5, None, None]


def test_quantity_fields(spark):
    assert values(spark, ["24 count", "1 Pair (Pack of 1)", "4 X 6", "", None], quantity.is_quantity_field) == [True, True, False, False, False]


def test_sizes(spark):
    goldens = [
        ('3" Width, 8" Length', "3 X 8 IN"), ("2x3 3/4", "2 X 3.75"), ("4 1/2 x 3", "4.5 X 3"), ("20mm", "20 MM"), ("X Large", "XL"), ("men's", "S"), ("4-1/2 X 3", "4-1/2 X 3"), ("", None), (None, None), ("1/0 in", None),
        ("3 wide 4 cm long", "3 X 4 CM"), ("5 cm wide; 7 long", "5 X 7 CM"), ('4" x 6" x 8" tray', "4 X 6 X 8 IN"), ('4 x 6"', "4 X 6"), ("1/32 inch", "0.0312 IN"), ("2 3/8 in and 1 1/2 ft", "2.375 IN"), ('tube 3/4"', "0.75 IN"),
        ("1 0/0 in", None), ("xx-large gown", "XXL"), ("2 yards", "2 YD"), ("5 x 3/4 in", "5 X 3"), ("no size here", None),
    ]
    assert values(spark, [t for t, _ in goldens], size.extract_size) == [s for _, s in goldens]


def test_norm_size(spark):
    assert values(spark, ["4X4", "4 INCH X 4 INCH", '4" X 6"', "", None, "20 mm"], size.norm_size) == ["4 X 4", "4 X 4", "4 X 6", None, None, "20 MM"]


def test_colors(spark):
    assert values(spark, ["grey", "off-white", "Multi Color", "", None], color.norm_color) == ["gray", "white", "multi", None, None]
    rows = ["Color: Teal gown", "Light blue gown", "gown, Navy", "gown", None, "a red and blue gown"]
    assert values(spark, rows, color.extract_color) == ["teal gown", "light blue", "navy", None, None, "blue"]


def test_codes_and_numbers(spark):
    assert values(spark, ["n/a", "0000", "AB1", "ABCDE", "ab-12 34", None], text.norm_code) == [None, None, None, None, "AB1234", None]
    assert values(spark, ["AB12; cd-34 | x", None], text.split_codes) == [["AB12", "CD34"], []]
    assert values(spark, ["15%", "1%", "0.5%", "8.5 %", "x", None], text.to_percent) == [0.15, 1.0, 0.5, 0.085, None, None]
    assert values(spark, ["12", "12d", " 1e3 ", "nan", "", None], text.to_number) == [12.0, None, 1000.0, None, None, None]


def test_titles(spark):
    rows = ['Acme Gauze (Box) 4" x 4" Sterile, 10/bx', "", None, "the of"]
    assert values(spark, rows, text.clean_title) == ["Acme Gauze 4 4 10 / Box", None, None, None]
    assert values(spark, ["CURITY GZE SPG 4X4", "gauze pad", None], text.maker_from_title) == ["curity", None, None]


def test_ratios():
    assert round(similarity.token_set("acme bandage 4x6 pack 12", "acme bandage 4 6 12 pack"), 2) == 95.83
    assert similarity.token_set("a b", "b a c") == 100.0
    assert similarity.token_sort("b a", "a b") == 100.0
    assert similarity.partial("bandage", "a bandage of gauze") == 100.0
    assert similarity.ratio("abc", "xyz") == 0.0


def test_common_length_against_tables():
    import random

    rng = random.Random(3)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd ") for _ in range(rng.randint(0, 30))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        assert similarity.common_length(a, b) == row[-1]


def test_comparisons(spark):
    df = spark.createDataFrame([("4.5 X 4.1 YD", "4.5 X 4.125YD"), ("4", "4 X 75"), ("M", "M"), ("4 CM", "4 MM"), ("0 X 1", "0 X 1"), (None, "4"), ("4", "4.2")], "a string, b string")
    assert [r[0] for r in df.select(similarity.size_approx_match(F.col("a"), F.col("b"))).collect()] == [1, 0, 0, 0, 1, 0, 0]
    df = spark.createDataFrame([("Acme Gauze", "gauze "), ("", "x"), (None, "x"), ("x", "")], "a string, b string")
    assert [r[0] for r in df.select(similarity.contains_text(F.col("a"), F.col("b"))).collect()] == [1, 0, 0, 0]
    df = spark.createDataFrame([("Acme", "acme "), (None, "x"), ("a b", "b a c")], "a string, b string")
    assert [r[0] for r in df.select(similarity.fuzzy_ratio("a", "b")).collect()] == [100.0, 0.0, 100.0]
