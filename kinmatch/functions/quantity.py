"""Quantities from titles and fields: each shape is looked for once, with all units that it may have, as column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, strip

#: How a number and its unit can stand together; {u} is the unit's spellings.
SHAPES = {
    "unit of N": r"\b{u}\s*of\s*(\d+)\b",
    "N per unit": r"\b(\d+)\s+per\s+{u}\b",
    "N words": r"\b(\d+)\s+{u}\b",
    "(N words)": r"\((\d+)\s+{u}\)",
    ",N,unit": r",(\d+),{u}\b",
    "N,unit": r"\b(\d+),{u}\b",
    "N/unit": r"\b(\d+)\s*/\s*{u}\b",
    "unit/N": r"\b{u}\s*/\s*(\d+)\b",
    "N-unit": r"\b(\d+)\s*-\s*{u}\b",
    "N unit": r"\b(\d+)\s*{u}\b",
    "label N": r"\b{u}\.?\s*[:=]?\s*(\d+)\b",
    "as written": "{u}",
}

# The order in which shapes are tried, the spellings, and the unit that each stands for.
TABLE: list[tuple[str, list[tuple[str, str]]]] = [
    ("unit of N", [("pack", "pack"), ("case", "case"), ("box", "box"), ("bag", "bag"), ("set", "set"), ("roll[s]?", "roll"), ("carton", "carton")]),
    ("N per unit", [("(?:case|cs)", "case"), ("(?:box|bx)", "box"), ("(?:pack|pk)", "pack"), ("(?:bag|bg)", "bag"), ("(?:carton|ctn)", "carton")]),
    ("N words", [(r"sponges\s*/\s*bag", "bag"), ("bandages", "bandage")]),
    ("(N words)", [("boxes", "box"), ("bags", "bag")]),
    ("N words", [(r"bottle\s*/\s*case", "case")]),
    ("as written", [(r"\b[a-z]{2,}of(\d+)\b", "compact_of"), (r",\s*[a-z]{2,}of(\d+)$", "compact_of_end")]),
    (",N,unit", [("(?:box|bx)", "box"), ("(?:case|cs)", "case"), ("(?:pack|pk)", "pack"), ("(?:bag|bg)", "bag")]),
    ("N,unit", [("(?:box|bx)", "box"), ("(?:case|cs)", "case"), ("(?:pack|pk)", "pack")]),
    ("N/unit", [("(?:box|bx)", "box"), ("(?:case|cs)", "case"), ("(?:pack|pk)", "pack"), ("(?:bag|bg)", "bag"), ("(?:ea|each)", "each"), ("(?:ct|count)", "count"), ("(?:roll|rl)", "roll"), ("(?:carton|ctn)", "carton"), ("(?:spool|sp)", "spool")]),
    ("unit/N", [("(?:box|bx)", "box"), ("(?:case|cs)", "case"), ("(?:pack|pk)", "pack"), ("(?:bag|bg)", "bag"), ("(?:ea|each)", "each"), ("(?:carton|ctn)", "carton"), ("(?:spool|sp)", "spool")]),
    ("N words", [(r"strips?\s*/\s*(?:cs|case|bx|box|pk|pack|ctn|carton)", "strip"), ("tests?", "test")]),
    ("N-unit", [("(?:pack|pk)", "pack"), ("(?:case|cs)", "case"), ("(?:box|bx)", "box"), ("(?:count|ct|cnt)", "count"), ("(?:piece|pc|pcs)", "piece"), ("(?:roll|rl)", "roll"), ("(?:bag|bg)", "bag"), ("(?:carton|ctn)", "carton"), ("(?:spool|sp)", "spool")]),
    ("N unit", [("(?:pk|pack)", "pack"), ("(?:cs|case)", "case"), ("(?:bx|box)", "box"), ("(?:ct|cnt|count)", "count"), ("(?:ea|each)", "each"), ("(?:pc|pcs|piece|pieces)", "piece"), ("(?:roll|rolls|rl)", "roll"), ("(?:bag|bags|bg)", "bag"), ("(?:pair|pairs|pr)", "pair"), ("(?:dozen|dz)", "dozen"), ("(?:carton|ctn)", "carton"), ("(?:spool|sp)", "spool")]),
    ("label N", [("qty", "qty"), ("quantity", "qty")]),
    ("as written", [(r"\((\d+)\s*(?:count|ct|pk|pack|cs|case|ea|each|pc|pcs)?\)", "paren")]),
    ("N words", [("(?:units?)", "unit"), ("(?:items?)", "item")]),
]
#: Each pattern by itself, in order.
PATTERNS = [("(?i)" + SHAPES[shape].replace("{u}", unit), kind) for shape, units in TABLE for unit, kind in units]
COMPOUND = r"(?i)\b(\d+)\s+(?:packs?|boxes|cases?|bags?|cartons?)\s+of\s+(\d+)\b"
# What makes a match a measure and not a quantity.
VETO = (
    r"(?i)\b\d+\s*(?:in|inch|inches|cm|mm|ft|feet|m|meter)\b|\b\d+\s*(?:ml|l|oz|fl|cc|gal|gallon)\b|\b\d+\s*(?:lb|lbs|g|gram|kg|mg|oz|ounce)\b"
    r"|\b\d+\s*(?:fr|french|ga|gauge)\b|\b\d+\s*x\s*\d+|\b\d+(?:\.\d+)?\s*%"
)
LEVEL_UNIT = "(?:pk|pack|bx|box|bg|bag|bt|bottle|ea|each|rl|roll|sp|spool|ctn|carton|cs|case)"
FIELD = r"^\d+\s*(?:count|ct|cnt|pk|pack|cs|case|ea|each|pc|pcs|box|bx|pair|pr)\b"
SHEETS = r"(?i)\bwipes?\b|\bbandages?\b|\bband\s*aids?\b|\badhesive\s+bandages?\b"


def _whole(c: Column) -> Column:
    """Digits as a number; null if there are none or too many."""
    return c.try_cast("bigint")


def _found(quantity: Column, unit: str | Column | None, confidence: str) -> Column:
    unit = unit if isinstance(unit, Column) else F.lit(unit).cast("string")
    return F.struct(quantity.alias("quantity"), unit.alias("unit_type"), F.lit(confidence).alias("confidence"))


def _shaped(t: Column, shape: str, units: list[tuple[str, str]]) -> Column:
    """What a shape finds: for each unit in its order the first match counts, if its number is plausible and it is no measure. Null if nothing does.

    No two matches of a shape overlap, as each has a number of its own next to its unit: so one pass finds the first match of every unit.
    """
    whole = lambda spelling: SHAPES[shape].replace("{u}", spelling)
    names = F.array(*[F.lit(name) for _, name in units])

    def as_number(m: Column) -> Column:
        rank = F.lit(len(units))
        for k in range(len(units) - 1, -1, -1):
            rank = F.when(m.rlike("(?i)" + whole(units[k][0])), k).otherwise(rank)
        return F.struct((rank if len(units) > 1 else F.lit(0)).alias("rank"), _whole(F.regexp_extract(m, r"(\d+)", 1)).alias("number"), m.rlike(VETO).alias("measure"))

    def chosen(found: Column) -> Column:
        first = F.filter(F.transform(F.sequence(F.lit(0), F.lit(len(units) - 1)), lambda k: F.get(F.filter(found, lambda m: m["rank"] == k), 0)), lambda m: m["number"].between(1, 100000) & ~m["measure"])
        return F.when(F.size(first) > 0, _found(F.get(first, 0)["number"], F.get(names, F.get(first, 0)["rank"]), "high"))

    every = "(?i)" + whole("(?:" + "|".join(spelling for spelling, _ in units) + ")")
    matches = F.regexp_extract_all(t, F.lit(every), 0)
    return let(matches, lambda found: F.when(F.size(found) > 0, let(F.transform(found, as_number), chosen)))


def extract_quantity(c: Column) -> Column:
    """struct<quantity bigint, unit_type string, confidence string>: a product of two levels, else the first shape that finds one, else a number at the end."""

    def of(t: Column) -> Column:
        part = lambda pattern, i: _whole(F.regexp_extract(t, pattern, i))
        whole = lambda low, high, unit, confidence: lambda q: F.when(q.between(low, high), _found(q, unit, confidence))
        compound = let(F.try_multiply(part(COMPOUND, 1), part(COMPOUND, 2)), whole(2, 100000, "compound", "high"))
        shapes = [_shaped(t, shape, group) for shape, units in TABLE for group in ([units] if shape != "as written" else [[u] for u in units])]
        last = let(part(r"\b(\d+)\s*$", 1), whole(2, 1000, None, "low"))
        none = _found(F.lit(None).cast("bigint"), None, "none")
        return F.when(t.rlike("[0-9]"), F.coalesce(compound, *shapes, last, none)).otherwise(none)

    return let(strip(F.coalesce(c, F.lit(""))), of)


def levels_quantity(c: Column) -> Column:
    """The product of "2/pk, 6pk/cs" or three such levels; wipes and bandages leave out the innermost."""
    t = strip(F.coalesce(c, F.lit("")))
    step = rf"\s*[,;]\s*(\d+)\s*{LEVEL_UNIT}\s*/\s*{LEVEL_UNIT}"
    two, three = rf"(?i)(\d+)\s*/\s*{LEVEL_UNIT}{step}", rf"(?i)(\d+)\s*/\s*{LEVEL_UNIT}{step}{step}"
    part = lambda p, i: _whole(F.regexp_extract(t, p, i))
    inner = lambda p: F.when(t.rlike(SHEETS), F.lit(1).cast("bigint")).otherwise(part(p, 1))
    product = lambda p, n: [inner(p), *[part(p, i) for i in range(2, n + 1)]]

    def multiplied(xs: list[Column]) -> Column:
        out = xs[0]
        for x in xs[1:]:
            out = F.try_multiply(out, x)
        return out

    return F.when(t.rlike(three), multiplied(product(three, 3))).when(t.rlike(two), multiplied(product(two, 2)))


def is_quantity_field(c: Column) -> Column:
    return F.lower(strip(F.coalesce(c, F.lit("")))).rlike(FIELD)
