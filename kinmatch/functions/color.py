"""Colours from titles and fields."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import empty_to_null, let, search_text, strip

# Other names of a colour, and the colours looked for.
ALIASES = {
    "grey": "gray", "transparent": "clear", "off white": "white", "off-white": "white", "offwhite": "white", "multicolor": "multi",
    "multi color": "multi", "multi-color": "multi", "multicolored": "multi", "assorted colors": "assorted", "various": "assorted",
}
LEXICON = [
    "black", "white", "gray", "silver", "charcoal", "navy", "blue", "light blue", "dark blue", "royal blue", "sky blue", "teal", "turquoise", "aqua",
    "cyan", "green", "lime", "olive", "sage", "mint", "forest green", "hunter green", "red", "maroon", "burgundy", "crimson", "scarlet", "wine", "pink",
    "hot pink", "magenta", "rose", "blush", "coral", "purple", "violet", "lavender", "plum", "mauve", "orange", "yellow", "gold", "amber", "peach",
    "beige", "tan", "khaki", "brown", "chocolate", "mocha", "coffee", "copper", "bronze", "caramel", "cream", "ivory", "bone", "eggshell", "clear",
    "transparent", "translucent", "multi", "assorted", "rainbow", "natural", "nude", "sand", "almond", "smoke", "slate",
]
#: Canonical names, those of two words first, else in the lexicon's order.
WANTED = list(dict.fromkeys(ALIASES.get(c, c) for c in sorted(LEXICON, key=lambda c: -len(c.split()))))
LABEL = r"(?i)\b(?:colou?r)\s*[:\-=]\s*([a-z][a-z ]{1,24})\b"


def canonical(c: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv])
    return F.coalesce(F.try_element_at(names, c), c)


def norm_color(c: Column) -> Column:
    """A field's colour under its canonical name; null for an empty field."""
    return F.when(strip(F.coalesce(c, F.lit(""))) != "", canonical(search_text(c)))


def extract_color(c: Column) -> Column:
    """The labelled colour, else the first known colour of the text in the lexicon's order, else a known one as the last part after a comma."""

    def of(raw: Column) -> Column:
        label = empty_to_null(canonical(search_text(F.regexp_extract(raw, LABEL, 1))))
        spelled = F.array(*[F.struct(F.lit(f" {x} ").alias("padded"), F.lit(x).alias("name")) for x in WANTED])
        known = let(F.concat(F.lit(" "), search_text(raw), F.lit(" ")), lambda p: F.get(F.filter(spelled, lambda x: F.contains(p, x["padded"])), 0)["name"])
        last = F.filter(F.split(search_text(F.regexp_extract(raw, r"([^,]*)[,\s]*$", 1)), " "), lambda w: w.rlike(r"^\p{L}+$"))
        last = let(canonical(F.array_join(last, " ")), lambda x: F.when(x.isin(WANTED), x))
        return F.coalesce(label, known, last)

    return let(strip(F.coalesce(c, F.lit(""))), of)
