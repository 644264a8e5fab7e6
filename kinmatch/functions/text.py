"""Text and code normalisation as column expressions."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word lists that cleaned titles must agree on.
STOPWORDS = """
a an the and or with without for of to from in on at by as is are was were be been being this that these those there where when what which
who whom whose into onto via per its it our your sterile non-sterile nonsterile disposable reusable latex latexfree free individually wrapped
sealed medical grade professional hospital
""".split()
UNIT_WORDS = """
in inch inches cm mm ft feet yd yds yard yards m meter meters fr french ga gauge ml milliliter milliliters l liter liters cc oz fl lb lbs
pound pounds ounce ounces g gram grams kg kilogram kilograms
""".split()
ABBREVIATIONS = {"bx": "box", "cs": "case", "ea": "each", "pk": "pack", "ct": "count", "ctn": "carton", "bg": "bag", "rl": "roll", "pr": "pair", "dz": "dozen", "sp": "spool"}
MANUFACTURER_SKIP = """
fabric gauze sponge bandage dressing pad roll stocking wrap tape foam film compress sterile adhesive elastic conforming stretch non woven
spg nw ldg bx cs ea pk rl pr ns lf
""".split()

#: A number, a fraction, or a hyphenated mixed fraction.
NUMBER = r"(?:\d+(?:\.\d+)?|\d+\s*/\s*\d+|\d+\s*-\s*\d+\s*/\s*\d+)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once for each row; a plain column would be evaluated anew wherever it stands, and for each element inside a lambda."""
    return F.get(F.transform(F.array(value), body), 0)


def first_of(values: Column) -> Column:
    """The first element that isn't null."""
    return F.get(F.filter(values, lambda x: x.isNotNull()), 0)


def strip(c: Column) -> Column:
    """Without white space at the ends; Spark's trim takes blanks only. Between visible ASCII signs nothing is looked for."""
    return F.when(F.ascii(c).between(33, 126) & F.ascii(F.substring(c, -1, 1)).between(33, 126), c).otherwise(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def lower_key(c: Column) -> Column:
    """Stripped and lower-cased; null becomes an empty string."""
    return F.lower(strip(F.coalesce(c, F.lit(""))))


def plain_quotes(c: Column) -> Column:
    """Multiplication sign, curly quotes and primes as ASCII."""
    return F.translate(c, "×“”″′", "x\"\"\"'")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def search_text(c: Column) -> Column:
    """Lower-cased words separated by single blanks, other signs dropped; null becomes an empty string."""
    s = F.lower(plain_quotes(F.coalesce(c, F.lit(""))))
    return squeeze(F.regexp_replace(F.regexp_replace(s, "[-_]+", " "), r"(?U)[^\w\s]", " "))


def clean_title(c: Column) -> Column:
    """A title for fuzzy comparison: no parentheses, units or filler words, abbreviations spelled out, words capitalised."""
    s = plain_quotes(F.coalesce(c, F.lit("")))
    s = F.regexp_replace(s, r"\([^)]*\)", " ")
    s = F.regexp_replace(s, rf'\b({NUMBER})\s*"', "$1")
    s = F.regexp_replace(F.lower(s), r"[-,;:()\[\]{}|]", " ")
    s = F.regexp_replace(F.replace(s, F.lit("/"), F.lit(" / ")), r"[^a-z0-9\s.\-/x]+", " ")
    s = F.regexp_replace(s, r"\bx\b", " ")
    words = F.filter(F.split(s, r"\s+"), lambda w: w != "")
    spelled = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    words = F.transform(words, lambda w: F.coalesce(F.try_element_at(spelled, w), w))
    words = F.filter(words, lambda w: ~w.isin(STOPWORDS + UNIT_WORDS))
    words = F.transform(words, lambda w: F.when(w.rlike("[0-9]"), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))))
    return empty_to_null(F.array_join(words, " "))


def maker_from_title(c: Column) -> Column:
    """The first word with four letters or more, other signs dropped, that isn't a product word."""
    words = F.transform(F.split(lower_key(c), r"\s+"), lambda w: F.regexp_replace(w, "[^a-z]", ""))
    return F.get(F.filter(words, lambda w: (F.length(w) >= 4) & ~w.isin(MANUFACTURER_SKIP)), 0)


# Codes and numbers


def norm_code(c: Column) -> Column:
    """Letters and digits in upper case; null unless there are four, one of them a digit, and not zeros only."""
    s = F.upper(F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z0-9]", ""))
    return let(s, lambda x: F.when((F.length(x) >= 4) & x.rlike("[0-9]") & ~x.rlike("^0+$"), x))


def split_codes(c: Column) -> Column:
    """All codes of a field that may hold several."""
    codes = F.filter(F.transform(F.split(c, r"[,\s;/|]+"), norm_code), lambda x: x.isNotNull())
    return F.when(c.isNotNull(), codes).otherwise(F.array().cast("array<string>"))


def joined_codes(*cs: Column) -> Column:
    return empty_to_null(squeeze(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in cs])))


def to_number(c: Column) -> Column:
    """A double, or null for anything that isn't written as a finite number."""
    return let(strip(c), lambda s: F.when(s.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), s.try_cast("double")))


def to_percent(c: Column) -> Column:
    """A fraction: per cent signs dropped, values above 1 divided by 100, values up to 1 as they are."""
    number = let(F.replace(strip(c), F.lit("%"), F.lit("")), to_number)
    return let(number, lambda v: F.when(v > 1, v / 100).otherwise(v))
