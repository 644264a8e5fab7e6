"""Similarity of strings: token-set, token-sort and partial ratios over Arrow batches, size and text comparison as expressions."""
from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .text import lower_key, strip


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence: one bit a character of a, one step a character of b."""
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & places.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    return 200.0 * common_length(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    shared = x & y
    if shared and (x <= y or y <= x):
        return 100.0
    dx, dy = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    s = len(" ".join(sorted(shared)))
    gap = 1 if s else 0
    whole_x, whole_y = s + gap + len(dx), s + gap + len(dy)
    edits = len(dx) + len(dy) - 2 * common_length(dx, dy)
    best = 100.0 * (1 - edits / (whole_x + whole_y))
    if s:
        best = max(best, 100.0 * (1 - (gap + len(dx)) / (s + whole_x)), 100.0 * (1 - (gap + len(dy)) / (s + whole_y)))
    return best


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def partial(a: str, b: str) -> float:
    """The best ratio of the shorter string with a stretch of the longer one, at its ends shorter stretches too."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    m, best = len(short), 0.0
    for at in range(1 - m, len(long)):
        piece = long[max(at, 0) : at + m]
        if piece[-1] in short or piece[0] in short:
            best = max(best, ratio(short, piece))
            if best == 100.0:
                break
    return max(best, partial(b, a)) if len(a) == len(b) and a > b else best


def _scored(measure):
    def of(a: str | None, b: str | None) -> float:
        a, b = (a or "").strip().lower(), (b or "").strip().lower()
        return 0.0 if not a or not b else 100.0 if a == b else round(measure(a, b), 2)

    @F.pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        kept: dict = {}
        out = []
        for pair in zip(a.where(a.notna(), None), b.where(b.notna(), None), strict=True):
            if pair not in kept:
                kept[pair] = of(*pair)
            out.append(kept[pair])
        return pd.Series(out, dtype="float64")

    return run


fuzzy_ratio, fuzzy_partial, fuzzy_token_sort = _scored(token_set), _scored(partial), _scored(token_sort)


def size_approx_match(a: Column, b: Column) -> Column:
    """1 if both sizes have as many numbers, each within 3 % of the larger, and the same unit if both end in one; else 0."""
    x, y = strip(a), strip(b)
    numbers = lambda c: F.transform(F.regexp_extract_all(c, F.lit(r"(\d+(?:\.\d+)?)"), 1), lambda v: v.cast("double"))
    near = lambda p, q: F.when((p == 0) & (q == 0), True).when((p == 0) | (q == 0), False).otherwise(F.try_divide(F.abs(p - q), F.greatest(p, q)) <= 0.03)
    unit = lambda c: F.regexp_extract(c, "[A-Z]{2,}$", 0)
    same = (F.size(numbers(x)) > 0) & (F.size(numbers(x)) == F.size(numbers(y))) & F.forall(F.zip_with(numbers(x), numbers(y), near), lambda v: v)
    units = (unit(x) == "") | (unit(y) == "") | (unit(x) == unit(y))
    return F.coalesce(F.when(same & units, 1).otherwise(0), F.lit(0))


def contains_text(text: Column, part: Column) -> Column:
    """1 if the part occurs in the text, whatever the case; 0 for empty ones."""
    t, p = lower_key(text), lower_key(part)
    return F.when((t != "") & (p != "") & F.contains(t, p), 1).otherwise(0)
