"""The whole matching plan, lazily chained, and its steps as tables."""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..dealing import parts
from ..functions import similarity
from ..operators import feedback, matching, report
from ..operators.standardize import catalog_codes, listing_codes, missing_columns, standard_catalog, standard_listing
from ..shipping import ship
from ..sources.files import write_table
from ..sources.workbook import write_workbook


@dataclass
class Matches:
    """The tables of one run; none is worked out before it is used."""

    catalog: DataFrame
    listing: DataFrame
    pairs: DataFrame
    scored: DataFrame
    all: DataFrame
    best: DataFrame

    def unpersist(self) -> None:
        self.catalog.unpersist()
        self.listing.unpersist()


def match_standard(catalog: DataFrame, listing: DataFrame, n: int | None = None) -> Matches:
    """From standard tables on, codes in n parts if that is given. Extraction stays below the join: it runs once a row of either side, not once a pair."""
    cand = matching.candidates(catalog_codes(catalog), listing_codes(listing, n, ("code",)), n)
    pairs = matching.validated(matching.paired(cand, catalog, listing))
    scored = matching.scored(pairs)
    every = matching.categorized(scored)
    return Matches(catalog, listing, pairs, scored, every, matching.best_per_listing(every))


def match(catalog_raw: DataFrame, listing_raw: DataFrame, *, folder: str | None = None) -> Matches:
    """From raw sheets on. With a folder the standard tables are written there first, so the joins read plain columns and a later run can start from them.

    Without one they are persisted, as codes, rarity and pairs all read them: extraction then runs once a row, not once a use."""
    for df, kind in ((catalog_raw, "catalog"), (listing_raw, "listing")):
        if missing := missing_columns(df, kind):
            raise ValueError(f"the {kind} sheet lacks {', '.join(missing)}")
    ship(catalog_raw.sparkSession)
    catalog, listing = standard_catalog(catalog_raw), standard_listing(listing_raw)
    if folder:
        catalog, listing = write_table(catalog, f"{folder}/catalog_std"), write_table(listing, f"{folder}/keepa_std")
    else:
        catalog, listing = catalog.persist(), listing.persist()
    return match_standard(catalog, listing, parts(catalog_raw, listing_raw))


def verified(every: DataFrame, best: DataFrame, model: feedback.Model = feedback.offline_model, *, old_scores: DataFrame | None = None, limit: int | None = None, categories=("High", "Medium"), floors: dict[str, float] | None = None, per_call: int = feedback.MATCHES_PER_CALL) -> DataFrame:
    """All scores, earlier ones included, after the model has looked at the doubtful pairs. `feedback.rescored` applies them."""
    new = feedback.verify(feedback.to_verify(best, categories, limit=limit, floors=floors), model, per_call=per_call)
    return feedback.upsert_scores(old_scores, new) if old_scores is not None else new


def filled(catalog: DataFrame, listing: DataFrame, best: DataFrame, model: feedback.Model = feedback.offline_model, categories=("Certain", "High")) -> tuple[DataFrame, DataFrame]:
    """The standard tables with quantities that the model reads in matched titles without one."""
    read = lambda std, side: feedback.fill_quantity(std, feedback.parse_titles(feedback.without_quantity(best, std, categories, side), model), side)
    return read(catalog, "catalog"), read(listing, "listing")


def export(best: DataFrame, path: str, *, minimal: bool = False, summary_only: bool = False, categories=None, min_confidence: float | None = None, min_fuzzy: dict[str, float] | None = None) -> None:
    """A workbook for people to read, its long sheets in several; Parquet files by category if the path does not end in .xlsx."""
    kept = report.arranged(report.filtered(best, categories=categories, min_confidence=min_confidence), report.MINIMAL if minimal else report.EXPORT)
    if not path.lower().endswith(".xlsx"):
        kept.write.mode("overwrite").partitionBy("Category").parquet(path)
        return
    write_workbook(path, _sheets(kept, summary_only, min_fuzzy))


def _sheets(kept: DataFrame, summary_only: bool, min_fuzzy: dict[str, float] | None) -> Iterator[tuple[str, list[str], Iterable[tuple]]]:
    """A workbook's sheets; rows come to the driver a partition at a time. Empty ones but for the first two are left out."""
    summary = report.export_summary(kept, min_fuzzy)
    yield "Summary", summary.columns, summary.toLocalIterator()
    if summary_only:
        return
    for name, df in report.sheets(kept, min_fuzzy).items():
        whole = name == "All Matches"
        if whole and kept.count() > report.ALL_ROWS or not whole and df.isEmpty():
            continue
        yield name, df.columns, df.toLocalIterator()


def statements(text: str) -> list[tuple[int, str]]:
    """(first line, statement) of a script: split at semicolons that stand in no string, name or comment."""
    out, current, start, i, line = [], "", 0, 0, 1
    ends = {"'": "'", '"': '"', "`": "`", "--": "\n", "/*": "*/"}
    while i < len(text):
        opener = next((o for o in ends if text.startswith(o, i)), None)
        if opener:
            stop = text.find(ends[opener], i + len(opener))
            stop = len(text) if stop < 0 else stop + len(ends[opener])
            piece = text[i:stop]
            if opener not in ("--", "/*"):
                start = start or line
                current += piece
            else:
                current += " "
            line += piece.count("\n")
            i = stop
            continue
        ch = text[i]
        if ch == ";":
            if current.strip():
                out.append((start, current.strip()))
            current, start = "", 0
        else:
            current += ch
            if not ch.isspace():
                start = start or line
        line += ch == "\n"
        i += 1
    return out + ([(start, current.strip())] if current.strip() else [])


def run_sql(spark: SparkSession, text: str, show: bool = False) -> list[DataFrame]:
    """Runs a script's statements; the results of its queries. A failing one is named by its first line."""
    out = []
    for line, statement in statements(text):
        try:
            df = spark.sql(statement)
        except Exception as e:
            raise RuntimeError(f"statement at line {line} failed: {statement[:500]}") from e
        if statement.upper().startswith(("SELECT", "WITH")):
            out.append(df)
            if show:
                df.show(truncate=False)
    return out


#: Functions that are SQL expressions, for scripts.
SQL_FUNCTIONS = {
    "contains_text": """CASE WHEN {a} <> '' AND {b} <> '' AND contains({a}, {b}) THEN 1 ELSE 0 END""",
    "size_approx_match": """CASE WHEN size({n_a}) > 0 AND size({n_a}) = size({n_b})
        AND forall(zip_with({n_a}, {n_b}, (p, q) -> (p = 0 AND q = 0) OR (p <> 0 AND q <> 0 AND abs(p - q) / greatest(p, q) <= 0.03D)), v -> v)
        AND ({u_a} = '' OR {u_b} = '' OR {u_a} = {u_b}) THEN 1 ELSE 0 END""",
}


def register_functions(spark: SparkSession) -> None:
    """The comparison functions under their SQL names."""
    ship(spark)
    for name in ("fuzzy_ratio", "fuzzy_partial", "fuzzy_token_sort"):
        spark.udf.register(name, getattr(similarity, name))
    stripped = lambda x: rf"regexp_replace(coalesce({x}, ''), r'(?U)^\s+|\s+$', '')"
    parts = {x: f"lower({stripped(x)})" for x in "ab"}
    parts |= {f"n_{x}": rf"transform(regexp_extract_all({stripped(x)}, r'(\d+(?:\.\d+)?)', 1), v -> CAST(v AS DOUBLE))" for x in "ab"}
    parts |= {f"u_{x}": f"regexp_extract({stripped(x)}, '[A-Z]{{2,}}$', 0)" for x in "ab"}
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(a STRING, b STRING) RETURNS INT RETURN {body.format(**parts)}")
