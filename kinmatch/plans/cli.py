"""Command line: python -m kinmatch.plans.cli COMMAND ..."""
from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ..operators import feedback, report
from ..operators.matching import CATEGORIES, best_per_listing, category_summary
from ..operators.standardize import missing_columns
from ..sources.files import read_sheet, read_table, table_names, write_table
from . import match as plan


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kinmatch")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple, **kinds) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        for o, settings in options:
            p.add_argument(o, **settings)
        return p

    folder = ("--folder", {"required": True, "help": "where the tables of a run are kept"})
    model = [("--model-url", {"help": "a chat completions service; without it, titles are read and pairs judged by plain rules"}), ("--model-name", {"default": ""}), ("--model-key-file", {})]
    inputs = [("--multiline", {"action": "store_true", "help": "quoted CSV cells hold line feeds"}), ("--catalog", {}), ("--listings", {}), ("--catalog-sheet", {}), ("--listings-sheet", {}), ("--validate-only", {"action": "store_true"})]
    exports = [("--out", {}), ("--minimal", {"action": "store_true"}), ("--summary-only", {"action": "store_true"}), ("--min-confidence", {"type": float}), ("--categories", {"nargs": "+", "choices": CATEGORIES})]
    exports += [(f"--{c.lower()}-min-fuzzy", {"type": float}) for c in CATEGORIES]
    command("run", folder, *inputs, *exports, ("--skip-build", {"action": "store_true"}), ("--skip-match", {"action": "store_true"}), ("--fill-quantities", {"action": "store_true"}), *model)
    command("build", folder, *inputs)
    command("export", folder, *exports)
    command("verify", folder, ("--limit", {"type": int}), ("--dry-run", {"action": "store_true"}), ("--batch-size", {"type": int, "default": feedback.MATCHES_PER_CALL}), ("--categories", {"nargs": "+", "choices": CATEGORIES, "default": ["High", "Medium"]}), *[(f"--{c.lower()}-min-fuzzy", {"type": float}) for c in CATEGORIES[:3]], *model)
    command("fill", folder, *model, ("--categories", {"nargs": "+", "choices": CATEGORIES, "default": ["Certain", "High"]}), ("--dry-run", {"action": "store_true"}))
    command("diagnose", folder)
    command("tables", folder)
    command("sql", ("--folder", {}), ("--file", {"required": True}))
    return top


def _floors(a) -> dict[str, float]:
    return {c: v for c in CATEGORIES if (v := getattr(a, f"{c.lower()}_min_fuzzy", None)) is not None}


def _export(best, a) -> None:
    if a.out:
        plan.export(best, a.out, minimal=a.minimal, summary_only=a.summary_only, categories=a.categories, min_confidence=a.min_confidence, min_fuzzy=_floors(a))


def _model(a) -> feedback.Model:
    if not a.model_url:
        return feedback.offline_model
    key = None
    if a.model_key_file:
        with open(a.model_key_file, encoding="utf-8") as f:
            key = f.read().strip()
    return feedback.retrying(feedback.chat_model(a.model_url, a.model_name, key))


def _build(spark: SparkSession, a) -> bool:
    catalog = read_sheet(spark, a.catalog, a.catalog_sheet, multiline=a.multiline)
    listings = read_sheet(spark, a.listings, a.listings_sheet, all_sheets=True, multiline=a.multiline)
    missing = [(k, m) for k, df in (("catalog", catalog), ("listing", listings)) if (m := missing_columns(df, k))]
    for kind, names in missing:
        print(f"the {kind} sheet lacks {', '.join(names)}", file=sys.stderr)
    if not missing and not a.validate_only:
        run = plan.match(catalog, listings, folder=a.folder)
        print(f"{run.catalog.count()} catalog rows, {run.listing.count()} listings")
    return not missing


def _store(every, best, folder: str) -> None:
    """The final tables, and the listings' best matches from what was stored."""
    stored = write_table(every, f"{folder}/final_matches_all")
    best = write_table(best(stored), f"{folder}/final_matches_dedup_asin")
    print(f"{stored.count()} matches, {best.count()} listings matched")


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("kinmatch").getOrCreate()
    plan.ship(spark)
    load = lambda name: read_table(spark, a.folder, name)
    if a.command == "sql":
        plan.register_functions(spark)
        for name in table_names(spark, a.folder) if a.folder else ():
            load(name).createOrReplaceTempView(name)
        with open(a.file, encoding="utf-8") as f:
            plan.run_sql(spark, f.read(), show=True)
        return 0
    if a.command == "tables":
        for name in table_names(spark, a.folder):
            load(name).createOrReplaceTempView(name)
        for t in report.describe_tables(spark, table_names(spark, a.folder)):
            print(f"{t['name']}: {t['rows']} rows")
            print("\n".join(f"  {c} {kind}" for c, kind in t["columns"]))
            print(*t["sample"], sep="\n")
        return 0
    if a.command in ("build", "run") and not getattr(a, "skip_build", False):
        if not _build(spark, a):
            return 1
        if a.validate_only:
            return 0
    if a.command == "run" and not a.skip_match:
        _store(plan.match_standard(load("catalog_std"), load("keepa_std")).all, best_per_listing, a.folder)
    if a.command == "fill" or a.command == "run" and a.fill_quantities:
        catalog, listing, best = load("catalog_std"), load("keepa_std"), load("final_matches_dedup_asin")
        wanted = getattr(a, "categories", None) or ["Certain", "High"]
        titles = {"catalog": feedback.without_quantity(best, catalog, wanted, "catalog"), "listing": feedback.without_quantity(best, listing, wanted, "listing")}
        counts = {s: df.count() for s, df in titles.items()}
        print(f"titles without a quantity: {counts}, estimated cost {feedback.estimate_cost(sum(counts.values()), 0)}")
        if getattr(a, "dry_run", False):
            for s, df in titles.items():
                print(s, df.orderBy("id").limit(5).collect())
            return 0
        catalog, listing = plan.filled(catalog, listing, best, _model(a), wanted)
        catalog, listing = write_table(catalog, f"{a.folder}/catalog_std"), write_table(listing, f"{a.folder}/keepa_std")
        _store(plan.match_standard(catalog, listing).all, best_per_listing, a.folder)
    if a.command in ("run", "export"):
        best = load("final_matches_dedup_asin")
        _export(best, a)
        category_summary(best).show()
    if a.command == "verify":
        every, best = load("final_matches_all"), load("final_matches_dedup_asin")
        pairs = feedback.to_verify(best, a.categories, limit=a.limit, floors=_floors(a))
        n = pairs.count()
        print(f"{n} pairs, estimated cost {feedback.estimate_cost(0, n)}")
        pairs.groupBy("Category").count().orderBy("Category").show()
        if a.dry_run:
            pairs.limit(20).show(truncate=False)
            return 0
        old = load("ai_match_scores") if "ai_match_scores" in table_names(spark, a.folder) else None
        scores = plan.verified(every, best, _model(a), old_scores=old, limit=a.limit, categories=a.categories, floors=_floors(a), per_call=a.batch_size)
        scores = write_table(scores, f"{a.folder}/ai_match_scores")
        before = write_table(every.select("catalog_mpn", "asin", "Category"), f"{a.folder}/_categories_before")
        _store(feedback.apply_scores(every, scores), best_per_listing, a.folder)
        feedback.verification_summary(scores, before, load("final_matches_all")).show()
    if a.command == "diagnose":
        every, best = load("final_matches_all"), load("final_matches_dedup_asin")
        needed = ["asin", "catalog_mpn", "Category", "fuzzy_score", "flag_code_match", "flag_brand_match"]
        if lacking := [c for c in needed if c not in every.columns]:
            print(f"final_matches_all lacks {', '.join(lacking)}", file=sys.stderr)
            return 1
        for df in (report.contested_listings(every), report.doubtful_examples(every, best), report.distribution(best), report.similar_by_category(best), report.near_threshold(best, "High")):
            df.show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
