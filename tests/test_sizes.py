"""What shows only on larger tables: keys that repeat, and how tables are dealt."""
from kinmatch.operators import feedback


def test_summary_counts_repeated_pairs_as_their_join_does(spark):
    scores = spark.createDataFrame([("M", "A", 0.8), ("N", "A", 0.2)], "mpn string, asin string, ai_match_score double")
    before = spark.createDataFrame([("M", "A", "Verify"), ("M", "A", "Verify"), ("N", "A", "High")], "catalog_mpn string, asin string, Category string")
    after = spark.createDataFrame([("M", "A", "High"), ("M", "A", "High"), ("M", "A", "Verify"), ("N", "A", "Medium")], "catalog_mpn string, asin string, Category string")
    assert tuple(feedback.verification_summary(scores, before, after).first()) == (7, 6, 0, 1, 4, 1, 2)
    assert tuple(feedback.verification_summary(scores.limit(0), before, after).first()) == (0,) * 7


def test_parts_grow_with_the_files(spark, tmp_path, monkeypatch):
    import glob
    import os

    from kinmatch import dealing

    spark.range(50_000).selectExpr("id", "sha(cast(id AS string)) AS s").write.parquet(f"{tmp_path}/t")
    held = sum(map(os.path.getsize, glob.glob(f"{tmp_path}/t/*.parquet")))
    least = 2 * spark.sparkContext.defaultParallelism
    df = spark.read.parquet(f"{tmp_path}/t")
    assert dealing.parts(df) == max(least, held // dealing.PART_BYTES)
    monkeypatch.setattr(dealing, "PART_BYTES", held // 100)
    assert 99 <= dealing.parts(df) <= 101 and 198 <= dealing.parts(df, df.groupBy("s").count()) <= 202


def test_listing_and_catalog_tables_are_dealt(spark, tmp_path, monkeypatch):
    """One file with one row group gave one task for the whole catalog."""
    from kinmatch import dealing
    from kinmatch.plans import queries

    spark.createDataFrame([(k, "red ring", "Brand#1", "LARGE", 5) for k in range(200)], "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(dealing, "PART_BYTES", 100)
    assert queries.view(spark, str(tmp_path), queries.CATALOG_RAW).rdd.getNumPartitions() > 8
    assert queries.queries()["fuzzy_partial"](spark, str(tmp_path)).count() == 199


def test_a_title_is_read_once_whatever_it_holds(spark):
    from pyspark.sql import functions as F

    from kinmatch.dealing import once_a_value

    rows = [(1, "a"), (2, None), (3, "a"), (4, ""), (5, None), (6, " a")]
    got = once_a_value(spark.createDataFrame(rows, "i int, t string"), "t", {"n": F.coalesce(F.length("_value"), F.lit(-1))}, 3)
    assert got.columns == ["i", "t", "n"]
    assert sorted((r.i, r.n) for r in got.collect()) == [(1, 1), (2, -1), (3, 1), (4, 0), (5, -1), (6, 2)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("coalesce(length") == 1 and "Aggregate" in plan


def test_white_space_codes_and_numbers_as_before(spark):
    from pyspark.sql import functions as F

    from kinmatch.functions import text

    odd = [None, "", " ", "a", "\u00a0x\u3000", "x\n", "\tx y\u2003", "é", " é ", "x\x1f", "\x7fx", "PN-0001 / TBD,0000;ab12", "12.5 %", "150%", " 7 ", "1e3", "\u00a05%\u00a0"]
    df = spark.createDataFrame([(x,) for x in odd], "t string").repartition(2)
    old = F.regexp_replace("t", r"(?U)^\s+|\s+$", "")
    assert df.where(~text.strip(F.col("t")).eqNullSafe(old)).count() == 0
    got = {r.t: (r.c, r.p) for r in df.select("t", text.split_codes(F.col("t")).alias("c"), text.to_percent(F.col("t")).alias("p")).collect()}
    assert got["PN-0001 / TBD,0000;ab12"][0] == ["PN0001", "AB12"] and got[None] == ([], None)
    assert [got[x][1] for x in ("12.5 %", "150%", " 7 ", "\u00a05%\u00a0")] == [0.125, 1.5, 7 / 100, 5 / 100]


def test_candidates_are_dealt_by_code_into_the_given_parts(spark):
    """Counts and joins stay in n parts, whatever AQE would make of them."""
    from kinmatch.operators import matching, standardize

    std = spark.createDataFrame([(f"B{i}", f"PN-{i % 40:04d} / PN-9999", f"PN-{i % 7:04d}") for i in range(400)], "asin string, keepa_model string, partnumber string").selectExpr("*", "string(null) AS upc", "string(null) AS ean", "string(null) AS gtin")
    catalog = spark.createDataFrame([(f"M{i}", f"PN{i % 30:04d}") for i in range(33)], "mpn string, code string").distinct()
    got = matching.candidates(catalog, standardize.listing_codes(std, 37, ("code",)), 37)
    assert got.rdd.getNumPartitions() == 37
    pairs = {(f"M{m}", f"B{i}", f"PN{m % 30:04d}") for m in range(33) for i in range(400) if m % 30 in (i % 40, i % 7)}
    often = {f"PN{c:04d}": sum(c in (i % 40, i % 7) for i in range(400)) for c in range(40)}
    rows = got.collect()
    assert {(r.mpn, r.asin, r.matched_code) for r in rows} == pairs and len(rows) == len(pairs)
    assert all(r.code_frequency == often[r.matched_code] for r in rows)
    assert sorted(rows) == sorted(matching.candidates(catalog, standardize.listing_codes(std)).collect())


def test_codes_are_counted_in_the_parts_that_the_files_give(spark, tmp_path, monkeypatch):
    """The count by code had an exchange of its own, whose partitions AQE sized."""
    import math

    from kinmatch import dealing
    from kinmatch.plans import queries

    spark.createDataFrame([(k, "red ring", "Brand#1", "LARGE", 5) for k in range(60)], "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(i % 60, i % 7, 1.0 * i) for i in range(900)], "l_partkey bigint, l_suppkey bigint, l_extendedprice double").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(dealing, "PART_BYTES", 100)
    got = queries.queries()["code_rarity"](spark, str(tmp_path))
    n = dealing.parts(queries.view(spark, str(tmp_path), queries.LISTING_RAW))
    assert n > 8 and got.rdd.getNumPartitions() == n
    often: dict = {}
    for r in queries._listing_code_table(spark, str(tmp_path)).collect():
        often[r.code] = often.get(r.code, 0) + 1
    rows = got.collect()
    assert {r.code: r.asin_count for r in rows} == often and len(rows) == len(often)
    assert all(math.isclose(r.code_rarity_score, min(1.0, 1 / math.log10(r.asin_count + 1))) for r in rows)
