"""The plan from sheets to workbook, feedback with a model handed in, files and the command line, on a few rows."""
import http.server
import itertools
import json
import threading

import pytest
from pyspark.sql import functions as F

from kinmatch.functions import similarity
from kinmatch.operators import feedback, matching, report, standardize
from kinmatch.plans import cli, match
from kinmatch.sources import files, workbook
from kinmatch.streaming import append

CATALOG = [("AB-1234", "Acme", "Acme Gauze 4x6, pack of 12", "EA", None), ("CD-5678", None, "Borealis Tape Royal Blue", "Pair", "n/a"), (None, "x", "no key", None, None), ("", "x", "no key", None, None)]
LISTINGS = [("B1", "Gauze 4 x 6.1 by Acme (Pack of 12) AB-1234", "Acme", "ab1234", "grey", ""), ("B1", "another offer", "Acme", "ab1234", None, None), ("B2", "Borealis tape, blue", "Other", "CD5678 / TBD", None, "24 count"), ("", "no key", "x", "AB1234", None, None)]


@pytest.fixture(scope="module")
def run(spark):
    catalog = spark.createDataFrame(CATALOG, "mpn string, Manufacturer string, ` Title ` string, uom_unit string, uom_quantity string")
    listings = spark.createDataFrame(LISTINGS, "ASIN string, Title string, Brand string, `Product Codes: PartNumber` string, Color string, Size string")
    return match.match(catalog, listings)


def test_standard_tables(run):
    assert run.catalog.columns == standardize.CATALOG_COLUMNS and run.listing.columns == standardize.LISTING_COLUMNS
    rows = {r.mpn: r for r in run.catalog.collect()}
    assert set(rows) == {"AB-1234", "CD-5678"}
    assert (rows["AB-1234"].catalog_qty, rows["AB-1234"].catalog_size_norm) == (12.0, "4 X 6")
    assert (rows["CD-5678"].catalog_qty, rows["CD-5678"].manufacturer, rows["CD-5678"].catalog_color_norm) == (1.0, "borealis", "royal blue")
    other = {r.keepa_title: r for r in run.listing.collect()}
    assert other["Borealis tape, blue"].keepa_qty == 24.0 and other["Borealis tape, blue"].keepa_size is None
    assert len(other) == 3


def test_matches(run):
    assert run.all.columns[: len(matching.VALIDATED)] == matching.VALIDATED
    best = {r.asin: r for r in run.best.collect()}
    assert best["B1"].Category == "Certain" and best["B1"].catalog_mpn == "AB-1234"
    assert best["B1"].keepa_title.startswith("Gauze")
    assert all(r.rn == 1 and r.fuzzy_score >= 15 for r in best.values())


def test_dealing_does_not_matter(run):
    again = matching.best_per_listing(run.all.repartition(7, "fuzzy_score"))
    assert sorted(map(tuple, again.select("asin", "catalog_mpn", "Category").collect())) == sorted(map(tuple, run.best.select("asin", "catalog_mpn", "Category").collect()))


def decided(f, c, n, p, code, brand, qty, qty_off, unit_off, color_off, size_off, size_on):
    """The decision list in plain Python."""
    clear, fits = n == 0, not qty_off and not unit_off
    if clear and (f >= 90 or f >= 85 and (c >= 60 or code) or f >= 75 and c >= 65 or f >= 40 and (c >= 70 or code and brand and (qty or f >= 70))):
        return "Certain"
    if f >= 90 and c >= 50 and qty_off and not (size_off or color_off or unit_off):
        return "Certain"
    if code and brand and clear and (qty and c >= 55 or size_on and fits and f >= 25):
        return "Certain"
    if f >= 85 and n <= 1 and not unit_off or fits and (f >= 75 and n <= 1 or f >= 60 and code or f >= 25 and (code and brand or c >= 50)):
        return "High"
    if f >= 40 and code and p >= 2 or c >= 30 and p >= 2 or code and brand and f >= 25 and n <= 1 or code and clear and f >= 15 and c >= 20:
        return "Medium"
    if f < 30 or n >= 2 or qty_off or unit_off or c < 20 or p < 2 and f < 40 or not brand and f < 40:
        return "Verify"
    return "Medium"


def test_decision_list(spark):
    fuzzy = [14.0, 15.0, 25.0, 30.0, 40.0, 60.0, 75.0, 85.0, 90.0]
    cube = list(itertools.product(fuzzy, [0.0, 20.0, 50.0, 60.0, 70.0], [1, 3], *[[0, 1]] * 8))
    rows = [(f, c, sum(x[3:7]), p, *map(int, x)) for f, c, p, *x in cube]
    names = "code_match brand_match qty_match qty_mismatch unit_type_mismatch color_mismatch size_mismatch size_match".split()
    schema = "fuzzy_score double, confidence_score double, negative_flags int, positive_flags int, " + ", ".join(f"flag_{n} int" for n in names)
    df = spark.createDataFrame(rows, schema).withColumns({f"flag_{n}": F.lit(0) for n in ("qty_both_null", "qty_ratio_match", "color_match", "code_in_title")})
    got = [r[0] for r in df.select(matching.decide(matching.category_rules(), "Medium")).collect()]
    assert got == [decided(r[0], r[1], r[2], r[3], *map(bool, r[4:])) for r in rows]
    assert set(got) == set(matching.CATEGORIES)


def test_feedback(spark, run):
    every = run.all
    pair = every.where("asin = 'B1'").select(F.col("catalog_mpn").alias("mpn"), "asin").distinct()
    scores = pair.select("mpn", "asin", F.lit(0.1).alias("ai_match_score"), F.lit("no").alias("ai_reasoning"), F.lit("High").alias("original_category"))
    new = feedback.upsert_scores(scores, scores.withColumn("ai_match_score", F.lit(0.75)))
    assert [r.ai_match_score for r in new.collect()] == [0.75]
    changed = {r.asin: r.Category for r in feedback.apply_scores(every, new).where("keepa_title LIKE 'Gauze%'").collect()}
    assert changed == {"B1": "High"}
    summary = feedback.verification_summary(new, every, feedback.apply_scores(every, new)).first()
    assert summary.scored >= 1 and summary.sure == summary.scored


def test_models():
    calls = []

    def failing(prompt):
        calls.append(prompt)
        raise OSError

    assert feedback.retrying(failing, wait=lambda s: calls.append(s))("x") is None
    assert calls == ["x", 2.0, "x", 4.0, "x"]
    pairs = [{"catalog_title": "a b", "keepa_title": "b a"}, {"catalog_title": "a", "keepa_title": "z"}]
    assert [s for s, _, _ in feedback.judged(pairs, feedback.offline_model)] == [1.0, 0.0]
    assert feedback.judged(pairs, lambda p: "")[0] == (0.5, False, "Empty response")
    assert feedback.judged(pairs, lambda p: "no json")[0] == (0.65, False, "Parse error (fallback)")
    assert feedback.judged(pairs, failing)[0][0] == 0.0
    assert feedback.read_answer('```json\n{"a": 1}\n```') == {"a": 1} and feedback.read_answer("[1]") is None
    assert feedback.estimate_cost(31, 11) == 0.0015
    assert [feedback.parse_title(t) for t in ("pack of 7", "gauze", "")] == [7, None, None] and feedback.parse_title("x", failing) is None
    assert feedback.parse_title("x", lambda p: '{"1": {"quantity": "many"}}') is None and feedback.parse_title("x", lambda p: '{"1": {"quantity": -2}}') is None


def test_verify_and_fill(spark, run):
    scores = feedback.verify(feedback.to_verify(run.best, matching.CATEGORIES))
    assert scores.columns == ["mpn", "asin", "ai_match_score", "ai_reasoning", "original_category"]
    found = feedback.parse_titles(spark.createDataFrame([("x", "pack of 7"), ("y", None)], "id string, title string"))
    assert sorted((r.id, r.quantity) for r in found.collect() if r.quantity == r.quantity and r.quantity is not None) == [("x", 7.0)]
    std = spark.createDataFrame([("x", None), ("z", 2.0)], "mpn string, catalog_qty double")
    assert sorted(map(tuple, feedback.fill_quantity(std, found, "catalog").collect())) == [("x", 7.0), ("z", 2.0)]


def test_workbook_and_files(spark, run, tmp_path):
    path = str(tmp_path / "out.xlsx")
    match.export(run.best, path, min_fuzzy={"Certain": 101})
    names = workbook.sheet_names(path)
    assert names[0] == "Summary" and names[-1] == "All Matches" and "Certain" not in names
    back = files.read_sheet(spark, path, "All Matches")
    assert back.count() == run.best.count() and back.columns[:3] == ["catalog_mpn", "asin", "Category"]
    (tmp_path / "in.CSV").write_text("ASIN,Title\nB1,NA\nB2,x\n")
    assert [tuple(r) for r in files.read_sheet(spark, str(tmp_path / "in.CSV")).orderBy("ASIN").collect()] == [("B1", None), ("B2", "x")]
    assert report.arranged(run.best, report.MINIMAL).columns[:2] == ["catalog_mpn", "asin"]


def test_statements():
    text = "-- head; er\nSELECT ';' AS a;\n\n/* ; */ SELECT 2 -- tail\n"
    assert match.statements(text) == [(2, "SELECT ';' AS a"), (4, "SELECT 2")]


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    (tmp_path / "c.csv").write_text("MPN,Title,uom_unit\nAB-1234,Acme Gauze Roll Blue pack of 12,EA\n")
    (tmp_path / "l.csv").write_text("ASIN,Title,Brand,Product Codes: PartNumber\nB1,Acme Gauze Pads Large (Pack of 12),Acme,AB1234\n")
    common = ["--catalog", str(tmp_path / "c.csv"), "--listings", str(tmp_path / "l.csv"), "--folder", str(tmp_path / "f")]
    assert cli.main(["run", *common, "--out", str(tmp_path / "o.xlsx")], spark) == 0
    assert workbook.sheet_names(str(tmp_path / "o.xlsx"))[0] == "Summary"
    assert cli.main(["verify", "--folder", str(tmp_path / "f"), "--dry-run"], spark) == 0
    (tmp_path / "bad.csv").write_text("Title\nx\n")
    assert cli.main(["build", "--catalog", str(tmp_path / "bad.csv"), "--listings", str(tmp_path / "l.csv"), "--folder", str(tmp_path / "g")], spark) == 1
    def answer(prompt):
        task = json.loads(prompt)
        if "titles" in task:
            return json.dumps({i: {"quantity": 5} for i, _ in task["titles"]})
        return json.dumps({"matches": [{"confidence": 0.75, "reasoning": "same"} for _ in task["pairs"]]})

    folder = str(tmp_path / "f")
    table = lambda name: files.read_table(spark, folder, name)
    before = {r.asin: r.Category for r in table("final_matches_dedup_asin").collect()}
    monkeypatch.setattr(feedback, "offline_model", answer)
    assert cli.main(["verify", "--folder", folder, "--categories", *matching.CATEGORIES[:3]], spark) == 0
    after = {r.asin: r.Category for r in table("final_matches_dedup_asin").collect()}
    scored = {(r.mpn, r.asin): r.ai_match_score for r in table("ai_match_scores").collect()}
    assert scored == {("AB-1234", "B1"): 0.75} and before["B1"] == "Medium" and after["B1"] == "High"
    assert cli.main(["export", "--folder", folder, "--out", str(tmp_path / "v.xlsx")], spark) == 0
    assert [r.Category for r in files.read_sheet(spark, str(tmp_path / "v.xlsx"), "All Matches").collect()] == [after["B1"]]
    # Scores of an earlier run stay.
    files.write_table(spark.createDataFrame([("old", "B9", 0.5, "r", "High")], feedback.SCORES), f"{folder}/ai_match_scores")
    assert cli.main(["run", "--skip-build", "--folder", folder], spark) == 0
    assert cli.main(["verify", "--folder", folder, "--categories", *matching.CATEGORIES[:3]], spark) == 0
    assert {(r.mpn, r.asin) for r in table("ai_match_scores").collect()} == {("old", "B9"), ("AB-1234", "B1")}

    (tmp_path / "c.csv").write_text("MPN,Title\nAB-1234,Acme Gauze\n")
    assert cli.main(["run", *common], spark) == 0
    assert cli.main(["fill", "--folder", folder, "--dry-run", "--categories", *matching.CATEGORIES], spark) == 0
    assert table("catalog_std").first().catalog_qty is None
    assert cli.main(["fill", "--folder", folder, "--categories", *matching.CATEGORIES], spark) == 0
    assert table("catalog_std").first().catalog_qty == 5.0
    assert cli.main(["run", "--skip-build", "--folder", folder], spark) == 0
    assert table("final_matches_all").first().catalog_qty == 5.0
    assert cli.main(["tables", "--folder", folder], spark) == 0 and cli.main(["diagnose", "--folder", folder], spark) == 0
    (tmp_path / "q.sql").write_text("SELECT asin, fuzzy_ratio(catalog_title, keepa_title) AS f FROM final_matches_all;")
    assert cli.main(["sql", "--folder", folder, "--file", str(tmp_path / "q.sql")], spark) == 0
    assert "final_matches_all: 1 rows" in capsys.readouterr().out
    with pytest.raises(ValueError, match="no_such"):
        files.read_table(spark, folder, "no_such")


def test_chat_model():
    class Service(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.headers["Authorization"], body["model"], body["response_format"], body["messages"][-1]["content"]))
            self.send_response(200 if len(asked) > 1 else 500)
            self.end_headers()
            self.wfile.write(json.dumps({"choices": [{"message": {"content": feedback.offline_model(asked[-1][3])}}]}).encode())

        def log_message(self, *args):
            pass

    asked, waits = [], []
    with http.server.HTTPServer(("127.0.0.1", 0), Service) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        model = feedback.retrying(feedback.chat_model(f"http://127.0.0.1:{server.server_port}/v1", "m", "k", pause=0), wait=waits.append)
        assert feedback.judged([{"catalog_title": "a b", "keepa_title": "b a"}], model)[0][0] == 1.0
        server.shutdown()
    assert len(asked) == 2 and asked[0][:3] == ("Bearer k", "m", {"type": "json_object"}) and waits == [2.0]


def test_sql_functions(spark):
    match.register_functions(spark)
    rows = [("4.5 X 4.1 YD", "4.5 X 4.125YD"), ("4", "4 X 75"), ("M", "M"), ("4 CM", "4 MM"), ("0 X 1", "0 X 1"), (None, "4"), ("Acme Gauze", "gauze "), ("", "x"), ("x", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    df.createOrReplaceTempView("pairs_of_text")
    got = spark.sql("SELECT a, b, size_approx_match(a, b) AS s, contains_text(a, b) AS c FROM pairs_of_text")
    own = df.select("a", "b", similarity.size_approx_match(F.col("a"), F.col("b")).alias("s"), similarity.contains_text(F.col("a"), F.col("b")).alias("c"))
    assert sorted(map(str, got.collect())) == sorted(map(str, own.collect()))


def test_long_sheets(tmp_path, monkeypatch):
    monkeypatch.setattr(workbook, "MOST_ROWS", 4)
    names = workbook.write_workbook(str(tmp_path / "w.xlsx"), [("One", ["a"], iter([(i,) for i in range(7)])), ("None", ["a"], iter(()))])
    assert names == ["One", "One 2", "One 3", "None"] == workbook.sheet_names(str(tmp_path / "w.xlsx"))
    found = [r for n in names for r in list(workbook.rows_of(str(tmp_path / "w.xlsx"), n))[1:]]
    assert [int(float(r[0])) for r in found] == list(range(7))


def test_stream_of_listings(spark, run, tmp_path):
    """Two micro-batches; each is matched by the same plan as a whole table of its rows."""
    catalog = spark.createDataFrame(CATALOG, "mpn string, Manufacturer string, ` Title ` string, uom_unit string, uom_quantity string")
    schema = "ASIN string, Title string, Brand string, `Product Codes: PartNumber` string, Color string, Size string"
    for k, rows in enumerate((LISTINGS[:2], LISTINGS[2:])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = append.match_new_listings(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), catalog, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
        query.awaitTermination()
        own = match.match(catalog, spark.createDataFrame(rows, schema)).all
        got = spark.read.parquet(str(tmp_path / "out" / f"batch={k}"))
        columns = ["catalog_mpn", "asin", "Category", "fuzzy_score", "confidence_score", "catalog_qty", "keepa_qty"]
        assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, own.select(columns).collect())) and got.count() > 0
