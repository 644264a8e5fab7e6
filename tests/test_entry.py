"""Registered queries against their SQL, on the smallest tables; skipped where those are absent."""
import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
SOME = ["norm_codes", "candidates", "clean_title_listing", "color_extract", "size_extract", "size_extract_catalog", "qty_extract", "std_catalog", "std_listing", "std_flags", "pipeline_full", "size_norm", "size_approx", "fuzzy_token_set", "flags", "score", "categorize", "dedup_best", "rescored_best", "qty_fill"]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_names_need_no_session():
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=root, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr


def plain(rows):
    tidy = lambda v: None if v is None or v != v else round(float(v), 6) if isinstance(v, int | float) and not isinstance(v, bool) else str(v)
    return sorted(tuple(str(tidy(v)) for v in r) for r in rows)


@pytest.mark.parametrize("name", SOME)
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    other = con.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert plain(df.select(*columns).collect()) == plain(other)
