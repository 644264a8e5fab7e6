"""Sheets of strings from CSV files, workbooks and tables."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings of a missing cell.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def without_missing(df: DataFrame) -> DataFrame:
    """All columns as strings, with the usual spellings of a missing cell as null."""
    return df.select(*[F.when(~F.col(f"`{c}`").cast("string").isin(MISSING), F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])


def combined(parts: list[DataFrame]) -> DataFrame:
    """Sheets one after another, columns by name, absent ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None, *, all_sheets: bool = False, multiline: bool = False) -> DataFrame:
    """A CSV file (by its ending, whatever its case), or a workbook's sheet: the named one, the first, or all of them combined.

    CSV files are split among tasks; with multiline, for line feeds inside quoted cells, each file is one task.
    """
    if path.lower().endswith(".csv"):
        return without_missing(spark.read.csv(path, header=True, inferSchema=False, multiLine=multiline, escape='"'))
    from .workbook import WorkbookSource, sheet_names

    spark.dataSource.register(WorkbookSource)
    names = [sheet] if sheet else sheet_names(path)
    read = lambda n: spark.read.format("workbook").option("path", path).option("sheet", n).load()
    return without_missing(combined([read(n) for n in (names if all_sheets and not sheet else names[:1])]))


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def table_names(spark: SparkSession, folder: str) -> list[str]:
    """The tables that a folder holds, by name."""
    fs, where = _file_system(spark, folder)
    if not fs.exists(where):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(where) if f.isDirectory() and not f.getPath().getName().startswith((".", "_")))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a run's folder; an error that names it if it isn't there."""
    fs, where = _file_system(spark, f"{folder}/{name}")
    if not fs.exists(where):
        raise ValueError(f"table {name} does not exist in {folder}; run the earlier stage first")
    return spark.read.parquet(f"{folder}/{name}")


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Replaces a table's files by df, which may read the same table, and reads them again: they are written aside, then put in its place."""
    spark = df.sparkSession
    aside = f"{path.rstrip('/')}.new"
    df.write.mode("overwrite").parquet(aside)
    fs, where = _file_system(spark, path)
    fs.delete(where, True)
    if not fs.rename(_file_system(spark, aside)[1], where):
        raise OSError(f"{aside} could not be renamed to {path}")
    spark.catalog.refreshByPath(path)
    return spark.read.schema(df.schema).parquet(path)
