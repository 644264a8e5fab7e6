"""How many parts a table is dealt into, and columns that are worked out once for each distinct value."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of files to a part: some 100,000 rows of a narrow table.
PART_BYTES = 2_000_000
#: A plan without known sizes says more than this.
UNKNOWN = 1 << 50


def parts(*tables: DataFrame) -> int:
    """Parts in proportion to the files that the tables are read from, two for each core at least.

    AQE sizes partitions by compressed bytes, and repetitive rows take many times those in memory; so a task's share would grow with the tables.
    """
    total = 0
    for df in tables:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
        total += sum(s for s in sizes if s < UNKNOWN)
    return max(2 * tables[0].sparkSession.sparkContext.defaultParallelism, total // PART_BYTES)


def once_a_value(df: DataFrame, key: str, columns: dict[str, Column], n: int) -> DataFrame:
    """df with the columns, which depend on the key only: they are worked out once for each distinct key, the keys dealt evenly into n parts."""
    found = df.select(F.col(key).alias("_value")).distinct().repartition(n).withColumns(columns)
    return df.join(found, F.col(key).eqNullSafe(F.col("_value")), "left").drop("_value")
