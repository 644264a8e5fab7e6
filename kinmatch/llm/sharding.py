"""Sharding by proportional stratified interleaving.

Method. Rows of each source are put in a seeded random order and ranked; row r of a source with n rows gets the fractional rank
(r + 1/2) / n. Sorted by fractional rank, every stretch of the result has the sources in the mixture's proportions, so cutting it into
equal stretches gives shards that match the mixture. Law: `rows`, shards' row counts differ by one at most.

Ranks of a source that holds most rows aren't worked out in one task: rows are dealt by ranges of (source, random order), numbered inside
each partition, and the partitions' row counts give each partition's first number. No window runs over rows.

Defined cases. A null text has no bytes: size 1, text_crc32 0. A null source is a source of its own. Null and repeated doc_ids are rows as
any other; identical rows are interchangeable. An empty table gives no rows; with fewer rows than shards some shards stay empty. Other
columns are not looked at.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import table, written

SHARDS = 8
SEED = 20240607


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with `pos`, each row's place (from 0) in the order of those columns."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id()  # the partition's number in the upper bits, the row's in the lower 33
    kept = written(dealt.select("*", row.alias("_row")).withColumn("_part", F.shiftright("_row", 33)), name)
    counts = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row for each partition, however many rows the table has
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    pos = F.col("_first") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return kept.join(firsts, "_part").withColumn("pos", pos).drop("_part", "_row", "_first")


def interleave(docs: DataFrame, *, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, text_crc32, pos, shard, slot of every row of docs (doc_id, text, source)."""
    data = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    base = docs.select(
        "doc_id", "source", (F.length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("_s"), F.xxhash64(F.lit(seed), "doc_id").alias("_h")
    )
    base = numbered(written(base, "rows"), ["_s", "_h", "doc_id", "text_crc32", "size"], "by-source")
    per_source = base.groupBy("_s").agg(F.min("pos").alias("_at"), F.count(F.lit(1)).alias("_all"))
    share = (2 * (F.col("pos") - F.col("_at")) + 1).cast("double") / (2 * F.col("_all"))
    ranked = base.join(per_source, "_s").withColumn("_f", share).withColumn("_t", F.xxhash64(F.lit(seed), "_s")).drop("pos", "_at", "_all")
    placed = numbered(ranked, ["_f", "_t", "_s", "_h", "doc_id", "text_crc32", "size"], "interleaved")
    total = docs.count()
    shard, slot = cut(F.col("pos"), total, shards)
    return placed.select("doc_id", "source", "size", "text_crc32", "pos", shard.alias("shard"), slot.alias("slot"))


def cut(pos: Column, total: int, shards: int) -> tuple[Column, Column]:
    """Shard k takes the places from floor(k * total / shards) on, up to the next shard's first place."""
    shard = F.floor(((pos + 1) * shards - 1) / F.lit(max(total, 1)).cast("decimal(20,0)"))
    first = F.floor((shard * total) / F.lit(shards).cast("decimal(20,0)"))
    return shard.cast("int"), (pos - first).cast("long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = interleave(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


NAME, ORACLE = "op3_sharding", None
