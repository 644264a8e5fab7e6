"""A corpus pipeline of the operators in kinmatch.llm; each stage's decisions take effect on what the next one reads.

A stage begins by having what the stage before took given back: executors' memory, shuffle files, broadcasts.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.llm import bpe_automaton, decontamination, parity_join, substring_dedup, toxicity
from kinmatch.llm._common import free, table, written
from kinmatch.llm._links import bounded


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier predicts to be toxic go.

    Null and empty texts are scored like texts without features and stay unless the classifier's bias alone is toxic. Rows of one doc_id are decided
    by their own texts; equal rows are decided alike. Without toxic labels all stay. Columns keep their names, whatever these are.
    """
    free(spark)
    names = {c: "text" if c == "text" else f"_kin_{i}" for i, c in enumerate(docs.columns)}
    classifier = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    found = toxicity.score(docs.select(*[docs[c].alias(n) for c, n in names.items()]), classifier)
    return found.where("predicted = 0").select(*[F.col(n).alias(c) for c, n in names.items()])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies stays, that with the smallest doc_id (null last), then the smallest hash of doc_id and text.

    Rows are decided by their own texts: those that are linked with nothing stay, so null and empty texts do, and other texts of a doc_id whose
    text goes. Of rows equal in doc_id and text one stays, the one whose other columns' hash is smallest (equal rows in all columns are one).
    Empty tables give no rows.
    """
    free(spark)
    keyed = docs.withColumn("_kin_key", F.xxhash64("doc_id", "text"))
    classes = parity_join.similarity_classes(keyed.select(F.col("_kin_key").alias("doc_id"), "text")).where("n_shingles > 0")
    members = classes.select(F.col("doc_id").alias("_kin_key"), "component_id").distinct().join(keyed.select("_kin_key", F.col("doc_id").alias("_kin_id")).distinct(), "_kin_key")
    members = written(members, "members")
    firsts = members.groupBy("component_id").agg(F.min(F.struct(F.col("_kin_id").isNull().alias("none"), "_kin_id", "_kin_key")).alias("f"), F.count(F.lit(1)).alias("n"))
    gone = written(members.join(firsts.where("n > 1"), "component_id").where("_kin_key <> f._kin_key").select("_kin_key"), "gone")
    kept = keyed.join(bounded(gone, gone.count()), "_kin_key", "left_anti")
    # Rows equal in doc_id and text, if they have words.
    again = classes.groupBy(F.col("doc_id").alias("_kin_key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_kin_key")
    again = written(again.join(gone, "_kin_key", "left_anti"), "again")
    n = again.count()
    if n:
        others = F.xxhash64(*[c for c in docs.columns if c not in ("doc_id", "text")], F.lit(0))
        repeated = kept.join(bounded(again, n), "_kin_key", "left_semi").withColumn("_kin_others", others)
        first = repeated.groupBy("_kin_key").agg(F.min("_kin_others").alias("_kin_others"))
        repeated = repeated.join(first, ["_kin_key", "_kin_others"], "left_semi").dropDuplicates(["_kin_key"]).drop("_kin_others")
        kept = kept.join(bounded(again, n), "_kin_key", "left_anti").select(*docs.columns).union(repeated.select(*docs.columns))
    return kept.select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Paragraphs and runs of words that an earlier place has go from the texts; n_chars follows. All rows stay, some with an empty text.

    Null and empty texts, and rows without a doc_id, stay as they are; further columns are kept.
    """
    free(spark)
    out = substring_dedup.deduplicate(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go. Null and empty texts have none and stay; rows of one doc_id are decided by their own texts."""
    free(spark)
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), keep_rows=True)
    return found.where(F.size("spans") == 0).select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text of what is left: a row for each row; a null text is an empty one."""
    free(spark)
    import public_tokenizers

    return bpe_automaton.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", drop_repeated_passages),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

#: The first stage is a fitted model and the last a tokenizer; SQL can express neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' rows for the table documents; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
