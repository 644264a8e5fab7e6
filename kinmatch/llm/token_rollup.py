"""Delta-maintained token counts by source, language and tokenizer version.

Method. Changes come in batches of signed rows: an insert adds a document and its tokens, a delete takes both away, a revision adds the
difference of the new and the old count. A batch is summed by key before it is stored, so what a commit writes does not depend on how many
documents changed. Maintained totals hold the sums of all batches but the last few and, in the same table, the names of the batches that are
in them; every `fold_every` commits the pending batches are added to them. Reading adds the pending batches, so it never goes over all of them.

Commits are idempotent. A batch, and each version of the totals, is written aside and put in its place by one rename that fails if the name is
taken: of two writers of one batch id, or of one version, only one succeeds, and a lost job leaves nothing that is read. A batch that is there is
never written again, whatever is handed in under its id. (On object stores a rename is no single step; there one writer at a time must be seen to.)

Defined cases. Null sources, languages and versions are keys of their own (null). Null counts are 0. A kind that is unknown or null fails the
commit. Keys whose documents and tokens come to 0 are left out of the totals; deletes of what was never inserted make them negative, and they are
returned so. An empty batch commits and changes nothing. Repeated rows of a batch count as often as they occur. Other columns are not looked at.
"""
from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import new_folder, table, written

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long"


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums by key. changes: kind (insert, delete, revise), the keys, n_tokens, old_tokens (of revisions)."""
    n, old = F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)), F.coalesce(F.col("old_tokens").cast("long"), F.lit(0))
    kind = F.col("kind")
    unknown = F.raise_error(F.concat(F.lit("unknown kind of change: "), F.coalesce(kind, F.lit("null")))).cast("long")
    docs = F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0).otherwise(unknown)
    tokens = F.when(kind == "insert", n).when(kind == "delete", -n).when(kind == "revise", n - old).otherwise(unknown)
    return changes.groupBy(*KEYS).agg(F.sum(docs).cast("long").alias("docs"), F.sum(tokens).cast("long").alias("tokens"))


class Rollup:
    def __init__(self, spark: SparkSession, folder: str, fold_every: int = 8):
        self.spark, self.folder, self.fold_every = spark, folder.rstrip("/"), fold_every
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.folder).getFileSystem(self._conf)

    def _batch(self, batch_id: str) -> str:
        if not batch_id or not all(c.isalnum() or c in "-_." for c in batch_id) or batch_id.startswith((".", "_")):
            raise ValueError(f"no batch id: {batch_id!r}")
        return f"{self.folder}/batch={batch_id}"

    def _whole(self, folder: str) -> bool:
        return self._fs.exists(self._path(f"{folder}/_SUCCESS"))

    def _put(self, df: DataFrame, folder: str) -> bool:
        """Writes df as this folder, unless there is one; whether it did."""
        aside = f"{self.folder}/_aside-{uuid.uuid4().hex}"
        df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(aside)
        if self._fs.exists(self._path(folder)) and not self._whole(folder):
            self._fs.delete(self._path(folder), True)
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        try:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(folder).toUri(), self._conf)
            context.rename(self._path(aside), self._path(folder), gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError:
            if not self._whole(folder):
                raise
            self._fs.delete(self._path(aside), True)
            return False
        return True

    def committed(self, batch_id: str) -> bool:
        return self._whole(self._batch(batch_id))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Adds a batch; False if it has been committed before, and then nothing is done."""
        if self.committed(batch_id) or not self._put(deltas(changes), self._batch(batch_id)):
            return False
        if len(self._pending(self._maintained())) >= self.fold_every:
            self.fold()
        return True

    def _names(self, prefix: str) -> list[str]:
        if not self._fs.exists(self._path(self.folder)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder)) if s.isDirectory()]
        return sorted(n[len(prefix) :] for n in names if n.startswith(prefix) and self._whole(f"{self.folder}/{n}"))

    def batches(self) -> list[str]:
        return self._names("batch=")

    def _maintained(self) -> tuple[int, DataFrame]:
        """The last version of the totals, and its rows: sums by key, and a row for each batch in them."""
        last = max(map(int, self._names("total=")), default=0)
        schema = f"{SCHEMA}, batch string"
        return last, self.spark.read.schema(schema).parquet(f"{self.folder}/total={last}") if last else self.spark.createDataFrame([], schema)

    def _pending(self, maintained: tuple[int, DataFrame]) -> list[str]:
        # one name for each batch
        done = {r[0] for r in maintained[1].where("batch IS NOT NULL").select("batch").toLocalIterator()}
        return [b for b in self.batches() if b not in done]

    def _sums(self, maintained: tuple[int, DataFrame], pending: list[str]) -> DataFrame:
        sums = maintained[1].where("batch IS NULL").drop("batch")
        if pending:
            sums = sums.union(self.spark.read.schema(SCHEMA).parquet(*map(self._batch, pending)))
        return sums.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 OR tokens <> 0")

    def fold(self) -> bool:
        """Adds the pending batches to the maintained totals, as their next version; whether this call did."""
        last, rows = self._maintained()
        if not (pending := self._pending((last, rows))):
            return False
        names = rows.where("batch IS NOT NULL").union(self.spark.createDataFrame([(None, None, None, None, None, b) for b in pending], f"{SCHEMA}, batch string"))
        done = self._put(self._sums((last, rows), pending).withColumn("batch", F.lit(None).cast("string")).union(names), f"{self.folder}/total={last + 1}")
        if done and last > 1:  # readers of the version before may still be at it
            self._fs.delete(self._path(f"{self.folder}/total={last - 1}"), True)
        return done

    def totals(self) -> DataFrame:
        """The keys with docs and tokens, over all committed batches."""
        maintained = self._maintained()
        return self._sums(maintained, self._pending(maintained))


#: Two versions of a tokenizer: runs without white space; runs of letters and digits.
VERSIONS: dict[str, Column | str] = {"words-1": r"[^\x20\x09-\x0D]+", "runs-2": r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"}


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang and the count by each version."""
    return docs.select("doc_id", "source", "lang", *[F.regexp_count(F.coalesce("text", F.lit("")), F.lit(p)).cast("long").alias(v) for v, p in VERSIONS.items()])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in under both versions; those labelled toxic are taken down; the first version's counts of those labelled low in quality are revised to the second's; the last two batches are handed in again."""
    docs = written(counted(table(spark, sf_dir, "documents")), "counts")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    rows = lambda df, kind, v, n=None: df.select(F.lit(kind).alias("kind"), "source", "lang", F.lit(v).alias("tokenizer"), F.col(f"`{n or v}`").alias("n_tokens"), F.col(f"`{v}`").alias("old_tokens"))
    both = lambda df, kind: rows(df, kind, "words-1").union(rows(df, kind, "runs-2"))
    marked = docs.join(labels, "doc_id")
    taken, poor = marked.where("toxic = 1"), marked.where("quality = 0 AND coalesce(toxic, 0) <> 1")
    rollup = Rollup(spark, new_folder(spark, "rollup"), fold_every=2)
    rollup.commit("0-insert", both(docs, "insert"))
    for _ in range(2):
        rollup.commit("1-takedown", both(taken, "delete"))
        rollup.commit("2-recount", rows(poor, "revise", "words-1", "runs-2"))
    return rollup.totals()


NAME = "op4_token_rollup"
ORACLE = r"""
WITH n AS (SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w, len(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS r FROM documents),
l AS (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY doc_id),
d AS (SELECT n.*, coalesce(l.toxic, 0) AS toxic, coalesce(l.quality, 1) AS quality FROM n LEFT JOIN l ON n.doc_id = l.doc_id),
k AS (SELECT source, lang, 'words-1' AS tokenizer, CASE WHEN quality = 0 THEN r ELSE w END AS t FROM d WHERE toxic <> 1
      UNION ALL SELECT source, lang, 'runs-2', r FROM d WHERE toxic <> 1)
SELECT source, lang, tokenizer, CAST(count(*) AS BIGINT) AS docs, CAST(sum(t) AS BIGINT) AS tokens FROM k GROUP BY source, lang, tokenizer
"""
