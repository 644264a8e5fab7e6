"""Quality rules: base counts of each text, and a hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Main path: DataFrame functions only.

Method. Word unigrams and bigrams are hashed into `buckets` bins. Two multinomials over the bins are counted: one over the trusted
documents, one over all documents. A document's score is the mean over its n-grams of log(p_target / p_raw), both with add-`alpha`
smoothing; mean, so length does not count. A document passes if its score is at least `threshold`.

Defined cases. Null and empty texts have no words: all counts 0, score 0.0, base_failed true, kept false. Repeated rows count and are
returned as often as they occur; rows with a null doc_id are scored, but cannot be trusted ones. Without trusted rows, or with an empty
table, the ratio is 0 for every bin. Other columns of the inputs are not looked at.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import SPACE_CLASS, let, table

BUCKETS = 1 << 15
ALPHA = 1.0
#: Mean log ratio per n-gram below which a text is unlike the trusted documents. On the 10,000 documents of the 0.1 tables it lies in the gap between
#: the kinds: of documents that pass the base counts all 3,243 of quality 1 are above it, and 0.3 % of those of quality 0.
THRESHOLD = -0.09
#: Low bits of a packed window that hold its position, enough for any array; the other 32 are hash bits that only preselect, equality is then
#: tested on the words.
POSITION_BITS = 31
#: Rows at most of the bits that go before a join by ids: 16.8 million bits.
FILTER_WORDS = 1 << 18


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}+"), lambda w: w != "")


def bins_at(words: Column, w: Column, i: Column, buckets: int) -> tuple[Column, Column]:
    """Bins of the unigram w at place i and of the bigram that ends there; the first word's bigram has no left word."""
    bin_of = lambda *c: F.pmod(F.xxhash64(*c), F.lit(buckets)).cast("int")
    return bin_of(w), bin_of(F.get(words, i - 1), F.lit(1), w)


def n_grams(words: Column, buckets: int) -> Column:
    """Bins of all unigrams and bigrams of an array of words."""
    return F.concat(F.transform(words, lambda w, i: bins_at(words, w, i, buckets)[0]), F.transform(words, lambda w, i: bins_at(words, w, i, buckets)[1]))


def mean_ratio(words: Column, llr: Column, buckets: int) -> Column:
    each = F.transform(words, lambda w, i: F.get(llr, bins_at(words, w, i, buckets)[0]) + F.get(llr, bins_at(words, w, i, buckets)[1]))
    return F.when(F.size(words) == 0, F.lit(0.0)).otherwise(F.aggregate(each, F.lit(0.0), lambda a, x: a + x) / (2 * F.size(words)))


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, first occurrences included.

    Windows are packed as hash bits and position and sorted as longs; those whose hash bits equal a neighbour's are sorted again by
    their words, so equality is exact.
    """
    low = (1 << POSITION_BITS) - 1

    def packed(w: Column) -> Column:
        return F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size(w) - 3),
                lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF & ~low)).bitwiseOR(i.cast("long")),
            )
        )

    def near(s: Column) -> Column:
        # the packed values are not negative, so equal hash bits mean a difference of at most `low`
        return F.filter(s, lambda x, j: (x - F.get(s, j - 1) <= low) | (F.get(s, j + 1) - x <= low))

    def keyed(w: Column, found: Column) -> Column:
        at = lambda x: x.bitwiseAND(F.lit(low)).cast("int")
        return F.sort_array(F.transform(found, lambda x: F.struct(F.concat_ws(" ", F.slice(w, at(x) + 1, 3)).alias("k"), at(x).alias("i"))))

    def places(s: Column) -> Column:
        other = lambda x, j: F.coalesce(F.get(s, j)["k"] == x["k"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, j: other(x, j + 1) | other(x, j - 1)), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    exact = lambda w: let(near_of(w), lambda found: F.when(F.size(found) == 0, F.lit(0).cast("long")).otherwise(let(keyed(w, found), lambda s: let(places(s), covered))))
    near_of = lambda w: let(packed(w), near)
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(exact(words))


def base_counts(text: Column, words: Column) -> dict[str, Column]:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(words),
    }


def among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is one of ids (distinct, not null), found by the same plan at any size: only their texts are shuffled, and few others'.

    One bit for each hash of an id, `FILTER_WORDS` rows of 64 bits at most, is broadcast first; what passes it is then joined by the ids themselves.
    """
    few = docs
    if docs.schema["doc_id"].dataType == ids.schema["doc_id"].dataType:  # else equal ids may have other hashes
        place = lambda c: F.pmod(F.xxhash64(c), F.lit(64 * FILTER_WORDS))
        word, bit = (lambda c: F.shiftright(place(c), 6)), (lambda c: F.pmod(place(c), F.lit(64)).cast("int"))
        held = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit("doc_id"))).alias("_bits")
        words = F.broadcast(ids.groupBy(word("doc_id").alias("_word")).agg(held))
        # A semi-join, as the next one would be pushed below an inner join.
        few = docs.join(words, (word(docs["doc_id"]) == words["_word"]) & (F.getbit(words["_bits"], bit(docs["doc_id"])) == 1), "left_semi")
    return few.join(ids.hint("merge"), "doc_id", "left_semi")


def log_ratio(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, alpha: float = ALPHA) -> DataFrame:
    """One row with the array `llr`: log(p_target / p_raw) of every bin. docs: doc_id, text; trusted: doc_id.

    The counts of all documents are summed by bin before anything is shuffled, so a task sends at most `buckets` rows.
    """
    spark = docs.sparkSession
    ids = trusted.where("doc_id IS NOT NULL").select("doc_id").distinct()
    binned = lambda df, t: df.select(F.lit(t).alias("t"), F.explode(let(words_of(F.col("text")), lambda w: n_grams(w, buckets))).alias("bin"))
    bins = binned(docs, 0).union(binned(among(docs, ids), 1))
    counts = bins.groupBy("bin").agg(F.sum("t").alias("target"), F.count_if(F.col("t") == 0).alias("raw"))
    full = spark.range(buckets).select(F.col("id").cast("int").alias("bin")).join(counts, "bin", "left").na.fill(0)
    total = full.groupBy().agg(
        F.sum("target").alias("all_target"), F.sum("raw").alias("all_raw"), F.sort_array(F.collect_list(F.struct("bin", "target", "raw"))).alias("each")
    )
    p = lambda n, of: (n + F.lit(alpha)) / (of + F.lit(alpha * buckets))
    return total.select(
        F.transform("each", lambda x: F.when(F.col("all_target") == 0, F.lit(0.0)).otherwise(F.log(p(x["target"], F.col("all_target")) / p(x["raw"], F.col("all_raw"))))).alias("llr")
    )


def trusted_rows(labels: DataFrame) -> DataFrame:
    return labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def quality_rules(docs: DataFrame, labels: DataFrame, *, buckets: int = BUCKETS, alpha: float = ALPHA, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base counts, base_failed, llr_score (double), kept. docs: doc_id, text. labels: doc_id, quality."""
    docs = docs.select("doc_id", "text")
    ratio = log_ratio(docs, trusted_rows(labels), buckets, alpha)
    text, words = F.col("text"), F.col("words")
    # `buckets` doubles, no more at any size: they come to the driver once and go out as one constant that is folded before tasks start.
    values = ratio.select(F.array_join(F.col("llr").cast("array<string>"), ",")).first()[0]
    llr = F.split(F.lit(values), ",").cast("array<double>")
    everything = let(
        words_of(text),
        lambda w: F.struct(*[c.alias(n) for n, c in base_counts(text, w).items()], mean_ratio(w, llr, buckets).alias("llr_score")),
    )
    out = docs.select("doc_id", everything.alias("x")).select("doc_id", "x.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("llr_score") >= F.lit(threshold)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


NAME, ORACLE = "op10_quality_rules", None
