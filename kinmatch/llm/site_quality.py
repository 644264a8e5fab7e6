"""Quality by hierarchical empirical Bayes over hosts and paths.

Method. A logistic classifier on a text's form (length, symbols, repeated words and lines, word length) gives each document's evidence, a
log odds against the base rate. Hosts and their paths are summed up as soft counts of good documents. Prior strengths come from the data by
the method of moments: how much the hosts' shares of good documents vary beyond chance (and the paths' within them). A host's share is shrunk
towards the global share, a path's towards its host's, so a sparse site stays near the prior; a document's own part is taken out of its
path's and host's counts before. The score is evidence and shrunk path share combined as log odds.

Any two columns can be host and path; `site_of` takes them from URLs. All is grouped aggregation and joins of small rows; texts are read once and never shuffled. The classifier is fitted to at most
`max_labelled` labelled rows, those with the smallest hashed ids.

Defined cases. Null and empty texts have the features of a text without words. Null hosts and paths are groups of their own. Rows with null
doc_ids are scored and never fitted to; repeated rows are scored, and count in their site, as often as they occur. Without labels of both
kinds the evidence is 0. An empty table gives no rows. Other columns are not looked at.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import SPACE_CLASS, let, table, written

MAX_LABELLED = 50_000
THRESHOLD = 0.5
#: Columns of the form features.
FORM = ("f_words", "f_symbols", "f_distinct", "f_lines", "f_length", "f_short")


def form_features(text: Column) -> Column:
    """Six numbers of a text, as a struct."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, f"{SPACE_CLASS}+"), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))

    def of(w: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1))
        return F.struct(
            F.log1p(F.size(w)).alias(FORM[0]),
            F.log1p(100 * F.regexp_count(whole, F.lit(r"[#*$%&|<>]")) / n).alias(FORM[1]),
            (F.size(F.array_distinct(w)) / n).alias(FORM[2]),
            let(lines, lambda x: F.size(F.array_distinct(x)) / F.greatest(F.size(x), F.lit(1))).alias(FORM[3]),
            F.least(F.length(F.array_join(w, "")) / n, F.lit(20.0)).alias(FORM[4]),
            (F.size(w) < 50).cast("double").alias(FORM[5]),
        )

    return let(words, of)


def site_of(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL: the host in lower case without user and port, the first part of the path; null where there is none."""
    part = lambda pattern: F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))
    before = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?"
    return F.lower(part(before + r"(\[[^\]/?#]*\]|[^/?#:]+)")), part(before + r"[^/?#]*/([^/?#]+)")


def fit_logistic(x: np.ndarray, y: np.ndarray, *, ridge: float = 1.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """Weights and intercept by Newton steps with a ridge on the weights."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hessian = (a * (p * (1 - p))[:, None]).T @ a + penalty
        step = np.linalg.solve(hessian, a.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def strength(groups: DataFrame, share: Column) -> float:
    """Prior strength (documents) of groups' shares around `share`, from their variance beyond chance. groups: good, n."""
    p = F.col("good") / F.col("n")
    spread = F.sum(F.col("n") * (p - share) ** 2)
    chance = F.sum(share * (1 - share))
    all_n, squares, k, mean = F.sum("n"), F.sum(F.col("n").cast("double") ** 2), F.count(F.lit(1)), F.sum("good") / F.sum("n")
    row = groups.where("n > 0").agg(spread.alias("s"), chance.alias("c"), all_n.alias("n"), squares.alias("q"), k.alias("k"), mean.alias("m")).first()
    if not row["k"] or row["k"] < 2 or not row["n"] or row["n"] == row["q"] / row["n"]:
        return 100.0
    between = max(0.0, (row["s"] - row["c"]) / (row["n"] - row["q"] / row["n"]))
    m = min(max(row["m"], 1e-6), 1 - 1e-6)
    return float(min(max(m * (1 - m) / between - 1 if between > 0 else 1e4, 1.0), 1e4))


def site_quality(docs: DataFrame, labels: DataFrame, *, host: str = "source", path: str = "lang", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, host, path, evidence, chance, host_share, path_share, score, kept. docs: doc_id, text and the two columns; labels: doc_id, quality."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    data = docs.select("doc_id", name(host).alias("host"), name(path).alias("path"), form_features(F.col("text")).alias("f")).select("doc_id", "host", "path", "f.*")
    data = written(data, "form")
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = marked.orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(max_labelled)
    # max_labelled rows of 12 bytes
    rows = data.join(F.broadcast(chosen), "doc_id").select(*FORM, F.col("quality").cast("double").alias("y")).orderBy(*FORM, "y").toPandas()
    x, y = rows[list(FORM)].to_numpy(), (rows["y"].to_numpy() > 0.5).astype(float)
    evidence = F.lit(0.0)
    base = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
    if 0 < y.sum() < len(y):
        centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        w, b = fit_logistic((x - centre) / scale, y)
        linear = F.lit(float(b - (w * centre / scale).sum()))
        for n, v in zip(FORM, w / scale, strict=True):
            linear = linear + F.lit(float(v)) * F.col(n)
        evidence = F.greatest(F.least(linear - F.lit(float(np.log(base / (1 - base)))), F.lit(12.0)), F.lit(-12.0))
    odds = lambda p: F.log(p / (1 - p))
    sigma = lambda z: 1 / (1 + F.exp(-z))
    data = data.select("doc_id", "host", "path", evidence.alias("evidence"))
    data = data.withColumn("chance", sigma(F.col("evidence") + F.lit(float(np.log(base / (1 - base))))))
    paths = written(data.groupBy("host", "path").agg(F.sum("chance").alias("good"), F.count(F.lit(1)).alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    total = hosts.agg(F.sum("good"), F.sum("n")).first()
    share = (total[0] + base) / (total[1] + 1) if total[1] else base
    by_host = strength(hosts, F.lit(share))
    sums = paths.join(hosts.select("host", F.col("good").alias("h_good"), F.col("n").alias("h_n")), "host")
    by_path = strength(sums, F.col("h_good") / F.col("h_n"))
    own = F.col("chance")
    host_share = (by_host * F.lit(float(share)) + F.col("h_good") - own) / (by_host + F.col("h_n") - 1)
    out = data.join(sums, ["host", "path"]).withColumn("host_share", host_share)
    path_share = (by_path * F.col("host_share") + F.col("good") - own) / (by_path + F.col("n") - 1)
    inside = F.greatest(F.least(path_share, F.lit(1 - 1e-6)), F.lit(1e-6))
    out = out.withColumn("path_share", inside).withColumn("score", sigma(F.col("evidence") + odds(F.col("path_share"))))
    return out.select("doc_id", "host", "path", "evidence", "chance", "host_share", "path_share", "score", (F.col("score") >= THRESHOLD).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


NAME, ORACLE = "op8_site_quality", None
