"""Toxicity by non-negative positive-unlabelled learning.

Method. Confirmed toxic examples are the positives; all other texts, whether or not anyone looked at them, are unlabelled. A linear
classifier f (numpy) minimises the class-prior-corrected risk
    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)])        with the logistic loss l,
whose second part estimates the risk on the unseen negatives and is held at zero or above: where a step finds it below, the step goes against
that part's gradient instead. The prior is the positives' share among the labelled training rows; it can be given.

The score is the posterior that the prior and the margins' densities among positives and unlabelled texts give, as a rising curve.

Features: hashed words, and hashed word beginnings and endings of 4 to 6 letters, of the lower-cased text; presence, not counts. A feature
is used if its presence differs between positives and unlabelled texts with a chi-square of `MIN_CHI2` or more: far above what the best of
all features reaches by chance, so rare words of single texts carry no weight. Labels, lang, source and doc_id are no features.

The curve is an isotonic regression over the distinct margins, so that texts with equal margins, however many, get one posterior of their own.

Bounds. At most `max_positive` positives and `max_unlabelled` unlabelled rows are fitted to, those with the smallest hashed ids. Features are
counted and selected on the executors; the driver gets two counts of each feature from each of a fixed number of tasks, and the selected
features of the fitted rows. Every text is scored in full.

Defined cases. Null and empty texts have no features: they get the classifier's bias. Rows with null doc_ids are scored and never trained on.
Repeated rows are scored as often as they occur. Without a positive in training every score is 0. An empty table gives no rows.
"""
from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import batches, dropped, table, tidied, written

BITS = 18
MAX_POSITIVE = 6_000
MAX_UNLABELLED = 18_000
#: Mini-batches that are fitted to, however many rows there are.
STEPS = 2500
#: Partitions of the rows that are fitted to.
FITTED_PARTS = 8
MIN_CHI2 = 25.0
THRESHOLD = 0.7
_TO_WORDS = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


class WordFeatures(dict):
    """The feature numbers of each word as 32-bit numbers, kept for the first words seen up to a bound."""

    LIMIT = 80_000

    def __missing__(self, word: bytes) -> bytes:
        import xxhash

        mask = (1 << BITS) - 1
        letters = word.decode("utf-8", "replace")
        parts = {b"w" + word} | {f"{k}<{letters[:k]}".encode() for k in (4, 5, 6) if len(letters) > k} | {f"{k}>{letters[-k:]}".encode() for k in (4, 5, 6) if len(letters) > k}
        value = array("i", [xxhash.xxh64_intdigest(p) & mask for p in parts]).tobytes()
        if len(self) < self.LIMIT:
            self[word] = value
        return value


_features = WordFeatures()


def feature_ids(text: bytes | None) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text."""
    words = set((text or b"").translate(_TO_WORDS).split())
    return np.unique(np.frombuffer(b"".join(map(_features.__getitem__, words)), np.int32))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


class Classifier:
    """A linear margin, and a rising curve from margins to probabilities."""

    def __init__(self, weights: np.ndarray, bias: float, margins: np.ndarray, chances: np.ndarray):
        self.weights, self.bias, self.margins, self.chances = weights, bias, margins, chances

    def score(self, ids: np.ndarray) -> float:
        z = self.bias + self.weights[ids].sum()
        # the small second part keeps scores apart where the curve is level
        return float(0.98 * np.interp(z, self.margins, self.chances) + 0.02 / (1 + np.exp(-np.clip(z, -30, 30))))


def curve(positive: np.ndarray, unlabelled: np.ndarray, prior: float, least: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic | margin) = prior * density among positives / density among unlabelled texts: isotonic regression over the distinct margins.

    Neighbouring margins are taken together until they hold that share of the unlabelled texts; the curve is straight between their middles.
    """
    z, of = np.unique(np.concatenate([positive, unlabelled]), return_inverse=True)
    a, c = prior * np.bincount(of[: len(positive)], minlength=len(z)) / len(positive), np.bincount(of[len(positive) :], minlength=len(z)) / len(unlabelled)
    groups: list[list[float]] = []  # positives, unlabelled, lowest and highest margin
    for x, y, low in zip(a.tolist(), c.tolist(), z.tolist(), strict=True):
        if groups and groups[-1][1] < least:
            groups[-1] = [groups[-1][0] + x, groups[-1][1] + y, groups[-1][2], low]
        else:
            groups.append([x, y, low, low])
    if len(groups) > 1 and groups[-1][1] < least:
        x, y, _, high = groups.pop()
        groups[-1] = [groups[-1][0] + x, groups[-1][1] + y, groups[-1][2], high]
    rising: list[list[float]] = []  # positives, unlabelled, groups
    for x, y, _, _ in groups:
        rising.append([x, y, 1])
        while len(rising) > 1 and rising[-2][0] * rising[-1][1] >= rising[-1][0] * rising[-2][1]:
            x, y, k = rising.pop()
            rising[-1] = [rising[-1][0] + x, rising[-1][1] + y, rising[-1][2] + k]
    chance = np.concatenate([np.full(k, min(1.0, x / y) if y else 1.0) for x, y, k in rising])
    return np.array([(low + high) / 2 for *_, low, high in groups]), chance


class Rows:
    """Rows of feature numbers: one flat array and where each row's begin."""

    def __init__(self, flat: np.ndarray, at: np.ndarray):
        self.flat, self.at = flat, at

    def __len__(self) -> int:
        return len(self.at) - 1

    @classmethod
    def of(cls, rows: list[np.ndarray]) -> "Rows":
        return cls(np.concatenate(rows) if rows else np.zeros(0, np.int32), np.cumsum([0] + [len(r) for r in rows]))

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The features of these rows, and each one's place in `which`."""
        size = self.at[which + 1] - self.at[which]
        of = np.repeat(np.arange(len(which)), size)
        return self.flat[np.arange(len(of)) + np.repeat(self.at[which] - np.append(0, np.cumsum(size)[:-1]), size)], of


def telling(a: np.ndarray, c: np.ndarray, n: int, m: int, least: float) -> np.ndarray:
    """Sorted features whose presence differs between n positives (a have it) and m unlabelled texts (c) with a chi-square of at least that."""
    share = (a + c) / (n + m)
    with np.errstate(divide="ignore", invalid="ignore"):
        chi2 = (a / n - c / m) ** 2 / (share * (1 - share) * (1 / n + 1 / m))
    return np.flatnonzero(np.nan_to_num(chi2) >= least).astype(np.int32)


def risk(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """The positives' part of the risk, and the part that estimates the unseen negatives', before it is held at zero."""
    return prior * float(np.logaddexp(0, -zp).mean()), float(np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean())


def gradient(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """By positive and by unlabelled margin: the gradient of the risk, or against the negatives' part alone where that is below zero."""
    sigma = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    part_p, part_u = -prior * sigma(zp) / len(zp), sigma(zu) / len(zu)
    if risk(zp, zu, prior)[1] >= 0:
        return -prior * sigma(-zp) / len(zp) + part_p, part_u
    return -part_p, -part_u


def fit(positive: Rows, unlabelled: Rows, used: np.ndarray, prior: float, *, steps: int = STEPS, rate: float = 0.2, decay: float = 1e-5, seed: int = 7) -> Classifier:
    """Non-negative PU risk by mini-batches of both kinds and Adagrad steps. The rows' numbers are places in `used`."""
    rng = np.random.default_rng(seed)
    weights, square, bias, bias_square = np.zeros(len(used)), np.full(len(used), 1e-6), -1.0, 1e-6
    batch = 256

    def margins(rows: Rows, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flat, of = rows.take(which)
        return bias + np.bincount(of, weights[flat], len(which)), flat, of

    for _ in range(-(-steps * batch // max(len(unlabelled), batch))):
        order = rng.permutation(len(unlabelled))
        for k in range(0, len(order), batch):
            zp, fp, op = margins(positive, rng.integers(0, len(positive), batch))
            zu, fu, ou = margins(unlabelled, order[k : k + batch])
            on_p, on_u = gradient(zp, zu, prior)
            g = np.bincount(np.concatenate([fp, fu]), np.concatenate([on_p[op], on_u[ou]]), len(used)) + decay * weights
            square += g * g
            weights -= rate * g / np.sqrt(square)
            gb = on_p.sum() + on_u.sum()
            bias_square += gb * gb
            bias -= rate * gb / np.sqrt(bias_square)
    whole = np.zeros(1 << BITS, np.float32)
    whole[used] = weights
    everything = lambda rows: np.concatenate([bias + np.bincount(of, whole[used][flat].astype(float), len(w)) for w in np.array_split(np.arange(len(rows)), 1 + len(rows) // 1000) for flat, of in [rows.take(w)]])
    # Margins that differ by rounding only are one.
    return Classifier(whole, bias, *curve(everything(positive).round(6), everything(unlabelled).round(6), prior))


def rows_to_fit(docs: DataFrame, labels: DataFrame, max_positive: int, max_unlabelled: int) -> DataFrame:
    """Training rows (doc_id, positive): a bounded number of each kind, with the share of positives among all labelled training rows."""
    seen = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("positive"))
    ids = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id").distinct()
    kinds = ids.join(seen, "doc_id", "left").select("doc_id", F.coalesce("positive", F.lit(False)).alias("positive"))
    first = lambda of, n: kinds.where(F.expr(of)).orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").limit(n)
    # Unlabelled rows stand for the whole mixture, so the positives are among them too.
    return first("positive", max_positive).union(first("true", max_unlabelled).withColumn("positive", F.lit(False)))


def train(docs: DataFrame, labels: DataFrame, *, prior: float | None = None, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Classifier | None:
    """docs: doc_id, text; labels: doc_id, toxic. None without a positive."""
    chosen = written(rows_to_fit(docs, labels, max_positive, max_unlabelled), "chosen")
    if prior is None:
        share = labels.where(~held_out(F.col("doc_id"))).agg(F.avg(F.when(F.col("toxic") == 1, 1.0).otherwise(0.0))).first()[0] or 0.0
        prior = min(0.9, max(1e-3, share))

    # max_positive + max_unlabelled ids of 9 bytes at most: small enough to broadcast
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("positive", "text")
    texts = written(texts.repartition(FITTED_PARTS), "texts-to-fit")

    def count(frames):
        total, n = np.zeros((2, 1 << BITS), np.int32), [0, 0]
        for b in batches(frames):
            for p, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                total[int(p), feature_ids(t)] += 1
                n[int(p)] += 1
        _features.clear()  # the worker process may go on to other stages
        yield pa.RecordBatch.from_arrays([pa.array([p]) for p in (n[0], n[1], total.tobytes())], names=["m", "n", "counts"])

    total, n, m = np.zeros((2, 1 << BITS), np.int64), 0, 0
    for r in texts.mapInArrow(tidied(count), "m long, n long, counts binary").toLocalIterator():  # one vector of 2 MB a task
        total += np.frombuffer(r["counts"], np.int32).reshape(2, -1)
        n, m = n + r["n"], m + r["m"]
    if not n or not m:
        return None
    used = telling(total[1].astype(float), total[0].astype(float), n, m, MIN_CHI2)

    def featurise(frames):
        for b in batches(frames):
            found = [feature_ids(t) for t in b.column(1).cast(pa.binary()).to_pylist()]
            own = [np.searchsorted(used, i[np.isin(i, used)]).astype(np.int32) for i in found]
            # Rows come in the order of their texts' hashes, whatever partition they were in.
            order = [hashlib.blake2b(t or b"", digest_size=16).digest() for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(order, pa.binary()), pa.array([i.tobytes() for i in own], pa.binary())], names=["positive", "hash", "ids"])
        _features.clear()

    rows = texts.mapInArrow(tidied(featurise), "positive boolean, hash binary, ids binary").toArrow().sort_by([("positive", "ascending"), ("hash", "ascending")])
    kinds = [[np.frombuffer(i, np.int32) for i in rows.filter(pa.compute.equal(rows["positive"], p))["ids"].to_pylist()] for p in (True, False)]
    del rows
    dropped(chosen, texts)
    return fit(*map(Rows.of, kinds), used, prior)


def score(docs: DataFrame, classifier: Classifier | None) -> DataFrame:
    """docs with `score` and `predicted`, which take the place of columns of these names; whole texts, all rows."""
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(frames):
        c = shared.value
        for b in batches(frames):
            found = [c.score(feature_ids(t)) if c else 0.0 for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.float64())], names=[*names, "score"])
        _features.clear()

    return docs.mapInArrow(tidied(run), f"{schema}, score double").withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, train(docs, table(spark, sf_dir, "labels"))).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


NAME, ORACLE = "op1_toxicity", None
