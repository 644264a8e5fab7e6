"""Benchmark decontamination as a prefix-filtered set join of item windows with document words.

Method. Every benchmark item yields windows of `width` consecutive words (an item with fewer words is one window). Words are ordered by
rarity: how often they occur in all documents. The containment asked for is whole, so one prefix token is enough for each window, its
rarest word. A document's word that is a prefix token of windows is joined with them; its place and the token's place in the window give
where the window would start (positional bound), it must lie inside the document (length bound), and then all words of the window are
compared with the document's. A document word inside any occurrence of a window is hit.

The benchmark is the stated query set. Its words are counted first: up to `block_words` it goes to the executors as one index of some 30 bytes a word;
a larger one is dealt into blocks of about that size (long items in pieces that overlap by a window less one word), all documents pass through
one block after another, and only what was hit is kept of the passes before the last.

Defined cases. Null and empty texts have no words: they aren't hit, and such items have no windows. Items with a null item_id hit words but
are not listed. Repeated documents are all returned; repeated item_ids are one item. Other columns are not looked at.
"""
from __future__ import annotations

from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._common import WordIds, batches, mix64, table, tidied, written

WIDTH = 10
BLOCK_WORDS = 4_000_000
#: Words at most of a piece of an item.
PIECE_WORDS = 50_000
#: Lower-cases A-Z; bytes of no word become spaces: all below 0x80 but digits and letters.
WORD_BYTES = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
#: 0xFF occurs in no UTF-8 text; as a word of its own it stands between the documents of a batch.
BETWEEN = b" \xff "


def split_words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def batch_ids(column: pa.Array, ids: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of a batch's texts, one after another with -2 after each text, and the places of the -2."""
    texts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
    words = split_words(BETWEEN.join(texts) + BETWEEN)
    found = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    return found, np.flatnonzero(found == -2)


def word_counts(docs: DataFrame, vocabulary: list[bytes]) -> np.ndarray:
    """How often each word occurs in all documents. As many counts as the vocabulary has words are shuffled from each task and collected."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)

    def count(frames):
        ids = WordIds({w: i for i, w in enumerate(shared.value)} | {b"\xff": -2})
        total = np.zeros(len(ids) - 1, np.int64)
        for b in batches(frames, 4096):
            found, _ = batch_ids(b.column(0), ids)
            total += np.bincount(found[found >= 0], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["w", "n"])

    rows = docs.select("text").mapInArrow(tidied(count), "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(len(vocabulary), np.int64)
    for w, n in rows:
        counts[w] = n
    return counts


class Index:
    """Windows of one block of the benchmark, by prefix token. A window is a place in the items' words, one after another, and a length."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], width: int):
        self.vocabulary = sorted({w for _, words in items for w in words})
        number = {w: i for i, w in enumerate(self.vocabulary)}
        self.names = sorted({i for i, _ in items} - {None})
        named = {n: k for k, n in enumerate(self.names)} | {None: -1}
        sizes = np.array([len(words) for _, words in items], np.int64)
        self.words = np.fromiter((number[w] for _, words in items for w in words), np.int32, int(sizes.sum()))
        windows = np.where(sizes > 0, np.maximum(sizes - width + 1, 1), 0)
        start = np.arange(windows.sum()) + np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(windows) - windows), windows)
        length = np.repeat(np.minimum(sizes, width), windows)
        owner = np.repeat(np.array([named[i] for i, _ in items], np.int64), windows)
        self.width, self.start, self.length = width, start, length
        order = np.lexsort((start, self._hashes(), length))
        start, length = start[order], length[order]
        same = np.append(False, length[1:] == length[:-1]) if len(start) else np.zeros(0, bool)
        for k in range(width):
            here = self._word(start, k)
            same[1:] &= (k >= length[1:]) | (here[1:] == here[:-1])
        group = np.cumsum(~same) - 1
        self.start, self.length = start[~same], length[~same]
        owner = owner[order]
        pairs = np.unique(np.stack([group[owner >= 0], owner[owner >= 0]]), axis=1)
        self.owner_of, self.owner_at = pairs[1], np.searchsorted(pairs[0], np.arange(len(self.start) + 1))

    def _word(self, start: np.ndarray, k: int) -> np.ndarray:
        return self.words[np.minimum(start + k, max(len(self.words) - 1, 0))] if len(start) else np.zeros(0, np.int32)

    def _hashes(self) -> np.ndarray:
        """Brings equal windows together; what stands side by side is compared."""
        total = np.zeros(len(self.start), np.uint64)
        for k in range(self.width):
            total = np.where(k < self.length, mix64(total + self._word(self.start, k).astype(np.uint64) + np.uint64(1)), total)
        return total

    def owners(self, windows: list[int]) -> list[str]:
        return sorted({self.names[i] for w in windows for i in self.owner_of[self.owner_at[w] : self.owner_at[w + 1]].tolist()})

    def order(self, counts: np.ndarray) -> None:
        """Chooses each window's rarest word (the first of equals) as its prefix token."""
        rarity = np.lexsort((np.arange(len(counts)), counts)).argsort() if len(counts) else counts
        least, self.offset, token = np.full(len(self.start), len(counts), np.int64), np.zeros(len(self.start), np.int64), np.zeros(len(self.start), np.int64)
        for k in range(self.width):
            word = self._word(self.start, k)
            better = (k < self.length) & (rarity[word] < least) if len(word) else np.zeros(0, bool)
            least[better], self.offset[better], token[better] = rarity[word[better]], k, word[better]
        self.by_token = np.argsort(token, kind="stable")
        many = np.bincount(token, minlength=len(counts)) if len(token) else np.zeros(len(counts), np.int64)
        self.many = np.append(many, [0, 0])  # ids -1 and -2 find no window
        self.first = np.cumsum(np.append(0, many))[: len(many)]

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, windows): every place in ids where a window occurs."""
        at = np.flatnonzero(self.many[ids])
        n = self.many[ids[at]]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        window = self.by_token[np.repeat(self.first[ids[at]], n) + within] if len(n) else np.zeros(0, np.int64)
        start = np.repeat(at, n) - self.offset[window]
        ok = (start >= 0) & (start + self.length[window] <= len(ids))
        start, window = start[ok], window[ok]
        for k in range(self.width):
            same = (self.length[window] <= k) | (ids[np.minimum(start + k, len(ids) - 1)] == self._word(self.start[window], k))
            start, window = start[same], window[same]
        return start, window


def hits_of_block(docs: DataFrame, index: Index) -> DataFrame:
    """docs with n_words, and with this block's occurrences added to the columns spans (half-open word ranges) and item_ids.

    The text is read from the column text, which goes, or where there is none from the struct doc, which stays.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)
    inside = "text" not in docs.columns
    schema = StructType([f for f in docs.schema.fields if f.name != "text"])
    names = schema.names
    as_arrow = pa.schema([("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("item_ids", pa.list_(pa.string()))])

    def find(frames):
        ix = shared.value
        ids = WordIds({w: i for i, w in enumerate(ix.vocabulary)} | {b"\xff": -2})
        for b in batches(frames, 4096):
            found, ends = batch_ids(pc.struct_field(b.column("doc"), "text") if inside else b.column("text"), ids)
            begins = np.append(-1, ends)[:-1] + 1
            start, window = ix.occurrences(found)
            spans, items = b.column("spans").to_pylist(), b.column("item_ids").to_pylist()
            doc = np.searchsorted(ends, start)
            order = np.lexsort((start, doc))
            for d, group in groupby(order.tolist(), key=lambda i: int(doc[i])):
                group = list(group)
                new = [[int(start[i] - begins[d]), int(start[i] - begins[d] + ix.length[window[i]])] for i in group]
                spans[d] = merged((spans[d] or []) + new)
                items[d] = sorted({*(items[d] or ()), *ix.owners(sorted({int(window[i]) for i in group}))})
            made = {"n_words": pa.array(ends - begins), "spans": pa.array(spans, as_arrow.field("spans").type), "item_ids": pa.array(items, as_arrow.field("item_ids").type)}
            yield pa.RecordBatch.from_arrays([made.get(n, b.column(n)) for n in names], names=names)

    return docs.mapInArrow(tidied(find), schema)


def merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def pieces(benchmark: DataFrame, width: int, most: int) -> DataFrame:
    """item_id, words (parted by blanks), n: the items, long ones in pieces that overlap by a window less one word."""

    def cut(frames):
        for b in batches(frames):
            out = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = split_words(t or b"")
                for at in range(0, max(len(words) - width + 1, 1) if words else 0, max(most - width + 1, 1)):
                    piece = words[at : at + max(most, width)]
                    out.append((i, b" ".join(piece), len(piece)))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.string(), pa.binary(), pa.int64()))], names=["item_id", "words", "n"])

    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(cut, "item_id string, words binary, n long")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, width: int = WIDTH, block_words: int = BLOCK_WORDS, keep_rows: bool = False) -> DataFrame:
    """doc_id, n_words, spans (merged half-open ranges of hit words), item_ids (strings); with keep_rows also `doc`, a struct of docs' own columns. docs: doc_id, text; benchmark: item_id, text."""
    items = written(pieces(benchmark, width, min(PIECE_WORDS, block_words)), "benchmark-pieces")
    blocks = max(1, -(-(items.agg(F.sum("n")).first()[0] or 0) // block_words))
    none = {"n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<array<long>>"), "item_ids": F.array().cast("array<string>")}

    def index_of(k: int) -> Index:
        block = items.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == k) if blocks > 1 else items
        index = Index([(i, bytes(w).split()) for i, w in block.select("item_id", "words").toLocalIterator()], width)
        index.order(word_counts(docs, index.vocabulary))
        return index

    row = F.struct(*[docs[c] for c in docs.columns]).alias("doc") if keep_rows else docs["text"]
    found = docs.select("doc_id", row, *[c.alias(n) for n, c in none.items()])
    if blocks > 1:
        # What a text is known by: 128 bits of hashes.
        key = lambda text: [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]
        keyed = docs.select(*key(F.col("text")), "text", *[c.alias(n) for n, c in none.items()])
        hits = [written(hits_of_block(keyed, index_of(k)).where(F.size("spans") > 0).select("k1", "k2", "spans", "item_ids"), "hits") for k in range(1, blocks)]
        hits = reduce(DataFrame.union, hits).groupBy("k1", "k2").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("_s"), F.array_distinct(F.flatten(F.collect_list("item_ids"))).alias("_i"))
        text = F.col("doc.text") if keep_rows else F.col("text")
        found = found.select("doc_id", "doc" if keep_rows else "text", "n_words", *key(text)).join(hits, ["k1", "k2"], "left")
        found = found.select("doc_id", "doc" if keep_rows else "text", "n_words", F.coalesce("_s", none["spans"]).alias("spans"), F.coalesce("_i", none["item_ids"]).alias("item_ids"))
    return hits_of_block(found, index_of(0))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated")
    )


NAME = "op7_benchmark_decontamination"
ORACLE = r"""
WITH d0 AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, w FROM d0),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS k FROM s),
sizes AS (SELECT DISTINCT n FROM wins),
ds AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, sizes WHERE len(w) >= n),
dk AS (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS k FROM ds),
h AS (SELECT dk.r, dk.i, dk.n, wins.item_id FROM dk JOIN wins ON dk.k = wins.k AND dk.n = wins.n),
hp AS (SELECT r, unnest(range(i, i + n)) AS p FROM h),
hc AS (SELECT r, count(DISTINCT p) AS n_hit FROM hp GROUP BY r),
hi AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM h GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hc.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(hi.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(hi.items, '')) AS items_sha256, coalesce(hc.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hc ON d.r = hc.r LEFT JOIN hi ON d.r = hi.r
"""
