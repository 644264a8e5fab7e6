"""N-gram Jaccard join by parity sketches.

A document's set is that of its distinct `width`-word shingles (64-bit hashes). Two sets link when their Jaccard index is at least 4/5.

Parity sketch. Every element flips one bit of a bit sketch, so a bit holds the parity of the elements that hash to it, the sketch of a
symmetric difference is the XOR of the sketches, and their Hamming distance is at most the size of the symmetric difference. Linked sets of
a and b elements differ in at most (a + b) / 9 of them, which is at most a / 4 =: d for the one with a. Sketches have a power of two of bits,
four to eight for each element (a quarter of that where they travel with pairs); a longer one folds onto a shorter one by XOR.

Pigeonhole join. A second, much longer sketch is cut into k segments; a difference of d elements touches at most d of them, so linked sets agree
in all others. k depends on the size band (sizes from 2^j up to 2^(j+1)); a set that may link to a larger one in the next band is put up there
as well. A segment's bits are held as one token, their 64-bit XOR fingerprint (a fixed random word for each set bit), so flips cancel as in the bits.
Of two linked sets' tokens at most d are not the other's. So if all tokens are put in one order, the same for all sets, the first d + 1 tokens of both
have one in common. The order is by how many sets have a token: tokens of one set only come first and need not be joined at all. A set with no more
than d tokens puts up all of them and, against others like it, its shingles under the same rule. So no link is lost.

Counting. Tokens travel once to be counted, packed by many; what comes back to a set is those that other sets have too. Tokens that many sets of a
stretch have are not sent there: a list of the most frequent ones of all (any list gives the same links) comes last in the order.

Buckets (sets with a common token) are not expanded into pairs, see `_links`: pairs whose sketches' Hamming distance is above the bound go
before any text moves, the rest is verified exactly on the sets themselves.

Defined cases. Null and empty texts and those without words have an empty set, linked with nothing. Rows with the same doc_id are one
document for links; each is returned with its own set's size. Rows without a doc_id take the class of an equal set, else none, and link
nothing. An empty table gives no rows. Other columns are not looked at.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import DEALT, WordHashes, batches, dealt, dropped, free, mix64, packed, parts_of, shingle_sets, table, tidied, unpacked, written
from ._links import linked_classes, narrow, sketch, verify

WIDTH = 5
#: A segment's share of the bits of the long sketch is 2^24; the fingerprint of each bit is worked out, not kept.
SEGMENT_BITS = 24
#: Most tokens that are known to be frequent. Any list gives the same links.
KNOWN_TOKENS = 200_000
#: Tokens looked at together in a task; those that so many sets among them have may be on that list.
STRETCH = 250_000
FREQUENT = 16

_words = WordHashes()
U = np.uint64
CODE = U(3)


def signatures(sets: list[np.ndarray], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set; zeros for empty ones."""
    x, y = np.zeros(len(sets), U), np.zeros(len(sets), U)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        flat = np.concatenate([sets[i] for i in full])
        at = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
        x[full] = np.add.reduceat(mix64(flat + U(0x14057B7EF767814F * (2 * seed + 1) % 2**64)), at)
        y[full] = np.bitwise_xor.reduceat(flat, at)
    return x.view(np.int64), y.view(np.int64)


def segments_of_band(j: int) -> int:
    """Segments for sizes from 2^j on: 1.8 to 3.6 elements in each; more segments for small sets, where chance would fill too few."""
    return max(1, 4 << j if j < 6 else (11 << j) // 20)


def segment_tokens(s: np.ndarray, j: int) -> np.ndarray:
    """The tokens of a set in the scheme of band j; their last two bits say which scheme."""
    # Elements are uniform and sorted, so taking the segment from the upper half keeps segments together.
    segment = ((s >> U(32)) * U(segments_of_band(j))) >> U(32)
    word = mix64((segment << U(SEGMENT_BITS) | s & U((1 << SEGMENT_BITS) - 1)) + U(0x9FB21C651E98DF25 + (j << 40)))
    first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
    return np.bitwise_xor.reduceat(word, first) & ~CODE | U(j & 1)


def tokens_of(s: np.ndarray) -> list[tuple[int, np.ndarray, int]]:
    """(scheme, tokens, how many of them from the end of the order need not be joined). Sets of fewer than four elements link to equal sets only."""
    n = len(s)
    if n < 4:
        return []
    j = n.bit_length() - 1
    found, few = [], False
    for scheme in (j, j + 1) if 5 * n >= 4 << (j + 1) else (j,):
        tokens = segment_tokens(s, scheme)
        found.append((scheme & 1, tokens, max(0, len(tokens) - n // 4 - 1)))
        few |= len(tokens) <= n // 4
    if few:
        found.append((2, mix64(s ^ U(0xD6E8FEB86659FD93)) & ~CODE | U(2), (4 * n + 4) // 5 - 1))
    return found


def features(docs: DataFrame, width: int, seed: int) -> DataFrame:
    """doc_id, n, s1, s2 of every document, the sketch of the first one of each set in a partition; rows with token and count of frequent tokens."""

    def run(frames):
        seen: set[tuple[int, int]] = set()
        held: list[np.ndarray] = []

        kinds = dict.fromkeys(["doc_id", "n", "s1", "s2", "token", "count"], pa.int64()) | dict.fromkeys(["sketch", "wide"], pa.binary())

        def rows(size: int, **columns) -> pa.RecordBatch:
            """Rows with these columns, the others null."""
            return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(size, k) for c, k in kinds.items()], names=list(kinds))

        def frequent():
            t = np.sort(np.concatenate(held)) if held else np.zeros(0, U)
            first = np.flatnonzero(np.append(True, t[1:] != t[:-1])) if len(t) else np.zeros(0, np.int64)
            n = np.diff(np.append(first, len(t)))
            often = n >= FREQUENT
            return rows(int(often.sum()), token=t[first][often].view(np.int64), count=n[often])

        size = 0
        for b in batches(frames):
            sets = shingle_sets(b.column("text").cast(pa.binary()).to_pylist(), width, _words)
            s1, s2 = signatures(sets, seed)
            wide = []
            for d, s, sign in zip(b.column("doc_id").to_pylist(), sets, zip(s1.tolist(), s2.tolist(), strict=True), strict=True):
                new = d is not None and len(s) > 0 and sign not in seen
                wide.append(sketch(s) if new else None)
                if new:
                    seen.add(sign)
                    held += [t for _, t, _ in tokens_of(s)]
                    size += len(s)
            yield rows(len(sets), doc_id=b.column("doc_id"), n=[len(s) for s in sets], s1=s1, s2=s2, wide=wide, sketch=[x and narrow(x) for x in wide])
            if size >= STRETCH:
                yield frequent()
                held, size = [], 0
        yield frequent()

    return docs.mapInArrow(tidied(run), "doc_id long, n long, s1 long, s2 long, token long, count long, sketch binary, wide binary")


def frequent_tokens(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens, sorted, and a number for each that grows with its count, above any count of other tokens."""
    rows = found.where("token IS NOT NULL").groupBy("token").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "token").limit(KNOWN_TOKENS).toArrow()
    t, n = (np.asarray(rows.column(c).combine_chunks()) for c in ("token", "count"))
    order = np.argsort(t.view(U))
    return t.view(U)[order], n[order].astype(np.int64).view(U) + U(1 << 48)


def send_tokens(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], width: int, seed: int, parts: int) -> DataFrame:
    """DEALT rows. Kind 0: token, set (its first hash). Kind 1: set, token, count of frequent tokens. Kind 2: set, scheme, tokens to leave out."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(frames):
        known, level = shared.value
        seen: set[tuple[int, int]] = set()
        held: list[tuple[int, int, np.ndarray, int]] = []

        def send():
            token = np.concatenate([h[2] for h in held])
            node = np.repeat(np.array([h[0] for h in held], np.int64).view(U), [len(h[2]) for h in held])
            at = np.minimum(np.searchsorted(known, token), max(len(known) - 1, 0))
            often = known[at] == token if len(known) else np.zeros(len(token), bool)
            rows = [*dealt([token[~often], node[~often]], token[~often], parts, 0)]
            if often.any():
                rows += dealt([node[often], token[often], level[at[often]]], node[often], parts, 1)
            node, code, spare = (np.array([h[i] for h in held], np.int64) for i in (0, 1, 3))
            return packed(rows + [*dealt([node, code, spare], node, parts, 2)])

        size = 0
        for b in batches(frames):
            sets = shingle_sets(b.column("text").cast(pa.binary()).to_pylist(), width, _words)
            s1, s2 = signatures(sets, seed)
            for d, s, x, y in zip(b.column("doc_id").to_pylist(), sets, s1.tolist(), s2.tolist(), strict=True):
                if d is not None and len(s) >= 4 and (x, y) not in seen:
                    seen.add((x, y))
                    for code, tokens, spare in tokens_of(s):
                        held.append((x, code, tokens, spare))
                        size += len(tokens)
            if size >= STRETCH:
                yield send()
                held, size = [], 0
        if held:
            yield send()

    return docs.mapInArrow(tidied(run), DEALT)


def count_tokens(parts: int):
    """Kind 0 in, kind 1 out: (set, token, count) of tokens that several sets have. Other kinds pass."""

    def run(frames):
        held = []
        for b in frames:
            kind, rows = np.asarray(b.column("kind")), b.column("rows")
            if len(other := np.flatnonzero(kind)):
                yield b.take(pa.array(other))
            held += [rows[i].as_py() for i in np.flatnonzero(kind == 0).tolist()]
        token, node = unpacked(held, 2)
        del held
        token, node = shared_rows(token, node)
        order = np.lexsort((node, token))
        token, node = token[order], node[order]
        keep = np.append(True, (token[1:] != token[:-1]) | (node[1:] != node[:-1])) if len(token) else np.zeros(0, bool)
        token, node = token[keep], node[keep]  # equal sets of several partitions
        first = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(token)))
        several = np.repeat(size > 1, size)
        rows = dealt([node[several], token[several], np.repeat(size, size)[several]], node[several], parts, 1)
        if out := [*rows]:
            yield packed(out)

    return run


def shared_rows(token: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose token occurs more than once."""
    order = np.argsort(token)
    t = token[order]
    same = np.append(False, t[1:] == t[:-1]) if len(t) else np.zeros(0, bool)
    same[:-1] |= same[1:].copy()
    return t[same], node[order[same]]


def choose_keys(frames):
    """Rows (s1, keys): of each set's tokens that other sets have, in order, those that must be joined."""
    tokens, spares = [], []
    for b in frames:
        kind, rows = np.asarray(b.column("kind")), b.column("rows")
        for i, k in enumerate(kind.tolist()):
            (tokens if k == 1 else spares).append(rows[i].as_py())
    node, token, count = unpacked(tokens, 3)
    own, code, spare = unpacked(spares, 3)
    # A set's row with the number to leave out comes before its tokens of that scheme.
    node, scheme = np.concatenate([own, node]), np.concatenate([code, token & CODE])
    count, token = np.concatenate([np.zeros(len(own), U), count]), np.concatenate([spare, token])
    order = np.lexsort((token, count, scheme, node))
    node, scheme, count, token = (c[order] for c in (node, scheme, count, token))
    if not len(node):
        return
    new = np.append(True, (node[1:] != node[:-1]) | (scheme[1:] != scheme[:-1]))
    keep = new | np.append(True, (token[1:] != token[:-1]) | (count[1:] != count[:-1]))  # equal sets of several partitions
    node, count, token, new = node[keep], count[keep], token[keep], new[keep]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(node)))
    joined = np.maximum(size - 1 - token[first].astype(np.int64), 0)
    place = np.arange(len(node)) - np.repeat(first, size)
    use = (place >= 1) & (place <= np.repeat(joined, size))
    node, token = node[use], token[use]
    if len(node):
        first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        ends = np.append(first, len(node))
        for a in range(0, len(first), 2000):
            part = ends[a : a + 2001]
            keys = pa.ListArray.from_arrays(pa.array((part - part[0]).astype(np.int32)), pa.array(token[part[0] : part[-1]].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(node[part[:-1]].view(np.int64)), keys], names=["s1", "keys"])


def similarity_classes(docs: DataFrame, *, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark, parts = docs.sparkSession, parts_of(docs.sparkSession)
    for seed in range(8):
        found = written(features(docs, width, seed), "features")
        sets = written(found.where("n > 0").groupBy("s1").agg(F.min("doc_id").alias("rep"), F.min("s2").alias("s2"), F.max("s2").alias("other"), F.max("n").alias("n"), F.max("wide").alias("wide"), F.max("sketch").alias("sketch")), "sets")
        if sets.where("s2 <> other").isEmpty():  # else two sets have the same 64-bit hash: another one
            break
    sent = send_tokens(docs, frequent_tokens(found), width, seed, parts).repartition("part").mapInArrow(tidied(count_tokens(parts)), DEALT)
    keyed = sent.repartition("part").mapInArrow(tidied(choose_keys), "s1 long, keys array<long>")
    put_up = written(keyed.join(sets.select("s1", "rep", "n", "sketch", "wide"), "s1").select(F.col("rep").alias("node"), "keys", "n", "sketch", "wide"), "put-up")
    free(spark)
    # Sets of one doc_id belong together.
    rows = found.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "s1").distinct()
    several = rows.groupBy("doc_id").count().where("count > 1").select("doc_id")
    equal = rows.join(several, "doc_id").join(sets.select("s1", "rep"), "s1").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    texts = docs.select(F.col("doc_id").alias("node"), "text")
    classes = linked_classes(put_up, lambda pairs: verify(pairs, texts, lambda t: shingle_sets(t, width, _words)), equal)
    named = sets.join(classes.withColumnRenamed("node", "rep"), "rep", "left").select("s1", F.coalesce("component", "rep").alias("component"))
    named = written(named, "named")
    rows = written(found.where("token IS NULL").select("doc_id", "n", "s1"), "rows")
    dropped(found, sets, put_up)
    free(spark)
    out = rows.join(named, "s1", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(table(spark, sf_dir, "documents"))


NAME = "op2_parity_join"
ORACLE = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT r, array_to_string(w[i : i + 4], ' ') AS k FROM p),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
f AS (SELECT k FROM s GROUP BY k HAVING count(*) > 1),
t AS (SELECT s.r, s.k FROM s JOIN f ON s.k = f.k),
pr AS (SELECT a.r AS x, b.r AS y, count(*) AS i FROM t a JOIN t b ON a.k = b.k AND a.r < b.r GROUP BY 1, 2),
l AS (SELECT dx.doc_id AS x, dy.doc_id AS y FROM pr JOIN n nx ON x = nx.r JOIN n ny ON y = ny.r JOIN w dx ON dx.r = x JOIN w dy ON dy.r = y WHERE 100 * i >= 80 * (nx.n + ny.n - i)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
c AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT c.x, e.y FROM c JOIN e ON c.y = e.x)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, (SELECT min(c.y) FROM c WHERE c.x = w.doc_id) AS component_id
FROM w LEFT JOIN n ON w.r = n.r
"""
