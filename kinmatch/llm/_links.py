"""Classes of linked nodes from join keys: buckets become stars, stars are verified, classes are the components of what holds.

A node puts up keys; nodes with a common key are candidates. A bucket (the nodes of one key) is not expanded into its pairs: each member is
paired with the smallest one, first inside a stretch of rows (so a key's rows are at most one a stretch when they are shuffled), then across.
If all pairs of a bucket's star are linked or end up in one class by other links, so is the bucket. What is left are buckets with members
in several classes; there members of different classes are compared by their parity sketches, bucket by bucket and, where a bucket is large, in
tiles of it. Of the pairs that the sketches let through, those leave the task that would join classes, the closest first, and are verified; where one
fails, the next turn looks for others. So every linked pair with a common key ends up in one class.

Parity sketch: a bit for each hash value, the parity of the elements that have it. The Hamming distance of two sketches is at most the size of
the symmetric difference, and sets of a and b elements with a Jaccard index of 4/5 or more differ in at most (a + b) / 9 elements.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ._common import DEALT, batches, dealt, dropped, free, packed, parts_of, tidied, unpacked, written
from .components import components

#: Bytes at most that are broadcast in a join, by counted rows and the given width; larger sides are shuffled.
BROADCAST_BYTES = 16 << 20
#: Parts at least that one node's partners are dealt over when they are verified, and pairs for each further part.
SALTS = 16
PAIRS_A_PART = 100_000
#: Keys that are brought together in a task before they are dealt.
STRETCH = 250_000
#: Members of a bucket that are compared in one tile.
TILE = 1024
#: Turns in which only as many pairs are verified as may join the classes of a tile.
FORESTS = 4


def sketch(s: np.ndarray) -> bytes:
    """The parity sketch of a set of 64-bit hashes: a power of two of bits, four to eight for each element, 64 at least."""
    bits = max(64, 4 << len(s).bit_length())
    parity = np.bincount(((s >> np.uint64(20)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def folded(x: bytes, size: int) -> bytes:
    """The same set's sketch of fewer bytes."""
    while len(x) > size:
        half = len(x) // 2
        x = (int.from_bytes(x[:half], "little") ^ int.from_bytes(x[half:], "little")).to_bytes(half, "little")
    return x


def narrow(x: bytes) -> bytes:
    """The sketch that travels with pairs: a quarter of the bits."""
    return folded(x, max(8, len(x) // 4))


def may_link(n: int, x: bytes, m: int, y: bytes) -> bool:
    """Whether sets of n and m elements with these sketches may have a Jaccard index of 4/5."""
    if 5 * min(n, m) < 4 * max(n, m):
        return False
    size = min(len(x), len(y))
    return 9 * (int.from_bytes(folded(x, size), "little") ^ int.from_bytes(folded(y, size), "little")).bit_count() <= n + m


@F.arrow_udf(BooleanType())
def pair_may_link(n: pa.Array, x: pa.Array, m: pa.Array, y: pa.Array) -> pa.Array:
    return pa.array([may_link(*r) for r in zip(n.to_pylist(), x.to_pylist(), m.to_pylist(), y.to_pylist(), strict=True)], pa.bool_())


def _bucket_stars(key: np.ndarray, node: np.ndarray):
    """(key, smallest node, other node) for buckets with several nodes; (keys, smallest nodes) of all buckets."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(first, len(key)))
    smallest = np.repeat(node[first], size)
    other = node != smallest
    return (key[other], smallest[other], node[other]), (key[first], node[first])


def _pairs(p: np.ndarray, x: np.ndarray):
    """Batches (p, x) with each pair once."""
    order = np.lexsort((x, p))
    p, x = p[order], x[order]
    new = np.append(True, (p[1:] != p[:-1]) | (x[1:] != x[:-1])) if len(p) else np.zeros(0, bool)
    p, x = p[new], x[new]
    for at in range(0, len(p), 8192):
        yield pa.RecordBatch.from_arrays([pa.array(p[at : at + 8192]), pa.array(x[at : at + 8192])], names=["p", "x"])


def _local_stars(parts: int):
    """DEALT rows. Kind 0: key, smallest node, for what meets other partitions' rows. Kind 1: the rays p, x inside this stretch, each pair once."""

    def send(key: list, node: list) -> pa.RecordBatch:
        (_, p, x), (k0, p0) = _bucket_stars(np.concatenate(key), np.concatenate(node))
        rows = [*dealt([k0, p0], k0.view(np.uint64), parts, 0)]
        for b in _pairs(p, x):
            rows += dealt([np.asarray(c) for c in b.columns], np.asarray(b.column(0)).view(np.uint64) * np.uint64(3) + np.asarray(b.column(1)).view(np.uint64), parts, 1)
        return packed(rows)

    def run(frames):
        key, node, size = [], [], 0
        for f in frames:
            lists = f.column("keys")
            key.append(np.asarray(lists.flatten()))
            node.append(np.repeat(np.asarray(f.column("node")), np.asarray(lists.value_lengths())))
            size += len(node[-1])
            if size >= STRETCH:
                yield send(key, node)
                key, node, size = [], [], 0
        if size:
            yield send(key, node)

    return run


def _stars(frames):
    """Rows (p, x): the rays of the stars of a partition's buckets, and those found before."""
    held = []
    for f in frames:
        for kind, rows in zip(f.column("kind").to_pylist(), f.column("rows"), strict=True):
            if kind:
                yield from _pairs(*unpacked([rows.as_py()], 2).view(np.int64))
            else:
                held.append(rows.as_py())
    key, node = unpacked(held, 2).view(np.int64)
    if len(key):
        (_, p, x), _ = _bucket_stars(key, node)
        yield from _pairs(p, x)


def bounded(df: DataFrame, rows: int, width: int = 40) -> DataFrame:
    """df with a broadcast hint if its counted rows, of so many bytes at most, allow it."""
    return F.broadcast(df) if rows * width <= BROADCAST_BYTES else df


def verify(pairs: DataFrame, texts: DataFrame, sets_of: Callable[[list], list[np.ndarray]]) -> DataFrame:
    """(p, x, linked) of pairs (p, x): the sets of their texts are compared in full; linked is a Jaccard index of at least 4/5.

    texts: node, text. Texts travel, once for each pair and once for each p and salt.
    """
    n = pairs.count()
    salt = F.pmod(F.xxhash64("x"), F.lit(max(SALTS, n // PAIRS_A_PART))).cast("int").alias("salt")
    pairs = pairs.select("p", "x", salt)
    texts = texts.where(F.col("node").isNotNull())
    members = texts.join(bounded(pairs, n), texts["node"] == pairs["x"]).select("p", "salt", "x", "text")
    pivots = pairs.select("p", "salt").distinct()
    pivots = texts.join(bounded(pivots, n), texts["node"] == pivots["p"]).select("p", "salt", F.lit(None).cast("long").alias("x"), "text")

    def compare(frames):
        pivot, of = [], None
        for b in batches(frames):
            p, s, x = (b.column(i).to_pylist() for i in range(3))
            out = []
            for p_, s_, x_, own in zip(p, s, x, sets_of(b.column(3).cast(pa.binary()).to_pylist()), strict=True):
                if of != (p_, s_):
                    of, pivot = (p_, s_), []
                if x_ is None:
                    pivot.append(own)
                    continue
                same = [len(np.intersect1d(own, q, assume_unique=True)) for q in pivot]
                out.append((p_, x_, any(100 * i >= 80 * (len(own) + len(q) - i) for i, q in zip(same, pivot, strict=True))))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.bool_()))], names=["p", "x", "linked"])

    # Nulls first: a pivot's text comes before those it is compared with. A node of several texts links if one of them does.
    dealt = members.union(pivots).repartition("p", "salt").sortWithinPartitions("p", "salt", "x")
    return dealt.mapInArrow(tidied(compare), "p long, x long, linked boolean").groupBy("p", "x").agg(F.max("linked").alias("linked"))


def _forest(apart: np.ndarray, r: np.ndarray, c: np.ndarray, cls: np.ndarray) -> list[int]:
    """Of pairs (r, c), those that join classes which the pairs before them leave apart, the closest first."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = up[x]
        return x

    chosen = []
    order = np.argsort(apart, kind="stable")
    for k, a, b in zip(order.tolist(), cls[r[order]].tolist(), cls[c[order]].tolist(), strict=True):
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
            chosen.append(k)
    return chosen


def _cross_pairs(forest: bool):
    """Rows (key, p, x): pairs of nodes of a tile that are in different classes, whose sketches may link and that have not failed; with forest, no more than join their classes."""

    def run(frames):
        held = {c: [] for c in ("key", "i", "j", "own", "node", "class", "n", "bits", "failed")}
        for f in frames:
            for c, got in held.items():
                got.append(f.column(c) if c in ("bits", "failed") else np.asarray(f.column(c)))
        if not held["key"]:
            return
        key, i, j, own, node, cls, n = (np.concatenate(held[c]) for c in list(held)[:-2])
        bits, failed = pa.chunked_array(held["bits"]), pa.chunked_array(held["failed"])
        order = np.lexsort((node, own != i, j, i, key))
        key, i, j, own, node, cls, n = (c[order] for c in (key, i, j, own, node, cls, n))
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
        for a, b in zip(first.tolist(), np.append(first[1:], len(key)).tolist(), strict=True):
            two, split = i[a] != j[a], int((own[a:b] == i[a:b]).sum())
            for f in tile(node[a:b], cls[a:b], n[a:b], [bits[k].as_py() for k in order[a:b].tolist()], [failed[k].as_py() for k in order[a:b].tolist()], split if two else None):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(f.num_rows, key[a])), *f.columns], names=["key", "p", "x"])

    def tile(node, cls, n, sketches, failed, split):
        if len(np.unique(cls)) < 2:
            return
        size = min(map(len, sketches))
        bits = np.frombuffer(b"".join(folded(x, size) for x in sketches), np.uint64).reshape(len(sketches), -1)
        at_of = {x: k for k, x in enumerate(node.tolist())}
        known: dict[int, list[int]] = {}
        for k, others in enumerate(failed):
            for q in (at_of[p] for p in others or () if p in at_of):
                known.setdefault(k, []).append(q)
                known.setdefault(q, []).append(k)
        found = []
        for r in range(len(node) - 1 if split is None else split):
            begin = r + 1 if split is None else split
            m = n[begin:]
            may = (cls[begin:] != cls[r]) & (node[begin:] != node[r]) & (5 * np.minimum(m, n[r]) >= 4 * np.maximum(m, n[r]))
            for q in known.get(r, ()):
                if q >= begin:
                    may[q - begin] = False
            at = np.flatnonzero(may)
            if not len(at):
                continue
            ham = np.bitwise_count(bits[at + begin] ^ bits[r]).sum(axis=1, dtype=np.int64)
            share = ham / (n[r] + m[at])
            near = 9 * ham <= n[r] + m[at]
            at, share = at[near] + begin, share[near]
            if forest and len(at):  # the closest of each class is enough
                at, share = (v[np.lexsort((share, cls[at]))] for v in (at, share))
                new = np.append(True, cls[at[1:]] != cls[at[:-1]])
                at, share = at[new], share[new]
            if len(at):
                found.append((share, np.full(len(at), r), at))
        if found:
            share, r, c = (np.concatenate([f[k] for f in found]) for k in range(3))
            if forest:
                chosen = _forest(share, r, c, cls)
                r, c = r[chosen], c[chosen]
            yield from _pairs(np.minimum(node[r], node[c]), np.maximum(node[r], node[c]))

    return run


def linked_classes(put_up: DataFrame, check: Callable[[DataFrame], DataFrame], equal: DataFrame | None = None) -> DataFrame:
    """(node, component) of all nodes that have links.

    put_up: node, keys (array), n, sketch and wide (the set's size, its sketch, narrow and whole); a table, as it is read more than once.
    check: pairs (p, x) to (p, x, linked). equal: links (a, b) known without.
    """
    local = put_up.select("node", "keys").mapInArrow(tidied(_local_stars(parts_of(put_up.sparkSession))), DEALT)
    rays = written(local.repartition("part").mapInArrow(tidied(_stars), "p long, x long").distinct(), "rays")
    touched = written(rays.select(F.col("p").alias("node")).union(rays.select("x")).distinct(), "touched")
    put_up = put_up.join(bounded(touched, touched.count(), 16), "node", "left_semi").select("node", "keys", "n", "sketch", "wide")
    put_up = written(put_up.dropDuplicates(["node", "wide"]), "members")
    sets = put_up.select("node", "n", "sketch")
    of = lambda name: sets.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}"))
    near = rays.join(of("p"), "p").join(of("x"), "x").where(pair_may_link("n_p", "sketch_p", "n_x", "sketch_x"))
    near = written(near.select("p", "x").distinct(), "near")
    dropped(rays)
    # Each node is verified with one partner first; further pairs only if that leaves them apart.
    tried = [written(check(written(near.groupBy("x").agg(F.min("p").alias("p")).select("p", "x"), "first")), "verified")]
    links = tried[0].where("linked").select(F.col("p").alias("a"), F.col("x").alias("b"))
    classes = components(links.union(equal) if equal is not None else links)

    def own(df: DataFrame, name: str) -> DataFrame:
        found = classes.select(F.col("node").alias(name), F.col("component").alias(f"{name}_class"))
        return df.join(bounded(found, classes.count(), 24), name, "left").withColumn(f"{name}_class", F.coalesce(f"{name}_class", name))

    def joined(pairs: DataFrame) -> DataFrame:
        """Classes after these pairs, as far as they hold."""
        tried.append(written(check(pairs), "verified"))
        more = tried[-1].where("linked").select(F.col("p").alias("a"), F.col("x").alias("b"))
        return classes if more.isEmpty() else components(classes.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    left = near.join(tried[0], ["p", "x"], "left_anti")
    left = written(own(own(left, "p"), "x").where("p_class <> x_class").select("p", "x"), "left")
    if not left.isEmpty():
        classes = joined(left)
    dropped(near, left)
    # Buckets that are still in several classes. While pairs that fail leave others to be tried, they are taken a forest at a time; then all at once.
    buckets = written(put_up.select("node", F.explode("keys").alias("key")).distinct(), "buckets")
    for turn in range(FORESTS + 1):
        members = own(buckets, "node").withColumnRenamed("node_class", "class")
        keys = members.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count(F.lit(1)).alias("rows"))
        keys = written(keys.where("low <> high").select("key", F.ceil(F.col("rows") / TILE).cast("int").alias("blocks")), "open")
        n = keys.count()
        if not n:
            break
        failed = reduce(DataFrame.union, tried).where("NOT linked").groupBy(F.col("x").alias("node")).agg(F.collect_set("p").alias("failed"))
        # The narrow sketches do for most buckets; where pairs that they let through fail, the wide ones are asked.
        sets = put_up.select("node", "n", F.col("wide" if turn else "sketch").alias("bits"))
        rows = members.join(bounded(keys, n), "key").join(sets, "node").join(failed, "node", "left")
        rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
        pairs = rows.select("key", "i", "j", "own", "node", "class", "n", "bits", "failed").repartition("key", "i", "j").mapInArrow(tidied(_cross_pairs(turn < FORESTS)), "key long, p long, x long")
        pairs = written(pairs, "candidates")
        dropped(keys)
        free(put_up.sparkSession)
        if pairs.isEmpty():
            break
        classes = joined(written(pairs.select("p", "x").distinct(), "pairs"))
        # A bucket whose pairs all hold is done: all that its sketches let through is in one class with its partner.
        again = written(pairs.join(tried[-1].where("NOT linked"), ["p", "x"], "left_semi").select("key").distinct(), "again")
        dropped(pairs)
        if again.isEmpty():
            break
        last, buckets = buckets, written(buckets.join(bounded(again, again.count()), "key", "left_semi"), "buckets")
        dropped(last, again)
    dropped(put_up, touched, buckets, *tried)
    return classes
