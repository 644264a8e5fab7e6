"""Substring dedup: near-equal paragraphs by MinHash banding and exact verification, then equal runs of words wherever they stand.

Method. A text's paragraphs are its lines of `min_words` words or more, and blocks: consecutive shorter lines, up to a blank line or one of
so many words, that have so many words together. A block is named by its first line and goes as a whole. A paragraph's set is that of its distinct
`width`-word shingles. Equal sets are one node. Bands of `rows` MinHash values are its join keys; `tuned` takes the longest bands that still
find a pair at the threshold with a chance of `recall` within `most` hash values. Colliding paragraphs are compared by parity sketches, then by the
exact Jaccard index of their sets; classes are the components of verified links. The first place (smallest doc_id, then line) of each class stays;
the others go. Fewer words than `min_words` are no paragraph: short notices that many texts have in common are left alone, unless they are part of a run.

Runs. In what is left of the texts, every run of `RUN` equal words (A-Z lower-cased, white space apart) that occurs again goes but for its
first place, inside lines and across line ends. Winnowing picks, of all runs of `ANCHOR` words inside any `RUN` words, the one with the lowest
hash; equal runs pick equal anchors, so a run that repeats has an anchor that repeats. Only around such anchors is every run of `RUN` words
looked at, by 128 hash bits of its words. Overlapping runs that go are one span, so a repeated passage goes up to where the texts part.
A run that overlaps its own first place stays. What repeats inside a stretch of rows is settled there; its first place only is shuffled.

Defined cases. Null and empty texts have no paragraphs. Lines keep their order; a removed line goes with its line feed. A place is doc_id, the
hash of the row's text and line: rows of one doc_id with equal texts are one place, with different texts they are places of their own. Rows
without a doc_id are left whole and are no one's first place; each of their paragraphs counts as a place of its class. An empty table
gives no rows. Other columns are kept by `deduplicate` and not looked at; names that begin with `_kin_` are taken.
"""
from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ._common import DEALT, LOWER_AZ, WordHashes, batches, dealt, dropped, flat_words, free, mix64, packed, parts_of, sets_of, shingle_sets, table, tidied, unpacked, written
from ._links import BROADCAST_BYTES, bounded, linked_classes, narrow, sketch, verify
from .parity_join import shared_rows, signatures

WIDTH = 5
MIN_WORDS = 30
THRESHOLD = 0.8
RECALL = 0.9999
MOST_HASHES = 72
#: Equal words that make a repeated run; words of an anchor.
RUN = 50
ANCHOR = 25
#: Anchors, and runs, that are brought together in a task before they are dealt.
STRETCH = 250_000
#: Odd multipliers of the two hashes of a run.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

_words = WordHashes()
_powers: dict[int, np.ndarray] = {}


def tuned(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the longest bands that find a pair of that similarity with that chance within so many hash values."""
    best = (most, 1)
    for rows in range(1, most + 1):
        miss = 1 - threshold**rows
        bands = int(np.ceil(np.log(1 - recall) / np.log(miss)))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def band_keys(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of the MinHash values of each set (none is empty); a row for each set."""
    odd = mix64(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
    lowest = np.empty((bands * rows, len(sets)), np.uint64)
    ends = np.cumsum([len(s) for s in sets])
    first = 0
    while first < len(sets):  # so many sets at a time as stay in the processor's cache; a very long one by itself
        begin = ends[first] - len(sets[first])
        last = max(first + 1, int(np.searchsorted(ends, begin + 16_384, side="right")))
        flat, at = np.concatenate(sets[first:last]), np.append(begin, ends[first : last - 1]) - begin
        for k, o in enumerate(odd):  # the hashes of a set are random, and so are the upper bits of their products
            lowest[k, first:last] = np.minimum.reduceat(flat * o, at)
        first = last
    keys = np.empty((len(sets), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(sets), b + 1, np.uint64)
        for r in range(rows):
            key = mix64(key * np.uint64(0xC2B2AE3D27D4EB4F) + lowest[b * rows + r])
        keys[:, b] = key
    return keys.view(np.int64)


def paragraph_words(text: bytes | None, min_words: int) -> list[tuple[int, int, list[bytes], bytes]]:
    """(first line, lines, words, text) of each paragraph: lines of min_words, and blocks of so many words in shorter lines between blank or long ones."""
    out: list[tuple[int, int, list[bytes], bytes]] = []
    block: list[bytes] = []
    words: list[bytes] = []

    def close(end: int) -> None:
        if len(words) >= min_words:
            out.append((end - len(block), len(block), words.copy(), b"\n".join(block)))
        block.clear()
        words.clear()

    lines = (text or b"").translate(LOWER_AZ).split(b"\n")
    for i, line in enumerate(lines):
        own = line.split()
        if 0 < len(own) < min_words:
            block.append(line)
            words += own
            continue
        close(i)
        if own:
            out.append((i, 1, own, line))
    close(len(lines))
    return out


def paragraphs(docs: DataFrame, min_words: int, width: int, bands: int, rows: int, seed: int) -> DataFrame:
    """doc_id, row, line, lines, words, node of every paragraph; its other hash, and for the first of each node in a partition n, sketches, keys, text."""
    names = ["doc_id", "row", "line", "lines", "words", "node", "other", "n", "sketch", "wide", "keys", "text"]
    kinds = [*[pa.int64()] * 7, pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.string()]

    def run(frames):
        seen: set[int] = set()
        for b in batches(frames):
            rows_ = zip(b.column("doc_id").to_pylist(), b.column("row").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), strict=True)
            found = [(d, r, *p) for d, r, t in rows_ for p in paragraph_words(t, min_words)]
            if not found:
                continue
            n = [len(p[4]) for p in found]
            h = np.fromiter(map(_words.__getitem__, chain.from_iterable(p[4] for p in found)), np.uint64, sum(n))
            sets = sets_of(h, np.cumsum([0, *n]), width)
            node, other = signatures(sets, seed)
            new = []
            for i, x in enumerate(node.tolist()):
                if x not in seen:
                    seen.add(x)
                    new.append(i)
            columns = [[p[k] for p in found] for k in range(4)] + [n, node, other] + [[None] * len(found) for _ in range(5)]
            if new:
                for i, keys in zip(new, band_keys([sets[i] for i in new], bands, rows), strict=True):
                    wide = sketch(sets[i])
                    for c, v in zip(columns[7:], (len(sets[i]), narrow(wide), wide, keys, found[i][5]), strict=True):
                        c[i] = v
            columns[-1] = as_text(columns[-1])
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return docs.mapInArrow(tidied(run), "doc_id long, row long, line long, lines long, words long, node long, other long, n long, sketch binary, wide binary, keys array<long>, text string")


def repeated_paragraphs(docs: DataFrame, *, min_words: int = MIN_WORDS, width: int = WIDTH) -> DataFrame:
    """doc_id, row, line, lines, words, class, first_doc, first_line, n_places, removed of every paragraph. docs: doc_id, text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    for seed in range(8):
        found = written(paragraphs(docs, min_words, width, *tuned(), seed), "paragraphs")
        if found.groupBy("node").agg(F.min("other").alias("a"), F.max("other").alias("b")).where("a <> b").isEmpty():
            break  # else two sets have the same 64-bit hash: another one
    firsts = found.where("keys IS NOT NULL")

    def check(pairs: DataFrame) -> DataFrame:
        nodes = written(pairs.select(F.col("p").alias("node")).union(pairs.select("x")).distinct(), "nodes")
        texts = written(firsts.select("node", "text").join(bounded(nodes, nodes.count()), "node", "left_semi").dropDuplicates(["node"]), "texts")
        checked = written(verify(pairs, texts, lambda t: shingle_sets(t, width, _words)), "checked")
        dropped(nodes, texts)
        return checked

    classes = linked_classes(firsts.select("node", "keys", "n", "sketch", "wide"), check)
    place, known = F.struct("doc_id", "row", "line"), F.col("doc_id").isNotNull()
    named = written(found.groupBy("doc_id", "row", "line", "lines", "words", "node").agg(F.count(F.lit(1)).alias("rows")), "named")
    dropped(found)
    free(docs.sparkSession)
    named = named.join(bounded(classes, classes.count(), 24), "node", "left").withColumn("class", F.coalesce("component", "node"))
    first = named.groupBy("class").agg(F.min(F.when(known, place)).alias("f"), F.sum(F.when(known, 1).otherwise(F.col("rows"))).alias("n_places"))
    first = written(first.where("n_places > 1"), "firsts")
    out = named.join(bounded(first, first.count(), 64), "class", "left")
    of = lambda n: F.coalesce(F.col("f")[n], F.col(n))
    removed = known & F.col("f").isNotNull() & (place != F.col("f"))
    return out.select("doc_id", "row", "line", "lines", "words", "class", of("doc_id").alias("first_doc"), of("line").alias("first_line"), F.coalesce("n_places", F.lit(1)).alias("n_places"), removed.alias("removed"))


def powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i below n."""
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, 4096), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def run_hashes(h: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hashes of all runs of width consecutive values, by differences of prefix sums."""
    n = len(h)
    sums = np.append(np.uint64(0), np.cumsum(h * powers(pow(base, -1, 1 << 64), n)))
    return mix64((sums[width:] - sums[: n - width + 1]) * powers(base, n - width + 1))


def sliding(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """op over every width consecutive values."""
    step = 1
    while 2 * step <= width:
        x = op(x[:-step], x[step:])
        step *= 2
    return op(x[: len(x) - (width - step)], x[width - step :]) if width > step else x


def anchors_of(h: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the anchors of texts, one after the other, of which ends has where each begins and the last one ends.

    An anchor is the lowest of those inside some RUN words of a text.
    """
    if len(h) < RUN:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    each = run_hashes(h, ANCHOR, BASES[0])
    low = sliding(each, RUN - ANCHOR + 1, np.minimum)
    low[~inside(ends, len(low))] = 0  # runs that go over the end of a text have no anchor
    gap = np.zeros(RUN - ANCHOR, np.uint64)
    at = np.flatnonzero(sliding(np.concatenate([gap, low, gap]), RUN - ANCHOR + 1, np.maximum) == each)
    return at, each[at]


def inside(ends: np.ndarray, n: int) -> np.ndarray:
    """Whether a run of RUN words from each of n places stays in its text."""
    ok = np.ones(n, bool)
    for a, b in zip(np.maximum(ends[1:] - RUN + 1, ends[:-1]).tolist(), ends[1:].tolist(), strict=True):
        ok[a:b] = False
    return ok


def others_and_own(frames, held: list[bytes]):
    """Passes rows that are not of kind 0; puts the blobs of kind 0 into held."""
    for b in frames:
        kind, rows = np.asarray(b.column("kind")), b.column("rows")
        if len(other := np.flatnonzero(kind)):
            yield b.take(pa.array(other))
        held += [rows[i].as_py() for i in np.flatnonzero(kind == 0).tolist()]


def send_anchors(parts: int):
    """DEALT rows. Kind 0: anchor, row key: one row for each anchor of a stretch. Kind 1: row key, anchor, for all that have an anchor found again there."""

    def send(anchor: list, key: list) -> pa.RecordBatch:
        anchor, key = np.concatenate(anchor), np.concatenate(key)
        again, of = shared_rows(anchor, key)
        one = np.unique(anchor, return_index=True)[1]
        return packed([*dealt([anchor[one], key[one]], anchor[one], parts, 0), *dealt([of, again], of, parts, 1)])

    def run(frames):
        anchor, key, size = [], [], 0
        for b in batches(frames):
            h, at = flat_words(b.column("text").cast(pa.binary()).to_pylist(), _words)
            place, found = anchors_of(h, at)
            anchor.append(found)
            key.append(np.asarray(b.column("key")).view(np.uint64)[np.searchsorted(at, place, side="right") - 1])
            size += len(found)
            if size >= STRETCH:
                yield send(anchor, key)
                anchor, key, size = [], [], 0
        if size:
            yield send(anchor, key)

    return run


def meet_anchors(parts: int):
    """Kind 0 in, kind 1 out, for anchors that several stretches have. Kind 1 passes."""

    def run(frames):
        held: list[bytes] = []
        yield from others_and_own(frames, held)
        anchor, key = shared_rows(*unpacked(held, 2))
        if out := [*dealt([key, anchor], key, parts, 1)]:
            yield packed(out)

    return run


def anchors_by_row(frames):
    """key, anchors: a row for each row key, with 32 bits of each of its anchors that repeat."""
    key, anchor = unpacked([r.as_py() for b in frames for r in b.column("rows")], 2)
    order = np.lexsort((anchor, key))
    key, anchor = key[order], anchor[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    ends = np.append(first, len(key))
    for a in range(0, len(first), 2000):
        part = ends[a : a + 2001]
        lists = pa.ListArray.from_arrays(pa.array((part - part[0]).astype(np.int32)), pa.array(anchor[part[0] : part[-1]].astype(np.uint32).view(np.int32)))
        yield pa.RecordBatch.from_arrays([pa.array(key[part[:-1]].view(np.int64)), lists], names=["key", "anchors"])


def settled(x: np.ndarray, y: np.ndarray, doc: np.ndarray, row: np.ndarray, at: np.ndarray, several: np.ndarray):
    """Runs (x, y) at places, in order; where each run's first one is, which overlap it, which others there are, each one's first; whether others repeat the first."""
    order = np.lexsort((at, row, doc, y, x))
    x, y, doc, row, at, several = (c[order] for c in (x, y, doc, row, at, several))
    new = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])) if len(x) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    of = np.repeat(first, np.diff(np.append(first, len(x))))
    close = ~new & (doc == doc[of]) & (row == row[of]) & (at < at[of] + RUN)
    others = ~new & ~close
    again = np.maximum.reduceat(np.maximum(several, others), first) if len(first) else several
    return (x, y, doc, row, at), first, close, others, of, again


def deal(doc: np.ndarray, row: np.ndarray) -> np.ndarray:
    return mix64(doc.view(np.uint64) + row.view(np.uint64) * np.uint64(BASES[0]))


def that_go(doc: np.ndarray, row: np.ndarray, at: np.ndarray, of: np.ndarray, parts: int):
    """Kind 1 of places whose runs go, and the documents of their first places: a row for each stretch of places with one such document."""
    order = np.lexsort((at, of, row, doc))
    doc, row, at, of = (c[order] for c in (doc, row, at, of))
    new = np.append(True, (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (of[1:] != of[:-1]) | (at[1:] > at[:-1] + 1)) if len(at) else np.zeros(0, bool)
    last = np.append(new[1:], True) if len(at) else new
    return dealt([doc[new], row[new], at[new], at[last], of[new]], deal(doc[new], row[new]), parts, 1)


def send_runs(parts: int):
    """DEALT rows of the runs around repeated anchors. Kind 0: x, y, doc, row, at, several: what other stretches must see. Kind 1: doc, row, first and last place of a stretch that goes, doc of the first places."""

    def send(runs: list) -> pa.RecordBatch:
        x, y, doc, row, at = (np.concatenate([r[i] for r in runs]) for i in range(5))
        (x, y, doc, row, at), first, close, others, of, again = settled(x, y, doc, row, at, np.zeros(len(x), np.int64))
        several = np.zeros(len(x), np.int64)
        several[first] = again
        on = close.copy()
        on[first] = True
        return packed([*dealt([c[on] for c in (x, y, doc, row, at, several)], x[on].view(np.uint64), parts, 0), *that_go(doc[others], row[others], at[others], doc[of][others], parts)])

    def run(frames):
        runs, size = [], 0
        for b in batches(frames):
            h, ends = flat_words(b.column("text").cast(pa.binary()).to_pylist(), _words)
            at, key = anchors_of(h, ends)
            # An anchor that repeats is known as such to every row that has it; one with the same 32 bits does no harm.
            at = at[np.isin(key.astype(np.uint32), np.asarray(b.column("anchors").flatten()).view(np.uint32))]
            n = len(h) - RUN + 1
            if n < 1 or not len(at):
                continue
            edges = np.zeros(n + 1, np.int64)
            np.add.at(edges, np.maximum(at - (RUN - ANCHOR), 0), 1)
            np.add.at(edges, np.minimum(at + 1, n), -1)
            at = np.flatnonzero((np.cumsum(edges[:n]) > 0) & inside(ends, n))
            row = np.searchsorted(ends, at, side="right") - 1
            x, y = (run_hashes(h, RUN, base)[at].view(np.int64) for base in BASES)
            runs.append((x, y, np.asarray(b.column("doc_id"))[row], np.asarray(b.column("row"))[row], at - ends[row]))
            size += len(at)
            if size >= STRETCH:
                yield send(runs)
                runs, size = [], 0
        if size:
            yield send(runs)

    return run


def meet_runs(parts: int):
    """Kind 0 in; kind 1 out for the runs that go, kind 2 (doc, row, -1, -1, doc) for rows with first places that others repeat. Kind 1 passes."""

    def run(frames):
        held: list[bytes] = []
        yield from others_and_own(frames, held)
        (_, _, doc, row, at), first, _, others, of, again = settled(*unpacked(held, 6).view(np.int64))
        rows = [*that_go(doc[others], row[others], at[others], doc[of][others], parts)]
        holds = np.unique(np.stack([doc[first[again > 0]], row[first[again > 0]]]), axis=1)
        none = np.full(holds.shape[1], -1)
        rows += dealt([holds[0], holds[1], none, none, holds[0]], deal(holds[0], holds[1]), parts, 2)
        if rows:
            yield packed(rows)

    return run


def spans_by_row(frames):
    """doc_id, row, begins, ends (words), firsts, holds: the spans that go from a row, the documents of their first places; whether others repeat a run of its own."""
    doc, row, begin, end, of = unpacked([r.as_py() for b in frames for r in b.column("rows")], 5).view(np.int64)
    order = np.lexsort((begin, row, doc))
    doc, row, begin, end, of = (c[order] for c in (doc, row, begin, end, of))
    first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]))) if len(doc) else np.zeros(0, np.int64)
    out: list[tuple] = []
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(doc)], strict=True) if len(first) else ():
        k = a + int((begin[a:b] < 0).sum())
        upto = np.maximum.accumulate(end[k:b])
        new = np.append(True, begin[k + 1 : b] > upto[:-1] + RUN) if k < b else np.zeros(0, bool)
        last = np.append(new[1:], True) if k < b else new
        out.append((doc[a], row[a], begin[k:b][new], upto[last] + RUN, np.unique(of[k:b]), k > a))
        if len(out) == 2000 or b == len(doc):
            kinds = (pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=["doc_id", "row", "begins", "ends", "firsts", "holds"])
            out = []


def repeated_runs(left: DataFrame) -> DataFrame:
    """doc_id, row, begins, ends, firsts, holds of the rows with runs of RUN words that repeat, see `spans_by_row`. left: doc_id, row, text; read twice.

    A row is known by doc_id and `row`; rows without a doc_id are not looked at.
    """
    parts = parts_of(left.sparkSession)
    left = left.where("doc_id IS NOT NULL").withColumn("key", F.xxhash64("doc_id", "row"))
    met = left.select("key", "text").mapInArrow(tidied(send_anchors(parts)), DEALT).repartition("part").mapInArrow(tidied(meet_anchors(parts)), DEALT)
    near = written(met.repartition("part").mapInArrow(tidied(anchors_by_row), "key long, anchors array<int>"), "near")
    free(left.sparkSession)
    rows, n = near.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("anchors")), F.lit(0))).first()
    if 64 * rows + 4 * n > BROADCAST_BYTES:  # then at least other rows' texts need not travel, if the keys do
        left = left.join(bounded(near.select("key"), rows, 16), "key", "left_semi")
    around = left.join(bounded(near, 64 * rows + 4 * n, 1), "key").select("doc_id", "row", "text", "anchors").mapInArrow(tidied(send_runs(parts)), DEALT)
    met = around.repartition("part").mapInArrow(tidied(meet_runs(parts)), DEALT)
    out = written(met.repartition("part").mapInArrow(tidied(spans_by_row), "doc_id long, row long, begins array<long>, ends array<long>, firsts array<long>, holds boolean"), "runs")
    dropped(near)
    return out


def without_runs(text: bytes, begins: list[int], ends: list[int]) -> bytes:
    """text without the words of these spans; a line that loses its last word goes with its line feed."""
    gone = np.zeros(max(ends) + 1, bool)
    for a, b in zip(begins, ends, strict=True):
        gone[a:b] = True
    out, k = [], 0
    for line in text.split(b"\n"):
        words = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", line)]
        lost = [k + i < len(gone) and bool(gone[k + i]) for i in range(len(words))]
        k += len(words)
        if not any(lost):
            out.append(line)
        elif not all(lost):
            stops = [w[0] for w in words[1:]] + [len(line)]
            out.append((line[: words[0][0]] + b"".join(line[w[0] : e] for w, e, x in zip(words, stops, lost, strict=True) if not x)).rstrip())
    return b"\n".join(out)


def as_text(rows: list[bytes | None]) -> pa.Array:
    return pa.array(rows, pa.binary()).cast(pa.string())


def without_lines(text: bytes, gone: list[dict]) -> bytes:
    drop = {i for g in gone for i in range(g["line"], g["line"] + g["lines"])}
    return b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in drop)


@F.arrow_udf(StringType())
def cut(text: pa.Array, gone: pa.Array, begins: pa.Array, ends: pa.Array) -> pa.Array:
    """Texts without the lines that go, and in what they leave without the spans of words that go; null lists are empty."""
    out = []
    for t, g, b, e in zip(text.cast(pa.binary()).to_pylist(), gone.to_pylist(), begins.to_pylist(), ends.to_pylist(), strict=True):
        t = without_lines(t, g) if t is not None and g else t
        out.append(without_runs(t, b, e) if t is not None and b else t)
    return as_text(out)


def joined_by_row(docs: DataFrame, found: DataFrame, entries: str) -> DataFrame:
    """docs (doc_id, _kin_row) with the columns of found (doc_id, row and others, once a row; its size mostly that of the list `entries`) where there are any."""
    found = found.withColumnsRenamed({"doc_id": "_kin_id", "row": "_kin_r"})
    rows, n = found.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(entries)), F.lit(0))).first()
    return docs.join(bounded(found, rows + n), (docs["doc_id"] == found["_kin_id"]) & (docs["_kin_row"] == found["_kin_r"]), "left").drop("_kin_id", "_kin_r")


def marked(docs: DataFrame, places: DataFrame) -> DataFrame:
    """docs with _kin_row, the hash of the text, and _kin_gone, the lines that places remove from that row."""
    gone = written(places.where("removed").groupBy("doc_id", "row").agg(F.collect_list(F.struct("line", "lines")).alias("_kin_gone")), "gone")
    return joined_by_row(docs.withColumn("_kin_row", F.xxhash64("text")), gone, "_kin_gone")


def left_of(begins: Column, ends: Column) -> Column:
    """The text of rows of `marked` without what goes; rows that nothing goes from don't go through Python."""
    touched = F.col("_kin_gone").isNotNull() | begins.isNotNull()
    return F.when(touched, cut(F.when(touched, F.col("text")), "_kin_gone", begins, ends)).otherwise(F.col("text"))


def runs_left(docs: DataFrame, places: DataFrame) -> DataFrame:
    """`repeated_runs` in what places leave of docs (doc_id, text)."""
    none = F.lit(None).cast("array<long>")
    left = marked(docs.select("doc_id", "text"), places).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_kin_row").alias("row"), left_of(none, none).alias("text"))
    left = written(left, "left")
    free(docs.sparkSession)
    runs = repeated_runs(left)
    dropped(left)
    free(docs.sparkSession)
    return runs


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """docs without the removed lines and runs; texts that lose every line become empty."""
    places = written(repeated_paragraphs(docs, **options), "places")
    free(docs.sparkSession)
    runs = runs_left(docs, places).where(F.size("begins") > 0).select("doc_id", "row", F.col("begins").alias("_kin_begins"), F.col("ends").alias("_kin_ends"))
    out = joined_by_row(marked(docs, places), runs, "_kin_begins")
    return out.withColumn("text", left_of(F.col("_kin_begins"), F.col("_kin_ends"))).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By row: whether it holds a paragraph or run that has other places; paragraphs with other places, paragraphs, runs and words removed; documents that hold what was removed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    places = written(repeated_paragraphs(docs), "places")
    free(spark)
    runs = runs_left(docs, places).withColumn("n_runs_removed", F.size("begins").cast("long"))
    runs = runs.withColumn("n_words", F.aggregate(F.zip_with("begins", "ends", lambda b, e: e - b), F.lit(0).cast("long"), lambda a, x: a + x))
    shared = F.col("n_places") > 1
    per_row = places.groupBy("doc_id", "row").agg(
        F.count(F.lit(1)).alias("n_paragraphs"), F.count_if(shared).alias("n_shared"), F.count_if("removed").alias("n_removed"),
        F.sum(F.when(F.col("removed"), F.col("words"))).alias("words_removed"), F.collect_set(F.when(F.col("removed"), F.col("first_doc"))).alias("duplicate_of"),
    )
    known = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    none = F.array().cast("array<long>")
    both = F.sort_array(F.array_union(F.coalesce("duplicate_of", none), F.coalesce("firsts", none)))
    ids = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    found = ids.join(per_row, ids["id"].eqNullSafe(per_row["doc_id"]) & (ids["hash"] == per_row["row"]), "left").drop("doc_id", "row")
    found = found.join(runs, (found["id"] == runs["doc_id"]) & (found["hash"] == runs["row"]), "left")
    repeated = (known("n_shared") > 0) | F.coalesce("holds", F.lit(False)) | (known("n_runs_removed") > 0)
    return found.select(
        F.col("id").alias("doc_id"), repeated.alias("repeated"), known("n_shared").alias("n_shared"), known("n_removed").alias("n_removed"), known("n_runs_removed").alias("n_runs_removed"),
        (known("words_removed") + known("n_words")).alias("n_words_removed"), both.alias("duplicate_of"), known("n_paragraphs").alias("n_paragraphs"),
    )


NAME, ORACLE = "op9_substring_dedup", None
