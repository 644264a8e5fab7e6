"""Byte-pair encoding and decoding by a tokenization automaton.

Compiling. The automaton's arcs carry tokens; it accepts exactly the token sequences that the merges can give. It starts as one state with
an arc for every byte back to itself. Each merge (a, b) -> c, in order, adds a gadget: the state that arcs a lead to becomes a copy without
its arc b (a then b must not stay apart), and every state that has an arc a gets an arc c to where a then b led. All arcs of a token lead
to one state, so a state is named by the token that was read last; and arcs of c are made where arcs of a are, so a state's lost arcs are,
for each merge, the lost token and what was built on it later. With tokens numbered in the order of a walk through the tree "c was built on
a", later-built ones first, that is one interval. The compiled table is, for each state, its sorted disjoint intervals of lost arcs: a few
numbers a state instead of a row of all tokens, and a step is one look-up.

Encoding. Every string of bytes has one right tokenization, and that of a prefix is a prefix of it or ends otherwise, but is one too: so at each
place of a word the automaton is in one state, the last token of the tokenization up to there. A second table, a matching automaton over the
arcs' labels (a trie with links from each node to its longest suffix), goes on by one transition for each byte and names the arcs that end at the
place, longest first; the state is the one arc among them that the state at its beginning has not lost. The run goes from left to right once, never
back; the last state names the last token, the state at its beginning the one before. Words are the tokenizer's own pre-split pieces; each
distinct piece runs through the automaton once and is kept (at most `limit` pieces). Decoding emits the labels (bytes) of the arcs.

Defined cases. A null text is an empty one and has no ids. Strings of added tokens in a text become their ids. Rows are returned as often
as they occur, whatever their doc_id; other columns are not looked at. A tokenizer in which two merges give one token, or whose added tokens
match single words only, or with white space at their sides or after normalisation, is refused.
"""
from __future__ import annotations

import hashlib
import json
import re
from array import array
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ._common import Pieces, batches, kept, table, tidied

#: What the byte-level pre-tokenizer splits texts by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of printable ASCII, common white space and Latin letters, in the standard library's faster expressions.
USUAL_PATTERN = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ‐-‧‰-⁞₠-₿]")


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand for themselves, the others follow from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out = {chr(b): b for b in shown}
    for n, b in enumerate(b for b in range(256) if b not in shown):
        out[chr(256 + n)] = b
    return out


class Automaton:
    """Compiled from the text of a tokenizer's JSON file with a byte-level BPE model."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        vocab: dict[str, int] = model["vocab"]
        to_byte = byte_of_letter()
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made = {a + b for a, b in merges}
        names = [t for t in vocab if t not in made and len(t) == 1]
        number = {t: i for i, t in enumerate(names)}
        left, right = [-1] * len(names), [-1] * len(names)
        for a, b in merges:
            if a + b in number or a not in number or b not in number:
                raise ValueError(f"merge {a!r} {b!r} does not build a new token from known ones")
            number[a + b] = len(left)
            left.append(number[a])
            right.append(number[b])
        # Arcs are numbered so that what was built on a token follows it, later-built first.
        n, n_bytes = len(left), len(names)
        size, built_on = [1] * n, [[] for _ in range(n)]
        for c in range(n - 1, n_bytes - 1, -1):
            size[left[c]] += size[c]
        for c in range(n_bytes, n):
            built_on[left[c]].append(c)
        place, at = [0] * n, 0
        for t in range(n):
            if t < n_bytes:
                place[t], at = at, at + size[t]
            cursor = place[t] + 1
            for c in reversed(built_on[t]):
                place[c] = cursor
                cursor += size[c]
        # The gadgets: merge c takes from the state of its left token the arc of its right token and all built on that from then on.
        lost: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
        for c in range(n_bytes, n):
            a, b = left[c], right[c]
            k = bisect_left(built_on[b], c)
            first = built_on[b][k] if k < len(built_on[b]) else None
            lost[a].append((c, place[b], place[first] + size[first] if first is not None else place[b] + 1))
        offsets, lows, highs = [0], [], []
        for t in range(n):
            found, s, before = [], t, n
            while s >= 0:  # the state of a built token was copied from its right token's state when it was built
                found += [(lo, hi) for c, lo, hi in lost[s] if c < before]
                s, before = right[s], s
            end = -1
            for lo, hi in sorted(found):
                if lo > end:
                    lows.append(lo)
                    highs.append(hi)
                    end = hi
                elif hi > end:
                    highs[-1] = end = hi
            offsets.append(len(lows))
        # Plain arrays of 32-bit numbers: they take a tenth of what lists of numbers do in each worker process.
        self.offsets, self.lows, self.highs = (array("i", x) for x in (offsets, lows, highs))
        self.labels = {t: bytes(to_byte[x] for x in t) for t in number}
        self.place, self.ids = array("i", place), array("i", [vocab[t] for t in number])
        self.step: dict[int, int] = {}  # node * 256 + byte -> node
        self.arc = array("i", [-1])  # the arc whose label ends in a node
        for t, i in number.items():
            node = 0
            for b in self.labels[t]:
                following = self.step.get(node << 8 | b)
                if following is None:
                    following = self.step[node << 8 | b] = len(self.arc)
                    self.arc.append(-1)
                node = following
            self.arc[node] = i
        self._link()
        for t in data.get("added_tokens") or []:
            if t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized") and data.get("normalizer"):
                raise ValueError(f"added token {t['content']!r} is matched in a way that is not provided for")
        self.added = {t["content"]: t["id"] for t in data.get("added_tokens") or []}
        self.label_of = {vocab[t]: s for t, s in self.labels.items()} | {i: s.encode() for s, i in self.added.items()}
        del self.labels


    def _link(self) -> None:
        """Links each node of the trie to that of its longest proper suffix; names for each node the nearest one on that way, itself first, where an arc ends, and the next after that."""
        n = len(self.arc)
        below: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for key, node in self.step.items():
            below[key >> 8].append((key & 255, node))
        self.suffix, self.depth, self.ends, self.shorter = (array("i", bytes(4 * n)) for _ in range(4))
        level = [0]
        while level:
            following = []
            for node in level:
                for b, child in below[node]:
                    s = self.suffix[node]
                    while node and (found := self.step.get(s << 8 | b)) is None and s:
                        s = self.suffix[s]
                    self.suffix[child] = (found or 0) if node else 0
                    self.depth[child] = self.depth[node] + 1
                    near = self.ends[self.suffix[child]]
                    self.ends[child], self.shorter[child] = (child, near) if self.arc[child] >= 0 else (near, self.shorter[near])
                    following.append(child)
            level = following


class Encoder:
    """Runs pieces and texts through an automaton."""

    def __init__(self, automaton: Automaton, limit: int = 120_000):
        import regex

        self.automaton = automaton
        self.offsets, self.lows, self.highs = automaton.offsets, automaton.lows, automaton.highs
        self.pattern = regex.compile(PATTERN)
        self.added = automaton.added
        self.specials = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        top = max(automaton.label_of)
        self.labels = [automaton.label_of.get(i, b"") for i in range(top + 1)]
        self.kept = Pieces(lambda p: array("I", self.piece(p.encode())).tobytes(), limit)
        self.pairs = Pieces(lambda pair: self.lost(pair >> 20, pair & (1 << 20) - 1), limit // 2)

    def lost(self, state: int, arc: int) -> bool:
        place, first = self.automaton.place[arc], self.offsets[state]
        k = bisect_right(self.lows, place, first, self.offsets[state + 1]) - 1
        return k >= first and place < self.highs[k]

    def piece(self, word: bytes) -> list[int]:
        """The ids of one piece."""
        auto, pairs = self.automaton, self.pairs
        step, arc_at, suffix, depth, ends, shorter = auto.step, auto.arc, auto.suffix, auto.depth, auto.ends, auto.shorter
        states, begins, node = [-1], [0], 0
        for at, byte in enumerate(word, 1):
            while (following := step.get(node << 8 | byte)) is None and node:
                node = suffix[node]
            node = following or 0
            end = ends[node]
            while True:
                arc, begin = arc_at[end], at - depth[end]
                if not begin:
                    break
                if not pairs[states[begin] << 20 | arc]:
                    break
                end = shorter[end]
            states.append(arc)
            begins.append(begin)
        out, at = [], len(word)
        while at:
            out.append(auto.ids[states[at]])
            at = begins[at]
        return out[::-1]

    def _plain(self, text: str) -> bytes:
        pieces = (self.pattern if UNUSUAL.search(text) else USUAL_PATTERN).findall(text)
        return b"".join(map(self.kept.__getitem__, pieces))

    def encode(self, text: str) -> list[int]:
        if self.specials is None or not self.specials.search(text):
            return np.frombuffer(self._plain(text), np.uint32).tolist()
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += np.frombuffer(self._plain(text[at : m.start()]), np.uint32).tolist() + [self.added[m[0]]]
            at = m.end()
        return out + np.frombuffer(self._plain(text[at:]), np.uint32).tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


def _encoder(shared) -> Encoder:
    """The worker process's encoder for a broadcast automaton, kept with its pieces for the stage's later tasks."""
    return kept("pieces", shared.value, lambda: Encoder(shared.value))


def _spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """docs (doc_id, text) as doc_id, ids."""
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(_spec(tokenizer_path)))

    def run(frames):
        enc = _encoder(shared)
        for b in batches(frames):
            ids = [enc.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(tidied(run, "pieces"), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """encoded (doc_id, ids) as doc_id, text."""
    shared = encoded.sparkSession.sparkContext.broadcast(Automaton(_spec(tokenizer_path)))

    def run(frames):
        enc = _encoder(shared)
        for b in batches(frames):
            texts = [enc.decode(i or []) for i in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    encoded = encoded.select("doc_id", "ids")
    return encoded.mapInArrow(tidied(run, "pieces"), f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Encodes and decodes docs (doc_id, text) in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256. No ids leave the task."""
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(_spec(tokenizer_path)))

    def run(frames):
        enc = _encoder(shared)
        decimal = list(map(str, range(len(enc.labels))))
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in batches(frames):
            n, ids_digest, text_digest = [], [], []
            for t in b.column(1).to_pylist():
                ids = enc.encode(t or "")
                n.append(len(ids))
                ids_digest.append(digest(",".join(map(decimal.__getitem__, ids))))
                text_digest.append(digest(enc.decode(ids)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_digest, pa.string()), pa.array(text_digest, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(tidied(run, "pieces"), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


NAME, ORACLE = "op6_bpe_automaton", None
