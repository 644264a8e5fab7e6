"""Token ids in binary files, with the documents' boundaries as Elias-Fano sequences.

File format (little endian). A file holds blocks, after each one byte 0x0A. A block:
  header  "EFID", u8 version, u8 bytes of an id, u16 0, u32 partition, u32 block in the partition, u64 documents, u64 ids,
          u64 documents whose doc_id is null, i64 smallest doc_id, u64 largest doc_id less the smallest,
          u64 ids of the partition before this block, u64 bytes of this block
  bounds  Elias-Fano sequence of the documents' ends in the block's id array
  keys    Elias-Fano sequence of the other documents' doc_id less the smallest
  ids     the id array
An Elias-Fano sequence of n non-decreasing values below u: u8 low bits l = floor(log2(u / n)); the low bits, packed; the high parts as
unary gaps in a bit array; and for select one u32 for every 512 bits, the number of ones before them: about 2 + log2(u / n) bits a value.
Offsets are read back by select, some thousand documents at a time: no table of all offsets is made.

Documents are dealt by ranges of doc_id and the beginning of the text, sorted and encoded in the task that writes them; Spark's commit protocol
keeps files of finished tasks only. Files are read back by Spark as binary files, each once; a running sum over the partitions' sizes, one row
a partition, gives each partition's first position.

Defined cases. A null text is an empty one; an empty text has the end id alone. Null doc_ids come first. Rows with the same doc_id are
ordered by text, and each is returned. An empty table gives no rows. Other columns are not looked at.
"""
from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import Pieces, batches, kept, new_folder, table, tidied, written

MAGIC = b"EFID"
HEADER = struct.Struct("<4sBBHIIQQQqQQQ")
END_ID = 1
#: Ids after which a block is closed; a single longer document makes a longer block.
BLOCK_IDS = 2 << 20
#: Blocks at most in a file: 128 MB of two-byte ids. A partition's blocks beyond that go to further files.
FILE_BLOCKS = 32
#: Documents whose offsets are read at a time; a multiple of eight, so that packed low bits of as many values end at a byte.
CHUNK = 4096


# Elias-Fano


def pack_sequence(values: np.ndarray, universe: int) -> bytes:
    n = len(values)
    low = max(0, (universe // n).bit_length() - 1) if n and universe else 0
    values = values.astype(np.uint64)
    lows = [np.packbits(((values[k : k + CHUNK, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8), bitorder="little").tobytes() for k in range(0, n, CHUNK)]
    highs = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    size = int(highs[-1]) + 1 if n else 0
    unary = np.zeros(-(-size // 512) * 512, np.uint8)
    unary[highs] = 1
    ones = unary.reshape(-1, 512).sum(axis=1, dtype=np.uint32)
    before = (np.cumsum(ones) - ones).astype("<u4")
    parts = [*lows, np.packbits(unary, bitorder="little").tobytes(), before.tobytes()]
    return struct.pack("<BQI", low, n, len(before)) + b"".join(parts)


class Sequence:
    """A packed sequence in a buffer. select(i) gives one value, values() all."""

    def __init__(self, data: bytes, at: int = 0):
        self.low, self.n, blocks = struct.unpack_from("<BQI", data, at)
        at += struct.calcsize("<BQI")
        n_low = -(-self.n * self.low // 8)
        self.lows = np.frombuffer(data, np.uint8, n_low, at)
        self.unary = np.frombuffer(data, np.uint8, blocks * 64, at + n_low)
        self.before = np.frombuffer(data, "<u4", blocks, at + n_low + blocks * 64)
        self.end = at + n_low + blocks * 68

    def select(self, i: int) -> int:
        """Value number i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        return int(self.selected(i, i + 1)[0])

    def selected(self, a: int, b: int) -> np.ndarray:
        """Values number a to b - 1: the samples name the stretch of 512-bit words that holds their ones, a scan of that finds them."""
        if a >= b:
            return np.zeros(0, np.uint64)
        first, last = (int(np.searchsorted(self.before, i, side="right")) - 1 for i in (a, b - 1))
        ones = np.flatnonzero(np.unpackbits(self.unary[first * 64 : last * 64 + 64], bitorder="little"))
        skip = a - int(self.before[first])
        highs = (ones[skip : skip + b - a] + first * 512 - np.arange(a, b)).astype(np.uint64)
        begin = a * self.low // 8
        bits = np.unpackbits(self.lows[begin : -(-b * self.low // 8)], bitorder="little")[a * self.low - begin * 8 :][: (b - a) * self.low]
        lows = (bits.reshape(b - a, self.low).astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return (highs << np.uint64(self.low)) | lows

    def values(self) -> np.ndarray:
        return np.concatenate([self.selected(k, min(k + CHUNK, self.n)) for k in range(0, self.n, CHUNK)] or [np.zeros(0, np.uint64)])


# Blocks


def pack_block(part: int, block: int, before: int, doc_ids: list[int | None], counts: np.ndarray, ids: bytes, width: int) -> bytes:
    nulls = sum(d is None for d in doc_ids)
    keys = np.array(doc_ids[nulls:], np.int64)
    base = int(keys[0]) if len(keys) else 0
    span = int(keys[-1]) - base if len(keys) else 0
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    relative = keys.astype(np.uint64) - np.array(base, np.int64).astype(np.uint64)
    body = pack_sequence(ends, total + 1) + pack_sequence(relative, span + 1) + ids
    return HEADER.pack(MAGIC, 2, width, 0, part, block, len(doc_ids), total, nulls, base, span, before, HEADER.size + len(body)) + body


class Block:
    """One block, read from a file's bytes, where it begins."""

    def __init__(self, data: bytes, at: int = 0):
        magic, version, width, _, self.part, self.block, self.n_docs, self.n_ids, self.nulls, self.base, _, self.before, size = HEADER.unpack_from(data, at)
        if magic != MAGIC or version != 2:
            raise ValueError("not a token-id block")
        self.end = at + size
        if len(data) <= self.end or data[self.end] != 10:
            raise ValueError("a token-id block of the wrong length")
        self.bounds = Sequence(data, at + HEADER.size)
        self.keys = Sequence(data, self.bounds.end)
        if self.keys.end + width * self.n_ids != self.end:
            raise ValueError("a token-id block of the wrong length")
        self.ids = np.frombuffer(data, f"<u{width}", self.n_ids, self.keys.end)

    def doc_ids(self, a: int, b: int) -> list[int | None]:
        """doc_ids of documents a to b - 1."""
        none = max(0, min(b, self.nulls) - a)
        return [None] * none + [self.base + int(k) for k in self.keys.selected(max(a - self.nulls, 0), max(b - self.nulls, 0))]

    def ends(self, a: int, b: int) -> np.ndarray:
        """Where documents a to b - 1 begin, and where the last one ends, in the block's ids."""
        ends = self.bounds.selected(max(a - 1, 0), b).astype(np.int64)
        return ends if a else np.append(0, ends)

    def document(self, i: int) -> np.ndarray:
        """The ids of document i, found through select alone."""
        return self.ids[self.bounds.select(i - 1) if i else 0 : self.bounds.select(i)]


def blocks_of(data: bytes) -> Iterator[Block]:
    at = 0
    while at < len(data):
        block = Block(data, at)
        yield block
        at = block.end + 1


# Encoding


#: Any character outside what the word cache may split by itself: printable ASCII, tab, line feed, carriage return, Latin letters that
#: normalisation leaves alone, and common punctuation and currency signs. Texts with others go through the library whole.
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\xd6\xd8-\xf6\xf8-įı-ɏ‐-‧‰-⁞₠-₿]|<\\|")
#: What the word tokenizer's own pattern finds in lower-cased texts of those characters.
PIECES = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes for themselves, the others from U+0100 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class WordEncoder:
    """encode(text) as bytes of ids, equal to the library's encode(text, add_special_tokens=False).

    The word tokenizer lower-cases, drops white space and merges inside pieces only, so the ids of a piece do not depend on what
    surrounds it. Each distinct piece is encoded by the library's model once and kept; at most `limit` pieces are kept.
    """

    def __init__(self, spec: str, width: int, limit: int = 150_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(spec)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.model, self.kind = self.whole.model, f"<u{width}"
        self.letters = byte_letters()
        self.kept = Pieces(self._piece, limit)

    def _piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return np.array([t.id for t in self.model.tokenize(spelled)], self.kind).tobytes()

    def encode(self, text: str) -> bytes:
        if UNUSUAL.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        return b"".join(map(self.kept.__getitem__, PIECES.findall(text.lower())))


# The operator


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, *, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Writes the ids of docs (doc_id, text) to a new folder, in ascending doc_id order."""
    from tokenizers import Tokenizer

    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    width = 2 if max(Tokenizer.from_str(spec).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def encode(frames):
        enc = kept("words", shared.value, lambda: WordEncoder(shared.value, width))
        end = np.array([end_id], f"<u{width}").tobytes()
        part, block, before, held = TaskContext.get().partitionId(), 0, 0, 0
        doc_ids, counts, ids = [], [], []
        packed = lambda: pa.RecordBatch.from_arrays([pa.array([pack_block(part, block, before, doc_ids, np.array(counts, np.int64), b"".join(ids), width)], pa.binary())], names=["value"])
        for b in batches(frames):
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                got = enc.encode(t or "") + end
                doc_ids.append(d)
                ids.append(got)
                counts.append(len(got) // width)
                held += counts[-1]
                if held >= block_ids:
                    yield packed()
                    block, before, held, doc_ids, counts, ids = block + 1, before + held, 0, [], [], []
        if doc_ids:
            yield packed()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # The beginning of the text parts rows of one doc_id, or of none, in the order that they are sorted in.
    ordered = ordered.repartitionByRange("doc_id", F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text")
    # Spark's text writer puts out a string's bytes as they are; a record is a block.
    ordered.mapInArrow(tidied(encode, "words"), "value binary").select(F.col("value").cast("string")).write.option("maxRecordsPerFile", FILE_BLOCKS).option("lineSep", "\n").text(folder)


def read_ids(spark: SparkSession, folder: str, *, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the folder's files, and its ids if asked for."""
    kinds = dict.fromkeys(["part", "doc_id", "local", "n_tokens", "ids_crc32"], pa.int64()) | ({"ids": pa.list_(pa.int64())} if with_ids else {})

    def decode(frames):
        for b in frames:
            for data in b.column("content"):
                for block in blocks_of(data.as_py()):
                    for a in range(0, block.n_docs, CHUNK):
                        z = min(a + CHUNK, block.n_docs)
                        ends = block.ends(a, z)
                        wide = block.ids[ends[0] : ends[-1]].astype("<u4")
                        each = [wide[i:j] for i, j in zip((ends[:-1] - ends[0]).tolist(), (ends[1:] - ends[0]).tolist(), strict=True)]
                        columns = {"part": [block.part] * (z - a), "doc_id": block.doc_ids(a, z), "local": block.before + ends[:-1], "n_tokens": np.diff(ends), "ids_crc32": [zlib.crc32(x) for x in each]}
                        columns |= {"ids": [x.astype(np.int64) for x in each]} if with_ids else {}
                        yield pa.RecordBatch.from_arrays([pa.array(columns[c], k) for c, k in kinds.items()], names=list(kinds))

    schema = ", ".join(f"{c} {'array<long>' if c == 'ids' else 'long'}" for c in kinds)
    found = written(spark.read.format("binaryFile").load(folder).select("content").mapInArrow(tidied(decode), schema), "read-ids")
    # One row for each task that wrote.
    parts = found.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    bases = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return found.join(bases, "part").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = new_folder(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(spark, folder)


NAME, ORACLE = "op5_token_output", None
