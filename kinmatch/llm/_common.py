"""What the operators share: reading tables, cutting lineage in the shared folder, byte-level word splitting and hashing."""
from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let  # noqa: F401 - for the operators
from ..shipping import ship

#: Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return. Also a regular expression of what words are made of.
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Lower-cases A-Z and leaves every other byte.
LOWER_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset in local mode (tests) a temporary one, under a name of this run's own."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not root:
            if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            root = "file://" + tempfile.mkdtemp(prefix="kinmatch-")
        _folders[app] = f"{root.rstrip('/')}/kinmatch-{app}"
        atexit.register(_purge, spark, _folders[app])
    return _folders[app]


def _purge(spark: SparkSession, folder: str) -> None:
    try:
        drop_folder(spark, folder)
    except Exception:  # the JVM may have gone first; its folder then stays for the cluster's own cleaning
        pass


def drop_folder(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, read again: later stages survive lost executors without recomputing what came before."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.parquet(folder)
    out = spark.read.schema(df.schema).parquet(folder)
    out._kinmatch_folder = folder
    return out


def dropped(*frames: DataFrame) -> None:
    """Removes the files of tables made by `written` that nothing reads any more."""
    for df in frames:
        drop_folder(df.sparkSession, df._kinmatch_folder)


#: Rows of a batch that goes to Python, where the session leaves Spark's default of 10,000: whole texts are long.
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads each 64-bit value over all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


class WordHashes(dict):
    """64-bit hashes of words (bytes), kept for the first words seen up to a bound; others are worked out each time."""

    LIMIT = 50_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh64_intdigest(word)
        if len(self) < self.LIMIT:
            self[word] = value
        return value


class Pieces(dict):
    """What a function gives for each piece, kept for the first ones seen up to a bound; for others it is called each time."""

    def __init__(self, of, limit: int):
        super().__init__()
        self.of, self.limit = of, limit

    def __missing__(self, piece):
        value = self.of(piece)
        if len(self) < self.limit:
            self[piece] = value
        return value


class WordIds(dict):
    """Ids of known words; -1 for any other, without keeping it."""

    def __missing__(self, word: bytes) -> int:
        return -1


def hashes_of(words: list[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of width consecutive values (order counts); one hash of the whole sequence if it is shorter; empty for an empty one."""
    n = len(h)
    if n == 0:
        return h
    w = min(width, n)
    total = h[: n - w + 1] + np.uint64(w)
    for k in range(1, w):  # a polynomial over random words, then spread
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += h[k : n - w + 1 + k]
    return mix64(total)


def flat_words(texts: list[bytes | None], cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, one after the other, and where each text's begin (one more number than texts)."""
    words: list[bytes] = []
    at = [0]
    for t in texts:
        if t:
            words += t.translate(LOWER_AZ).split()
        at.append(len(words))
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)), np.array(at, np.int64)


def shingle_sets(texts: list[bytes | None], width: int, cache: WordHashes) -> list[np.ndarray]:
    """Sorted distinct window hashes of each text."""
    h, at = flat_words(texts, cache)
    return sets_of(h, at, width)


def sets_of(h: np.ndarray, at: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct window hashes of each stretch h[at[i] : at[i + 1]]."""
    whole = window_hashes(h, width) if len(h) >= width else h[:0]
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        s = np.sort(whole[a : b - width + 1]) if b - a >= width else window_hashes(h[a:b], width)
        if len(s) > 1 and not (new := s[1:] != s[:-1]).all():
            s = s[np.append(True, new)]
        out.append(s)
    return out


def dealt(columns: list[np.ndarray], by: np.ndarray, parts: int, kind: int) -> Iterator[tuple[int, int, bytes]]:
    """(part, kind, columns as bytes) for each part, a number below parts that depends on `by` only: what travels in a shuffle as few wide rows."""
    if not len(by):
        return
    part = (mix64(by) >> np.uint64(33)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    rows = np.stack([c.view(np.uint64)[order] for c in columns])
    part = part[order]
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    for a, b in zip(first, [*first[1:], len(part)], strict=True):
        yield int(part[a]), kind, rows[:, a:b].tobytes()


DEALT = "part int, kind int, rows binary"


def packed(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["part", "kind", "rows"])


def unpacked(blobs: list[bytes], columns: int) -> np.ndarray:
    """The columns of all blobs, side by side."""
    return np.concatenate([np.frombuffer(b, np.uint64).reshape(columns, -1) for b in blobs], axis=1) if blobs else np.zeros((columns, 0), np.uint64)


def parts_of(spark: SparkSession) -> int:
    """Parts to deal to: several for each shuffle partition, so that partitions come out even."""
    return 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def free(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files and broadcasts of what is done, and executors give back the memory that it took.

    Spark does so when the driver's and the executors' machines collect garbage, which they may not do for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).write.format("noop").mode("overwrite").save()


_held: dict[str, tuple] = {}


def kept(name: str, key: object, make: Callable[[], object]):
    """make() for this worker process, made anew when the key is another object. Only one such value is held at a time."""
    if name not in _held or _held[name][0] is not key:
        _held.clear()
        _held[name] = (key, make())
    return _held[name][1]


def let_go(keep: str | None) -> None:
    """Drops what another stage's tasks have left in this worker process, and what memory its allocators hold on to."""
    for name in [n for n in _held if n != keep]:
        del _held[name]
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def tidied(run: Callable[[Iterable], Iterator], keep: str | None = None) -> Callable[[Iterable], Iterator]:
    """run, before and after which the worker process gives back memory: it goes on to other stages, and may wait beside other workers."""

    def whole(frames):
        let_go(keep)
        yield from run(frames)
        let_go(keep)

    return whole


def batches(frames: Iterable, rows: int = 256, nbytes: int = 4 << 20) -> Iterator:
    """Record batches cut into slices that hold at most so many rows and, by their mean row, about so many bytes."""
    for b in frames:
        step = max(1, min(rows, int(nbytes * b.num_rows / max(b.nbytes, 1)))) if b.num_rows else 1
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)
