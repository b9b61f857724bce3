"""Helpers that several operators share: shared folder, id ranges, words and their hashes."""

from __future__ import annotations

import contextlib
import ctypes
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

M64 = 0xFFFFFFFFFFFFFFFF


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests) a temporary one is set.
    """
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="maskline-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(where)
    return where


def stage(df: DataFrame, free: bool = False) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage.

    ``free`` deletes the files of its shuffles once it is written, not when the driver next
    collects garbage. An executor lost until then is made good from the lineage, later from the written copy.
    """
    spark, setting = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    shared_dir(spark)
    if not free:
        return df.checkpoint()
    held = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        return df.select("*").checkpoint()  # planned under the setting
    finally:
        spark.conf.unset(setting) if held is None else spark.conf.set(setting, held)


RANGE_BYTES, MOST_RANGES = 8 << 20, 50_000  # a range of rows, and how many of them at most
DRAWN = 12  # rows that are drawn for each range


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


@dataclass
class Ranges:
    """Cuts of a table, in the order of its key: a range holds the rows above one cut, up to and with the next."""

    keys: list[Column]
    kind: str
    cuts: list[dict]
    top: dict | None  # the largest key

    def points(self) -> Column:
        return F.from_json(F.lit(json.dumps(self.cuts)), f"array<{self.kind}>")  # folded once

    def key(self) -> Column:
        return F.struct(*self.keys)

    def index(self) -> Column:
        """The range of a row: how many cuts lie below its key, by a binary search (nulls are smallest)."""
        if not self.cuts:
            return F.lit(0)
        points, key = self.points(), self.key()
        steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(self.cuts).bit_length()))))
        return F.aggregate(
            steps,
            F.lit(0),
            lambda low, step: F.when(F.try_element_at(points, low + step) < key, low + step).otherwise(low),
        )

    def dealt(self, df: DataFrame, index: str) -> DataFrame:
        """Every range in a partition of its own."""
        return df.repartitionById(len(self.cuts) + 1, F.col(index))


def ranges(df: DataFrame, keys: list[Column], weight: Column, target: int = RANGE_BYTES) -> Ranges:
    """Cut a table into ranges of about ``target`` bytes (or a 50,000th of it, if that is more).

    Rows are drawn with a probability in proportion to their bytes, twelve for each range, and
    every range gets the same number of drawn bytes. The draw's keys, a few for each range, and
    one row of totals are all that the driver sees. Rows with one id are told apart by the
    keys after it, so that one id, or none, may hold any share of the rows.
    """
    wanted = df.select(F.struct(*keys).alias("key"), weight.alias("weight"))
    seen = wanted.agg(F.sum("weight"), F.max("key")).first()
    total, top = seen[0] or 0, seen[1]
    kind, cuts = wanted.schema["key"].dataType.simpleString(), []
    n = min(MOST_RANGES, -(-int(total) // target))
    if n > 1:
        step = total / (n * DRAWN)
        drawn = [(tuple(r["key"]), max(step, float(r["weight"]))) for r in wanted.where(F.rand(17) * step < F.col("weight")).toLocalIterator()]
        drawn.sort(key=lambda d: [(x is not None, x) for x in d[0]])
        due, share, upto = 1, sum(w for _, w in drawn) / n, 0.0
        for key, w in drawn:
            upto += w
            if upto >= due * share and key != tuple(top):
                due = int(upto / share) + 1
                if not cuts or cuts[-1] != key:
                    cuts.append(key)
    names = [f.name for f in wanted.schema["key"].dataType.fields]
    return Ranges(keys, kind, [dict(zip(names, c, strict=True)) for c in cuts], top and top.asDict())


FEW = 1 << 20  # bytes of texts whose words, ids or sets, at eight bytes and more, are in memory at a time


def slices(batch: pa.RecordBatch, column: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows whose texts in a column have about ``size`` bytes, one row at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        done = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, done + size, "right")))
        yield batch.slice(first, last - first)
        first = last


BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Have Spark hand rows to Python in Arrow batches of about ``BATCH_BYTES``, where the session lets them be larger.

    10,000 texts are a batch of 20 MB and more otherwise, held on both sides by each task. The
    session keeps the setting, since a returned frame runs later.
    """
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(setting)) <= BATCH_BYTES:
        spark.conf.set(setting, f"{BATCH_BYTES}b")


def give_back() -> None:
    """Hand freed memory that Arrow's pool and the C library keep for later back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's function that hands freed memory back at its end.

    A Python worker serves one task after the other, of all stages, and would keep what the
    largest step of each took.
    """

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return outer


_PART = 1 << 18  # bytes of text that are hashed at a time, each taking about 40 bytes meanwhile
_APART = np.zeros(256, bool)  # what stands between words
_APART[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLACES = 256  # bytes of the longest word that is hashed with the others
_PLACED = np.random.default_rng(11).integers(1, 1 << 63, _PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a column's texts, and each text's bounds among them.

    Texts are read as bytes, a quarter of a megabyte at a time, cut between words, whatever their number and
    length; with ``lower``, A-Z count as a-z. A null text has no words.
    """
    texts = texts.fill_null("").cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[: at[-1]]
    hashes, begins, first = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], int(at[0])
    while first < len(data):
        last = min(first + _PART, len(data))
        while last < len(data) and not _APART[data[last]]:
            ahead = np.flatnonzero(_APART[data[last : last + (1 << 16)]])
            last = last + int(ahead[0]) if len(ahead) else min(last + (1 << 16), len(data))
        part = data[first:last]
        apart, starts = _APART[part], np.zeros(last - first, bool)
        starts[at[np.searchsorted(at, first) : np.searchsorted(at, last)] - first] = True  # a text starts
        begin = ~apart
        begin[1:] &= apart[:-1] | starts[1:]
        words = np.flatnonzero(begin)
        if len(words):
            place = np.maximum(np.arange(len(part)) - np.repeat(words, np.diff(words[1:], prepend=0, append=len(part))), 0)
            terms = ((_LOWER[part] if lower else part).astype(np.uint64) + np.uint64(1)) * _PLACED[np.minimum(place, _PLACES - 1)]
            terms[apart] = 0
            h = mix(np.add.reduceat(terms, words))
            for i in np.flatnonzero(np.diff(words, append=len(part)) > _PLACES).tolist():
                word = part[words[i] : words[i + 1] if i + 1 < len(words) else len(part)]
                word = word[: len(word) - int(_APART[word][::-1].argmin())]
                if len(word) > _PLACES:
                    h[i] = xxhash.xxh3_64_intdigest((_LOWER[word] if lower else word).tobytes())
            hashes.append(h)
            begins.append(words + first)
        first = last
    return np.concatenate(hashes), np.searchsorted(np.concatenate(begins), at)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 (bytes.split knows exactly these separators)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = (np.random.default_rng(20).integers(1 << 32, 1 << 63, 64, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words that start at each position; empty if there are fewer."""
    if k > len(_POWERS):
        raise ValueError(f"at most {len(_POWERS)} words")
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n] * _POWERS[0]
    for i in range(1, k):
        out = out + h[i : i + n] * _POWERS[i]
    return mix(out)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def table(df: DataFrame):
    """``df`` as a Parquet table in the shared folder, for the length of a ``with`` block."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)


def hashes_at(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The same hashes at chosen positions only."""
    return mix((h[at[:, None] + np.arange(k)] * _POWERS[:k]).sum(axis=1, dtype=np.uint64))
