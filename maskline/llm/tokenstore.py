"""Token-id files: concatenated ids with Elias-Fano coded document boundaries."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import eliasfano, shared, wordbpe

MAGIC = b"MLTOK1\0\0"
_HEAD = struct.Struct("<8sqqBqqq")  # magic, range, chunk, id width, documents, of these without an id, smallest id


def pack(where: int, chunk: int, doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """One file: header, coded document ids, coded boundaries, ids. Documents in ascending id, nulls first."""
    nulls = sum(d is None for d in doc_ids)
    known = [d for d in doc_ids if d is not None]
    least = known[0] if known else 0
    bounds = np.cumsum([0, *map(len, ids)])
    head = _HEAD.pack(MAGIC, where, chunk, ids[0].dtype.itemsize, len(doc_ids), nulls, least)
    return b"".join([head, eliasfano.encode(np.array([d - least for d in known], np.uint64)), eliasfano.encode(bounds), *(x.tobytes() for x in ids)])


class TokenFile:
    """A file's documents, by position, without unpacking the rest."""

    def __init__(self, data: bytes):
        magic, self.range, self.chunk, width, self.n, self._nulls, self._least = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        docs = eliasfano.Reader(data, _HEAD.size)
        self._docs, self.bounds = docs, eliasfano.Reader(data, docs.end)
        self.ids = np.frombuffer(data, f"<u{width}", self.bounds.universe - 1, self.bounds.end)

    def doc_id(self, i: int) -> int | None:
        return None if i < self._nulls else self._least + self._docs.select(i - self._nulls)

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document: two selects and a slice."""
        return self.ids[self.bounds.select(i) : self.bounds.select(i + 1)]

    def table(self) -> tuple[list[int | None], list[int]]:
        """All document ids and all boundaries."""
        return [None] * self._nulls + [self._least + int(x) for x in self._docs.all()], self.bounds.all().tolist()


def _put(root: str, name: str, data: bytes) -> None:
    """Write under another name, then rename: a retried task replaces whole files only."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(root)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, f"{path}/{name}")


def write_tokens(df: DataFrame, root: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, chunk_ids: int = 4_000_000, range_bytes: int = shared.RANGE_BYTES) -> DataFrame:
    """Encode every whole text and write the ids, in ascending document id, to files under ``root``.

    Rows are dealt to ranges of about ``range_bytes`` by one shuffle, a task for each, and sorted
    there; rows with one id or none are told apart by a hash of their text. A task streams its range into
    files of about ``chunk_ids`` ids, named by range and chunk, so it holds one file at a time
    and a retry rewrites the same names. Returns a row for each file: range, chunk, n_ids.
    ``root`` is a URI that pyarrow can write (file://, hdfs://, s3://).
    """
    from pyarrow import fs

    tie = F.xxhash64(F.col(text_col))
    cut = shared.ranges(df, [F.col(id_col).cast("long").alias("id"), tie.alias("tie")], F.coalesce(F.octet_length(text_col), F.lit(0)) + 16, range_bytes)
    store, path = fs.FileSystem.from_uri(root)
    store.create_dir(path, recursive=True)
    docs = df.select(cut.index().alias("_range"), F.col(id_col).cast("long").alias("_id"), tie.alias("_tie"), F.col(text_col).alias("_text"))
    docs = cut.dealt(docs, "_range").sortWithinPartitions("_range", F.col("_id").asc_nulls_first(), "_tie", "_text").drop("_tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = wordbpe.encoder(vocabulary)
        where, chunk, doc_ids, ids, held = None, 0, [], [], 0

        def flush() -> tuple[int, int, int]:
            _put(root, f"r{where:06d}-{chunk:06d}.tok", pack(where, chunk, doc_ids, ids))
            return where, chunk, held

        done = []
        for whole in batches:
            for batch in shared.slices(whole, 2):
                flat, at = encode.batch(batch.column(2), end_id)
                for i, (r, d) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                    if ids and (r != where or held >= chunk_ids):
                        done.append(flush())
                        chunk = chunk + 1 if r == where else 0
                        doc_ids, ids, held = [], [], 0
                    where = r
                    doc_ids.append(d)
                    ids.append(flat[at[i] : at[i + 1]])
                    held += len(ids[-1])
        if ids:
            done.append(flush())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*done, strict=True)], ["range", "chunk", "n_ids"])

    return docs.mapInArrow(write, "range long, chunk long, n_ids long")


def read_tokens(spark: SparkSession, root: str) -> DataFrame:
    """Documents of the files under ``root``: range, chunk, doc_id, local_start, n_tokens, ids_crc32."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(root).select("content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                f = TokenFile(data.as_py())
                docs, bounds = f.table()
                crc = [zlib.crc32(f.ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds, bounds[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f.range] * f.n, pa.int64()), pa.array([f.chunk] * f.n, pa.int64()), pa.array(docs, pa.int64()), pa.array(bounds[:-1], pa.int64()), pa.array(np.diff(bounds), pa.int64()), pa.array(crc, pa.int64())],
                    ["range", "chunk", "doc_id", "local_start", "n_tokens", "ids_crc32"],
                )

    return files.mapInArrow(read, "range long, chunk long, doc_id long, local_start long, n_tokens long, ids_crc32 long")


def token_store(df: DataFrame, vocabulary: str, root: str | None = None, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = shared.RANGE_BYTES) -> DataFrame:
    """Write a table's token files, read them back, and give each document's place and checksum.

    Returns doc_id, start (ids of all documents before it), n_tokens (with the end id),
    ids_crc32 (of its ids as little-endian unsigned 32-bit numbers), all as read from the files.
    Null texts are empty; null ids come first; rows with equal ids follow in the order of a hash of their texts; an
    empty table gives no files and no rows; other columns are not read.
    """
    spark = df.sparkSession
    root = root or f"{shared.shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    files = shared.stage(write_tokens(df, root, vocabulary, id_col, text_col, range_bytes=range_bytes))  # runs the writing
    ranges = files.groupBy("range").agg(F.sum("n_ids").alias("n"))  # as many rows as ranges
    of_range = ranges.select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_r0"))
    in_range = Window.partitionBy("range").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("range", "chunk", F.coalesce(F.sum("n_ids").over(in_range), F.lit(0)).alias("_c0")).join(F.broadcast(of_range), "range")
    return read_tokens(spark, root).join(starts, ["range", "chunk"]).select("doc_id", (F.col("_r0") + F.col("_c0") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
