"""Lexical retrieval packing: sharded BM25 indexes fill each seed's window with its neighbours."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, wordbpe

K1, B = 1.2, 0.75
DENSE = 8  # a term in more than one of so many documents has a full row of weights
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _tokenise(vocabulary: str, end_id: int):
    @shared.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = wordbpe.encoder(vocabulary)
        for whole in batches:
            for batch in shared.slices(whole, 1, shared.FEW):
                flat, bounds = encode.batch(batch.column(1), end_id)
                # smallest hash of two neighbouring ids: texts that share much often share it
                pairs = flat[:-1].astype(np.uint64) << np.uint64(32) | flat[1:]
                hashes = shared.mix(np.append(pairs, np.uint64(0)))
                hashes[bounds[1:] - 1] = np.uint64(shared.M64)
                route = np.minimum.reduceat(hashes, bounds[:-1]) >> np.uint64(1)
                ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(bounds * flat.itemsize), pa.py_buffer(flat)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(route.astype(np.int64)), ids], ["doc_id", "route", "ids"])

    return run


def _counted(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids of each document: document number, id, and how often it occurs there; ordered by both."""
    keys = np.repeat(np.arange(len(lengths), dtype=np.uint64) << np.uint64(32), lengths)
    keys |= flat.astype(np.uint64)
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    times, keys = np.diff(first, append=len(keys)).astype(np.int32), keys[first]
    return (keys >> np.uint64(32)).astype(np.int32), (keys & np.uint64(0xFFFFFFFF)).astype(np.int32), times


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and how many each row has."""
    wide = column.cast(pa.large_binary())
    at = np.frombuffer(wide.buffers()[1], np.int64, len(wide) + 1, 8 * wide.offset)
    return np.frombuffer(wide.buffers()[2], np.uint8)[at[0] : at[-1]].view(kind), np.diff(at) // np.dtype(kind).itemsize


def _document_frequencies(kind: str, vocab: int):
    @shared.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, total = np.zeros(vocab, np.int64), 0, 0
        for whole in batches:
            for batch in shared.slices(whole, 0, shared.FEW):
                flat, lengths = _flat(batch.column(0), kind)
                df += np.bincount(_counted(flat, lengths)[1], minlength=vocab)
                docs, total = docs + len(lengths), total + len(flat)
        terms = np.flatnonzero(df)
        counts = [np.concatenate([[-2, -1], terms]), np.concatenate([[docs, total], df[terms]])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in counts], ["term", "n"])

    return run


class Index:
    """A shard's inverted index: for each term, its documents and their BM25 weights."""

    def __init__(self, docs: list[np.ndarray], df: np.ndarray, n_docs: int, mean: float):
        lengths = np.array([len(d) for d in docs])
        doc, distinct, tf = _counted(np.concatenate(docs), lengths)
        self.n, self._cut = len(docs), np.searchsorted(doc, np.arange(len(docs) + 1))
        by_term = np.argsort(distinct, kind="stable")
        self.docs, term, tf = doc[by_term], distinct[by_term], tf[by_term]
        del doc, distinct
        self.weights = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))[term]
        self.weights *= tf
        self.weights *= K1 + 1
        below = B * lengths[self.docs]
        below /= mean
        below += 1 - B
        below *= K1
        below += tf
        self.weights /= below
        del below
        fresh = np.diff(term, prepend=-1) != 0
        begins = np.flatnonzero(fresh)
        ends = np.append(begins[1:], len(term))
        group = np.cumsum(fresh, dtype=np.int32) - 1
        self._groups = np.empty_like(group)  # of each document's distinct terms
        self._groups[by_term] = group
        self._spans = list(zip(begins.tolist(), ends.tolist(), strict=True))
        common = ends - begins > self.n / DENSE
        self._row = np.where(common, np.cumsum(common) - 1, -1)
        self._common = np.zeros((int(common.sum()), self.n))
        dense = common[group]
        self._common[self._row[group[dense]], self.docs[dense]] = self.weights[dense]

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of every document of the shard for all distinct terms of a document."""
        groups = self._groups[self._cut[doc] : self._cut[doc + 1]]
        rows = self._row[groups]
        total = self._common[rows[rows >= 0]].sum(axis=0)
        spans = [self._spans[g] for g in groups[rows < 0].tolist()]
        if spans:
            docs = np.concatenate([self.docs[a:b] for a, b in spans])
            total += np.bincount(docs, np.concatenate([self.weights[a:b] for a, b in spans]), self.n)
        return total


def fill(docs: list[np.ndarray], index: Index, size: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of a shard as lists of (document, start, length).

    Whole windows of a document stand alone. What is left of it seeds a sequence, whose best
    unused neighbours are added while there is room; the last is cut, and its rest is the next
    seed. When no unused neighbour shares a term, the next unused document follows. So every
    sequence of a shard but its last is full.
    """
    left = np.array([len(d) % size for d in docs])
    for i, d in enumerate(docs):
        for start in range(0, len(d) - size + 1, size):
            yield [(i, start, size)]
    unused = left > 0
    order = deque(np.flatnonzero(unused).tolist())
    seed = None
    while True:
        while seed is None and order:
            i = order.popleft()
            if unused[i]:
                unused[i], seed = False, (i, len(docs[i]) - int(left[i]), int(left[i]))
        if seed is None:
            return
        sequence, room, scores = [seed], size - seed[2], None
        doc, seed = seed[0], None
        while room:
            if scores is None:
                scores = np.where(unused, index.scores(doc), 0.0)
            best = int(scores.argmax())
            if scores[best] <= 0:
                while order and not unused[order[0]]:
                    order.popleft()
                if not order:
                    break
                best = order.popleft()
            unused[best], scores[best] = False, 0.0
            start, length = len(docs[best]) - int(left[best]), int(left[best])
            take = min(length, room)
            sequence.append((best, start, take))
            room -= take
            if take < length:
                seed = (best, start + take, length - take)
        yield sequence


def _pack(size: int, kind: str, df: np.ndarray, n_docs: int, mean: float):
    @shared.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        doc_ids = [d for b in got for d in b.column(0).to_pylist()]
        docs = [np.frombuffer(x.as_py(), kind) for b in got for x in b.column(1)]
        first, rows = TaskContext.get().partitionId() << 32, []

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(x, pa.binary() if i == 6 else pa.int64()) for i, x in enumerate(zip(*rows, strict=True))]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for k, sequence in enumerate(fill(docs, Index(docs, df, n_docs, mean), size)):
            offset = 0
            for i, start, length in sequence:
                rows.append((doc_ids[i], start, length, len(docs[i]), first + k, offset, docs[i][start : start + length].astype("<u4").tobytes()))
                offset += length
            if len(rows) >= 500:
                yield flush()
        if rows:
            yield flush()

    return run


def pack_by_retrieval(df: DataFrame, vocabulary: str, size: int = 2048, shard_ids: int = 1_500_000, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1) -> DataFrame:
    """Pack every document's ids, with an end id, into sequences of at most ``size`` ids.

    Documents are tokenised once; document frequencies of the vocabulary's ids (its size bounds
    them) are summed over all rows and sent to the tasks. Documents are then cut, in order of a
    content hash and of id, into shards of about ``shard_ids`` ids, so a hot source or a group
    of copies spreads over shards; each shard builds its inverted index and fills its sequences
    (see ``fill``). At most one sequence a shard is not full.

    Returns a row for each piece: doc_id, start, length, doc_tokens, sequence_id, offset, and
    its ids as little-endian unsigned 32-bit numbers. Null and empty texts give the end id
    alone; rows with equal or null ids are packed as the separate rows they are; an empty table
    gives no rows; other columns are not read.
    """
    spark = df.sparkSession
    known = wordbpe.encoder(vocabulary)
    kind, vocab = known.kind.str, max(known.library.get_vocab_size(), end_id + 1)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tokens = shared.stage(docs.mapInArrow(_tokenise(vocabulary, end_id), "doc_id long, route long, ids binary"))
    counted = tokens.select("ids").mapInArrow(_document_frequencies(kind, vocab), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in counted.toLocalIterator()}  # a row for each id of the vocabulary at most
    n_docs, total = found.pop(-2, 0), found.pop(-1, 0)
    if not n_docs:
        return spark.createDataFrame([], PIECES)
    frequencies = np.zeros(vocab, np.int64)
    frequencies[list(found)] = list(found.values())
    shards = tokens.repartitionByRange(max(1, -(-total // shard_ids)), "route", "doc_id").select("doc_id", "ids")
    return shards.mapInArrow(_pack(size, kind, frequencies, n_docs, total / n_docs), PIECES)
