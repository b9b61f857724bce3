"""Removal of repeated word windows: content anchors route candidates to FM-index shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared
from .fmindex import FMIndex

GRAM = 8  # words of an anchor
BLOCK = 5  # words of an index symbol
SHARD = 8_000  # segments of an index
HOT = 4_000  # distinct segments of one anchor from which its windows are dealt one by one


def _stage(df: DataFrame) -> DataFrame:
    return shared.stage(df, free=True)


def _check(window: int) -> None:
    if window % BLOCK or not 2 * BLOCK <= window <= 60:
        raise ValueError(f"the window must be a multiple of {BLOCK} words from {2 * BLOCK} to 60")


def _anchors(h: np.ndarray, grams: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Anchors of a text: for each, the first window it stands for, how many, its hash, the segment's hash.

    A window's anchor is the leftmost smallest of its 8-word hashes, so equal windows have equal
    anchors; successive windows with the same anchor form a segment.
    """
    at = np.lib.stride_tricks.sliding_window_view(grams, window - GRAM + 1).argmin(axis=1) + np.arange(len(h) - window + 1)
    lo = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    hi = np.concatenate([lo[1:], [len(at)]]) - 1
    ends = shared.hashes_at(h, np.concatenate([lo, hi]), window)
    segment = shared.mix(ends[: len(lo)] * np.uint64(3) + shared.mix(ends[len(lo) :]) + (hi - lo).astype(np.uint64))
    return lo, hi - lo + 1, grams[at[lo]].view(np.int64), segment.view(np.int64)


def _find(window: int):
    @shared.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in shared.slices(whole, 2, shared.FEW):
                words, bounds = shared.word_hashes(batch.column(2))
                grams = shared.gram_hashes(words, GRAM)
                parts = []
                for i in np.flatnonzero(np.diff(bounds) >= window).tolist():
                    a, b = bounds[i], bounds[i + 1]
                    lo, n, anchor, segment = _anchors(words[a:b], grams[a : b - GRAM + 1], window)
                    parts.append((np.full(len(lo), i), lo, n, anchor, segment))
                if parts:
                    row, lo, n, anchor, segment = map(np.concatenate, zip(*parts, strict=True))
                    row = pa.array(row)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(lo, pa.int32()), pa.array(n, pa.int32()), pa.array(anchor), pa.array(segment)], ["row", "check", "lo", "n", "anchor", "segment"])

    return run


def _segments(window: int):
    """Word hashes of wanted segments, a row for each."""

    @shared.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in shared.slices(whole, 0, shared.FEW):
                words, bounds = shared.word_hashes(batch.column(0))
                out = []
                for begin, wanted in zip(bounds.tolist(), batch.column(1).to_pylist(), strict=False):
                    for w in wanted:
                        lo, n = begin + w["lo"], w["n"]
                        out.append((w["anchor"], w["segment"], w["hot"], n, 1, words[lo : lo + n + window - 1].tobytes()))
                if out:
                    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary()]
                    names = ["anchor", "segment", "hot", "n", "copies", "words"]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return run


def _windows(window: int):
    """The hash of each window of segments, whose word hashes are given."""

    @shared.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in shared.slices(whole, 3, shared.FEW // 4)):
            n = batch.column(2).to_numpy().astype(np.int64)
            flat = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint64)
            row = np.repeat(np.arange(len(n)), n)
            at = np.arange(len(row)) - (np.cumsum(n) - n)[row]
            begin = np.cumsum(n + window - 1) - (n + window - 1)
            keys = shared.hashes_at(flat, begin[row] + at, window).view(np.int64)
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(keys), pa.array(at, pa.int32())], ["anchor", "segment", "key", "at"])

    return run


def _search(window: int):
    """Index a shard's segments and stream their windows through it.

    A symbol is a block of five words. Each segment is laid down in five phases (twice where
    copies of it were left out), so that a window, whatever its start, is a run of
    ``window / 5`` symbols of one phase. The matching statistics at the window's end tell how
    many of its last blocks stand at two places and more; where all do, the window is repeated.
    """
    starts = range(0, window, BLOCK)

    @shared.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got)
        n_of, copies = rows.column("n").to_numpy(), rows.column("copies").to_numpy()
        flat = np.frombuffer(b"".join(x.as_py() for x in rows.column("words")), np.uint64)
        begin = np.concatenate([[0], np.cumsum(n_of + window - 1)])
        text, queries = [np.zeros(1, np.uint64)], []
        for n in np.unique(n_of):
            own = np.flatnonzero(n_of == n)
            grid = flat[begin[own][:, None] + np.arange(n + window - 1)]
            blocks = sum(grid[:, i : grid.shape[1] - BLOCK + 1 + i] * shared._POWERS[i] for i in range(BLOCK))
            blocks = np.maximum(shared.mix(blocks), np.uint64(1))
            laid = np.repeat(blocks, copies[own], axis=0)
            for phase in range(min(BLOCK, int(n))):  # windows start in these only
                text.append(np.concatenate([laid[:, phase::BLOCK], np.zeros((len(laid), 1), np.uint64)], axis=1).ravel())
            queries.append((own, int(n), blocks))
        del flat, grid, laid
        text = np.concatenate(text)
        names = np.unique(text)
        index = FMIndex(np.searchsorted(names, text), len(starts))
        del text
        mask = np.zeros(len(n_of), np.int64)
        for own, n, blocks in queries:
            for i in range(n):
                length, _, _ = index.matching(np.searchsorted(names, blocks[:, [i + s for s in starts]]))
                mask[own[length * BLOCK >= window]] |= 1 << i
        yield pa.RecordBatch.from_arrays([rows.column("anchor").combine_chunks(), rows.column("segment").combine_chunks(), pa.array(mask)], ["anchor", "segment", "mask"])

    return run


def _remove(window: int, text_at: int):
    @shared.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in shared.slices(whole, text_at, shared.FEW)):
            texts, total, gone = [], [], []
            for text, marks in zip(batch.column(text_at), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                text = text.as_py()
                words = shared.words_of(text)
                total.append(len(words))
                edge = np.zeros(len(words) + 1, np.int32)
                for mark in marks or ():
                    for i in range(mark["mask"].bit_length()):
                        if mark["mask"] >> i & 1:
                            edge[mark["lo"] + i] += 1
                            edge[mark["lo"] + i + window] -= 1
                drop = np.cumsum(edge[:-1]) > 0
                gone.append(int(drop.sum()))
                kept = [w for w, d in zip(words, drop.tolist(), strict=True) if not d] if gone[-1] else words
                texts.append(None if text is None else b" ".join(kept).decode("utf-8", "surrogatepass"))
            columns = [pa.array(texts, pa.string()) if i == text_at else c for i, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64())], [*batch.schema.names[:-1], "n_words", "n_removed"])

    return run


def remove_repeats(df: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Drop every word covered by a ``window``-word sequence that starts at two or more places.

    1. Every text yields its anchors (about one for 14 words), the windows each stands for and
       a hash of that segment. Equal windows share an anchor, so windows of anchors that occur
       once in the corpus are unique and go no further.
    2. Equal segments collapse to one with a count; such a segment repeats as a whole. Where a
       repeated anchor has no other segment, that is all.
    3. The others are dealt by anchor to shards of about 8,000 segments. Each shard builds an
       FM-index of its segments and streams their windows through it; the matching statistics
       give the windows that stand at two places and more. The windows of an anchor with more
       than 4,000 distinct segments are collapsed by their hashes first; those that stand once
       go no further, one of each other kind is laid down twice and dealt by its own hash, so
       that no anchor or window is a task. Both come from one cut: the texts are shuffled once
       for it, however many anchors are hot, and once more for the marks.
    4. The marks go back to their rows, and the words they cover are dropped.

    Windows are judged on the input, by hashes: 64 bits a word, 128 bits (anchor and segment) a
    segment, 96 bits (id and text) a row. The window is a multiple of five words from 10 to 60.
    Returns the columns of ``df`` with the text replaced by its kept words, joined by one space
    (null stays null), and n_words, n_removed (which replace columns of these names; all other
    names may be any). Texts of fewer words than the window lose nothing; repeated rows count as
    repeats of each other; an empty table gives no rows.
    """
    _check(window)
    df = df.drop("n_words", "n_removed")
    row, check = F.xxhash64(F.col(id_col), F.col(text_col)), F.hash(F.col(text_col), F.col(id_col))
    texts = df.select(row.alias("row"), check.alias("check"), F.col(text_col).alias("text"))
    with shared.table(texts.mapInArrow(_find(window), "row long, check int, lo int, n int, anchor long, segment long")) as found:
        # a stage of its own, so that a join's hot keys can be split at run time; so below
        twice = _stage(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("anchor"))
        repeated = _stage(found.join(twice.hint("merge"), "anchor", "left_semi"))  # alike at every size
    segments = repeated.groupBy("anchor", "segment").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("row", "check", "lo", "n")).alias("one"))
    segments = _stage(segments)
    kinds = _stage(segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"))
    whole = segments.where("times > 1").select("anchor", "segment", F.lit(-1).cast("long").alias("mask"))

    twins = _stage(repeated.where("lo = 0").groupBy("row", "check").agg(F.count(F.lit(1)).alias("times")).where("times > 1").drop("times"))
    one_each = texts
    if twins.take(1):  # of rows with equal id and text, one is indexed
        one_each = texts.join(twins, ["row", "check"], "left_anti").unionByName(texts.join(twins, ["row", "check"], "left_semi").dropDuplicates(["row", "check"]))

    tally = kinds.agg(F.coalesce(F.sum(F.when(F.col("kinds") <= HOT, F.col("kinds"))), F.lit(0)), F.coalesce(F.max("kinds") > HOT, F.lit(False))).first()
    one = F.struct(F.col("one.lo").alias("lo"), F.col("one.n").alias("n"), "anchor", "segment", (F.col("kinds") > HOT).alias("hot"))
    wanted = segments.join(kinds.hint("merge"), "anchor").groupBy(F.col("one.row").alias("row"), F.col("one.check").alias("check")).agg(F.collect_list(one).alias("wanted"))
    # the only shuffle of the texts before the marks go back: all that follows comes from the word hashes
    cut = one_each.join(wanted, ["row", "check"]).select("text", "wanted")
    cut = _stage(cut.mapInArrow(_segments(window), "anchor long, segment long, hot boolean, n int, copies int, words binary"))

    def searched(rows: DataFrame, n: int, by: str) -> DataFrame:
        return rows.repartition(max(1, -(-n // SHARD)), by).mapInArrow(_search(window), "anchor long, segment long, mask long").where("mask <> 0")

    marks = searched(cut.where("not hot").drop("hot"), tally[0], "anchor").unionByName(whole)
    if tally[1]:
        hot = cut.where("hot").select("anchor", "segment", "n", "words")
        windows = _stage(hot.mapInArrow(_windows(window), "anchor long, segment long, key long, at int"))  # hashes only
        once = windows.groupBy("anchor", "key").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("segment", "at")).alias("first")).where("times > 1")
        once = _stage(once.select("anchor", "key", F.col("first.segment").alias("segment"), F.col("first.at").alias("at")))
        lone = once.join(hot, ["anchor", "segment"]).select("anchor", F.col("key").alias("segment"), F.lit(1).alias("n"), F.lit(2).alias("copies"), F.expr(f"substring(words, 8 * at + 1, {8 * window})").alias("words"))
        again = _stage(searched(lone, once.count(), "segment").select("anchor", F.col("segment").alias("key")))
        bits = windows.join(again, ["anchor", "key"]).select("anchor", "segment", F.expr("shiftleft(1L, at)").alias("mask"))
        marks = marks.unionByName(bits)
    marks = _stage(marks.groupBy("anchor", "segment").agg(F.bit_or("mask").alias("mask")))
    full, marked, key = F.expr("shiftleft(1L, n) - 1"), shared.fresh(df, "marks"), [shared.fresh(df, "row"), shared.fresh(df, "check")]
    on_row = repeated.join(marks.hint("merge"), ["anchor", "segment"]).groupBy("row", "check", "lo").agg(F.bit_or(F.col("mask").bitwiseAND(full)).alias("mask"))
    on_row = on_row.groupBy(F.col("row").alias(key[0]), F.col("check").alias(key[1])).agg(F.collect_list(F.struct("lo", "mask")).alias(marked))
    out = df.withColumns(dict(zip(key, (row, check), strict=True))).join(on_row, key, "left").drop(*key)
    schema = T.StructType([*df.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    return out.select(*df.columns, marked).mapInArrow(_remove(window, df.columns.index(text_col)), schema)
