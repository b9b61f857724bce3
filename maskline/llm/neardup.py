"""Near-duplicate classes: circulant MinHash, banding, exact verification, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

BANDS, ROWS = 38, 6  # a pair at similarity 0.8 misses all 38 bands with probability 1e-5
UNIVERSE = 1 << 20
BLOCK = 512  # members of a bucket that are compared with as many others at a time
LIKELY = 0.68  # agreeing coordinates of a pair, 4.5 standard errors below 0.8
_made: dict[str, np.ndarray] = {}


def _stage(df: DataFrame) -> DataFrame:
    return shared.stage(df, free=True)


def permutations() -> tuple[np.ndarray, np.ndarray]:
    """The two permutations: the first scatters shingles, the second gives all coordinates.

    Coordinate j reads the second one shifted by j, so the values of all coordinates for an
    element are one contiguous slice of it. It is kept with its head repeated, for the circle.
    """
    if not _made:
        rng = np.random.default_rng(7)
        _made["first"] = rng.permutation(UNIVERSE).astype(np.int64)
        second = rng.permutation(UNIVERSE).astype(np.uint32)
        _made["second"] = np.lib.stride_tricks.sliding_window_view(np.concatenate([second, second[: BANDS * ROWS]]), BANDS * ROWS)
    return _made["first"], _made["second"]


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's k-word shingles.

    A-Z are lower-cased; a text of fewer than k words has its whole sequence as its one
    shingle (of its own length, so it equals no longer one); no words, no shingles.
    """
    words, bounds = shared.word_hashes(texts, lower=True)
    grams = shared.gram_hashes(words, k)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if 0 < b - a < k:
            yield shared.gram_hashes(words[a:b], b - a) + np.uint64(b - a)
        else:
            yield np.unique(grams[a : max(a, b - k + 1)])


def bands_of(shingles: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The 64-bit key of each band of a set's circulant MinHash signature, and a byte of each coordinate."""
    first, second = permutations()
    at = first[(shingles & np.uint64(UNIVERSE - 1)).astype(np.int64)]
    signature = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(at), 4096):
        np.minimum(signature, second[at[i : i + 4096]].min(axis=0), out=signature)
    grid = signature.reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(ROWS):
        keys = shared.mix(keys ^ grid[:, j])
    return keys.view(np.int64), signature.astype(np.uint8).tobytes()


def _sketch(k: int):
    @shared.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in shared.slices(whole, 1, shared.FEW)):
            sizes, left, right, bands, minis = [], [], [], [], []
            for s in shingle_sets(batch.column(1), k):
                sizes.append(len(s))
                digest = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
                left.append(digest[0])
                right.append(digest[1])
                keys, mini = bands_of(s) if len(s) else (np.empty(0, np.int64), b"")
                bands.append(keys)
                minis.append(mini)
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(left, pa.int64()), pa.array(right, pa.int64())]
            offsets = pa.array(np.cumsum([0, *map(len, bands)]), pa.int32())
            yield pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int64), *bands]))), pa.array(minis, pa.binary())], ["doc_id", "n_shingles", "c1", "c2", "bands", "mini"])

    return run


def _sets(k: int):
    @shared.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in shared.slices(whole, 1, shared.FEW)):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in shingle_sets(batch.column(1), k)], pa.binary())], ["node", "shingles"])

    return run


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have a Jaccard similarity of ``percent`` or more."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify(percent: int):
    @shared.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("mine"), batch.column("theirs"), strict=True)
            keep = [similar(*(np.frombuffer(x.as_py(), np.uint64) for x in pair), percent) for pair in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _by_key(handle, names: list[str]):
    """Hand the rows of each (band, i, j), which come sorted by it, to ``handle``; at most two blocks at a time."""

    @shared.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in handle(held)], names)

        for got in batches:
            for row in zip(*(c.to_pylist() for c in got.columns), strict=True):
                if held and row[:3] != held[0][:3]:
                    if len(held) > 1:
                        yield flush()
                    held = []
                held.append(row)
        if len(held) > 1:
            yield flush()

    return run


def _alike(rows: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of a block pair with different labels whose signatures agree often enough to reach the similarity: row numbers and agreement."""
    own, label = (np.array([r[c] for r in rows]) for c in (3, 5))
    mini = np.frombuffer(b"".join(r[6] for r in rows), np.uint8).reshape(len(rows), -1)
    left, right = np.flatnonzero(own == rows[0][1]), np.flatnonzero(own == rows[0][2])
    for at in np.array_split(left, max(1, -(-len(left) // 64))):
        agree = (mini[at][:, None] == mini[right][None]).sum(axis=2, dtype=np.int16)
        apart = np.less if rows[0][1] == rows[0][2] else np.not_equal  # within a block, each pair once
        x, y = np.nonzero((agree >= LIKELY * mini.shape[1]) & apart(label[at][:, None], label[right][None]))
        yield at[x], right[y], agree[x, y]


def _likeliest(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """For each two labels that meet in a block pair, the pair of nodes whose signatures agree most."""
    node, label = (np.array([r[c] for r in rows]) for c in (4, 5))
    x, y, agree = (np.concatenate(c) for c in zip(*_alike(rows), strict=True))
    low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
    order = np.lexsort((agree, high, low))
    best = order[np.flatnonzero(np.append((np.diff(low[order]) != 0) | (np.diff(high[order]) != 0), True))] if len(order) else order
    return np.maximum(node[x[best]], node[y[best]]), np.minimum(node[x[best]], node[y[best]])


def _still_alike(rows: list[tuple]) -> tuple[list[int], ...]:
    """Rows of a block pair that have a likely partner of another label: band, i, j, block, node, label."""
    hit = sorted({r for x, y, _ in _alike(rows) for r in (*x.tolist(), *y.tolist())})
    return tuple([rows[r][c] for r in hit] for c in range(6))


def _linked(percent: int):
    """One confirmed link for each two labels that a block pair joins."""

    def links(rows: list[tuple]) -> tuple[list[int], list[int]]:
        sets = [np.frombuffer(r[7], np.uint64) for r in rows]
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for x, y, _ in _alike(rows):
            for a, b in zip(x.tolist(), y.tolist(), strict=True):
                key = (min(rows[a][5], rows[b][5]), max(rows[a][5], rows[b][5]))
                if key not in found and similar(sets[a], sets[b], percent):
                    found[key] = (max(rows[a][4], rows[b][4]), min(rows[a][4], rows[b][4]))
        return [u for u, _ in found.values()], [v for _, v in found.values()]

    return links


def _blocks(members: DataFrame) -> DataFrame:
    """Deal the members (band, node, label, mini) of buckets of several labels to pairs of blocks: band, i, j, block, node, label, mini.

    A label with half a block of members and more in a bucket has blocks of its own, dealt by a
    hash; the others share blocks. Blocks of one and the same label never meet, so a large class
    costs its bucket a share for each block of other labels, not for each of its own. Counts by
    (band, label) decide; no task sorts a bucket.
    """
    counts = members.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"))
    counts = _stage(counts)
    mixed = counts.groupBy("band").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.sum(F.when(F.col("n") < BLOCK // 2, F.col("n")).otherwise(0)).alias("few")).where("a < b")
    own = counts.where(F.col("n") >= BLOCK // 2).groupBy("band").agg(F.sort_array(F.collect_list(F.struct("label", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))).alias("own"))
    plan = mixed.join(own, "band", "left").select("band", F.ceil(F.col("few") / BLOCK).cast("int").alias("pool"), F.coalesce("own", F.array().cast("array<struct<label:bigint,blocks:int>>")).alias("own"))
    held = members.join(_stage(plan), "band")
    at = F.array_position(F.transform("own", lambda o: o["label"]), F.col("label")).cast("int")  # 0: in the pool
    base = F.aggregate(F.slice("own", 1, F.greatest(F.col("at") - 1, F.lit(0))), F.col("pool"), lambda t, o: t + o["blocks"])
    size = F.when(F.col("at") > 0, F.try_element_at("own", F.greatest(F.col("at"), F.lit(1)))["blocks"]).otherwise(F.col("pool"))
    held = held.withColumn("at", at).withColumn("base", F.when(F.col("at") > 0, base).otherwise(0)).withColumn("size", size)
    held = held.withColumn("block", F.col("base") + F.pmod(F.xxhash64("node"), F.col("size")).cast("int"))
    total = F.aggregate("own", F.col("pool"), lambda t, o: t + o["blocks"])
    every = F.sequence(F.lit(0), total - 1)
    met = F.when(F.col("at") > 0, F.filter(every, lambda b: (b < F.col("base")) | (b >= F.col("base") + F.col("size")))).otherwise(every)
    dealt = held.withColumn("other", F.explode(met)).select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "label", "mini")
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, "band", "i", "j").sortWithinPartitions("band", "i", "j")


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable over edges (u, v): columns node, label, a row for each node of an edge.

    Every node has a label, at first the least of itself and its neighbours. In each round every
    edge offers the label's label of one end to the other end and to that end's label, so whole
    groups are joined at once, and labels are replaced by their own labels, so paths shorten by
    half. The rounds grow with the logarithm of the longest path (a path of 400 nodes in mixed
    order takes about ten); each is checkpointed.
    """
    both = _stage(edges.select("u", "v").union(edges.select("v", "u")).distinct())
    labels = _stage(both.groupBy(F.col("u").alias("node")).agg(F.least(F.first("u"), F.min("v")).alias("label")))
    while True:
        own = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        held = labels.join(own, "label").select("node", "label", "beyond")
        near = both.join(held.select(F.col("node").alias("v"), "beyond"), "v").groupBy(F.col("u").alias("node")).agg(F.min("beyond").alias("near"))
        held = held.join(near, "node")
        hooks = held.groupBy("label").agg(F.min("near").alias("hook")).withColumnRenamed("label", "node")
        new = _stage(held.join(hooks, "node", "left").select("node", F.col("label").alias("was"), F.least("label", "beyond", "near", "hook").alias("label")))
        if not new.where("was <> label").take(1):
            return new.select("node", "label")
        labels = new.select("node", "label")


def near_duplicates(df: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group documents whose k-word shingle sets have a Jaccard similarity of ``percent`` or more.

    1. Each text gives its set's size, a 128-bit digest and the band keys of its signature.
    2. Texts with equal sets form a class with one node, its smallest id; only nodes go on.
    3. In every band bucket the node with most companions leads; it is paired with the others
       (a star, never all pairs), pairs are confirmed on the full sets, components are formed.
    4. Where a bucket's members still lie in different components, they are compared in blocks
       of about 512 by one byte of each coordinate (see ``_blocks``). For each two components
       that meet there, the likeliest pair is confirmed on the full sets; that joins nearly all
       that belong together, and components are formed again.
    5. What is still apart meets once more; rows with a likely partner in another component
       are given their full sets, and pairs are confirmed there until the two are joined or
       shown to be too far apart. No list of pairs is written, and full sets go to these rows only.

    Returns doc_id, n_shingles, component_id, kept. Texts without words have no shingles, link
    with nothing and are kept. Rows without an id are kept with a null component. Rows with one
    id are one document: they share a component and are all kept or not. Other columns of ``df``
    are not read; an empty table gives no rows.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sketch = _stage(docs.mapInArrow(_sketch(k), "doc_id long, n_shingles long, c1 long, c2 long, bands array<long>, mini binary"))
    members = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = members.groupBy("c1", "c2").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("mini").alias("mini"))
    spread = _stage(classes.select("node", F.explode("bands").alias("band")))
    sizes = _stage(spread.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))  # so that a hot band's rows can be split
    full = _stage(spread.join(sizes, "band"))  # buckets of two and more
    central = full.groupBy("node").agg(F.sum("size").alias("score"))
    shared_bands = _stage(full.join(central, "node").select("band", "node", F.struct("score", (-F.col("node")).alias("less")).alias("place")))

    involved = shared_bands.select("node").distinct()
    sets = _stage(docs.join(involved, docs.doc_id == involved.node, "left_semi").mapInArrow(_sets(k), "node long, shingles binary"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        mine = sets.select(F.col("node").alias("u"), F.col("shingles").alias("mine"))
        theirs = sets.select(F.col("node").alias("v"), F.col("shingles").alias("theirs"))
        return _stage(pairs.join(mine, "u").join(theirs, "v").mapInArrow(_verify(percent), "u long, v long"))

    leaders = _stage(shared_bands.groupBy("band").agg(F.max("place").alias("top")).select("band", (-F.col("top.less")).alias("leader")))
    led = _stage(shared_bands.join(leaders, "band").where("node <> leader"))
    edges = confirmed(led.select(F.greatest("node", "leader").alias("u"), F.least("node", "leader").alias("v")).distinct())
    labels = components(edges)

    signs = classes.select("node", "mini")

    def unlike() -> DataFrame:
        """Members of the buckets, as they are labelled now, dealt to pairs of blocks."""
        now = shared_bands.select("band", "node").join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
        torn = _stage(now.groupBy("band").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a < b").select("band"))
        return _blocks(_stage(now.join(torn, "band", "left_semi").join(signs, "node")))

    likely = _stage(unlike().mapInArrow(_by_key(_likeliest, ["u", "v"]), "u long, v long").distinct())
    edges = _stage(edges.unionByName(confirmed(likely)))
    labels = components(edges)
    rows = ["band", "i", "j", "block", "node", "label"]
    dealt = unlike()
    rest = _stage(dealt.mapInArrow(_by_key(_still_alike, rows), ", ".join(f"{c} long" for c in rows)))
    if rest.take(1):
        rest = rest.join(signs, "node").join(sets, "node").select(*rows, "mini", "shingles")
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rest = rest.repartition(parts, "band", "i", "j").sortWithinPartitions("band", "i", "j")
        links = _stage(rest.mapInArrow(_by_key(_linked(percent), ["u", "v"]), "u long, v long").distinct())
        labels = components(edges.unionByName(links))

    of_class = classes.select("c1", "c2", "node").join(labels, "node", "left").select("c1", "c2", F.coalesce("label", "node").alias("component"))
    return (
        sketch.join(of_class, ["c1", "c2"], "left")
        .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")))
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )
