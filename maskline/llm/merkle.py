"""A Merkle manifest of a table: stored levels of parent-linked nodes, and a recursive climb from each leaf."""

from __future__ import annotations

import contextlib
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import shared

FAN = 3  # nodes that become one
LEVELS, TOP = 128, 64  # a node's number is its first leaf times 128, plus its level; levels of the tree of subroots start at 64
HEAVY, HEAVY_LEAVES = 2_000, 729  # a node is heavy if more than a 2,000th of all leaves, and more than 729, are below it
HEAVY_PARTS = 8  # partitions of the heavy nodes
BUCKET_LEAVES = 200_000  # leaves for each bucket of the node table, beyond as many buckets as shuffle partitions
_LEAF_BYTES = 100


def sha(*parts: Column) -> Column:
    """SHA-256 of concatenated inputs, as 32 bytes; digests go in as hex text."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def shown(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves_of(df: DataFrame, columns: list[str], group: str, order: str, text: str) -> DataFrame:
    """A row for each row of ``df``: its group, its order, its leaf, and the leaf after the tampering.

    Tampering deletes the line breaks of the text where the checksum of the decimal order key is even.
    """
    tampered = F.coalesce(F.crc32(F.col(order).cast("string")) % 2 == 0, F.lit(False)) & F.coalesce(F.contains(F.col(text), F.lit("\n")), F.lit(False))
    without = [F.translate(F.col(c), "\n", "") if c == text else F.col(c) for c in columns]
    return df.select(
        F.col(order).cast("long").alias("doc_id"),
        F.col(group).cast("string").alias("source"),
        sha(*(framed(F.col(c)) for c in columns)).alias("leaf"),
        F.when(tampered, sha(*(framed(c) for c in without))).alias("tampered"),
    )


def placed(rows: DataFrame, range_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Each leaf's place in its group and each group's place among all, both from range totals.

    Returns the leaves with their range, group's number, size and first place, and own index in
    it; and a row for each range and group. Rows are cut into ranges in the order of group,
    id and leaf, so a group of any size spreads over ranges, and no task sees more than one.
    """
    rows = rows.withColumn("tie", F.xxhash64("leaf"))
    cut = shared.ranges(rows, [F.col("source"), F.col("doc_id"), F.col("tie")], F.lit(_LEAF_BYTES), range_bytes)
    rows = shared.stage(rows.withColumn("where", cut.index()))
    inside = Window.partitionBy("where").orderBy("source")
    of_group = Window.partitionBy("source")
    earlier = of_group.orderBy("where").rowsBetween(Window.unboundedPreceding, -1)
    parts = (  # at most as many rows as ranges and groups together
        rows.groupBy("where", "source")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .withColumn("size", F.sum("n").over(of_group))
        .withColumn("begins", (F.col("before") == 0).cast("long"))
        .withColumn("place", F.coalesce(F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("nth", F.sum("begins").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    )
    before = Window.orderBy("where").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # a row for each range
        parts.groupBy("where")
        .agg(F.sum("n").alias("n"), F.sum("begins").alias("groups"))
        .select("where", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("leaves0"), F.coalesce(F.sum("groups").over(before), F.lit(0)).alias("groups0"))
    )
    first = F.col("begins") == 1
    parts = shared.stage(
        parts.join(F.broadcast(offsets), "where")
        .withColumn("base", F.max(F.when(first, F.col("leaves0") + F.col("place"))).over(of_group))
        .withColumn("tree", F.max(F.when(first, F.col("groups0") + F.col("nth"))).over(of_group))
        .select(F.col("where").alias("part"), F.col("source").alias("own"), "before", "size", "base", "tree")
    )
    nth = F.row_number().over(Window.partitionBy("part", "tree").orderBy("doc_id", "tie", "leaf")) - 1
    leaves = rows.join(parts.hint("shuffle_hash"), (F.col("where") == F.col("part")) & F.col("source").eqNullSafe(F.col("own")))
    return shared.stage(leaves.select("part", "tree", "base", "size", (F.col("before") + nth).cast("long").alias("index"), "doc_id", "leaf", "tampered")), parts


def node_key(base: Column, index: Column, level: int, top: bool) -> Column:
    return (base + index * FAN ** level) * LEVELS + (level + (TOP if top else 0))


def built(level: DataFrame, most: int, top: bool, above: Column) -> tuple[list[DataFrame], DataFrame]:
    """Build trees, all at once, a level at a time, from rows (tree, base, n nodes of the level, index, hash, leaves below).

    ``most`` is the largest tree's number of nodes. Each level is one aggregate over runs of
    three, stored. Returns the node rows of each level (key, parent, before, after, the
    leaves below it and below its parent) and the roots (tree, base, hash, weight). A root is no node here: the
    parent of a tree's last nodes is ``above``.
    """
    nodes, roots, k = [], [level.where("n = 1").select("tree", "base", "hash", "weight")], 0
    level = level.where("n > 1")
    while most > 1:
        runs = shared.stage(
            level.groupBy("tree", "base", "n", F.expr(f"index div {FAN}").alias("up"))
            .agg(F.array_sort(F.collect_list(F.struct("index", "hash", "weight"))).alias("kids"))
            .withColumn("n_up", F.expr(f"(n + {FAN - 1}) div {FAN}"))
            .withColumn("weight", F.aggregate("kids", F.lit(0).cast("long"), lambda a, x: a + x["weight"]))
        )
        beside = lambda kid, side: F.array_join(F.transform(F.filter("kids", lambda x: side(x["index"], kid["index"])), lambda x: shown(x["hash"])), "")
        kid = F.col("kid")
        nodes.append(
            runs.select("*", F.explode("kids").alias("kid")).select(
                node_key(F.col("base"), kid["index"], k, top).alias("key"),
                F.when(F.col("n_up") > 1, node_key(F.col("base"), F.col("up"), k + 1, top)).otherwise(above).alias("parent"),
                F.unhex(beside(kid, lambda a, b: a < b)).alias("before"),
                F.unhex(beside(kid, lambda a, b: a > b)).alias("after"),
                kid["weight"].alias("weight"),
                F.col("weight").alias("parent_weight"),
            )
        )
        up = runs.select("tree", "base", F.col("n_up").alias("n"), F.col("up").alias("index"), sha(F.array_join(F.transform("kids", lambda x: shown(x["hash"])), "")).alias("hash"), "weight")
        roots.append(up.where("n = 1").select("tree", "base", "hash", "weight"))
        level, most, k = up.where("n > 1"), -(-most // FAN), k + 1
    return nodes, reduce(DataFrame.unionByName, roots)


_FOLDED = "unhex(sha2(concat(lower(hex(n.before)), lower(hex(c.fold)), lower(hex(n.after))), 256))"
_IN_ORDER = "array_join(transform(array_sort(collect_list(struct(step, beside))), x -> lower(hex(x.beside))), '')"

# From each leaf through the light nodes: where it ends, what it has folded to, what stood beside its path.
BELOW = f"""
WITH RECURSIVE climb(leaf, at, more, step, fold, beside) AS (
  SELECT leaf, at, at IS NOT NULL, 0, fold, X'' FROM {{starts}}
  UNION ALL
  SELECT /*+ SHUFFLE_HASH(n) */ c.leaf, n.parent, n.more, c.step + 1, {_FOLDED}, concat(n.before, n.after)
  FROM climb c JOIN {{light}} n ON c.at = n.key)
SELECT leaf, max(if(more, NULL, at)) AS at, max(if(more, NULL, fold)) AS fold, {_IN_ORDER} AS beside
FROM climb GROUP BY leaf"""

# What stands beside the path from each heavy node to the root.
PATHS = f"""
WITH RECURSIVE path(entry, at, step, beside) AS (
  SELECT key, key, 0, X'' FROM {{heavy}}
  UNION ALL
  SELECT /*+ BROADCAST(n) */ p.entry, n.parent, p.step + 1, concat(n.before, n.after)
  FROM path p JOIN {{heavy}} n ON p.at = n.key)
SELECT entry, {_IN_ORDER} AS above FROM path GROUP BY entry"""

# From where each leaf left the light nodes, on to the root.
ABOVE = f"""
WITH RECURSIVE climb(leaf, at, fold, proof) AS (
  SELECT leaf, at, fold, proof FROM {{starts}}
  UNION ALL
  SELECT /*+ BROADCAST(n) */ c.leaf, n.parent, {_FOLDED}, c.proof
  FROM climb c JOIN {{heavy}} n ON c.at = n.key)
SELECT leaf AS climbed, fold, proof FROM climb WHERE at IS NULL"""


@contextlib.contextmanager
def unbounded(spark: SparkSession):
    """No bound on the rows of recursive queries, for the length of a ``with`` block."""
    limit = "spark.sql.cteRecursionRowLimit"
    held = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        yield
    finally:
        spark.conf.unset(limit) if held is None else spark.conf.set(limit, held)


def manifest(df: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "source", order: str = "doc_id", text: str = "text", range_bytes: int = shared.RANGE_BYTES) -> DataFrame:
    """Digests of a table's rows, groups and whole, the proof of each row, and what a tampered row folds to.

    A leaf is the digest of a row's framed columns. In each group leaves ascend by ``order``
    (nulls first; rows of one key by their leaf) and every three consecutive nodes become one
    until one is left, the subroot; subroots in the order of their groups (null first,
    bytewise) likewise give the root. All levels are stored as rows linked to their parent, with
    the digests beside them. A recursive query ascends from each leaf, appending the digests beside
    it and folding the tampered leaf (the original one where nothing is tampered).

    The climb has two parts, so that no key is hot. Nodes with few leaves below them are joined
    by key, in a table bucketed by it, so only the climbing rows are shuffled. Heavy nodes (more
    than a 2,000th of all leaves below them, so at most 2,000 in a level, some 40,000 in all)
    are broadcast, and rows climb on where they are; what stands beside the path above is found once for each heavy node.

    Returns doc_id, leaf, subroot, root, proof_sha256 (of the digests beside the path, hex,
    level by level and left to right), folded_root and verified (it equals the root). Nulls of
    any column are framed as ``-``, empty texts as ``0:``; equal rows have equal leaves and
    places of their own; a lone leaf is its subroot, a lone subroot the root, with a proof of nothing;
    an empty table gives no rows; columns that are not named are not read. Texts of any length are hashed whole.
    """
    spark, root_dir = df.sparkSession, shared.shared_dir(df.sparkSession)
    leaves, parts = placed(leaves_of(df, list(columns), group, order, text), range_bytes)
    seen = leaves.agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("most"), (F.max("tree") + 1).alias("trees")).first()
    n, trees = seen["n"], seen["trees"] or 0
    bound = max(HEAVY_LEAVES, n // HEAVY)
    nothing = F.lit(None).cast("long")
    top_leaf = node_key(F.lit(0), F.col("tree"), 0, True) if trees > 1 else nothing
    low, roots = built(leaves.select("tree", "base", F.col("size").alias("n"), "index", F.col("leaf").alias("hash"), F.lit(1).cast("long").alias("weight")), seen["most"] or 0, False, top_leaf)
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))  # unions of levels have as many partitions as all of them
    roots = shared.stage(roots.coalesce(few))
    over = roots.select(F.lit(0).alias("tree"), F.lit(0).cast("long").alias("base"), F.lit(trees).cast("long").alias("n"), F.col("tree").alias("index"), "hash", "weight")
    high, whole = built(over, trees, True, nothing)
    root = whole.select("hash").first()
    root = bytes(root[0]) if root else b""
    parts_of = parts.join(roots.select("tree", F.col("hash").alias("subroot")).hint("shuffle_hash"), "tree")

    nodes = [*low, *high]
    stored = reduce(DataFrame.unionByName, nodes).coalesce(few) if nodes else spark.createDataFrame([], "key long, parent long, before binary, after binary, weight long, parent_weight long")
    where = f"{root_dir}/nodes-{uuid.uuid4().hex}"
    light, heavy, begun = (f"{name}_{uuid.uuid4().hex}" for name in ("light", "heavy", "starts"))
    buckets = max(few, n // BUCKET_LEAVES)
    placed_leaves = leaves.join(parts_of.select("part", "tree", "subroot").hint("shuffle_hash"), ["part", "tree"])
    place = F.col("base") + F.col("index")
    starts = leaves.select(
        place.alias("leaf"),
        F.when(F.col("size") > 1, node_key(F.col("base"), F.col("index"), 0, False)).otherwise(top_leaf).alias("at"),
        F.coalesce("tampered", "leaf").alias("fold"),
    )
    try:
        lit = stored.where(F.col("weight") <= bound).withColumn("more", F.col("parent").isNotNull() & (F.col("parent_weight") <= bound))
        lit.drop("weight", "parent_weight").repartition(buckets, "key").write.bucketBy(buckets, "key").option("path", where).saveAsTable(light)
        shared.stage(stored.where(F.col("weight") > bound).select("key", "parent", "before", "after").repartition(HEAVY_PARTS)).createOrReplaceTempView(heavy)
        starts.createOrReplaceTempView(begun)
        with unbounded(spark):
            paths = spark.sql(PATHS.format(heavy=heavy))
            below = spark.sql(BELOW.format(starts=begun, light=light)).join(F.broadcast(paths), F.col("at") == F.col("entry"), "left")
            proof = F.unhex(F.sha2(F.concat("beside", F.coalesce("above", F.lit(""))), 256)).alias("proof")
            shared.stage(below.select("leaf", "at", "fold", proof)).createOrReplaceTempView(begun)
            ends = shared.stage(spark.sql(ABOVE.format(starts=begun, heavy=heavy)).coalesce(few))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {light}")
        spark.catalog.dropTempView(heavy)
        spark.catalog.dropTempView(begun)
        shared.delete(spark, where)
    return (
        placed_leaves.select(place.alias("place"), "doc_id", F.col("leaf").alias("own"), "subroot")
        .join(ends, F.col("place") == F.col("climbed"))
        .select(
            "doc_id",
            shown(F.col("own")).alias("leaf"),
            shown(F.col("subroot")).alias("subroot"),
            F.lit(root.hex()).alias("root"),
            shown(F.col("proof")).alias("proof_sha256"),
            shown(F.col("fold")).alias("folded_root"),
            (F.col("fold") == F.lit(root)).alias("verified"),
        )
    )
