"""k-anonymity of every combination of generalisation levels, from one aggregate."""

from __future__ import annotations

from itertools import product

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lattice(df: DataFrame, hierarchies: dict[str, list[str]], k: int, most_at_risk: int = 0) -> DataFrame:
    """A row for each combination of levels of the quasi-identifiers, and whether it is safe.

    ``hierarchies`` names for each quasi-identifier its columns from fine to coarse; each must
    follow from the one before. Level i is the i-th column; the last level leaves the
    quasi-identifier out, so every subset is among the combinations. A combination is safe if
    at most ``most_at_risk`` rows are in classes of fewer than ``k``; then all coarser ones are.

    The rows are counted once, at the finest level. Combinations are tried from fine to coarse,
    all of one rank (sum of levels) in one aggregate over the finest counts; those that are
    coarser than a safe one are not tried. Returns NAME_level for each quasi-identifier,
    min_class, n_classes, at_risk (null where not tried), safe, and minimal (safe, and
    nothing finer is). Null is a value like others; of an empty table all is safe. The number of combinations, not of rows, is what the driver sees.
    """
    if not hierarchies or not all(hierarchies.values()):
        raise ValueError("every quasi-identifier needs a column")
    names, columns = list(hierarchies), [c for h in hierarchies.values() for c in h]
    finest = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).persist(StorageLevel.MEMORY_AND_DISK)
    nodes = sorted(product(*(range(len(h) + 1) for h in hierarchies.values())), key=lambda v: (sum(v), v))
    verdicts: dict[tuple[int, ...], tuple] = {}
    try:
        for rank in range(sum(len(h) for h in hierarchies.values()) + 1):
            tried = []
            for node in (v for v in nodes if sum(v) == rank):
                finer = [(*node[:i], level - 1, *node[i + 1 :]) for i, level in enumerate(node) if level]
                if any(verdicts[f][3] for f in finer):
                    verdicts[node] = (None, None, None, True, False)
                else:
                    tried.append(node)
            if tried:
                verdicts |= _tried(finest, hierarchies, tried, k, most_at_risk)
    finally:
        finest.unpersist()
    schema = ", ".join([f"{n}_level int" for n in names] + ["min_class long", "n_classes long", "at_risk long", "safe boolean", "minimal boolean"])
    return df.sparkSession.createDataFrame([(*v, *verdicts[v]) for v in nodes], schema)


def _tried(finest: DataFrame, hierarchies: dict[str, list[str]], nodes: list[tuple[int, ...]], k: int, most: int) -> dict:
    """Verdicts of combinations of one rank."""

    def at(i: int, node: tuple[int, ...]):
        values = [
            (F.col(f"`{h[level]}`").cast("string") if level < len(h) else F.lit(None).cast("string")).alias(f"v{j}")
            for j, (h, level) in enumerate(zip(hierarchies.values(), node, strict=True))
        ]
        return F.struct(F.lit(i).alias("node"), *values)

    rows = finest.select("_n", F.inline(F.array(*(at(i, node) for i, node in enumerate(nodes)))))
    sizes = rows.groupBy("node", *(f"v{j}" for j in range(len(hierarchies)))).agg(F.sum("_n").alias("n"))
    found = sizes.groupBy("node").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("classes"), F.coalesce(F.sum(F.when(F.col("n") < k, F.col("n"))), F.lit(0)).alias("risk")).collect()
    out = {node: (None, 0, 0, True, True) for node in nodes}
    for r in found:
        safe = r["risk"] <= most
        out[nodes[r["node"]]] = (r["least"], r["classes"], r["risk"], safe, safe)
    return out
