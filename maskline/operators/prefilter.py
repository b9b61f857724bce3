"""l-diversity from mergeable sketches: classes that are surely diverse are settled without their values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import risk

WORD = 64  # bits of a sketch's word


def words_for(l: int) -> int:  # noqa: E741
    """Words of a sketch that leave few classes of twice ``l`` values doubtful: eight bits for each value asked for."""
    return max(1, -(-8 * l // WORD))


def sketches(df: DataFrame, qis: list[str], sensitive: str, words: int) -> DataFrame:
    """A sketch of each class's sensitive values: a bit for each value's hash, null's included, in ``words`` numbers; and the class size.

    Sketches of parts merge by ``merged``: bits by or, sizes by sum.
    """
    place = F.pmod(F.xxhash64(F.col(sensitive).cast("string"), F.col(sensitive).isNull()), F.lit(WORD * words))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % WORD).cast("int"))
    held = [F.coalesce(F.bit_or(F.when(F.floor(place / WORD) == i, bit)), F.lit(0).cast("long")).alias(f"_bits{i}") for i in range(words)]
    return df.groupBy(*risk._some(qis)).agg(F.count(F.lit(1)).alias("class_size"), *held)


def merged(parts: DataFrame, qis: list[str]) -> DataFrame:
    """Sketches of parts of a table (days, batches, shards) as sketches of the whole."""
    bits = [c for c in parts.columns if c.startswith("_bits") and c not in qis]
    return parts.groupBy(*risk._some(qis)).agg(F.sum("class_size").alias("class_size"), *(F.bit_or(c).alias(c) for c in bits))


def at_least(sketch: DataFrame, qis: list[str]) -> Column:
    """A lower bound of a class's distinct values: different bits come from different values, so it never says too much."""
    return reduce(lambda a, b: a + b, (F.bit_count(c) for c in sketch.columns if c.startswith("_bits") and c not in qis))


def l_diversity(df: DataFrame, qis: list[str], sensitive: str, l: int, sketch: DataFrame | None = None) -> DataFrame:  # noqa: E741
    """The exact verdict on ``l`` in two passes: sketches of all classes, then the values of the doubtful ones only.

    The first pass shuffles one row of a few numbers for each class and task, whatever the number
    of values; the second reads rows of classes whose bound is below ``l`` (null-safe semi join).
    ``sketch`` gives stored sketches of the same rows. Returns one row: n_classes, doubtful_classes,
    violating_classes, violating_rows, passes; and ``l``, the fewest values of a class, where the
    table fails (null where it passes: it is ``l`` or more). An empty table has no classes and
    fails with 0, as in the exact measure.
    """
    if l < 1:
        raise ValueError("l must be 1 or more")
    sketch = sketches(df, qis, sensitive, words_for(l)) if sketch is None else sketch
    sure = at_least(sketch, qis) >= l
    sides = sketch.agg(F.count(F.lit(1)).alias("n_classes"), F.count_if(~sure).alias("doubtful_classes"))
    doubtful = sketch.where(~sure).select(*(F.col(f"`{c}`").alias(f"_d{i}") for i, c in enumerate(qis)))
    same = reduce(lambda a, b: a & b, (F.col(f"`{c}`").eqNullSafe(F.col(f"_d{i}")) for i, c in enumerate(qis)))
    small = F.col("n_values") < l
    exact = risk.diversity(df.join(doubtful, same, "left_semi"), qis, sensitive).where(small).agg(
        F.min("n_values").cast("long").alias("l"), F.count(F.lit(1)).alias("violating_classes"), F.coalesce(F.sum("class_size"), F.lit(0)).cast("long").alias("violating_rows"),
    )
    fails = (F.col("violating_classes") > 0) | (F.col("n_classes") == 0)
    return sides.crossJoin(exact).select(
        F.when(F.col("n_classes") == 0, F.lit(0).cast("long")).otherwise(F.col("l")).alias("l"), "n_classes", "doubtful_classes", "violating_classes", "violating_rows", (~fails).alias("passes")
    )
