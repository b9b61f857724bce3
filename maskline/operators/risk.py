"""Disclosure risk on full tables: k-anonymity, l-diversity, t-closeness, enforcement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _some(qis: list[str]) -> list[str]:
    if not qis:
        raise ValueError("at least one quasi-identifier is needed")
    return qis


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda x, y: x & y, (a[c].eqNullSafe(b[c]) for c in columns))


def classes(df: DataFrame, qis: list[str]) -> DataFrame:
    """Equivalence classes and their sizes; null is a value like others."""
    return df.groupBy(*_some(qis)).agg(F.count(F.lit(1)).alias("class_size"))


def k_anonymity(df: DataFrame, qis: list[str], k: int | None = None) -> DataFrame:
    """One row: smallest class, rows, classes, classes and rows under k, verdict (no k: passes)."""
    small = F.col("class_size") < F.lit(k if k is not None else 0)
    return classes(df, qis).agg(
        F.coalesce(F.min("class_size"), F.lit(0)).cast("long").alias("k"),
        F.coalesce(F.sum("class_size"), F.lit(0)).cast("long").alias("n_rows"),
        F.count(F.lit(1)).alias("n_classes"),
        F.count_if(small).alias("violating_classes"),
        F.coalesce(F.sum(F.when(small, F.col("class_size"))), F.lit(0)).cast("long").alias("violating_rows"),
    ).withColumn("passes", F.lit(True) if k is None else F.col("k") >= k)


def histogram(df: DataFrame, qis: list[str]) -> DataFrame:
    return classes(df, qis).groupBy("class_size").agg(F.count(F.lit(1)).alias("n_classes"))


def smallest(df: DataFrame, qis: list[str], top: int = 5) -> DataFrame:
    return classes(df, qis).orderBy("class_size", *(F.col(c).asc_nulls_first() for c in qis)).limit(top)


def diversity(df: DataFrame, qis: list[str], sensitive: str) -> DataFrame:
    """Distinct sensitive values of each class, null counted as one."""
    return df.groupBy(*_some(qis)).agg((F.count_distinct(sensitive) + F.max(F.col(sensitive).isNull().cast("int"))).alias("n_values"), F.count(F.lit(1)).alias("class_size"))


def l_diversity(df: DataFrame, qis: list[str], sensitive: str, l: int | None = None) -> DataFrame:  # noqa: E741
    small = F.col("n_values") < F.lit(l if l is not None else 0)
    return diversity(df, qis, sensitive).agg(
        F.coalesce(F.min("n_values"), F.lit(0)).cast("long").alias("l"),
        F.count(F.lit(1)).alias("n_classes"),
        F.count_if(small).alias("violating_classes"),
        F.coalesce(F.sum(F.when(small, F.col("class_size"))), F.lit(0)).cast("long").alias("violating_rows"),
    ).withColumn("passes", F.lit(True) if l is None else F.col("l") >= l)


def least_diverse(df: DataFrame, qis: list[str], sensitive: str, top: int = 5) -> DataFrame:
    return diversity(df, qis, sensitive).orderBy("n_values", *(F.col(c).asc_nulls_first() for c in qis)).limit(top)


def distances(df: DataFrame, qis: list[str], sensitive: str) -> DataFrame:
    """Total variation between each class's and the table's distribution of the sensitive value.

    Values that a class lacks add what is left of the table's mass, so no class meets a value
    that it doesn't hold: two aggregates and a null-safe join with the value counts.
    """
    cells = df.groupBy(*_some(qis), sensitive).agg(F.count(F.lit(1)).alias("_n"))
    values = cells.groupBy(sensitive).agg(F.sum("_n").alias("_all")).select(F.col(sensitive).alias("_value"), "_all")
    total = cells.agg(F.sum("_n").alias("_total"))
    sizes = cells.groupBy(*qis).agg(F.sum("_n").alias("_size"))
    joined = cells.join(values, cells[sensitive].eqNullSafe(values["_value"])).drop("_value")
    joined = joined.join(sizes.select(*(F.col(c).alias(f"_q{i}") for i, c in enumerate(qis)), "_size"), reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_q{i}")) for i, c in enumerate(qis))))
    joined = joined.crossJoin(F.broadcast(total))  # one row
    p, q = F.col("_n") / F.col("_size"), F.col("_all") / F.col("_total")
    return joined.groupBy(*qis).agg(((F.sum(F.abs(p - q)) + 1 - F.sum(q)) / 2).alias("distance"), F.max("_size").alias("class_size"))


def t_closeness(df: DataFrame, qis: list[str], sensitive: str, t: float | None = None) -> DataFrame:
    far = F.col("distance") > F.lit(float(t) if t is not None else 2.0)
    return distances(df, qis, sensitive).agg(
        F.round(F.coalesce(F.max("distance"), F.lit(0.0)), 9).alias("t"),
        F.count(F.lit(1)).alias("n_classes"),
        F.count_if(far).alias("violating_classes"),
    ).withColumn("passes", F.lit(True) if t is None else F.col("t") <= t)


def most_skewed(df: DataFrame, qis: list[str], sensitive: str, top: int = 5) -> DataFrame:
    ranked = distances(df, qis, sensitive).withColumn("distance", F.round("distance", 9))
    return ranked.orderBy(F.desc("distance"), *(F.col(c).asc_nulls_first() for c in qis)).limit(top)


def enforce_k(df: DataFrame, qis: list[str], k: int, strategy: str = "join") -> DataFrame:
    """Rows of classes of k and more. ``join`` (default) streams past a null-safe semi join with the class
    counts, so a huge class is no single task; ``window`` saves a second read where classes are small."""
    if k < 1:
        raise ValueError("k must be at least 1")
    if strategy == "window":
        return df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*_some(qis)))).where(F.col("_n") >= k).drop("_n")
    large = classes(df, qis).where(F.col("class_size") >= k).select(*qis)
    return df.alias("a").join(large.alias("b"), reduce(lambda x, y: x & y, (F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in qis)), "left_semi")


def suppression_report(df: DataFrame, qis: list[str], k: int) -> DataFrame:
    keep = F.col("class_size") >= k
    out = classes(df, qis).agg(
        F.coalesce(F.sum("class_size"), F.lit(0)).cast("long").alias("rows_in"),
        F.coalesce(F.sum(F.when(keep, F.col("class_size"))), F.lit(0)).cast("long").alias("rows_out"),
        F.count_if(keep).alias("retained_classes"),
        F.count_if(~keep).alias("dropped_classes"),
    )
    lost = F.col("rows_in") - F.col("rows_out")
    return out.withColumn("suppressed", lost).withColumn("rate", F.round(F.coalesce(F.try_divide(lost, "rows_in"), F.lit(0.0)), 6))


def advisory(df: DataFrame, qis: list[str], sensitive: str, k: int, l: int, t: float) -> DataFrame:  # noqa: E741
    """k, l and t over the whole table as rows of a scorecard: check, passed, detail."""
    told = lambda least: F.concat(least, F.lit("; "), F.col("violating_rows").cast("string"), F.lit(" rows in "), F.col("violating_classes").cast("string"), F.lit(" classes"))
    named = lambda name: F.concat(F.lit(f"{name}="), F.col(name).cast("string"))
    on = ", ".join(qis)
    rows = [
        k_anonymity(df, qis, k).select(F.lit(f"k-anonymity of at least {k} on {on}").alias("check"), "passes", told(named("k")).alias("detail")),
        l_diversity(df, qis, sensitive, l).select(F.lit(f"l-diversity of at least {l} for {sensitive}").alias("check"), "passes", told(named("l")).alias("detail")),
        t_closeness(df, qis, sensitive, t).select(
            F.lit(f"t-closeness of at most {t} for {sensitive}").alias("check"), "passes", F.concat(F.lit("t="), F.format_string("%.3f", "t"), F.lit(" over "), F.col("violating_classes").cast("string"), F.lit(" classes")).alias("detail")
        ),
    ]
    return reduce(DataFrame.unionByName, rows).withColumnRenamed("passes", "passed")


def evidence(k: DataFrame | None = None, l: DataFrame | None = None, t: DataFrame | None = None, residual: DataFrame | None = None) -> DataFrame:  # noqa: E741
    """One row: each check's verdict (null where it wasn't made) and whether nothing made failed."""
    made = {"k_passes": k, "l_passes": l, "t_passes": t, "residual_passes": residual}
    given = [d.select(F.col("passes").alias(n)) for n, d in made.items() if d is not None]
    if not given:
        raise ValueError("no check was made")
    row = reduce(DataFrame.crossJoin, given)  # one row each
    row = row.select(*(F.col(n) if made[n] is not None else F.lit(None).cast("boolean").alias(n) for n in made))
    return row.withColumn("passes", reduce(lambda a, b: a & b, (F.coalesce(F.col(n), F.lit(True)) for n in made)))
