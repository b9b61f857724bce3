"""Two tables compared as bags of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def row_hash(columns: list[str]) -> Column:
    return F.xxhash64(*(F.col(f"`{c}`") for c in columns))


def digest(df: DataFrame, columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """An order-free digest of the rows: for each hash bucket their number, and sum and xor of two hashes.

    Digests of parts can be added up (number and sum) and combined by xor, so they can be kept
    for each part of a table and merged.
    """
    second = F.xxhash64(F.lit(1), *(F.col(f"`{c}`") for c in columns))
    held = df.select(row_hash(columns).alias("h"), second.alias("g")).groupBy(F.pmod("h", F.lit(buckets)).cast("int").alias("bucket"))
    return held.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(20,0)")).alias("total"), F.bit_xor("g").alias("mixed"))


def differing(before: DataFrame, after: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Buckets whose digests differ, at most ``buckets`` rows."""
    columns = before.columns
    a, b = digest(before, columns, buckets).alias("a"), digest(after, columns, buckets).alias("b")
    alike = F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.total").eqNullSafe(F.col("b.total")) & F.col("a.mixed").eqNullSafe(F.col("b.mixed"))
    return a.join(b, F.col("a.bucket") == F.col("b.bucket"), "full_outer").where(~alike).select(F.coalesce("a.bucket", "b.bucket").alias("bucket"))


def difference(before: DataFrame, after: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows that one table has more often than the other: side (before, after), copies, and the columns.

    First the digests are compared; only rows of buckets that differ are compared themselves,
    by their counts, so equal tables cost one pass over each and no shuffle of rows. Null equals null, and equal rows are
    counted. Both must have the same columns, in any order. A differing row goes unseen if
    its bucket's number, sum and xor of 64-bit hashes are all the same by chance.
    """
    if sorted(before.columns) != sorted(after.columns):
        raise ValueError("the tables have different columns")
    columns = before.columns
    after = after.select(*(F.col(f"`{c}`") for c in columns))
    doubtful = F.broadcast(differing(before, after, buckets).select(F.col("bucket").alias("_doubtful")))
    bucket = F.pmod(row_hash(columns), F.lit(buckets)).cast("int")
    held = lambda df, n: df.withColumn("_bucket", bucket).join(doubtful, F.col("_bucket") == F.col("_doubtful"), "left_semi").drop("_bucket").withColumn("_n", F.lit(n))
    counted = held(before, 1).unionByName(held(after, -1)).groupBy(*(F.col(f"`{c}`") for c in columns)).agg(F.sum("_n").alias("_n"))
    return counted.where("_n <> 0").select(F.when(F.col("_n") > 0, "before").otherwise("after").alias("side"), F.abs("_n").alias("copies"), *(F.col(f"`{c}`") for c in columns))
