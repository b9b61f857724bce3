"""Tables laid out by token: bucketed and sorted, so that joins on it need no shuffle; partitioned by year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_BYTES = 256 << 20
MOST_BUCKETS = 1 << 16  # Spark's own bound is 100,000; beyond 16 TB buckets grow instead


def buckets_for(n_bytes: int) -> int:
    """A power of two of buckets of about 256 MB, so that tables of different sizes still fit one another."""
    return min(MOST_BUCKETS, 1 << (-(-max(n_bytes, 1) // BUCKET_BYTES) - 1).bit_length())


def save_bucketed(df: DataFrame, table: str, token: str, buckets: int, path: str | None = None, year: str | None = None, salt: int = 1) -> None:
    """Write a table in ``buckets`` by the hash of ``token``, sorted by it; ``year`` names a column of years to partition by.

    Rows are dealt to their bucket before the write, so each year has ``salt`` files a bucket and
    not one for every task. A token that holds much of the table is one bucket by design; a
    larger ``salt`` lets several tasks write it. Null tokens share a bucket.
    """
    if buckets < 1 or salt < 1:
        raise ValueError("buckets and salt must be 1 or more")
    bucket = F.pmod(F.hash(F.col(f"`{token}`")), F.lit(buckets))
    part = F.pmod(F.xxhash64(*(F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant"))), F.lit(salt))
    dealt = df.repartition(buckets * salt, bucket, part) if salt > 1 else df.repartition(buckets, F.col(f"`{token}`"))
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, token).sortBy(token)
    writer = writer.partitionBy(year) if year else writer
    (writer.option("path", path) if path else writer).saveAsTable(table)


def joined(facts: DataFrame, dimension: DataFrame, token: str, how: str = "inner") -> DataFrame:
    """Join of two layers bucketed alike, by merging their buckets."""
    return facts.join(dimension.hint("merge"), token, how)


def shuffles(df: DataFrame) -> int:
    """How many shuffles a frame's plan asks for before it runs."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange " in line and "BroadcastExchange" not in line for line in plan.splitlines())


def require_no_shuffle(df: DataFrame) -> DataFrame:
    """The frame itself, if its plan shuffles nothing."""
    if n := shuffles(df):
        raise AssertionError(f"the plan has {n} shuffles: the layers are not bucketed alike by the join's key")
    return df
