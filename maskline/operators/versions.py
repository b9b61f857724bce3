"""Facts joined to the version of a dimension that was valid on their day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DAYS = 64


def as_of(facts: DataFrame, fact_key: str, fact_day: str, dimension: DataFrame, key: str, effective: str, expiration: str, columns: list[str], bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """Add the dimension's ``columns`` as they were on each fact's day; null where no version was valid.

    A version is valid from its effective day to its expiration day, both included, and at most
    until the next version of its key begins; a null expiration never comes; of versions that
    begin on one day, the one with the later expiration counts, then the larger columns. Facts
    with a null key or day have no version.

    Days are cut into buckets; a version is laid into each bucket that it covers, within the
    span of the facts' days, and the two meet by key and bucket. So there is no join by range
    alone, and the facts of a frequent key spread over its buckets. Every fact stays one row.
    """
    day = F.col(fact_day).cast("date")
    span = facts.agg(F.min(day).alias("_from"), F.max(day).alias("_to"))  # one row
    number = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01").cast("date")) / bucket_days)
    shown = [F.col(c).alias(f"_{i}") for i, c in enumerate(columns)]
    rows = dimension.select(F.col(key).alias("_key"), F.col(effective).cast("date").alias("_begin"), F.coalesce(F.col(expiration).cast("date"), F.lit("9999-12-31").cast("date")).alias("_end"), *shown)
    rows = rows.where("_key is not null and _begin is not null")
    same_day = Window.partitionBy("_key", "_begin").orderBy(F.desc("_end"), *(F.col(f"_{i}").desc_nulls_last() for i in range(len(columns))))
    rows = rows.withColumn("_rank", F.row_number().over(same_day)).where("_rank = 1").drop("_rank")
    following = F.date_sub(F.lead("_begin").over(Window.partitionBy("_key").orderBy("_begin")), 1)
    rows = rows.withColumn("_end", F.least("_end", F.coalesce(following, F.col("_end")))).where("_begin <= _end")
    first, last = number(F.greatest("_begin", "_from")), number(F.least("_end", "_to"))
    laid = rows.crossJoin(F.broadcast(span)).where("_begin <= _to and _end >= _from").withColumn("_bucket", F.explode(F.sequence(first, last))).drop("_from", "_to")
    asked = facts.withColumn("_day", day).withColumn("_b", number(F.col("_day")))
    meets = (F.col(f"`{fact_key}`") == F.col("_key")) & (F.col("_b") == F.col("_bucket")) & F.col("_day").between(F.col("_begin"), F.col("_end"))
    return asked.join(laid, meets, "left").select(*(F.col(f"`{c}`") for c in facts.columns), *(F.col(f"_{i}").alias(c) for i, c in enumerate(columns)), F.col("_begin").alias(f"valid_{effective}"))
