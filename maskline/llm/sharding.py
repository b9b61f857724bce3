"""Sharding by global byte-size prefix sums [DataFrame functions only]."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared


def shard_by_bytes(df: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16, range_bytes: int = shared.RANGE_BYTES) -> DataFrame:
    """Cut a table, in ascending id order, into contiguous shards of near equal bytes.

    A row weighs the UTF-8 bytes of its text (null: none) plus ``overhead``. Rows are put into
    ranges of id, size and checksum, as many as their number asks for; the totals of the ranges give each range's global byte and row offset, a running
    sum inside the range gives each row's, and a row goes to the shard in whose equal share of
    all bytes its middle byte lies. No task sees more than one range.

    Returns doc_id, size, text_crc32 (null text: that of no bytes, 0), law ``bytes``, shard,
    slot (gapless from 0 in its shard), grown_shard (always null: the law is not ``key``).
    Null ids come first; rows with equal ids are ordered by size and checksum; an empty table
    gives no rows; a row heavier than a shard's share can leave neighbours empty. Other columns
    of ``df``, whatever their names, are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    order = ["doc_id", "size", "text_crc32"]
    cut = shared.ranges(rows, [F.col(c) for c in order], F.lit(24), range_bytes)  # a row is sorted as three numbers
    sized = shared.stage(rows.withColumn("_range", cut.index()))
    whole = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # a row for each range, of which there are as many as cuts + 1
        sized.groupBy("_range")
        .agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        .select(
            "_range",
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte0"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row0"),
            F.sum("_bytes").over(whole).alias("_total"),
        )
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        sized.withColumn("_end", F.sum("size").over(inside))
        .withColumn("_nth", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "_range")
        .withColumn("_middle", F.col("_byte0") + F.col("_end") - F.col("size") / 2)
        .withColumn("shard", F.least(F.lit(n_shards - 1), F.floor(F.col("_middle") / F.col("_total") * n_shards)).cast("int"))
        .withColumn("_row", F.col("_row0") + F.col("_nth"))
    )
    firsts = placed.groupBy("shard").agg(F.min("_row").alias("_first"))  # a row for each shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_row") - F.col("_first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
