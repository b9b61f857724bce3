"""Disclosure risk and residual identifiers of a stream: counts that go on from batch to batch.

Both monitors keep a log of changes in a folder, a part for each micro-batch. A batch that runs
again after a failure replaces its own part, so every row counts once. Reading the log gives at
any time what a batch query over all rows so far would give.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import residual
from ..sources import scratch


def _started(stream: DataFrame, mode: str, root: str, put) -> StreamingQuery:
    return stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()


def _put(root: str):
    def put(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/changes/batch={batch}")

    return put


def _changes(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).option("basePath", f"{root}/changes").parquet(f"{root}/changes/batch=*")


@dataclass
class ClassMonitor:
    """Sizes of the equivalence classes of a stream, for k at any time.

    Counts live in the state store, by class; no row is ever late for them. A batch logs only
    the classes that it changed, with their new size. ``compact`` replaces the log of the
    batches so far by one row for each class.
    """

    root: str
    schema: T.StructType  # of the stream
    qis: list[str]

    def start(self, stream: DataFrame) -> StreamingQuery:
        """Take in all that has arrived, and stop. Started again on the same root, it goes on where it stopped."""
        return _started(stream.groupBy(*self.qis).agg(F.count(F.lit(1)).alias("class_size")), "update", self.root, _put(self.root))

    def _logged(self) -> T.StructType:
        return T.StructType([*(self.schema[q] for q in self.qis), T.StructField("class_size", T.LongType())])

    def classes(self, spark: SparkSession) -> DataFrame:
        """Every class with its latest size."""
        log = _changes(spark, self.root, self._logged())
        return log.groupBy(*self.qis).agg(F.max_by("class_size", "batch").alias("class_size"))

    def verdict(self, spark: SparkSession, k: int) -> DataFrame:
        """One row: smallest class, rows, classes, classes and rows under k, whether it passes."""
        small = F.col("class_size") < k
        return self.classes(spark).agg(
            F.coalesce(F.min("class_size"), F.lit(0)).alias("k"),
            F.coalesce(F.sum("class_size"), F.lit(0)).alias("n_rows"),
            F.count(F.lit(1)).alias("n_classes"),
            F.count_if(small).alias("violating_classes"),
            F.coalesce(F.sum(F.when(small, F.col("class_size"))), F.lit(0)).alias("violating_rows"),
        ).withColumn("passes", F.col("k") >= k)

    def compact(self, spark: SparkSession) -> None:
        """Merge the log up to the last batch but one, which is surely done and will not run again.

        The latest sizes are added to that batch's part before earlier parts go, so a stop in between loses nothing.
        """
        log = _changes(spark, self.root, self._logged())
        upto = (log.agg(F.max("batch")).first()[0] or 0) - 1
        if upto < 1:
            return
        merged = log.where(F.col("batch") <= upto).groupBy(*self.qis).agg(F.max_by("class_size", "batch").alias("class_size"))
        merged.write.mode("append").parquet(f"{self.root}/changes/batch={upto}")
        for batch in range(upto):
            scratch.delete(spark, f"{self.root}/changes/batch={batch}")


@dataclass
class ResidualMonitor:
    """Residual identifiers in the texts of a stream, by window of event time.

    A batch logs partial counts for the windows that it touches; partial counts are added up
    when read, so no state is kept and a row counts however late it is. ``late_rows`` are those
    of windows that had closed before their batch: the window's end lies ``delay`` or more
    before the latest time of all earlier batches. A verdict on such a window has changed since.
    """

    root: str
    time: str
    text: str
    window: str = "1 day"
    delay: str = "1 day"

    _SCHEMA = T.StructType([T.StructField("window_start", T.TimestampType()), T.StructField("latest", T.TimestampType()), T.StructField("n_rows", T.LongType()), *(T.StructField(n, T.LongType()) for n in residual.RESIDUAL)])

    def start(self, stream: DataFrame) -> StreamingQuery:
        """Take in all that has arrived, and stop. Started again on the same root, it goes on where it stopped."""
        put = _put(self.root)
        held = residual.flags(F.col(self.text))
        rows = stream.select(F.window(self.time, self.window)["start"].alias("window_start"), F.col(self.time).alias("latest"), held.alias("held"))
        counts = [F.count_if(F.array_contains("held", n)).alias(n) for n in residual.RESIDUAL]
        partial = lambda batch, number: put(batch.groupBy("window_start").agg(F.max("latest").alias("latest"), F.count(F.lit(1)).alias("n_rows"), *counts), number)
        return _started(rows, "append", self.root, partial)

    def windows(self, spark: SparkSession) -> DataFrame:
        """Rows, late rows and hits by pattern of each window so far."""
        log = _changes(spark, self.root, self._SCHEMA)
        ends = log.groupBy("batch").agg(F.max("latest").alias("latest"))  # a row for each batch
        earlier = ends.alias("a").join(ends.alias("b"), F.col("b.batch") < F.col("a.batch"), "left").groupBy(F.col("a.batch").alias("batch")).agg(F.max("b.latest").alias("seen"))
        end = F.col("window_start") + F.expr(f"INTERVAL {self.window}") + F.expr(f"INTERVAL {self.delay}")
        late = F.when(end <= F.col("seen"), F.col("n_rows")).otherwise(0)
        return log.join(F.broadcast(earlier), "batch").groupBy("window_start").agg(F.sum("n_rows").alias("n_rows"), F.sum(late).alias("late_rows"), *(F.sum(n).alias(n) for n in residual.RESIDUAL))


def arriving(df: DataFrame, path: str, order: Column, parts: int) -> DataFrame:
    """A table as a stream that arrives in at most ``parts`` micro-batches, cut in an order; its files stay under ``path``.

    A micro-batch has as many files as its share of the table's input splits, so a file stays of
    a split's size however large the table is. Files arrive in the order in which they were written.
    """
    files = -(-df.rdd.getNumPartitions() // parts)
    df.repartitionByRange(parts * files, order).write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)
