"""Linkage risk of sequences of events: how many persons share one, before and after a date shift."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sequences(df: DataFrame, person: str, kind: str, day: str, within: int) -> DataFrame:
    """Distinct (person, first, then, gap, day): an event and the next one of the same person, at most ``within`` days later.

    Events of one kind and day count once, so what one person has is bounded by the calendar.
    Rows with a null person or day have no sequence; a null kind is a kind like others.
    """
    events = df.select(F.col(person).alias("person"), F.col(kind).alias("kind"), F.col(day).cast("date").alias("day")).where("person is not null and day is not null").distinct()
    mine = Window.partitionBy("person").orderBy("day", "kind")
    pairs = events.select("person", F.col("kind").alias("first"), F.lead(F.struct("kind", "day")).over(mine).alias("next"), "day")
    pairs = pairs.where("next is not null").select("person", "first", F.col("next.kind").alias("then"), F.datediff("next.day", "day").alias("gap"), "day")
    return pairs.where(F.col("gap") <= within).distinct()


def candidates(found: DataFrame, reach: int) -> DataFrame:
    """For each kind of sequence and day on which one starts: persons who start one within ``reach`` days of it.

    Days on which a person counts form intervals, joined where they overlap, so nobody counts
    twice. A person enters at an interval's start and leaves after its end; entries and exits
    are added up by day, and a running sum over the days gives the persons. Windows hold one
    person's intervals or one sequence's days, never all rows of a frequent sequence.
    """
    kind = ["first", "then", "gap"]
    mine = Window.partitionBy("person", *kind).orderBy("day")
    starts = F.lag("day").over(mine).isNull() | (F.datediff("day", F.lag("day").over(mine)) > 2 * reach)
    islands = found.withColumn("opens", starts.cast("int")).withColumn("island", F.sum("opens").over(mine.rowsBetween(Window.unboundedPreceding, 0)))
    spans = islands.groupBy("person", *kind, "island").agg(F.date_sub(F.min("day"), reach).alias("enters"), F.date_add(F.max("day"), reach + 1).alias("leaves"))
    moves = spans.select(*kind, F.inline(F.array(F.struct(F.col("enters").alias("day"), F.lit(1).alias("n")), F.struct(F.col("leaves").alias("day"), F.lit(-1).alias("n"))))).groupBy(*kind, "day").agg(F.sum("n").alias("n"))
    asked = found.select(*kind, "day").distinct().withColumn("n", F.lit(None).cast("long"))
    days = moves.withColumn("asked", F.lit(0)).unionByName(asked.withColumn("asked", F.lit(1)))
    running = F.sum("n").over(Window.partitionBy(*kind).orderBy("day", "asked").rowsBetween(Window.unboundedPreceding, 0))
    return days.withColumn("candidates", running).where("asked = 1").select(*kind, "day", "candidates")


def linkage_risk(df: DataFrame, person: str, kind: str, day: str, within: int, max_days: int) -> DataFrame:
    """For each person with a sequence: the fewest persons that one of their sequences could belong to, before and after the shift.

    Before it the day is known; after a shift of up to ``max_days`` only that the day lies
    within so many days (a shift keeps gaps). Returns person, n_sequences, before, after.
    """
    found = sequences(df, person, kind, day, within)
    same = lambda a, b: (a["first"].eqNullSafe(b["first"])) & (a["then"].eqNullSafe(b["then"])) & (a["gap"] == b["gap"]) & (a["day"] == b["day"])
    exact, near = (candidates(found, r).withColumnRenamed("candidates", n) for r, n in ((0, "before"), (max_days, "after")))
    both = exact.alias("a").join(near.alias("b"), same({c: F.col(f"a.{c}") for c in ("first", "then", "gap", "day")}, {c: F.col(f"b.{c}") for c in ("first", "then", "gap", "day")})).select("a.*", "after")
    rated = found.alias("f").join(both.alias("c"), same({c: F.col(f"f.{c}") for c in ("first", "then", "gap", "day")}, {c: F.col(f"c.{c}") for c in ("first", "then", "gap", "day")}))
    return rated.groupBy(F.col("person").alias(person)).agg(F.count(F.lit(1)).alias("n_sequences"), F.min("before").alias("before"), F.min("after").alias("after"))
