"""Detector quality: sets, flags and spans held against gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metrics(df: DataFrame) -> DataFrame:
    """Add precision, recall, f1 (1 over nothing), support to tp, fp, fn."""
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col("tp"), F.col(a) + F.col(b)), F.lit(1.0))
    p, r = ratio("tp", "fp"), ratio("tp", "fn")
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    return df.select("tp", "fp", "fn", F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(f1, 4).alias("f1"), (F.col("tp") + F.col("fn")).alias("support"))


def evaluate_sets(predicted: DataFrame, gold: DataFrame, columns: list[str]) -> DataFrame:
    a = predicted.select(*columns).distinct().withColumn("_p", F.lit(True))
    b = gold.select(*columns).distinct().withColumn("_g", F.lit(True))
    both = a.join(b, columns, "full_outer")
    return metrics(both.agg(F.count_if(F.col("_p") & F.col("_g")).alias("tp"), F.count_if(F.col("_g").isNull()).alias("fp"), F.count_if(F.col("_p").isNull()).alias("fn")))


def evaluate_flags(df: DataFrame, predicted: Column, gold: Column) -> DataFrame:
    return metrics(df.agg(F.count_if(predicted & gold).alias("tp"), F.count_if(predicted & ~gold).alias("fp"), F.count_if(~predicted & gold).alias("fn")))


def evaluate_spans(predicted: DataFrame, gold: DataFrame, id_col: str, min_overlap: float = 0.5, match_type: bool = True, order_col: str | None = None) -> DataFrame:
    """Greedy matching in each document: predictions, in the order of ``order_col`` (both frames have it;
    by default that of start, end, type), each take the unused gold span of the largest Jaccard overlap that
    reaches ``min_overlap``; the first of equal ones. At 0 a disjoint span can be taken, too."""

    def listed(df: DataFrame, name: str) -> DataFrame:
        place = F.col(order_col).cast("double") if order_col else F.lit(0.0)
        span = F.struct(place.alias("place"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), F.col("entity_type").alias("entity_type"))
        return df.groupBy(id_col).agg(F.sort_array(F.collect_list(span)).alias(name))

    none = F.array().cast("array<struct<place:double,start:int,end:int,entity_type:string>>")
    docs = listed(predicted, "p").join(listed(gold, "g"), id_col, "full_outer").select(id_col, *(F.coalesce(c, none).alias(c) for c in ("p", "g")))

    def take(state: Column, x: Column) -> Column:
        def scored(y: Column, i: Column) -> Column:
            common = F.greatest(F.least(x["end"], y["end"]) - F.greatest(x["start"], y["start"]), F.lit(0))
            overlap = F.coalesce(F.try_divide(common, (x["end"] - x["start"]) + (y["end"] - y["start"]) - common), F.lit(0.0))
            fits = (x["entity_type"] == y["entity_type"]) if match_type else F.lit(True)
            return F.struct(F.when(fits & (overlap >= min_overlap), -overlap).alias("s"), i.alias("i"))

        def without(best: Column) -> Column:
            left = F.filter(state["left"], lambda _, i: best.isNull() | (i != best["i"]))
            return F.struct(left.alias("left"), (state["tp"] + F.when(best.isNotNull(), 1).otherwise(0)).alias("tp"))

        best = F.array_min(F.filter(F.transform(state["left"], scored), lambda c: c["s"].isNotNull()))
        return F.element_at(F.transform(F.array(best), without), 1)  # as an element, the best one is found once

    start = F.struct(F.col("g").alias("left"), F.lit(0).alias("tp"))
    matched = docs.withColumn("hits", F.aggregate("p", start, take, lambda s: s["tp"]))
    tp = F.coalesce(F.sum("hits"), F.lit(0))
    n_p, n_g = F.coalesce(F.sum(F.size("p")), F.lit(0)), F.coalesce(F.sum(F.size("g")), F.lit(0))
    return metrics(matched.agg(tp.alias("tp"), (n_p - tp).alias("fp"), (n_g - tp).alias("fn")))
