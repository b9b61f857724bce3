"""Crosswalks between tokens and originals, re-identification, key rotation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keyed


def crosswalk(df: DataFrame, column: str, key: str, keep: list[str], namespace: str, prefix: str = "", name: str = "token") -> DataFrame:
    """Original columns with the recomputed token."""
    return keyed.with_key(df, key).select(*keep, keyed.token(F.col(column), namespace, prefix=prefix).alias(name))


def parity(published: DataFrame, walk: DataFrame, token: str, name: str = "token") -> DataFrame:
    """One row: published tokens, and how many the crosswalk doesn't know (all rows are held against it)."""
    seen = published.where(F.col(token).isNotNull()).select(F.col(token).alias("_t")).distinct()
    unknown = seen.join(walk.select(F.col(name).alias("_t")), "_t", "left_anti").agg(F.count(F.lit(1)).alias("unknown_tokens"))
    return seen.agg(F.count(F.lit(1)).alias("tokens")).crossJoin(unknown).withColumn("passes", F.col("unknown_tokens") == 0)


def reidentify(tokens: DataFrame, walk: DataFrame, name: str = "token") -> DataFrame:
    """Originals of a batch of tokens; unknown ones give no row."""
    return tokens.select(name).distinct().join(walk, name)


def rotation(df: DataFrame, column: str, old_key: str, new_key: str, namespace: str, prefix: str = "") -> DataFrame:
    """Map of old to new tokens of the originals."""
    old = crosswalk(df.select(column).distinct(), column, old_key, [column], namespace, prefix, "old_token")
    return keyed.with_key(old, new_key).select("old_token", keyed.token(F.col(column), namespace, prefix=prefix).alias("new_token"))


def rekey(published: DataFrame, token: str, mapping: DataFrame, unknown: str = "raise") -> DataFrame:
    """Published rows under the new tokens; the raw table isn't touched.

    A token that the mapping doesn't know stops the run, or becomes null (``unknown="null"``);
    null tokens stay null. ``parity`` counts unknown ones beforehand.
    """
    if unknown not in ("raise", "null"):
        raise ValueError(f"unknown choice {unknown!r}")
    known = mapping.select(F.col("old_token").alias("_old"), F.col("new_token").alias("_new"))
    joined = published.join(known, published[token] == known["_old"], "left")
    new = F.col("_new")
    if unknown == "raise":
        new = F.when(published[token].isNull() | new.isNotNull(), new).otherwise(F.raise_error(F.lit("a token to rotate is unknown")).cast("string"))
    return joined.select(*(new.alias(c) if c == token else published[c] for c in published.columns))
