"""Bloom filters of token sets: mergeable, stored by version, applied before an exact join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_WORDS = 1 << 20  # of a filter that is broadcast, about 30 MB; a larger one is left out and the exact join does all
PER_TOKEN = 12  # bits


def words_for(n_tokens: int) -> int:
    """64-bit words of a filter in which about one unknown token in fifty looks known."""
    return 1 << (-(-max(n_tokens, 1) * PER_TOKEN // 64) - 1).bit_length()


def _place(token: Column, words: int) -> tuple[Column, Column]:
    """The word of a token and its four bits there, from two hashes."""
    second = F.xxhash64(token, F.lit(1))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(second, 6 * i).bitwiseAND(63).cast("int")) for i in range(4)]
    return F.pmod(F.xxhash64(token), F.lit(words).cast("long")), reduce(lambda a, b: a.bitwiseOR(b), bits)


def build(df: DataFrame, column: str, words: int) -> DataFrame:
    """The filter of a column's tokens (nulls are none): words, word, bits. Tasks merge their own rows first, so a hot token costs no shuffle."""
    word, bits = _place(F.col(f"`{column}`").cast("string"), words)
    held = df.where(F.col(f"`{column}`").isNotNull()).select(word.alias("word"), bits.alias("bits"))
    return held.groupBy("word").agg(F.bit_or("bits").alias("bits")).select(F.lit(words).alias("words"), "word", "bits")


def merged(parts: DataFrame) -> DataFrame:
    """The filter of all tokens from filters of parts (days, shards) with the same number of words."""
    return parts.groupBy("words", "word").agg(F.bit_or("bits").alias("bits"))


def save(held: DataFrame, root: str, version: str) -> None:
    """Store a filter under its version; a version that exists is refused, since published runs name it."""
    held.write.mode("error").parquet(f"{root}/version={version}")


def load(spark: SparkSession, root: str, version: str) -> DataFrame:
    return spark.read.schema("words int, word long, bits long").parquet(f"{root}/version={version}")


def maybe(df: DataFrame, column: str, held: DataFrame, words: int) -> DataFrame:
    """Rows whose token may be one of the filter's: all that are, and few others; nulls never. No shuffle of ``df``.

    The filter has ``words`` rows at most and is broadcast up to ``MOST_WORDS``; beyond that all
    rows stay. A filter of another size is an error when the rows are read. An empty filter keeps nothing.
    """
    if words > MOST_WORDS:
        return df
    fits = F.when(F.col("words") == words, F.col("word")).otherwise(F.raise_error(F.lit("the filter has another number of words")).cast("long"))
    known = held.select(fits.alias("_word"), F.col("bits").alias("_bits"))
    token = df[f"`{column}`"]
    word, bits = _place(token.cast("string"), words)
    same = (word == known["_word"]) & (known["_bits"].bitwiseAND(bits) == bits) & token.isNotNull()
    return df.join(F.broadcast(known), same, "left_semi")


def reach(df: DataFrame, column: str, held: DataFrame, words: int) -> DataFrame:
    """One row: rows, and how many of them the filter lets through to the exact join."""
    through = maybe(df, column, held, words).agg(F.count(F.lit(1)).alias("n_through"))
    return df.agg(F.count(F.lit(1)).alias("n_rows")).crossJoin(through)


def known_rows(df: DataFrame, column: str, walk: DataFrame, held: DataFrame, words: int, name: str = "token") -> DataFrame:
    """Rows with the originals of their tokens; the filter drops most rows that have none before the exact join shuffles them.

    ``held`` is a filter of all of ``walk``'s tokens, so the result is that of the join alone.
    The crosswalk's columns come under their own names, its token under ``column``. Null tokens
    join with nothing, repeated rows stay, an empty crosswalk gives no rows.
    """
    own = walk.withColumnRenamed(name, "_token")
    through = maybe(df, column, held, words)
    return through.join(own, through[f"`{column}`"] == own["_token"]).drop(own["_token"])
