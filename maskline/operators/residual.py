"""Residual identifiers in published tables: flags, scans, scorecards, the publish gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import PATTERNS, any_match, hinted, java, spread

RESIDUAL = {"ssn": "US_SSN", "phone": "PHONE_NUMBER", "email": "EMAIL_ADDRESS"}
# The scorecard's own, anchored patterns.
LEAKS = [r"^\d{3}-\d{2}-\d{4}$", r"^(\+?1[-. ]?)?\(?\d{3}\)?[-. ]?\d{3}[-. ]?\d{4}$", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _holds(value: Column, name: str) -> Column:
    """Whether a value holds a residual pattern; most are passed over at a cheap look."""
    return hinted(value, RESIDUAL[name]) & value.rlike(java(PATTERNS[RESIDUAL[name]]))


def flags(value: Column) -> Column:
    """Names of the patterns that a value holds."""
    return F.filter(F.array(*(F.when(_holds(value, n), F.lit(n)) for n in RESIDUAL)), lambda x: x.isNotNull())


def scan(df: DataFrame, sample_limit: int | None = None) -> DataFrame:
    """Values with a hit, by column and pattern, in one aggregate over the whole table; only hits are listed."""
    df, columns = (df.limit(sample_limit) if sample_limit else df), text_columns(df)
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, pattern string, hits long")
    pairs = [(c, n) for c in columns for n in RESIDUAL]
    sums = spread(df.select(*(F.col(f"`{c}`") for c in columns))).agg(*(F.count_if(_holds(F.col(f"`{c}`"), n)).alias(f"h{i}") for i, (c, n) in enumerate(pairs)))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.lit(n).alias("pattern"), F.col(f"h{i}").alias("hits")) for i, (c, n) in enumerate(pairs)))
    return sums.select(F.inline(rows)).where("hits > 0")


def scan_layer(tables: dict[str, DataFrame]) -> DataFrame:
    """Hits of all tables of a layer by table, column and pattern."""
    parts = [scan(df).select(F.lit(name).alias("table"), "column", "pattern", "hits") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def totals(hits: DataFrame) -> DataFrame:
    return hits.groupBy("pattern").agg(F.sum("hits").alias("hits"))


def leaky_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """Whether each text column of each table holds a leak: one job for all columns of a table."""

    def one(name: str, df: DataFrame) -> DataFrame:
        columns = text_columns(df)
        found = df.agg(*(F.coalesce(F.max(any_match(F.col(c), LEAKS)), F.lit(False)).alias(c) for c in columns))
        return found.select(F.inline(F.array(*(F.struct(F.lit(name).alias("table"), F.lit(c).alias("column"), F.col(c).alias("leaks")) for c in columns))))

    return reduce(DataFrame.unionByName, (one(n, d) for n, d in tables.items() if text_columns(d)))


def scorecard(people: DataFrame, tables: dict[str, DataFrame], token: str, prefix: str, year: str, zip_col: str, forbidden: tuple[str, ...], advisory: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Checks of a published layer: check, passed, detail, advisory. Null tokens, years and ZIPs are no failures.

    The checks of the layer itself are hard; ``advisory`` frames (check, passed, detail) are
    added as rows that are reported and don't block.
    """
    has = set(people.columns)
    counted = people.agg(
        F.count_if(~F.col(token).startswith(prefix)).alias("raw_tokens"),
        F.count_if((F.col(year) < 1900) | (F.col(year) > 2100)).alias("odd_years") if year in has else F.lit(0).alias("odd_years"),
        F.count_if(F.length(zip_col) > 3).alias("long_zips"),
    )
    none = lambda name, told: (F.col(name) == 0, F.concat(F.col(name).cast("string"), F.lit(f" {told}")))
    facts = [("tokens carry the prefix", *none("raw_tokens", "without it")), ("years are plausible", *none("odd_years", "are not")), ("ZIPs have three characters", *none("long_zips", "have more"))]
    facts += [(f"no column {c}", F.lit(c not in has), F.lit("")) for c in forbidden] + [(f"column {year} is there", F.lit(year in has), F.lit(""))]
    rows = counted.select(F.inline(F.array(*(F.struct(F.lit(n).alias("check"), ok.alias("passed"), told.alias("detail")) for n, ok, told in facts))))
    found = F.array_join(F.sort_array(F.collect_list(F.when(F.col("leaks"), F.concat_ws(".", "table", "column")))), ", ")  # as many as columns
    leaks = leaky_columns(tables).agg((F.count_if("leaks") == 0).alias("passed"), found.alias("detail")).select(F.lit("no identifier patterns").alias("check"), "passed", "detail")
    card = rows.unionByName(leaks).withColumn("advisory", F.lit(False))
    return reduce(DataFrame.unionByName, (d.select("check", "passed", "detail", F.lit(True).alias("advisory")) for d in advisory), card)


def verdict(card: DataFrame) -> DataFrame:
    """One row: the hard checks decide; advisory ones that failed are counted."""
    return card.agg(
        F.coalesce(F.bool_and(F.when(~F.col("advisory"), F.col("passed"))), F.lit(True)).alias("passed"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("advisory") & ~F.col("passed")).alias("advisory_failures"),
    )


def reconcile(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """Row counts of two layers side by side: table, rows_before, rows_after, state."""

    def counts(tables: dict[str, DataFrame], name: str) -> DataFrame:
        return reduce(DataFrame.unionByName, (d.agg(F.count(F.lit(1)).alias(name)).select(F.lit(t).alias("table"), name) for t, d in tables.items()))

    both = counts(before, "rows_before").join(counts(after, "rows_after"), "table", "full_outer")
    return both.withColumn("state", F.when(F.col("rows_before").eqNullSafe(F.col("rows_after")), "OK").otherwise("MISMATCH"))


def gate(hits: DataFrame, counts: DataFrame) -> DataFrame:
    """One row: residual hits, mismatched tables, and whether the layer may be published."""
    a = hits.agg(F.coalesce(F.sum("hits"), F.lit(0)).alias("residual_hits"))
    b = counts.agg(F.count_if(F.col("state") != "OK").alias("mismatches"))
    return a.crossJoin(b).withColumn("publish", (F.col("residual_hits") == 0) & (F.col("mismatches") == 0))


def require_clean(verdict_row: DataFrame) -> None:
    """Stop the run unless the gate's row allows publishing."""
    row = verdict_row.first()
    if row is None or not row["publish"]:
        raise AssertionError(f"not published: {row}")
