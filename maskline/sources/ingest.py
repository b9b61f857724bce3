"""Typed CSV in, guarded and stamped; tables out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flag(value: Column) -> Column:
    """TRUE, T, 1, Y, YES in any case, trimmed, are true; other text is false; null stays null."""
    return F.upper(F.trim(value)).isin("TRUE", "T", "1", "Y", "YES")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, mode: str = "PERMISSIVE", malformed: str | None = None) -> DataFrame:
    """A CSV file with header, quoted line breaks and doubled quotes; boolean columns are read as text and normalised.

    ``mode`` is Spark's: what cannot be read becomes null (PERMISSIVE), is left out
    (DROPMALFORMED) or stops the run (FAILFAST). ``malformed`` names a column that gets the text
    of rows with unreadable values, so that they can be counted.
    """
    booleans = {f.name for f in schema.fields if isinstance(f.dataType, T.BooleanType)}
    fields = [T.StructField(f.name, T.StringType() if f.name in booleans else f.dataType) for f in schema.fields]
    read = T.StructType(fields + ([T.StructField(malformed, T.StringType())] if malformed else []))
    source = spark.read.schema(read).option("header", True).option("multiLine", True).option("escape", '"').option("mode", mode)
    raw = (source.option("columnNameOfCorruptRecord", malformed) if malformed else source).csv(path)
    return raw.select(*(flag(F.col(c)).alias(c) if c in booleans else F.col(c) for c in raw.columns), F.col("_metadata.file_name").alias("_source_file")).withColumn("_ingested_at", F.current_timestamp())


def stamp(df: DataFrame, source: str) -> DataFrame:
    """Lineage for frames that don't come from files."""
    return df.withColumn("_ingested_at", F.current_timestamp()).withColumn("_source_file", F.lit(source))


def guard(df: DataFrame, booleans: tuple[str, ...] = ()) -> DataFrame:
    """One row from one pass: rows, known values of each boolean, and whether the load may go on."""
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *(F.count(c).alias(f"known_{c}") for c in booleans))
    fine = F.col("n_rows") > 0
    for c in booleans:
        fine = fine & (F.col(f"known_{c}") > 0)
    return counts.withColumn("passes", fine)


def require_load(df: DataFrame, booleans: tuple[str, ...] = ()) -> DataFrame:
    row = guard(df, booleans).first()
    if not row["passes"]:
        raise AssertionError(f"load stopped: {row.asDict()}")
    return df


def save(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).option("overwriteSchema", "true").saveAsTable(table)


def load(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame:
    """A table of another zone, by path."""
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/{table}")


def missing_tables(spark: SparkSession, names: list[str]) -> list[str]:
    return [n for n in names if not spark.catalog.tableExists(n)]


def require_tables(spark: SparkSession, names: list[str]) -> None:
    if missing := missing_tables(spark, names):
        raise RuntimeError(f"tables are missing: {', '.join(missing)}")


def copy_tables(spark: SparkSession, names: list[str], source: str, target: str, fmt: str = "parquet") -> None:
    """Reference tables, unchanged, under another layer's prefix."""
    for n in names:
        save(spark.table(source + n), target + n, fmt)
