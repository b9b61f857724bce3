"""Run ledger and expiry flags: data about runs, kept as rows; never data values or keys."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import rules as plans


def rules_hash(rules: dict) -> str:
    return hashlib.sha256(json.dumps(rules, sort_keys=True).encode()).hexdigest()


def run_rows(tables: DataFrame, rules: dict[str, dict], columns: dict[str, list[str]], actor: str, key_version: str, at: datetime) -> DataFrame:
    """Ledger rows for (table, rows_in, rows_out): strategies by column count, rule hash, key version, actor, time."""
    plan = [(t, plans.resolve(rules.get(t, {}), c)["strategy"]) for t, cs in columns.items() for c in cs]
    spark = tables.sparkSession
    used = spark.createDataFrame(plan, "table string, strategy string").groupBy("table", "strategy").count()
    used = used.groupBy("table").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("strategy", "count")))).alias("strategies"))
    return tables.join(F.broadcast(used), "table", "left").select(
        "table", "rows_in", "rows_out", F.to_json("strategies").alias("strategies"), F.lit(rules_hash(rules)).alias("rules_hash"),
        F.lit(key_version).alias("key_version"), F.lit(actor).alias("actor"), F.lit(at).alias("at"),
    )


def record_run(spark: SparkSession, jobs: dict[str, tuple[DataFrame, dict]], key: str, actor: str, key_version: str, at: datetime, ledger: str, prefix: str = "silver_deid_", fmt: str = "parquet") -> DataFrame:
    """De-identify and write every table, and append a ledger row for each, with the counts that the writing jobs observed.

    Nothing is read a second time. If a table fails, the run raises and the ledger stays as it was.
    """
    counts = plans.deidentify_tables(spark, jobs, key, prefix, fmt)
    rows = run_rows(counts, {n: r for n, (_, r) in jobs.items()}, {n: d.columns for n, (d, _) in jobs.items()}, actor, key_version, at)
    append(rows, ledger, fmt)
    return rows


def expiry_row(spark: SparkSession, expires: datetime | None, as_of: datetime, method: str) -> DataFrame:
    """Whether a determination is in date, as a row of a scorecard. Without a date it isn't."""
    told = f"method {method}, review by {expires.isoformat() if expires else 'no date'}"
    return spark.createDataFrame([("determination not expired", expires is not None and as_of < expires, told)], "check string, passed boolean, detail string")


def append(rows: DataFrame, table: str, fmt: str = "parquet") -> None:
    rows.write.mode("append").format(fmt).saveAsTable(table)


def expired(expiry: Column, as_of: Column) -> Column:
    """Whether a determination has run out; null while no expiry is set. Times without a zone are UTC."""
    return as_of >= expiry.try_cast("timestamp")
