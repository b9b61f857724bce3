"""A distributed generator of synthetic people, claims, encounters and scores.

Every choice is a hash of (seed, field, row number), so rows can be made anywhere and again.
Amounts are drawn in whole cents. Keys of new rows go on after the largest existing one, and
foreign keys are drawn from the keys that exist.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import strategies

MOST = 50  # repeats of a value in a pool
BLOCK = 4096  # rows that are numbered together
BORN, SERVED = (date(1930, 1, 1), date(2015, 12, 31)), (date(2024, 1, 1), date(2026, 12, 31))
ForeignKey = tuple[DataFrame, str]  # a table and its key


def draw(seed: int, name: str, below: Column | int) -> Column:
    """A whole number from 0 up to ``below``, exclusively, for each row."""
    digest = F.md5(F.concat(F.lit(f"{seed}|{name}|"), F.col("id").cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(below) if isinstance(below, int) else below)


def any_day(seed: int, name: str, span: tuple[date, date]) -> Column:
    return F.date_add(F.lit(span[0]), draw(seed, name, (span[1] - span[0]).days + 1).cast("int"))


def _one_of(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def laid_out(items: DataFrame, value: str, weight: str) -> DataFrame:
    """Lay weighted values end to end: adds low and high, in the order of a hash group and the value.

    Totals of 256 groups come first, then running sums inside each group, so no task sees all.
    """
    held = items.withColumn("_g", F.substring(F.md5(F.col(value).cast("string")), 1, 2))
    totals = held.groupBy("_g").agg(F.sum(weight).alias("_w"))  # 256 rows at most
    before = totals.select("_g", F.coalesce(F.sum("_w").over(Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    inside = F.sum(weight).over(Window.partitionBy("_g").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    placed = held.withColumn("_i", inside).join(F.broadcast(before), "_g").withColumn("high", F.col("_i") + F.col("_b"))
    return placed.withColumn("low", F.col("high") - F.col(weight)).drop("_g", "_i", "_b")


def pool(df: DataFrame, column: str) -> DataFrame:
    """Observed values with their weight, at most fifty, and the range [low, high) that each takes up. Null and blank ones are left out."""
    known = df.where(F.trim(F.col(column).cast("string")) != "")
    weights = known.groupBy(F.col(column).alias("value")).agg(F.least(F.count(F.lit(1)), F.lit(MOST)).alias("weight"))
    return laid_out(weights, "value", "weight").select("value", "weight", "low", "high")


def _placed(rows: DataFrame, slots: DataFrame, total: DataFrame, seed: int, name: str) -> DataFrame:
    drawn = rows.crossJoin(F.broadcast(total)).withColumn("_slot", draw(seed, name, F.col("_n"))).drop("_n")  # one row
    return drawn.join(slots, "_slot", "left").drop("_slot").withColumnRenamed("_value", name)


def pick(rows: DataFrame, values: DataFrame, seed: int, name: str) -> DataFrame:
    """Give each row a pool value: its weights are laid out as slots, and slots are joined by number."""
    slots = values.select(F.col("value").alias("_value"), F.explode(F.sequence("low", F.col("high") - 1)).alias("_slot"))
    return _placed(rows, slots, values.agg(F.max("high").alias("_n")), seed, name)


def with_foreign_key(rows: DataFrame, source: ForeignKey, seed: int, name: str) -> DataFrame:
    """Give each row a key that exists: its draw is joined with the numbered distinct keys."""
    keys = source[0].select(F.col(source[1]).alias("_value")).where(F.col("_value").isNotNull()).distinct().withColumn("_one", F.lit(1))
    held = laid_out(keys, "_value", "_one").select("_value", F.col("low").alias("_slot"))
    return _placed(rows, held, held.agg(F.count(F.lit(1)).alias("_n")), seed, name)


def new_rows(existing: DataFrame, key: str, name: str, n: int | None = None) -> DataFrame:
    """``n`` rows (by default as many as there are) numbered ``id``, with a key that goes on after the largest."""
    ends = existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("_top"), F.count(F.lit(1)).alias("_n"))
    ends = ends.withColumn("_n", F.lit(n).cast("long")) if n is not None else ends
    blocks = ends.where("_n > 0").select("_top", "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / BLOCK))).alias("_b"))
    blocks = blocks.repartition(int(existing.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_b")
    last = F.least(F.col("_n"), (F.col("_b") + 1) * BLOCK) - 1
    return blocks.select("_top", F.explode(F.sequence(F.col("_b") * BLOCK, last)).alias("id")).withColumn(name, F.col("_top") + F.col("id") + 1).drop("_top")


def patients(existing: DataFrame, key: str, pools: dict[str, DataFrame], providers: ForeignKey, n: int | None = None, seed: int = 42) -> DataFrame:
    """New current patients; ``pools`` give Gender, Race, Ethnicity and ZIP."""
    rows = with_foreign_key(new_rows(existing, key, "PatientKey", n), providers, seed, "PCPProviderKey")
    for name in ("Gender", "Race", "Ethnicity", "ZIP"):
        rows = pick(rows, pools[name], seed, name)
    first, last = (_one_of(v, draw(seed, f, len(v))) for f, v in (("FirstName", strategies.FIRST_NAMES), ("LastName", strategies.LAST_NAMES)))
    return rows.select(
        "PatientKey", (F.col("PatientKey") + 500000).alias("PatientDurableKey"), F.format_string("MRN%08d", "PatientKey").alias("MRN"),
        first.alias("FirstName"), last.alias("LastName"), F.concat(first, F.lit(" "), last).alias("PatientName"), any_day(seed, "DateOfBirth", BORN).alias("DateOfBirth"),
        "Gender", "Race", "Ethnicity", "ZIP", "PCPProviderKey", F.lit(True).alias("_IsCurrent"),
        F.lit(date(2015, 1, 1)).alias("EffectiveDate"), F.lit(date(9999, 12, 31)).alias("ExpirationDate"),
    )


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(12,2)")


def _part(cents: Column, millionths: Column) -> Column:
    """A share of an amount in cents, rounded half up."""
    return F.floor((cents * millionths + 500_000) / 1_000_000)


def claims(existing: DataFrame, key: str, keys: dict[str, ForeignKey], statuses: DataFrame, n: int | None = None, seed: int = 43) -> DataFrame:
    """New claims: billed 75 to 5,200, allowed at 45 to 90 % of it, paid as allowed where the status is
    Paid (in any case) and at 0 to 80 % of it elsewhere. ``keys`` give PatientKey, BillingProviderKey,
    RenderingProviderKey, PayerKey, ProcedureKey, DiagnosisKey; ``statuses`` is a pool."""
    rows = new_rows(existing, key, "ClaimKey", n)
    for name in ("PatientKey", "BillingProviderKey", "RenderingProviderKey", "PayerKey", "ProcedureKey", "DiagnosisKey"):
        rows = with_foreign_key(rows, keys[name], seed, name)
    rows = pick(rows, statuses, seed, "ClaimStatus").withColumn("_billed", 7_500 + draw(seed, "BilledAmount", 512_501))
    rows = rows.withColumn("_allowed", _part(F.col("_billed"), 450_000 + draw(seed, "AllowedAmount", 450_001)))
    paid = F.when(F.lower("ClaimStatus") == "paid", F.col("_allowed")).otherwise(_part(F.col("_allowed"), draw(seed, "PaidAmount", 800_001)))
    return rows.select(
        "ClaimKey", "PatientKey", "BillingProviderKey", "RenderingProviderKey", "PayerKey", "ProcedureKey", "DiagnosisKey", any_day(seed, "ServiceDate", SERVED).alias("ServiceDate"),
        _money(F.col("_billed")).alias("BilledAmount"), _money(F.col("_allowed")).alias("AllowedAmount"), _money(paid).alias("PaidAmount"), "ClaimStatus",
    )


def encounters(existing: DataFrame, key: str, keys: dict[str, ForeignKey], types: DataFrame, n: int | None = None, seed: int = 44) -> DataFrame:
    """New encounters: stays of 1 to 14 days for inpatients (in any case) only; two in five have no referring
    provider. ``keys`` give PatientKey, AttendingProviderKey, ReferringProviderKey, DepartmentKey,
    LocationKey, DiagnosisKey; ``types`` is a pool."""
    rows = new_rows(existing, key, "EncounterKey", n)
    for name in ("PatientKey", "AttendingProviderKey", "ReferringProviderKey", "DepartmentKey", "LocationKey", "DiagnosisKey"):
        rows = with_foreign_key(rows, keys[name], seed, name)
    rows = pick(rows, types, seed, "EncounterType")
    stay = F.when(F.lower("EncounterType") == "inpatient", draw(seed, "LengthOfStay", 14) + 1).otherwise(0).cast("int")
    return rows.select(
        "EncounterKey", "PatientKey", "AttendingProviderKey", F.when(draw(seed, "referred", 5) >= 2, F.col("ReferringProviderKey")).alias("ReferringProviderKey"),
        "DepartmentKey", "LocationKey", "DiagnosisKey", any_day(seed, "EncounterDate", SERVED).alias("EncounterDate"), "EncounterType", stay.alias("LengthOfStay"),
    )


def risk_scores(existing: DataFrame, key: str, keys: dict[str, ForeignKey], models: DataFrame, n: int | None = None, seed: int = 45) -> DataFrame:
    """New scores of 0.1 to 2.5; ``keys`` give PatientKey and ProviderKey, ``models`` is a pool."""
    rows = new_rows(existing, key, "RiskScoreKey", n)
    for name in ("PatientKey", "ProviderKey"):
        rows = with_foreign_key(rows, keys[name], seed, name)
    score = (100 + draw(seed, "RiskScore", 2_401)) / 1_000
    return pick(rows, models, seed, "RiskModel").select("RiskScoreKey", "PatientKey", "ProviderKey", "RiskModel", score.alias("RiskScore"), any_day(seed, "ScoreDate", SERVED).alias("ScoreDate"))
