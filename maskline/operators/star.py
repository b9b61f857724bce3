"""Conforming, the star schema, its published form, measures and scoping."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def current(df: DataFrame, flag: str = "_IsCurrent") -> DataFrame:
    """Rows of a versioned dimension that hold now."""
    return df.where(F.col(flag))


def age_at(born: Column, as_of: Column) -> Column:
    return F.floor(F.datediff(as_of, born) / 365.25).cast("int")


def age_band(age: Column) -> Column:
    """Bands below 18, 40 and 65; all else, a null age too, is the last."""
    return F.when(age < 18, "0-17").when(age < 40, "18-39").when(age < 65, "40-64").otherwise("65+")


def full_name(*parts: Column) -> Column:
    """Parts with a blank between; nulls are skipped."""
    return F.concat_ws(" ", *parts)


def claim_columns(df: DataFrame, date: str, status: str, billed: str, allowed: str, paid: str, denied: str = "Denied") -> DataFrame:
    """Year, month, denied flag (null status: null), and the two differences of a claim."""
    return df.select(
        "*",
        F.year(date).alias("ServiceYear"),
        F.date_format(date, "yyyy-MM").alias("ServiceMonth"),
        (F.col(status) == denied).alias("DeniedFlag"),
        (F.col(billed) - F.col(allowed)).alias("AllowedVariance"),
        (F.col(allowed) - F.col(paid)).alias("PatientResponsibility"),
    )


def with_parent(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, orphans: bool = False) -> DataFrame:
    """Facts whose key the dimension has (or, as orphans, those whose key it lacks or that have none)."""
    keys = dim.select(F.col(dim_key).alias("_parent"))
    return fact.join(keys, fact[fact_key] == keys["_parent"], "left_anti" if orphans else "left_semi")


def date_dimension(first: DataFrame, first_date: str, second: DataFrame, second_date: str) -> DataFrame:
    """Every day from the earliest to the latest date of two facts, with its attributes; nothing is collected."""
    ends = [d.agg(F.min(F.col(c).cast("date")).alias(f"a{i}"), F.max(F.col(c).cast("date")).alias(f"b{i}")) for i, (d, c) in enumerate(((first, first_date), (second, second_date)))]
    span = ends[0].crossJoin(ends[1]).select(F.least("a0", "a1").alias("a"), F.greatest("b0", "b1").alias("b"))  # one row each
    days = span.where("a is not null").select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("Date"))
    d = F.col("Date")
    return days.select(
        date_key(d).alias("DateKey"), "Date", F.year(d).alias("Year"), F.quarter(d).alias("Quarter"), F.month(d).alias("Month"),
        F.date_format(d, "MMMM").alias("MonthName"), F.date_format(d, "yyyy-MM").alias("YearMonth"), F.date_format(d, "EEEE").alias("DayOfWeek"),
    )


def date_key(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd").cast("int")


def year_grain(df: DataFrame, column: str) -> Column:
    """Year of a column that holds years already or dates: its type decides."""
    return F.col(column) if df.schema[column].dataType.typeName() in ("integer", "long", "short") else F.year(column)


@dataclass(frozen=True)
class Relationship:
    """A many-to-one link of a star. An inactive one is a second role of its dimension and joins only when asked for."""

    role: str
    from_column: str  # of the fact or, as role_column, of a dimension joined before
    dimension: str
    to_column: str
    active: bool = True


def star_join(fact: DataFrame, dimensions: dict[str, DataFrame], relationships: list[Relationship], roles: tuple[str, ...] = ()) -> DataFrame:
    """Left-join a fact along its active relationships and the inactive ones named in ``roles``, in their order.

    A dimension's columns come as role_column, so one dimension can play several roles. Facts
    whose key is null or unknown keep their row, with nulls. Spark broadcasts small dimensions.
    """
    if unknown := set(roles) - {r.role for r in relationships}:
        raise ValueError(f"no relationship {sorted(unknown)}")
    for r in relationships:
        if r.active or r.role in roles:
            dim = dimensions[r.dimension]
            dim = dim.select(*(F.col(f"`{c}`").alias(f"{r.role}_{c}") for c in dim.columns))
            fact = fact.join(dim, fact[r.from_column] == dim[f"{r.role}_{r.to_column}"], "left")
    return fact


def project(tables: dict[str, DataFrame], shapes: dict[str, tuple[str, dict[str, Column | str]]]) -> dict[str, DataFrame]:
    """Published tables: for each name, its source and the columns that it shows, by their new names."""
    return {name: tables[source].select(*((F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items())) for name, (source, columns) in shapes.items()}


def claim_measures(billed: str, paid: str, denied: Column) -> list[Column]:
    """Total billed, total paid, denial rate (null over no rows), rows."""
    return [
        F.round(F.sum(billed), 2).alias("total_billed"),
        F.round(F.sum(paid), 2).alias("total_paid"),
        F.round(F.try_divide(F.count_if(denied), F.count(F.lit(1))), 6).alias("denial_rate"),
        F.count(F.lit(1)).alias("n_claims"),
    ]


def before_after(raw: DataFrame, safe: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Raw and published values of the same rows side by side."""
    a = raw.select(key, *(F.col(c).alias(f"{c}_before") for c in columns))
    return a.join(safe.select(key, *(F.col(c).cast("string").alias(f"{c}_after") for c in columns)), key)


def scoped_rows(df: DataFrame, mapping: DataFrame, principal: str, region: str, stewards: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the regions that a principal is mapped to; stewards see all."""
    if principal in stewards:
        return df
    own = mapping.where(F.col("principal") == principal).select(F.col("region").alias("_region"))
    return df.join(own, df[region] == own["_region"], "left_semi")


def scoped_columns(df: DataFrame, role: str, denied: dict[str, tuple[str, ...]]) -> DataFrame:
    """A role's view, without the columns that it is denied."""
    return df.drop(*denied.get(role, ()))
