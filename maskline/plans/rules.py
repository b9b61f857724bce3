"""Rule-driven de-identification: one projection of native expressions for a table."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import keyed, strategies, text

Rule = str | dict[str, Any]
STRATEGIES = ("passthrough", "suppress", "tokenize", "generalize", "date_shift", "synthesize", "redact_text")
_PARAMETERS = {
    "passthrough": (), "suppress": ("redaction",), "tokenize": ("namespace", "length", "prefix", "format_preserving"), "generalize": ("kind", "cap"),
    "date_shift": ("entity_column", "max_days"), "synthesize": ("kind",), "redact_text": ("replacement", "entities", "namespace", "score_threshold"),
}
_NEEDED = {"generalize": ("kind",), "date_shift": ("entity_column",), "synthesize": ("kind",)}
_KINDS = {"generalize": ("year", "zip3", "age_cap"), "synthesize": ("name", "first_name", "last_name")}  # the first is the default


def resolve(rules: dict[str, Rule], column: str, default: str = "suppress") -> dict[str, Any]:
    """A column's strategy and parameters; lineage columns pass, unlisted ones get the default."""
    if column.startswith("_"):
        return {"strategy": "passthrough"}
    rule = rules.get(column, default)
    return {"strategy": rule} if isinstance(rule, str) else dict(rule)


def check(rules: dict[str, Rule], default: str = "suppress") -> None:
    """Refuse unknown strategies, kinds and parameters, and missing parameters, before anything runs."""
    for column in [*rules, None]:
        rule = resolve(rules, column, default) if column else {"strategy": default}
        name = rule.get("strategy")
        if name not in STRATEGIES:
            raise ValueError(f"{column or 'default'}: unknown strategy {name!r}")
        if missing := [k for k in _NEEDED.get(name, ()) if k not in rule]:
            raise ValueError(f"{column}: {name} needs {', '.join(missing)}")
        if unknown := set(rule) - {"strategy", *_PARAMETERS[name]}:
            raise ValueError(f"{column}: {name} has no parameter {', '.join(sorted(unknown))}")
        if name in _KINDS and rule.get("kind", _KINDS[name][0]) not in _KINDS[name]:
            raise ValueError(f"{column}: unknown kind {rule['kind']!r}")
        if name == "redact_text" and (types := set(rule.get("entities") or ()) - set(text.PATTERNS)):
            raise ValueError(f"{column}: no pattern for {', '.join(sorted(types))}")


def applied(value: Column, kind: T.DataType, rule: dict[str, Any], column: str, entity: tuple[Column, T.DataType] | None = None) -> Column:
    """The native expression of a rule on a value of the type ``kind``; the frame carries the key. ``entity`` is whose date a shift moves."""
    name, shape = rule["strategy"], kind.simpleString()
    if name == "passthrough":
        return value
    if name == "suppress":
        return strategies.suppress(rule.get("redaction"))
    if name == "tokenize":
        keyed.require_keyable(kind, column)
        namespace = rule.get("namespace", "default")
        if rule.get("format_preserving"):
            return keyed.token_shaped(value, namespace)
        return keyed.token(value, namespace, rule.get("length", 16), rule.get("prefix", ""))
    if name == "synthesize":
        keyed.require_keyable(kind, column)
        return strategies.synthesize(value, rule.get("kind", "name"))
    if name == "generalize":
        made = {"year": lambda: strategies.year_of(value, shape), "zip3": lambda: strategies.zip3(value), "age_cap": lambda: strategies.age_cap(value, shape, rule.get("cap", 90))}
        return made[rule.get("kind", "year")]()
    if name == "date_shift":
        keyed.require_keyable(entity[1], rule["entity_column"])
        return strategies.date_shift(value, entity[0], shape, rule.get("max_days", 365))
    entities = tuple(rule.get("entities") or text.PATTERNS)
    found = text.merge(text.spans(value.cast("string"), entities, rule.get("score_threshold", 0.35)))
    return text.redact(value.cast("string"), found, rule.get("replacement", "label"), rule.get("namespace", "free_text"))


def entity_of(df: DataFrame, rule: dict[str, Any]) -> tuple[Column, T.DataType] | None:
    """The top-level column whose value decides a date shift, with its type."""
    name = rule.get("entity_column") if rule["strategy"] == "date_shift" else None
    return None if name is None else (F.col(f"`{name}`"), df.schema[name].dataType)


def expression(df: DataFrame, column: str, rule: dict[str, Any]) -> Column:
    """The native expression of a column's rule."""
    return applied(F.col(f"`{column}`"), df.schema[column].dataType, rule, column, entity_of(df, rule))


def deidentify(df: DataFrame, rules: dict[str, Rule], key: str, default: str = "suppress") -> DataFrame:
    """De-identify a table, batch or stream: same rows, same columns, each by its rule."""
    check(rules, default)
    with_key = keyed.with_key(df, key)
    return with_key.select(*(expression(df, c, resolve(rules, c, default)).alias(c) for c in df.columns))


def deidentify_layer(tables: dict[str, DataFrame], profile: dict[str, dict[str, Rule]], key: str, default: str = "suppress") -> dict[str, DataFrame]:
    """De-identify a layer's tables by a profile, which has rules for each; a table without rules is refused."""
    if missing := sorted(set(tables) - set(profile)):
        raise ValueError(f"the profile has no rules for {', '.join(missing)}")
    return {name: deidentify(df, profile[name], key, default) for name, df in tables.items()}


def _cause(e: Exception) -> str:
    """Class and condition of an error. Its text stays out: it can quote a cell."""
    condition = e.getCondition() if isinstance(e, PySparkException) else None
    return f"{type(e).__name__}: {condition}" if condition else f"{type(e).__name__}: {e}" if isinstance(e, ValueError | TypeError) else type(e).__name__


def deidentify_tables(spark: SparkSession, jobs: dict[str, tuple[DataFrame, dict[str, Rule]]], key: str, prefix: str = "silver_deid_", fmt: str = "parquet") -> DataFrame:
    """Write every table's de-identified form; one failure doesn't stop the others, but all are raised at the end.

    Returns table, rows_in, rows_out; counts are observed in the writing jobs.
    """
    from pyspark.sql import Observation

    done, failed = [], []
    for name, (df, rules) in jobs.items():
        try:
            before, after = Observation(f"in_{name}"), Observation(f"out_{name}")
            seen = df.observe(before, F.count(F.lit(1)).alias("n"))
            out = deidentify(seen, rules, key).observe(after, F.count(F.lit(1)).alias("n"))
            out.write.mode("overwrite").format(fmt).option("overwriteSchema", "true").saveAsTable(prefix + name)
            done.append((name, before.get["n"], after.get["n"]))
        except Exception as e:  # noqa: BLE001
            failed.append(f"{name}: {_cause(e)}")
    if bad := [n for n, a, b in done if a != b]:
        failed += [f"{n}: rows were lost" for n in bad]
    if failed:
        raise RuntimeError("; ".join(failed))
    return spark.createDataFrame(done, "table string, rows_in long, rows_out long")


def coverage(columns: DataFrame, rules: DataFrame) -> DataFrame:
    """Classified, defaulted and missing columns: (table, column) frames of the catalog and of the rules, outer joined. Further columns of ``columns`` stay."""
    live = columns.where(~F.col("column").startswith("_")).withColumn("_live", F.lit(True))
    ruled = rules.where(~F.col("column").startswith("_")).withColumn("_ruled", F.lit(True))
    state = F.when(F.col("_live") & F.col("_ruled"), "classified").when(F.col("_live"), "defaulted").otherwise("missing")
    return live.join(ruled, ["table", "column"], "full_outer").select("table", "column", state.alias("state"), *(c for c in columns.columns if c not in ("table", "column")))


def column_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and known values of every column of every table, in one aggregate each: table, column, n_rows, n_known."""

    def one(name: str, df: DataFrame) -> DataFrame:
        sums = df.agg(F.count(F.lit(1)).alias("n"), *(F.count(F.col(f"`{c}`")).alias(f"k{i}") for i, c in enumerate(df.columns)))
        cells = (F.struct(F.lit(name).alias("table"), F.lit(c).alias("column"), F.col("n").alias("n_rows"), F.col(f"k{i}").alias("n_known")) for i, c in enumerate(df.columns))
        return sums.select(F.inline(F.array(*cells)))

    return reduce(DataFrame.unionByName, (one(n, d) for n, d in tables.items()))


def columns_frame(spark: SparkSession, tables: dict[str, list[str]]) -> DataFrame:
    rows = [(t, c) for t, cs in tables.items() for c in cs]
    return spark.createDataFrame(rows, T.StructType().add("table", "string").add("column", "string"))
