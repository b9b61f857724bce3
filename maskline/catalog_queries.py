"""Registered queries of the library over the given tables, each with SQL that gives the same rows.

The customer table stands for people (its name is the record number; ZIP, age and date of birth
follow from its key by a formula), supplier for providers, orders and lineitem for claims,
events for encounters and scores, documents for free text.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import keyed, strategies, text
from .operators import ledger, quality, residual, risk, star, synth, vault
from .plans import rules
from .sources import ingest

KEY, NEW_KEY = "demonstration-key-for-synthetic-rows-0001", "demonstration-key-for-synthetic-rows-0002"
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- the tables, in both languages ---------------------------------------------------------


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def people(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return t(spark, d, "customer").select(
        k.alias("patient_key"), F.col("c_name").alias("mrn"), F.lpad((k * 7919 % 100000).cast("string"), 5, "0").alias("zip"),
        (k * 31 % 110).cast("int").alias("age"), F.date_add(F.lit("1930-01-01").cast("date"), (k * 97 % 30000).cast("int")).alias("dob"),
        F.when(k % 7 != 0, F.col("c_mktsegment")).alias("segment"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"),
    )


PEOPLE = """people AS (SELECT c_custkey AS patient_key, c_name AS mrn, lpad((c_custkey * 7919 % 100000)::VARCHAR, 5, '0') AS zip,
  (c_custkey * 31 % 110)::INTEGER AS age, (DATE '1930-01-01' + (c_custkey * 97 % 30000)::INTEGER)::DATE AS dob,
  CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS segment, c_nationkey AS nation, c_acctbal AS balance FROM customer)"""


def claims(spark: SparkSession, d: str) -> DataFrame:
    """Orders as claims: allowed is three quarters of billed, paid two thirds of allowed, in whole cents."""
    billed = F.round(F.col("o_totalprice"), 2).cast("decimal(12,2)")
    return t(spark, d, "orders").select(
        F.col("o_orderkey").alias("claim_key"), F.col("o_custkey").alias("patient_key"), F.col("o_orderdate").cast("date").alias("service_date"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderstatus")).alias("status"), F.col("o_orderpriority").alias("priority"), billed.alias("billed"),
        (F.floor(F.col("o_totalprice") * 75) / 100).cast("decimal(12,2)").alias("allowed"), (F.floor(F.col("o_totalprice") * 50) / 100).cast("decimal(12,2)").alias("paid"),
    )


CLAIMS = """claims AS (SELECT o_orderkey AS claim_key, o_custkey AS patient_key, o_orderdate::DATE AS service_date,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END AS status, o_orderpriority AS priority, round(o_totalprice, 2)::DECIMAL(12,2) AS billed,
  (floor(o_totalprice * 75) / 100)::DECIMAL(12,2) AS allowed, (floor(o_totalprice * 50) / 100)::DECIMAL(12,2) AS paid FROM orders)"""


def _blob(data: bytes) -> str:
    return "'" + "".join(f"\\x{b:02X}" for b in data) + "'::BLOB"


def hmac_sql(value: str, namespace: str, key: str = KEY) -> str:
    inner, outer = keyed.pads(key)
    return f"sha256({_blob(outer)} || unhex(sha256({_blob(inner)} || encode('{namespace}' || chr(31) || ({value})::VARCHAR))))"


def token_sql(value: str, namespace: str, prefix: str = "", length: int = 16, key: str = KEY) -> str:
    return f"'{prefix}' || left({hmac_sql(value, namespace, key)}, {length})"


def number_sql(value: str, namespace: str) -> str:
    return f"('0x' || left({hmac_sql(value, namespace)}, 8))::BIGINT"


def shift_sql(value: str, entity: str, most: int = 365) -> str:
    return f"({value} + ({number_sql(entity, 'date_shift')} % {2 * most + 1} - {most})::INTEGER)::DATE"


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


ZIP3_SQL = f"CASE WHEN left(zip, 3) IN ({', '.join(repr(z) for z in strategies.RESTRICTED_ZIP3)}) THEN '000' ELSE left(zip, 3) END"


# --- A: ingest ------------------------------------------------------------------------------


@query("SELECT o_orderkey, coalesce(upper(trim(v)) IN ('TRUE', 'T', '1', 'Y', 'YES'), NULL) AS flag FROM (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN ' y ' WHEN 1 THEN 'True' WHEN 2 THEN '0' WHEN 3 THEN NULL ELSE o_orderstatus END AS v FROM orders)")
def flag_normalize(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey") % 5
    v = F.when(k == 0, " y ").when(k == 1, "True").when(k == 2, "0").when(k == 3, None).otherwise(F.col("o_orderstatus"))
    return t(spark, d, "orders").select("o_orderkey", ingest.flag(v).alias("flag"))


@query("SELECT count(*) AS n_rows, count(urgent) AS known_urgent, count(*) > 0 AND count(urgent) > 0 AS passes FROM (SELECT CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority = '1-URGENT' END AS urgent FROM orders)")
def load_guard(spark: SparkSession, d: str) -> DataFrame:
    urgent = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority") == "1-URGENT")
    return ingest.guard(t(spark, d, "orders").select(urgent.alias("urgent")), ("urgent",))


# --- B: conform and star --------------------------------------------------------------------


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0")
def current_rows(spark: SparkSession, d: str) -> DataFrame:
    return star.current(t(spark, d, "customer").withColumn("_IsCurrent", F.col("c_custkey") % 3 != 0)).select("c_custkey", "c_name")


@query(f"WITH {PEOPLE} SELECT patient_key, concat_ws(' ', segment, mrn) AS full_name, age_, CASE WHEN age_ < 18 THEN '0-17' WHEN age_ < 40 THEN '18-39' WHEN age_ < 65 THEN '40-64' ELSE '65+' END AS age_band FROM (SELECT *, floor((DATE '2025-01-01' - dob) / 365.25)::INTEGER AS age_ FROM people)")
def derive_age_band(spark: SparkSession, d: str) -> DataFrame:
    p = people(spark, d).withColumn("age_", star.age_at(F.col("dob"), F.lit("2025-01-01").cast("date")))
    return p.select("patient_key", star.full_name(F.col("segment"), F.col("mrn")).alias("full_name"), "age_", star.age_band(F.col("age_")).alias("age_band"))


@query(f"""WITH {CLAIMS} SELECT claim_key, year(service_date)::INTEGER AS "ServiceYear", strftime(service_date, '%Y-%m') AS "ServiceMonth", status = 'F' AS "DeniedFlag", billed - allowed AS "AllowedVariance", allowed - paid AS "PatientResponsibility" FROM claims""")
def derive_fact(spark: SparkSession, d: str) -> DataFrame:
    c = star.claim_columns(claims(spark, d), "service_date", "status", "billed", "allowed", "paid", denied="F")
    return c.select("claim_key", "ServiceYear", "ServiceMonth", "DeniedFlag", "AllowedVariance", "PatientResponsibility")


@query("SELECT o_orderkey, o_custkey FROM orders SEMI JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0) ON o_custkey = c_custkey")
def ri_semi(spark: SparkSession, d: str) -> DataFrame:
    return star.with_parent(t(spark, d, "orders"), t(spark, d, "customer").where("c_custkey % 5 <> 0"), "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders ANTI JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0) ON o_custkey = c_custkey")
def ri_orphans(spark: SparkSession, d: str) -> DataFrame:
    return star.with_parent(t(spark, d, "orders"), t(spark, d, "customer").where("c_custkey % 5 <> 0"), "o_custkey", "c_custkey", orphans=True).select("o_orderkey", "o_custkey")


@query("""
SELECT strftime(f, '%Y%m%d')::INTEGER AS "DateKey", f AS "Date", year(f)::INTEGER AS "Year", quarter(f)::INTEGER AS "Quarter", month(f)::INTEGER AS "Month",
  monthname(f) AS "MonthName", strftime(f, '%Y-%m') AS "YearMonth", dayname(f) AS "DayOfWeek"
FROM (SELECT unnest(generate_series(least(a, b), greatest(c, e), INTERVAL 1 DAY))::DATE AS f
  FROM (SELECT min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS c FROM orders), (SELECT min(l_shipdate)::DATE AS b, max(l_shipdate)::DATE AS e FROM lineitem))""")
def dim_date(spark: SparkSession, d: str) -> DataFrame:
    return star.date_dimension(t(spark, d, "orders"), "o_orderdate", t(spark, d, "lineitem"), "l_shipdate")


@query("SELECT 'customer' AS dim, c_custkey AS dim_key, c_name AS label FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier UNION ALL SELECT 'part', p_partkey, p_name FROM part UNION ALL SELECT 'nation', n_nationkey, n_name FROM nation UNION ALL SELECT 'region', r_regionkey, r_name FROM region")
def star_dims(spark: SparkSession, d: str) -> DataFrame:
    dims = [("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"), ("part", "p_partkey", "p_name"), ("nation", "n_nationkey", "n_name"), ("region", "r_regionkey", "r_name")]
    parts = [t(spark, d, n).select(F.lit(n).alias("dim"), F.col(k).cast("long").alias("dim_key"), F.col(c).alias("label")) for n, k, c in dims]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')::INTEGER AS date_key, l_quantity FROM lineitem")
def fact_datekey(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", star.date_key(F.col("l_shipdate")).alias("date_key"), "l_quantity")


# --- C: strategies --------------------------------------------------------------------------


@query(f"SELECT c_custkey, {token_sql('c_name', 'mrn', 'PT-')} AS token FROM customer")
def tokenize(spark: SparkSession, d: str) -> DataFrame:
    return keyed.with_key(t(spark, d, "customer"), KEY).select("c_custkey", keyed.token(F.col("c_name"), "mrn", prefix="PT-").alias("token"))


@query(f"SELECT s_suppkey, lpad((('0x' || left({hmac_sql('s_suppkey', 'npi')}, 16))::UBIGINT % 10000000000)::VARCHAR, 10, '0') AS token FROM supplier")
def tokenize_numeric(spark: SparkSession, d: str) -> DataFrame:
    return keyed.with_key(t(spark, d, "supplier"), KEY).select("s_suppkey", keyed.token_numeric(F.col("s_suppkey"), "npi", 10).alias("token"))


@query(rf"""SELECT c_custkey, array_to_string(list_transform(string_split(c_name, ''), lambda ch, i: CASE WHEN regexp_matches(ch, '^\p{{Nd}}$') THEN (b[(i - 1) % 32 + 1] % 10)::VARCHAR WHEN regexp_matches(ch, '^\p{{Lu}}$') THEN chr((b[(i - 1) % 32 + 1] % 26 + 65)::INTEGER) WHEN regexp_matches(ch, '^\p{{Ll}}$') THEN chr((b[(i - 1) % 32 + 1] % 26 + 97)::INTEGER) ELSE ch END), '') AS token
FROM (SELECT c_custkey, c_name, list_transform(range(0, 32), lambda j: ('0x' || substr(h, 2 * j + 1, 2))::INTEGER) AS b FROM (SELECT *, {hmac_sql('c_name', 'mrn')} AS h FROM customer))""")
def tokenize_fpe(spark: SparkSession, d: str) -> DataFrame:
    return keyed.with_key(t(spark, d, "customer"), KEY).select("c_custkey", keyed.token_shaped(F.col("c_name"), "mrn").alias("token"))


@query("SELECT o_orderkey, year(o_orderdate)::INTEGER AS order_year FROM orders")
def generalize_year(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").select("o_orderkey", strategies.year_of(F.col("o_orderdate"), "timestamp").alias("order_year"))


@query(f"WITH {PEOPLE} SELECT patient_key, {ZIP3_SQL} AS zip3 FROM people")
def zip3(spark: SparkSession, d: str) -> DataFrame:
    return people(spark, d).select("patient_key", strategies.zip3(F.col("zip")).alias("zip3"))


@query(f"WITH {PEOPLE} SELECT patient_key, least(age, 90)::INTEGER AS age FROM people")
def age_cap(spark: SparkSession, d: str) -> DataFrame:
    return people(spark, d).select("patient_key", strategies.age_cap(F.col("age"), "int").alias("age"))


@query(f"SELECT o_orderkey, {shift_sql('o_orderdate::DATE', 'o_custkey')} AS shifted FROM orders")
def date_shift(spark: SparkSession, d: str) -> DataFrame:
    return keyed.with_key(t(spark, d, "orders"), KEY).select("o_orderkey", strategies.date_shift(F.col("o_orderdate"), F.col("o_custkey"), "timestamp").alias("shifted"))


def _synth(name: str) -> str:
    n, first, last = number_sql("c_name", f"synth_{name}"), _list(strategies.FIRST_NAMES), _list(strategies.LAST_NAMES)
    return {"first_name": f"{first}[{n} % 16 + 1]", "last_name": f"{last}[{n} % 16 + 1]", "name": f"{last}[({n} // 16) % 16 + 1] || ', ' || {first}[{n} % 16 + 1]"}[name]


def _synthesized(spark: SparkSession, d: str, kind: str) -> DataFrame:
    return keyed.with_key(t(spark, d, "customer"), KEY).select("c_custkey", strategies.synthesize(F.col("c_name"), kind).alias("made"))


@query(f"SELECT c_custkey, {_synth('first_name')} AS made FROM customer")
def synth_first(spark: SparkSession, d: str) -> DataFrame:
    return _synthesized(spark, d, "first_name")


@query(f"SELECT c_custkey, {_synth('last_name')} AS made FROM customer")
def synth_last(spark: SparkSession, d: str) -> DataFrame:
    return _synthesized(spark, d, "last_name")


@query(f"SELECT c_custkey, {_synth('name')} AS made FROM customer")
def synth_name(spark: SparkSession, d: str) -> DataFrame:
    return _synthesized(spark, d, "name")


@query("SELECT o_orderkey, coalesce(try_strptime(v, '%Y-%m-%d'), try_strptime(v, '%m/%d/%Y'), try_strptime(v, '%Y/%m/%d'))::DATE AS parsed FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d') ELSE 'on ' || strftime(o_orderdate, '%d') END AS v FROM orders)")
def coerce_date(spark: SparkSession, d: str) -> DataFrame:
    k, o = F.col("o_orderkey") % 4, F.col("o_orderdate")
    v = F.when(k == 0, F.date_format(o, "yyyy-MM-dd")).when(k == 1, F.date_format(o, "MM/dd/yyyy")).when(k == 2, F.date_format(o, "yyyy/MM/dd")).otherwise(F.concat(F.lit("on "), F.date_format(o, "dd")))
    return t(spark, d, "orders").select("o_orderkey", strategies.coerce_date(v).alias("parsed"))


STRICT: dict[str, rules.Rule] = {
    "patient_key": "passthrough", "mrn": {"strategy": "tokenize", "namespace": "mrn", "prefix": "PT-"}, "zip": {"strategy": "generalize", "kind": "zip3"},
    "age": {"strategy": "generalize", "kind": "age_cap", "cap": 90}, "dob": {"strategy": "generalize", "kind": "year"}, "nation": "passthrough", "segment": "passthrough",
}
ANALYTIC = STRICT | {"dob": {"strategy": "date_shift", "entity_column": "patient_key", "max_days": 365}}
SAFE = f"safe AS (SELECT patient_key, {token_sql('mrn', 'mrn', 'PT-')} AS mrn, {ZIP3_SQL} AS zip, least(age, 90)::INTEGER AS age, year(dob)::INTEGER AS dob, segment, nation, NULL::VARCHAR AS balance FROM people)"


def safe_people(spark: SparkSession, d: str) -> DataFrame:
    return rules.deidentify(people(spark, d), STRICT, KEY)


@query(f"WITH {PEOPLE}, {SAFE} SELECT * FROM safe")
def deid_table(spark: SparkSession, d: str) -> DataFrame:
    return safe_people(spark, d)


@query(f"WITH {PEOPLE}, {SAFE} SELECT safe.* REPLACE ({shift_sql('people.dob', 'people.patient_key')} AS dob) FROM safe JOIN people USING (patient_key)")
def deid_table_shift(spark: SparkSession, d: str) -> DataFrame:
    return rules.deidentify(people(spark, d), ANALYTIC, KEY)


_TOKEN = {"strategy": "tokenize", "namespace": "npi", "prefix": "NP-"}
_YEAR, _SHIFT = {"strategy": "generalize", "kind": "year"}, {"strategy": "date_shift", "entity_column": "patient_key", "max_days": 365}
PROFILES: dict[str, dict[str, dict[str, rules.Rule]]] = {
    "strict": {
        "people": STRICT,
        "providers": {"s_suppkey": _TOKEN, "s_name": {"strategy": "synthesize", "kind": "name"}, "s_nationkey": "passthrough"},
        "claims": {"claim_key": "passthrough", "patient_key": "passthrough", "service_date": _YEAR, "status": "passthrough"},
        "parts": {"p_partkey": "passthrough", "p_brand": "passthrough"},
    }
}
PROFILES["analytic"] = PROFILES["strict"] | {"people": ANALYTIC, "claims": PROFILES["strict"]["claims"] | {"service_date": _SHIFT}}


def layer(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {"people": people(spark, d), "providers": t(spark, d, "supplier"), "claims": claims(spark, d), "parts": t(spark, d, "part").drop("p_retailprice")}


def _digest(df: DataFrame) -> DataFrame:
    return df.select(F.md5(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in sorted(df.columns)))).alias("row"))


def _digest_sql(source: str, columns: dict[str, str]) -> str:
    cells = ", ".join(f"coalesce(({columns[c]})::VARCHAR, '-')" for c in sorted(columns))
    return f"SELECT md5(concat_ws('|', {cells})) AS row FROM {source}"


_DOB = {"strict": "year(dob)", "analytic": shift_sql("dob", "patient_key")}
_SERVED = {"strict": "year(service_date)", "analytic": shift_sql("service_date", "patient_key")}
_MADE = f"{_list(strategies.LAST_NAMES)}[({number_sql('s_name', 'synth_name')} // 16) % 16 + 1] || ', ' || {_list(strategies.FIRST_NAMES)}[{number_sql('s_name', 'synth_name')} % 16 + 1]"
_LAYER_SQL = " UNION ALL ".join(
    f"SELECT '{profile}' AS profile, '{name}' AS \"table\", row FROM ({_digest_sql(source, columns)})"
    for profile in PROFILES
    for name, source, columns in (
        ("people", "people", {"patient_key": "patient_key", "mrn": token_sql("mrn", "mrn", "PT-"), "zip": ZIP3_SQL, "age": "least(age, 90)", "dob": _DOB[profile], "segment": "segment", "nation": "nation", "balance": "NULL"}),
        ("providers", "supplier", {"s_suppkey": token_sql("s_suppkey", "npi", "NP-"), "s_name": _MADE, "s_nationkey": "s_nationkey", "s_acctbal": "NULL"}),
        ("claims", "claims", {"claim_key": "claim_key", "patient_key": "patient_key", "service_date": _SERVED[profile], "status": "status", "priority": "NULL", "billed": "NULL", "allowed": "NULL", "paid": "NULL"}),
        ("parts", "part", {"p_partkey": "p_partkey", "p_name": "NULL", "p_brand": "p_brand", "p_type": "NULL", "p_size": "NULL"}),
    )
)


@query(f"WITH {PEOPLE}, {CLAIMS} {_LAYER_SQL}")
def deid_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Two profiles over four tables; a digest of each row."""
    parts = [
        _digest(df).select(F.lit(profile).alias("profile"), F.lit(name).alias("table"), "row")
        for profile in PROFILES
        for name, df in rules.deidentify_layer(layer(spark, d), PROFILES[profile], KEY).items()
    ]
    return reduce(DataFrame.unionByName, parts)


PLAIN = {"o_custkey": "tokenize", "o_orderpriority": {"strategy": "tokenize", "namespace": "level", "format_preserving": True}, "o_orderstatus": {"strategy": "suppress", "redaction": "*"}}


@query(f"""
WITH h AS (SELECT *, {hmac_sql('o_orderpriority', 'level')} AS h FROM orders),
b AS (SELECT *, list_transform(range(0, 32), lambda j: ('0x' || substr(h, 2 * j + 1, 2))::INTEGER) AS b FROM h)
SELECT o_orderkey, {token_sql('o_custkey', 'default')} AS o_custkey, '*' AS o_orderstatus,
  array_to_string(list_transform(string_split(o_orderpriority, ''), lambda ch, i:
    CASE WHEN regexp_matches(ch, '^[0-9]$') THEN (b[(i - 1) % 32 + 1] % 10)::VARCHAR
         WHEN regexp_matches(ch, '^[A-Z]$') THEN chr((b[(i - 1) % 32 + 1] % 26 + 65)::INTEGER)
         WHEN regexp_matches(ch, '^[a-z]$') THEN chr((b[(i - 1) % 32 + 1] % 26 + 97)::INTEGER) ELSE ch END), '') AS o_orderpriority
FROM b""")
def deid_defaults(spark: SparkSession, d: str) -> DataFrame:
    """Rules that leave the namespace to its default, keep a value's shape, or put a fixed text."""
    columns = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return rules.deidentify(columns, PLAIN | {"o_orderkey": "passthrough"}, KEY)


@query("SELECT count(*) AS pairs, count(DISTINCT o_custkey) AS keys FROM orders JOIN customer ON o_custkey = c_custkey")
def token_join(spark: SparkSession, d: str) -> DataFrame:
    """Joins on tokens as on the raw keys: distinct keys are counted first, so that each is hashed once."""

    def tokens(table: str, key: str, n: str) -> DataFrame:
        counted = t(spark, d, table).groupBy(key).agg(F.count(F.lit(1)).alias(n))
        return keyed.with_key(counted, KEY).select(keyed.token(F.col(key), "person").alias("tk"), n)

    both = tokens("orders", "o_custkey", "n").join(tokens("customer", "c_custkey", "m"), "tk")
    return both.agg(F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0)).alias("pairs"), F.count(F.lit(1)).alias("keys"))


# --- D: free text ---------------------------------------------------------------------------



def notes(spark: SparkSession, d: str) -> DataFrame:
    """The documents, most with an identifier more: each type occurs, and URLs that hold a mail address."""
    k = F.col("doc_id")
    more = (
        F.when(k % 6 == 0, F.format_string(" SSN %03d-%02d-%04d", 100 + k % 500, 10 + k % 90, k % 9973))
        .when(k % 6 == 1, F.format_string(" see https://example.org/p/%d?q=1 now", k))
        .when(k % 6 == 2, F.format_string(" or a%d@example.com, +1 212-555-%04d.", k, k % 9973))
        .when(k % 6 == 3, F.format_string(" at https://example.org/u/a%d@example.com/x", k))
        .otherwise("")
    )
    return t(spark, d, "documents").select("doc_id", F.concat("text", more).alias("text"))


# The SQL engine's \b, \d and \s know ASCII only. Classes are widened; for patterns of digits,
# letters are set between two ASCII letters first (and taken out again), so that they bound no
# word. It has no look-ahead either: the areas 000, 666 and 9.. are left out by spelling the others.
_AREAS = r"(?:00[1-9]|0[1-9]\d|[1-578]\d\d|6[0-57-9]\d|66[0-57-9])"
DUCK = {n: p.replace(r"(?!000|666|9\d\d)\d{3}", _AREAS).replace(r"\d", r"\p{Nd}").replace(r"\s", r"\s\x0B\x{85}\p{Z}") for n, p in text.PATTERNS.items()}
DIGITS = ("US_SSN", "PHONE_NUMBER", "CREDIT_CARD", "IP_ADDRESS")


def _marked(x: str) -> str:
    return rf"regexp_replace({x}, '([\p{{L}}\p{{M}}])', 'q\1q', 'g')"


def _unmarked(x: str) -> str:
    return rf"regexp_replace({x}, 'q([\p{{L}}\p{{M}}])q', '\1', 'g')"


def matches_sql(x: str, name: str) -> str:
    return f"regexp_matches({_marked(x) if name in DIGITS else x}, '{DUCK[name]}')"


NOTES = """notes AS (SELECT doc_id, text || CASE doc_id % 6
  WHEN 0 THEN printf(' SSN %03d-%02d-%04d', 100 + doc_id % 500, 10 + doc_id % 90, doc_id % 9973)
  WHEN 1 THEN printf(' see https://example.org/p/%d?q=1 now', doc_id)
  WHEN 2 THEN printf(' or a%d@example.com, +1 212-555-%04d.', doc_id, doc_id % 9973)
  WHEN 3 THEN printf(' at https://example.org/u/a%d@example.com/x', doc_id) ELSE '' END AS text FROM documents)"""
_FOUND = " UNION ALL ".join(
    f"SELECT doc_id, '{n}' AS entity_type, {i} AS ord, regexp_extract_all({x}, '{DUCK[n]}') AS f, string_split_regex({x}, '{DUCK[n]}') AS g FROM marked"
    for i, (n, x) in enumerate((n, "m" if n in DIGITS else "text") for n in text.PATTERNS)
)
_BEFORE = f"list_sum(list_transform(g[1:i], lambda v: length(CASE WHEN entity_type IN {DIGITS} THEN {_unmarked('v')} ELSE v END))) + coalesce(list_sum(list_transform(f[1:i-1], lambda v: length(v))), 0)"
SPANS = f"""{NOTES}, marked AS (SELECT *, {_marked('text')} AS m FROM notes), found AS ({_FOUND}),
spans AS (SELECT doc_id, entity_type, ord, a, a + length(matched) AS b, matched FROM (
  SELECT doc_id, entity_type, ord, ({_BEFORE})::BIGINT AS a, f[i] AS matched FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM found)))"""
MERGED = f"""{SPANS},
runs AS (SELECT *, max(b) OVER (PARTITION BY doc_id ORDER BY a, b DESC, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
grouped AS (SELECT *, sum((reach IS NULL OR a >= reach)::INTEGER) OVER (PARTITION BY doc_id ORDER BY a, b DESC, ord) AS k FROM runs),
merged AS (SELECT doc_id, min(a) AS a, max(b) AS b, first(entity_type ORDER BY a, b DESC, ord) AS entity_type FROM grouped GROUP BY doc_id, k),
placed AS (SELECT m.*, text, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS done FROM merged m JOIN notes USING (doc_id))"""


def _redacted_sql(put: str) -> str:
    return f"""WITH {MERGED},
parts AS (SELECT doc_id, string_agg(substr(text, done + 1, a - done) || {put}, '' ORDER BY a) AS head, max(b) AS b FROM placed GROUP BY doc_id)
SELECT doc_id, md5(coalesce(head, '') || substr(text, coalesce(b, 0) + 1)) AS redacted FROM notes LEFT JOIN parts USING (doc_id)"""


def _hmac_found(key: str = KEY) -> str:
    inner, outer = keyed.pads(key)
    return f"sha256({_blob(outer)} || unhex(sha256({_blob(inner)} || encode('free_text:' || entity_type || chr(31) || substr(text, a + 1, b - a)))))"


_LABEL, _TOKEN = "'[' || entity_type || ']'", f"'[' || entity_type || ':' || left({_hmac_found()}, 12) || ']'"


@query(f"WITH {SPANS} SELECT doc_id, string_agg(entity_type || '@' || a || '-' || b, ' ' ORDER BY a, ord) AS spans FROM spans GROUP BY doc_id")
def text_spans(spark: SparkSession, d: str) -> DataFrame:
    found = text.spread(notes(spark, d)).select("doc_id", text.spans(F.col("text")).alias("s")).where("size(s) > 0")
    shown = F.transform("s", lambda s: F.concat(s["entity_type"], F.lit("@"), s["start"].cast("string"), F.lit("-"), s["end"].cast("string")))
    return found.select("doc_id", F.array_join(shown, " ").alias("spans"))


@query(_redacted_sql(_LABEL))
def redact_label(spark: SparkSession, d: str) -> DataFrame:
    return text.redact_column(notes(spark, d), "text").select("doc_id", F.md5("text").alias("redacted"))


@query(_redacted_sql("''"))
def redact_remove(spark: SparkSession, d: str) -> DataFrame:
    return text.redact_column(notes(spark, d), "text", "remove", output="clean").select("doc_id", F.md5("clean").alias("redacted"))


@query(_redacted_sql(_TOKEN))
def redact_token(spark: SparkSession, d: str) -> DataFrame:
    return text.redact_column(keyed.with_key(text.spread(notes(spark, d)), KEY), "text", "token").select("doc_id", F.md5("text").alias("redacted"))


@query(_redacted_sql(_TOKEN).replace("FROM spans)", "FROM spans WHERE entity_type IN ('US_SSN', 'EMAIL_ADDRESS', 'URL'))", 1))
def redact_rule(spark: SparkSession, d: str) -> DataFrame:
    """Redaction as a column's rule, for some types."""
    rule = {"strategy": "redact_text", "replacement": "token", "entities": ["US_SSN", "EMAIL_ADDRESS", "URL"]}
    safe = rules.deidentify(text.spread(notes(spark, d)), {"doc_id": "passthrough", "text": rule}, KEY)
    return safe.select("doc_id", F.md5("text").alias("redacted"))


@query(f"WITH {SPANS} SELECT entity_type, count(*) AS findings FROM spans GROUP BY entity_type")
def entity_counts(spark: SparkSession, d: str) -> DataFrame:
    return text.count_entities(notes(spark, d), "text")


@query(f"WITH {SPANS} SELECT doc_id, entity_type, a::INTEGER AS start, b::INTEGER AS \"end\", matched FROM spans")
def finding_rows(spark: SparkSession, d: str) -> DataFrame:
    return text.finding_rows(notes(spark, d), "doc_id", "text", include_text=True).drop("score")


# --- E: residual scan and gate --------------------------------------------------------------

def _hits(table: str, columns: tuple[str, ...], head: str = "") -> str:
    cells = (f"SELECT {head}'{c}' AS \"column\", '{n}' AS pattern, count_if({matches_sql(c, e)})::BIGINT AS hits FROM {table}" for c in columns for n, e in residual.RESIDUAL.items())
    return "SELECT * FROM (" + " UNION ALL ".join(cells) + ") WHERE hits > 0"


_FLAGS = ", ".join(f"CASE WHEN {matches_sql('text', e)} THEN '{n}' END" for n, e in residual.RESIDUAL.items())


@query(f"WITH {NOTES} SELECT doc_id, array_to_string(list_filter([{_FLAGS}], lambda x: x IS NOT NULL), ',') AS flags FROM notes")
def residual_flags(spark: SparkSession, d: str) -> DataFrame:
    return notes(spark, d).select("doc_id", F.array_join(residual.flags(F.col("text")), ",").alias("flags"))


@query(_hits("documents", ("text", "lang", "source")))
def residual_scan(spark: SparkSession, d: str) -> DataFrame:
    return residual.scan(t(spark, d, "documents"))


_LAYER = " UNION ALL ".join("SELECT * FROM (" + _hits(n, c, f"'{n}' AS \"table\", ") + ")" for n, c in (("documents", ("text", "lang", "source")), ("conversations", ("role", "text")), ("customer", ("c_name", "c_mktsegment"))))


def _layer(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {n: t(spark, d, n) for n in ("documents", "conversations", "customer")}


@query(f"SELECT pattern, sum(hits)::BIGINT AS hits FROM ({_LAYER}) GROUP BY pattern")
def residual_layer(spark: SparkSession, d: str) -> DataFrame:
    return residual.totals(residual.scan_layer(_layer(spark, d)))


_LEAK = " OR ".join(f"regexp_matches({{c}}, '{p}')" for p in residual.LEAKS)


@query(" UNION ALL ".join(f"SELECT '{n}' AS \"table\", '{c}' AS \"column\", coalesce(bool_or({_LEAK.replace('{c}', c)}), false) AS leaks FROM {n}" for n, cs in (("documents", ("text", "lang", "source")), ("conversations", ("role", "text")), ("customer", ("c_name", "c_mktsegment"))) for c in cs))
def scorecard_leaks(spark: SparkSession, d: str) -> DataFrame:
    return residual.leaky_columns(_layer(spark, d))


_NAMES = "(SELECT unnest(json_keys(to_json(s))) AS c FROM (SELECT * FROM safe LIMIT 1) s)"
_LEAKY = " UNION ALL ".join(f"SELECT 'people.{c}' AS c, coalesce(bool_or({_LEAK.replace('{c}', c)}), false) AS leaks FROM safe" for c in ("mrn", "zip", "segment"))
CARD = f"""SELECT 'tokens carry the prefix' AS "check", count_if(NOT starts_with(mrn, 'PT-')) = 0 AS passed, count_if(NOT starts_with(mrn, 'PT-')) || ' without it' AS detail, false AS advisory FROM safe
UNION ALL SELECT 'years are plausible', count_if(dob < 1900 OR dob > 2100) = 0, count_if(dob < 1900 OR dob > 2100) || ' are not', false FROM safe
UNION ALL SELECT 'ZIPs have three characters', count_if(length(zip) > 3) = 0, count_if(length(zip) > 3) || ' have more', false FROM safe
UNION ALL SELECT 'no column DateOfBirth', count_if(c = 'DateOfBirth') = 0, '', false FROM {_NAMES}
UNION ALL SELECT 'no column zip', count_if(c = 'zip') = 0, '', false FROM {_NAMES}
UNION ALL SELECT 'column dob is there', count_if(c = 'dob') > 0, '', false FROM {_NAMES}
UNION ALL SELECT 'no identifier patterns', count_if(leaks) = 0, coalesce(string_agg(c, ', ' ORDER BY c) FILTER (leaks), ''), false FROM ({_LEAKY})"""


@query(f"WITH {PEOPLE}, {SAFE} SELECT * FROM ({CARD})")
def scorecard(spark: SparkSession, d: str) -> DataFrame:
    safe = safe_people(spark, d)
    return residual.scorecard(safe, {"people": safe}, "mrn", "PT-", "dob", "zip", ("DateOfBirth", "zip"))


_KEPT = {"people": ("customer", "c_custkey % 7 <> 3"), "claims": ("orders", "o_custkey % 5 <> 0"), "providers": ("supplier", "true"), "events": ("events", "true")}
_COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS rows_before, count_if({kept})::BIGINT AS rows_after FROM {source}" for n, (source, kept) in _KEPT.items())
RECONCILED = f"""counted AS ({_COUNTS}), reconciled AS (SELECT *, CASE WHEN rows_before = rows_after THEN 'OK' ELSE 'MISMATCH' END AS state FROM counted)"""


def _reconciled(spark: SparkSession, d: str) -> DataFrame:
    """Four tables before and after a step that lost rows of two."""
    before = {n: t(spark, d, source) for n, (source, _) in _KEPT.items()}
    return residual.reconcile(before, {n: before[n].where(kept) for n, (_, kept) in _KEPT.items()})


@query(f"WITH {RECONCILED} SELECT * FROM reconciled")
def reconcile(spark: SparkSession, d: str) -> DataFrame:
    return _reconciled(spark, d)


@query(f"""WITH {RECONCILED}, totals AS (SELECT (SELECT coalesce(sum(hits), 0) FROM ({_LAYER}))::BIGINT AS residual_hits, (SELECT count(*) FROM reconciled WHERE state <> 'OK') AS mismatches)
SELECT *, residual_hits = 0 AND mismatches = 0 AS publish FROM totals""")
def publish_gate(spark: SparkSession, d: str) -> DataFrame:
    return residual.gate(residual.scan_layer(_layer(spark, d)), _reconciled(spark, d))


@query(f"""WITH {RECONCILED}, kept AS (SELECT * FROM reconciled WHERE "table" IN ('providers', 'events')),
totals AS (SELECT (SELECT coalesce(sum(hits), 0) FROM ({_hits('supplier', ('s_name',))}))::BIGINT AS residual_hits, (SELECT count(*) FROM kept WHERE state <> 'OK') AS mismatches)
SELECT *, residual_hits = 0 AND mismatches = 0 AS publish FROM totals""")
def publish_clean(spark: SparkSession, d: str) -> DataFrame:
    """The gate over tables that are clean and whole."""
    return residual.gate(residual.scan(t(spark, d, "supplier")), _reconciled(spark, d).where(F.col("table").isin("providers", "events")))


# --- F: disclosure risk ---------------------------------------------------------------------

QI, SENSITIVE = ["zip", "age", "segment"], "nation"
RISKY = "risky AS (SELECT left(zip, 1) AS zip, (age // 30)::INTEGER AS age, segment, CASE WHEN nation % 4 <> 0 THEN nation END AS nation FROM people)"
CLASSES = "classes AS (SELECT zip, age, segment, count(*) AS class_size, count(DISTINCT nation) + max((nation IS NULL)::INTEGER) AS n_values FROM risky GROUP BY ALL)"
DISTANCES = """cells AS (SELECT zip, age, segment, nation, count(*) AS n FROM risky GROUP BY ALL), everything AS (SELECT nation, sum(n) AS a FROM cells GROUP BY ALL), sizes AS (SELECT zip, age, segment, sum(n) AS size FROM cells GROUP BY ALL),
grid AS (SELECT s.zip, s.age, s.segment, size, abs(coalesce(c.n, 0) / size - a / (SELECT sum(n) FROM cells)) AS gap FROM sizes s CROSS JOIN everything e LEFT JOIN cells c ON c.zip IS NOT DISTINCT FROM s.zip AND c.age IS NOT DISTINCT FROM s.age AND c.segment IS NOT DISTINCT FROM s.segment AND c.nation IS NOT DISTINCT FROM e.nation),
far AS (SELECT zip, age, segment, max(size)::BIGINT AS class_size, sum(gap) / 2 AS distance FROM grid GROUP BY ALL)"""
_RISK = f"WITH {PEOPLE}, {RISKY}, {CLASSES}"
_NULLS = ", ".join(f"{c} NULLS FIRST" for c in QI)


def risky(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("nation")
    return people(spark, d).select(F.substring("zip", 1, 1).alias("zip"), F.floor(F.col("age") / 30).cast("int").alias("age"), "segment", F.when(n % 4 != 0, n).alias("nation"))


@query(f"{_RISK} SELECT zip, age, segment, class_size FROM classes")
def eq_classes(spark: SparkSession, d: str) -> DataFrame:
    return risk.classes(risky(spark, d), QI)


_K = "SELECT min(class_size) AS k, sum(class_size)::BIGINT AS n_rows, count(*) AS n_classes, count_if(class_size < 5)::BIGINT AS violating_classes, coalesce(sum(class_size) FILTER (class_size < 5), 0)::BIGINT AS violating_rows, min(class_size) >= 5 AS passes FROM classes"


@query(f"{_RISK} {_K}")
def k_anonymity(spark: SparkSession, d: str) -> DataFrame:
    return risk.k_anonymity(risky(spark, d), QI, 5)


@query(f"{_RISK} SELECT class_size, count(*) AS n_classes FROM classes GROUP BY class_size")
def class_histogram(spark: SparkSession, d: str) -> DataFrame:
    return risk.histogram(risky(spark, d), QI)


@query(f"{_RISK} SELECT zip, age, segment, class_size FROM classes ORDER BY class_size, {_NULLS} LIMIT 5")
def smallest_classes(spark: SparkSession, d: str) -> DataFrame:
    return risk.smallest(risky(spark, d), QI, 5)


@query(f"{_RISK} SELECT min(n_values)::BIGINT AS l, count(*) AS n_classes, count_if(n_values < 3)::BIGINT AS violating_classes, coalesce(sum(class_size) FILTER (n_values < 3), 0)::BIGINT AS violating_rows, min(n_values) >= 3 AS passes FROM classes")
def l_diversity(spark: SparkSession, d: str) -> DataFrame:
    return risk.l_diversity(risky(spark, d), QI, SENSITIVE, 3)


@query(f"{_RISK} SELECT zip, age, segment, n_values::BIGINT AS n_values, class_size FROM classes ORDER BY n_values, {_NULLS} LIMIT 5")
def worst_l(spark: SparkSession, d: str) -> DataFrame:
    return risk.least_diverse(risky(spark, d), QI, SENSITIVE, 5)


@query(f"WITH {PEOPLE}, {RISKY}, {DISTANCES} SELECT round(max(distance), 9) AS t, count(*) AS n_classes, count_if(distance > 0.2)::BIGINT AS violating_classes, round(max(distance), 9) <= 0.2 AS passes FROM far")
def t_closeness(spark: SparkSession, d: str) -> DataFrame:
    return risk.t_closeness(risky(spark, d), QI, SENSITIVE, 0.2)


@query(f"WITH {PEOPLE}, {RISKY}, {DISTANCES} SELECT zip, age, segment, round(distance, 9) AS distance, class_size FROM far ORDER BY round(distance, 9) DESC, {_NULLS} LIMIT 5")
def worst_t(spark: SparkSession, d: str) -> DataFrame:
    return risk.most_skewed(risky(spark, d), QI, SENSITIVE, 5)


@query(f"{_RISK} SELECT r.* FROM risky r SEMI JOIN (SELECT * FROM classes WHERE class_size >= 5) c ON r.zip IS NOT DISTINCT FROM c.zip AND r.age IS NOT DISTINCT FROM c.age AND r.segment IS NOT DISTINCT FROM c.segment")
def enforce_k(spark: SparkSession, d: str) -> DataFrame:
    return risk.enforce_k(risky(spark, d), QI, 5)


@query(f"{_RISK} SELECT sum(class_size)::BIGINT AS rows_in, coalesce(sum(class_size) FILTER (class_size >= 15), 0)::BIGINT AS rows_out, count_if(class_size >= 15)::BIGINT AS retained_classes, count_if(class_size < 15)::BIGINT AS dropped_classes, coalesce(sum(class_size) FILTER (class_size < 15), 0)::BIGINT AS suppressed, round(coalesce(sum(class_size) FILTER (class_size < 15), 0) / sum(class_size), 6) AS rate FROM classes")
def suppression_report(spark: SparkSession, d: str) -> DataFrame:
    return risk.suppression_report(risky(spark, d), QI, 15)


@query(f"WITH {PEOPLE}, {RISKY}, {CLASSES}, {DISTANCES}, v AS (SELECT (SELECT min(class_size) >= 5 FROM classes) AS k, (SELECT min(n_values) >= 3 FROM classes) AS l, (SELECT round(max(distance), 9) <= 0.2 FROM far) AS t, (SELECT coalesce(sum(hits), 0) = 0 FROM ({_hits('risky', ('zip', 'segment'))})) AS r) SELECT k AS k_passes, l AS l_passes, t AS t_passes, r AS residual_passes, k AND l AND t AND r AS passes FROM v")
def risk_evidence(spark: SparkSession, d: str) -> DataFrame:
    r = risky(spark, d)
    clean = residual.scan(r).agg((F.coalesce(F.sum("hits"), F.lit(0)) == 0).alias("passes"))
    return risk.evidence(risk.k_anonymity(r, QI, 5), risk.l_diversity(r, QI, SENSITIVE, 3), risk.t_closeness(r, QI, SENSITIVE, 0.2), clean)


# --- G: re-identification and rotation ------------------------------------------------------

WALK = f"walk AS (SELECT patient_key, mrn, dob, {token_sql('mrn', 'mrn', 'PT-')} AS token FROM people)"


def _walk(spark: SparkSession, d: str) -> DataFrame:
    return vault.crosswalk(people(spark, d), "mrn", KEY, ["patient_key", "mrn", "dob"], "mrn", "PT-")


@query(f"WITH {PEOPLE}, {WALK} SELECT * FROM walk")
def crosswalk(spark: SparkSession, d: str) -> DataFrame:
    return _walk(spark, d)


@query(f"""WITH {PEOPLE}, {WALK}, {SAFE}, known AS (SELECT token FROM walk WHERE patient_key % 10 <> 0), seen AS (SELECT DISTINCT mrn AS token FROM safe),
n AS (SELECT (SELECT count(*) FROM seen) AS tokens, (SELECT count(*) FROM seen ANTI JOIN known USING (token)) AS unknown_tokens)
SELECT *, unknown_tokens = 0 AS passes FROM n""")
def crosswalk_parity(spark: SparkSession, d: str) -> DataFrame:
    """A crosswalk that lacks every tenth person."""
    return vault.parity(safe_people(spark, d), _walk(spark, d).where("patient_key % 10 <> 0"), "mrn")


@query(f"WITH {PEOPLE}, {WALK} SELECT token, patient_key, mrn, dob FROM walk WHERE patient_key IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def reidentify(spark: SparkSession, d: str) -> DataFrame:
    asked = keyed.with_key(t(spark, d, "orders").where("o_orderstatus = 'P'").join(t(spark, d, "customer"), F.expr("o_custkey = c_custkey")), KEY)
    return vault.reidentify(asked.select(keyed.token(F.col("c_name"), "mrn", prefix="PT-").alias("token")), _walk(spark, d))


@query(f"WITH {PEOPLE} SELECT patient_key, {token_sql('mrn', 'mrn', 'PT-', key=NEW_KEY)} AS mrn FROM people")
def rotate_tokens(spark: SparkSession, d: str) -> DataFrame:
    moved = vault.rotation(people(spark, d), "mrn", KEY, NEW_KEY, "mrn", "PT-")
    return vault.rekey(safe_people(spark, d).select("patient_key", "mrn"), "mrn", moved)


# --- H: safe star and measures --------------------------------------------------------------


@query(f"WITH {PEOPLE}, {SAFE} SELECT patient_key, mrn, dob AS birth_year, age, zip FROM safe")
def safe_dims(spark: SparkSession, d: str) -> DataFrame:
    safe = safe_people(spark, d)
    return safe.select("patient_key", "mrn", star.year_grain(safe, "dob").alias("birth_year"), "age", "zip")


SHAPES: dict[str, tuple[str, dict]] = {
    "dim_patient": ("people", {"key": "patient_key", "label": "mrn", "place": "zip"}), "dim_provider": ("providers", {"key": "s_suppkey", "label": "s_name", "place": "s_nationkey"}),
    "dim_part": ("parts", {"key": "p_partkey", "label": "p_brand", "place": "p_size"}), "fact_claim": ("claims", {"key": "claim_key", "label": "status", "place": "service_date"}),
}
_SHAPED = f"""
SELECT 'dim_patient' AS "table", patient_key::VARCHAR AS key, {token_sql('mrn', 'mrn', 'PT-')} AS label, {ZIP3_SQL} AS place FROM people
UNION ALL SELECT 'dim_provider', {token_sql('s_suppkey', 'npi', 'NP-')}, {_MADE}, s_nationkey::VARCHAR FROM supplier
UNION ALL SELECT 'dim_part', p_partkey::VARCHAR, p_brand, NULL FROM part
UNION ALL SELECT 'fact_claim', claim_key::VARCHAR, status, year(service_date)::VARCHAR FROM claims"""


@query(f"WITH {PEOPLE}, {CLAIMS} {_SHAPED}")
def safe_layer(spark: SparkSession, d: str) -> DataFrame:
    """The published shapes of several tables at once."""
    shown = star.project(rules.deidentify_layer(layer(spark, d), PROFILES["strict"], KEY), SHAPES)
    return reduce(DataFrame.unionByName, (df.select(F.lit(n).alias("table"), *(F.col(c).cast("string").alias(c) for c in df.columns)) for n, df in shown.items()))


@query("""SELECT 'claims' AS fact, o_orderkey AS fact_key, year(o_orderdate)::INTEGER AS year FROM orders
UNION ALL SELECT 'lines', l_orderkey, year(l_shipdate)::INTEGER FROM lineitem UNION ALL SELECT 'events', event_id, year(ts)::INTEGER FROM events""")
def safe_fact_years(spark: SparkSession, d: str) -> DataFrame:
    """Three facts at year grain, whether their column holds dates or years."""
    facts = {"claims": (t(spark, d, "orders"), "o_orderkey", "o_orderdate"), "lines": (t(spark, d, "lineitem"), "l_orderkey", "l_shipdate"), "events": (t(spark, d, "events").withColumn("ts", F.year("ts")), "event_id", "ts")}
    return reduce(DataFrame.unionByName, (df.select(F.lit(n).alias("fact"), F.col(k).alias("fact_key"), star.year_grain(df, c).alias("year")) for n, (df, k, c) in facts.items()))


@query(f"WITH {CLAIMS} SELECT claim_key, patient_key, year({shift_sql('service_date', 'patient_key')})::INTEGER AS service_year, billed, paid FROM claims")
def safe_facts(spark: SparkSession, d: str) -> DataFrame:
    profile = {c: "passthrough" for c in ("claim_key", "patient_key", "billed", "paid")} | {"service_date": {"strategy": "date_shift", "entity_column": "patient_key"}}
    safe = rules.deidentify(claims(spark, d), profile, KEY)
    return safe.select("claim_key", "patient_key", star.year_grain(safe, "service_date").alias("service_year"), "billed", "paid")


@query(f"WITH {CLAIMS} SELECT round(sum(billed), 2)::DOUBLE AS total_billed, round(sum(paid), 2)::DOUBLE AS total_paid, round(count_if(status = 'F') / count(*), 6) AS denial_rate, count(*) AS n_claims FROM claims")
def kpi_claims(spark: SparkSession, d: str) -> DataFrame:
    out = claims(spark, d).agg(*star.claim_measures("billed", "paid", F.col("status") == "F"))
    return out.withColumns({c: F.col(c).cast("double") for c in ("total_billed", "total_paid")})


@query("SELECT event_type, count(*) AS encounters FROM events GROUP BY event_type")
def kpi_events(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("encounters"))


@query("SELECT user_id, round(avg(value), 6) AS avg_score FROM events GROUP BY user_id")
def kpi_score(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").groupBy("user_id").agg(F.round(F.avg("value"), 6).alias("avg_score"))


_R = star.Relationship
STAR = [  # the customer's nation is active, the supplier's a second role
    _R("order", "l_orderkey", "orders", "o_orderkey"), _R("customer", "o_custkey", "customer", "c_custkey"), _R("nation", "customer_c_nationkey", "nation", "n_nationkey"),
    _R("region", "nation_n_regionkey", "region", "r_regionkey"), _R("supplier", "l_suppkey", "supplier", "s_suppkey"),
    _R("supplier_nation", "supplier_s_nationkey", "nation", "n_nationkey", active=False),
]


@query("SELECT r_name, count(*) AS n_orders, round(sum(o_totalprice), 0) AS billed FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def star_by_region(spark: SparkSession, d: str) -> DataFrame:
    j = star.star_join(t(spark, d, "orders"), {n: t(spark, d, n) for n in ("customer", "nation", "region")}, STAR[1:4])
    return j.groupBy(F.col("region_r_name").alias("r_name")).agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 0).alias("billed"))


@query("SELECT a.n_name AS customer_nation, b.n_name AS supplier_nation, count(*) AS n_lines FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation a ON c_nationkey = a.n_nationkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation b ON s_nationkey = b.n_nationkey GROUP BY ALL")
def star_role_playing(spark: SparkSession, d: str) -> DataFrame:
    links = [_R(r.role, "order_o_custkey" if r.role == "customer" else r.from_column, r.dimension, r.to_column, r.active) for r in STAR if r.role != "region"]
    j = star.star_join(t(spark, d, "lineitem"), {n: t(spark, d, n) for n in ("orders", "customer", "nation", "supplier")}, links, ("supplier_nation",))
    return j.groupBy(F.col("nation_n_name").alias("customer_nation"), F.col("supplier_nation_n_name").alias("supplier_nation")).agg(F.count(F.lit(1)).alias("n_lines"))


@query(f"WITH {PEOPLE}, {SAFE} SELECT zip, age, segment, count(*) AS n_people FROM safe GROUP BY ALL")
def roster(spark: SparkSession, d: str) -> DataFrame:
    return safe_people(spark, d).groupBy("zip", "age", "segment").agg(F.count(F.lit(1)).alias("n_people"))


@query(f"WITH {PEOPLE}, {SAFE} SELECT patient_key, p.mrn AS mrn_before, p.zip AS zip_before, p.age AS age_before, s.mrn AS mrn_after, s.zip AS zip_after, s.age::VARCHAR AS age_after FROM people p JOIN safe s USING (patient_key)")
def before_after(spark: SparkSession, d: str) -> DataFrame:
    return star.before_after(people(spark, d), safe_people(spark, d), "patient_key", ["mrn", "zip", "age"])


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def rls_region(spark: SparkSession, d: str) -> DataFrame:
    mapping = t(spark, d, "nation").select(F.concat(F.lit("analyst_"), F.col("n_regionkey").cast("string")).alias("principal"), F.col("n_nationkey").alias("region"))
    return star.scoped_rows(t(spark, d, "customer"), mapping, "analyst_1", "c_nationkey", ("steward",)).select("c_custkey", "c_nationkey")


@query(f"WITH {PEOPLE}, {SAFE} SELECT * EXCLUDE (mrn) FROM safe")
def cls_columns(spark: SparkSession, d: str) -> DataFrame:
    return star.scoped_columns(safe_people(spark, d), "analyst", {"analyst": ("mrn",)})


# --- I: detector quality --------------------------------------------------------------------

_RATES = "round(coalesce(tp / nullif(tp + fp, 0), 1.0), 4) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 1.0), 4) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 1.0), 4) AS f1, tp + fn AS support"
_FLAGGED = " OR ".join(matches_sql("text", n) for n in DUCK)


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    return text.spread(t(spark, d, "documents")).select("doc_id", text.any_entity(F.col("text")).alias("flagged"))


@query(f"WITH p AS (SELECT doc_id FROM documents WHERE {_FLAGGED}), g AS (SELECT doc_id FROM labels WHERE toxic = 1), c AS (SELECT (SELECT count(*) FROM p SEMI JOIN g USING (doc_id)) AS tp, (SELECT count(*) FROM p ANTI JOIN g USING (doc_id)) AS fp, (SELECT count(*) FROM g ANTI JOIN p USING (doc_id)) AS fn) SELECT tp, fp, fn, {_RATES} FROM c")
def eval_sets(spark: SparkSession, d: str) -> DataFrame:
    return quality.evaluate_sets(_flagged(spark, d).where("flagged"), t(spark, d, "labels").where("toxic = 1"), ["doc_id"])


@query(f"WITH b AS (SELECT ({_FLAGGED}) AS p, quality = 0 AS g FROM documents JOIN labels USING (doc_id)), c AS (SELECT count_if(p AND g)::BIGINT AS tp, count_if(p AND NOT g)::BIGINT AS fp, count_if(NOT p AND g)::BIGINT AS fn FROM b) SELECT tp, fp, fn, {_RATES} FROM c")
def eval_flags(spark: SparkSession, d: str) -> DataFrame:
    both = _flagged(spark, d).join(t(spark, d, "labels"), "doc_id")
    return quality.evaluate_flags(both, F.col("flagged"), F.col("quality") == 0)


_COMMON = "greatest(0, least(p[i + 1].b, g[j].b) - greatest(p[i + 1].a, g[j].a))"
_SHARE = f"CASE WHEN p[i + 1].t = g[j].t THEN {_COMMON} / ((p[i + 1].b - p[i + 1].a) + (g[j].b - g[j].a) - {_COMMON}) ELSE -1 END"
_BEST = f"list_sort(list_filter(list_transform(range(1, len(g) + 1), lambda j: {{'s': -({_SHARE}), 'i': j}}), lambda c: c.s <= -0.5 AND NOT list_contains(used, c.i)))[1]"


@query(f"""WITH RECURSIVE {SPANS},
predicted AS (SELECT doc_id, list({{'a': a, 'b': b, 't': entity_type}} ORDER BY a, b, entity_type) AS p FROM spans GROUP BY doc_id),
golden AS (SELECT doc_id, list({{'a': a + doc_id % 3, 'b': b + 1, 't': entity_type}} ORDER BY a + doc_id % 3, b, entity_type) AS g FROM spans WHERE entity_type <> 'CREDIT_CARD' GROUP BY doc_id),
step AS (SELECT doc_id, p, coalesce(g, []) AS g, 0 AS i, []::BIGINT[] AS used FROM predicted LEFT JOIN golden USING (doc_id)
  UNION ALL SELECT doc_id, p, g, i + 1, CASE WHEN best IS NULL THEN used ELSE list_append(used, best.i) END FROM (SELECT *, {_BEST} AS best FROM step WHERE i < len(p))),
c AS (SELECT sum(len(used))::BIGINT AS tp, sum(len(p) - len(used))::BIGINT AS fp, sum(len(g) - len(used))::BIGINT AS fn FROM step WHERE i = len(p))
SELECT tp, fp, fn, {_RATES} FROM c""")
def eval_spans(spark: SparkSession, d: str) -> DataFrame:
    """The findings against themselves, moved a little and without cards."""
    found = text.finding_rows(notes(spark, d), "doc_id", "text")
    moved = found.withColumns({"start": F.col("start") + (F.col("doc_id") % 3).cast("int"), "end": F.col("end") + 1})
    return quality.evaluate_spans(found, moved.where("entity_type <> 'CREDIT_CARD'"), "doc_id")


# --- J: audit -------------------------------------------------------------------------------


LEDGER = {"people": ("passthrough", 3, "generalize", 3, "suppress", 1, "tokenize", 1), "claims": ("passthrough", 2, "suppress", 6)}
_USED = {n: "{" + ",".join(f'"{u[i]}":{u[i + 1]}' for i in sorted(range(0, len(u), 2), key=lambda i: u[i])) + "}" for n, u in LEDGER.items()}
_BOOKS: dict[str, dict[str, rules.Rule]] = {"people": STRICT, "claims": {"claim_key": "passthrough", "patient_key": "passthrough"}}
_BOOKED = " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS rows_in, count(*) AS rows_out, '{_USED[n]}' AS strategies, '{ledger.rules_hash(_BOOKS)}' AS rules_hash, 'v1' AS key_version, 'pipeline' AS actor FROM {source}"
    for n, source in (("people", "customer"), ("claims", "orders"))
)


@query(_BOOKED)
def run_ledger(spark: SparkSession, d: str) -> DataFrame:
    before = {"people": people(spark, d), "claims": claims(spark, d)}
    after = {n: rules.deidentify(df, _BOOKS[n], KEY) for n, df in before.items()}
    counts = residual.reconcile(before, after).select("table", F.col("rows_before").alias("rows_in"), F.col("rows_after").alias("rows_out"))
    return ledger.run_rows(counts, _BOOKS, {n: df.columns for n, df in before.items()}, "pipeline", "v1", datetime(2025, 1, 1)).drop("at")


_CELLS = " UNION ALL ".join(f"SELECT '{c}' AS c, count(*) AS n_rows, count({c}) AS n_known FROM people" for c in ("patient_key", "mrn", "zip", "age", "dob", "segment", "nation", "balance"))


@query(f"""WITH {PEOPLE}, live AS ({_CELLS}), ruled AS (SELECT unnest([{', '.join(repr(c) for c in (*STRICT, 'gender'))}]) AS c)
SELECT 'people' AS "table", c AS "column", CASE WHEN n_rows IS NULL THEN 'missing' WHEN ruled.c IS NULL THEN 'defaulted' ELSE 'classified' END AS state, n_rows, n_known
FROM live FULL JOIN ruled USING (c)""")
def coverage(spark: SparkSession, d: str) -> DataFrame:
    """What the rules say of each column, with its rows and known values."""
    live = rules.column_counts({"people": people(spark, d).withColumn("_ingested_at", F.current_timestamp())})
    return rules.coverage(live, rules.columns_frame(spark, {"people": [*STRICT, "gender"]}))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN TIMESTAMP '1998-01-01' >= o_orderdate END AS expired FROM orders")
def expired(spark: SparkSession, d: str) -> DataFrame:
    due = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate").cast("string"))
    return t(spark, d, "orders").select("o_orderkey", ledger.expired(due, F.lit("1998-01-01").cast("timestamp")).alias("expired"))


# --- K: synthetic load ----------------------------------------------------------------------


def draw_sql(seed: int, name: str, below: str | int) -> str:
    return f"(('0x' || left(md5('{seed}|{name}|' || id), 15))::BIGINT % {below})"


def laid_out_sql(values: str, value: str, weight: str) -> str:
    return f"SELECT *, sum({weight}) OVER (ORDER BY left(md5({value}::VARCHAR), 2), {value}) AS high FROM ({values})"


def pool_sql(table: str, column: str) -> str:
    weights = f"SELECT {column} AS value, least(count(*), 50)::BIGINT AS weight FROM {table} WHERE trim({column}::VARCHAR) <> '' GROUP BY {column}"
    return f"SELECT value, weight, (high - weight)::BIGINT AS low, high::BIGINT AS high FROM ({laid_out_sql(weights, 'value', 'weight')})"


def made_sql(existing: str, key: str, seed: int, keys: dict[str, tuple[str, str]], pools: dict[str, tuple[str, str]], columns: str) -> str:
    """Rows of a generator: numbered, with foreign keys and pool values joined by their draws."""
    parts = [f"base AS (SELECT i AS id, (SELECT coalesce(max({key}), 0) FROM {existing}) + i + 1 AS new_key FROM range((SELECT count(*) FROM {existing})) r(i))"]
    joins, shown = [], []
    for name, (table, column) in keys.items():
        parts.append(f"k_{name} AS ({laid_out_sql(f'SELECT DISTINCT {column} AS value, 1 AS one FROM {table} WHERE {column} IS NOT NULL', 'value', 'one')})")
        joins.append(f'LEFT JOIN k_{name} ON k_{name}.high - 1 = {draw_sql(seed, name, f"(SELECT count(*) FROM k_{name})")}')
        shown.append(f'k_{name}.value AS "{name}"')
    for name, (table, column) in pools.items():
        parts.append(f"p_{name} AS ({pool_sql(table, column)})")
        drawn = draw_sql(seed, name, f"(SELECT max(high) FROM p_{name})")
        joins.append(f"LEFT JOIN p_{name} ON {drawn} >= p_{name}.low AND {drawn} < p_{name}.high")
        shown.append(f'p_{name}.value AS "{name}"')
    return f"WITH {PEOPLE}, {', '.join(parts)}, made AS (SELECT id, new_key, {', '.join(shown)} FROM base {' '.join(joins)}) SELECT {columns} FROM made"


def day_sql(seed: int, name: str, span: tuple) -> str:
    return f"(DATE '{span[0]}' + {draw_sql(seed, name, (span[1] - span[0]).days + 1)}::INTEGER)::DATE"


def _sources(spark: SparkSession, d: str, keys: dict[str, tuple[str, str]]) -> dict[str, synth.ForeignKey]:
    return {name: (people(spark, d) if table == "people" else t(spark, d, table), column) for name, (table, column) in keys.items()}


@query(pool_sql("part", "p_brand"))
def gen_pool(spark: SparkSession, d: str) -> DataFrame:
    return synth.pool(t(spark, d, "part"), "p_brand")


_P_KEYS, _P_POOLS = {"PCPProviderKey": ("supplier", "s_suppkey")}, {"Gender": ("people", "segment"), "Race": ("part", "p_brand"), "Ethnicity": ("part", "p_size"), "ZIP": ("people", "zip")}
_FIRST, _LAST = (f"{_list(v)}[{draw_sql(42, n, 16)} + 1]" for n, v in (("FirstName", strategies.FIRST_NAMES), ("LastName", strategies.LAST_NAMES)))


@query(made_sql("customer", "c_custkey", 42, _P_KEYS, _P_POOLS, f"""new_key AS "PatientKey", new_key + 500000 AS "PatientDurableKey", printf('MRN%08d', new_key) AS "MRN",
{_FIRST} AS "FirstName", {_LAST} AS "LastName", {_FIRST} || ' ' || {_LAST} AS "PatientName", {day_sql(42, 'DateOfBirth', synth.BORN)} AS "DateOfBirth",
"Gender", "Race", "Ethnicity", "ZIP", "PCPProviderKey", true AS "_IsCurrent", DATE '2015-01-01' AS "EffectiveDate", DATE '9999-12-31' AS "ExpirationDate" """))
def gen_patients(spark: SparkSession, d: str) -> DataFrame:
    pools = {name: synth.pool(source, column) for name, (source, column) in _sources(spark, d, _P_POOLS).items()}
    return synth.patients(t(spark, d, "customer"), "c_custkey", pools, (t(spark, d, "supplier"), "s_suppkey"))


_C_KEYS = {
    "PatientKey": ("customer", "c_custkey"), "BillingProviderKey": ("supplier", "s_suppkey"), "RenderingProviderKey": ("supplier", "s_suppkey"),
    "PayerKey": ("nation", "n_nationkey"), "ProcedureKey": ("part", "p_partkey"), "DiagnosisKey": ("part", "p_size"),
}
_STATUS = "(SELECT CASE o_orderstatus WHEN 'F' THEN 'Paid' WHEN 'O' THEN 'Denied' ELSE 'Pending' END AS status FROM orders)"
_BILLED = f"(7500 + {draw_sql(43, 'BilledAmount', 512501)})"
_ALLOWED = f"(({_BILLED} * (450000 + {draw_sql(43, 'AllowedAmount', 450001)}) + 500000) // 1000000)"
_PAID = f"""(CASE WHEN lower("ClaimStatus") = 'paid' THEN {_ALLOWED} ELSE ({_ALLOWED} * {draw_sql(43, 'PaidAmount', 800001)} + 500000) // 1000000 END)"""
_CENTS = ", ".join(f'({x} / 100)::DECIMAL(12,2) AS "{n}"' for n, x in (("BilledAmount", _BILLED), ("AllowedAmount", _ALLOWED), ("PaidAmount", _PAID)))


@query(made_sql("orders", "o_orderkey", 43, _C_KEYS, {"ClaimStatus": (_STATUS, "status")}, f"""new_key AS "ClaimKey", {', '.join(f'"{k}"' for k in _C_KEYS)}, {day_sql(43, 'ServiceDate', synth.SERVED)} AS "ServiceDate", {_CENTS}, "ClaimStatus" """))
def gen_claims(spark: SparkSession, d: str) -> DataFrame:
    o, s = t(spark, d, "orders"), F.col("o_orderstatus")
    status = o.select(F.when(s == "F", "Paid").when(s == "O", "Denied").otherwise("Pending").alias("status"))
    return synth.claims(o, "o_orderkey", _sources(spark, d, _C_KEYS), synth.pool(status, "status"))


_E_KEYS = {
    "PatientKey": ("customer", "c_custkey"), "AttendingProviderKey": ("supplier", "s_suppkey"), "ReferringProviderKey": ("supplier", "s_suppkey"),
    "DepartmentKey": ("nation", "n_nationkey"), "LocationKey": ("region", "r_regionkey"), "DiagnosisKey": ("part", "p_size"),
}
_TYPE = "(SELECT CASE event_type WHEN 'click' THEN 'Inpatient' ELSE event_type END AS kind FROM events)"


@query(made_sql("events", "event_id", 44, _E_KEYS, {"EncounterType": (_TYPE, "kind")}, f"""new_key AS "EncounterKey", "PatientKey", "AttendingProviderKey",
CASE WHEN {draw_sql(44, 'referred', 5)} >= 2 THEN "ReferringProviderKey" END AS "ReferringProviderKey", "DepartmentKey", "LocationKey", "DiagnosisKey", {day_sql(44, 'EncounterDate', synth.SERVED)} AS "EncounterDate",
"EncounterType", (CASE WHEN lower("EncounterType") = 'inpatient' THEN {draw_sql(44, 'LengthOfStay', 14)} + 1 ELSE 0 END)::INTEGER AS "LengthOfStay" """))
def gen_encounters(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events")
    kinds = e.select(F.when(F.col("event_type") == "click", "Inpatient").otherwise(F.col("event_type")).alias("kind"))
    return synth.encounters(e, "event_id", _sources(spark, d, _E_KEYS), synth.pool(kinds, "kind"))


_R_KEYS = {"PatientKey": ("customer", "c_custkey"), "ProviderKey": ("supplier", "s_suppkey")}


@query(made_sql("events", "event_id", 45, _R_KEYS, {"RiskModel": ("events", "event_type")}, f"""new_key AS "RiskScoreKey", "PatientKey", "ProviderKey", "RiskModel",
(100 + {draw_sql(45, 'RiskScore', 2401)}) / 1000 AS "RiskScore", {day_sql(45, 'ScoreDate', synth.SERVED)} AS "ScoreDate" """))
def gen_risk(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events")
    return synth.risk_scores(e, "event_id", _sources(spark, d, _R_KEYS), synth.pool(e, "event_type"))


from . import mechanism_queries  # noqa: E402, F401  registers its queries with the ones above
