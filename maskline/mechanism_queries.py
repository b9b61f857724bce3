"""Registered queries of monitors, lattices, linkage, versions and contents, each with SQL that gives the same rows."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalog_queries as base
from .catalog_queries import PEOPLE, matches_sql, people, query, t
from .functions import keyed
from .operators import contents, lattice, ledger, linkage, prefilter, residual, risk, synth, tokenfilter, vault, versions
from .plans import nested
from .sources import layout, scratch
from .streaming import monitor

# --- streams -------------------------------------------------------------------------------

_STREAM_QI = ["event_type", "weekday", "value"]
_STREAMED = "streamed AS (SELECT ts, event_type, isodow(ts)::INTEGER AS weekday, floor(value / 10)::BIGINT AS value FROM events)"


def streamed(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events")
    return e.select("ts", "event_type", (F.weekday("ts") + 1).alias("weekday"), F.floor(F.col("value") / 10).alias("value"))


@query(f"""WITH {_STREAMED}, classes AS (SELECT count(*) AS n FROM streamed GROUP BY event_type, weekday, value)
SELECT min(n) AS k, sum(n)::BIGINT AS n_rows, count(*) AS n_classes, count_if(n < 5)::BIGINT AS violating_classes,
coalesce(sum(n) FILTER (n < 5), 0)::BIGINT AS violating_rows, min(n) >= 5 AS passes FROM classes""")
def stream_k_anonymity(spark: SparkSession, d: str) -> DataFrame:
    """The verdict after the last of four micro-batches."""
    rows, root = streamed(spark, d), scratch.folder(spark, "stream")
    watch = monitor.ClassMonitor(root, rows.schema, _STREAM_QI)
    watch.start(monitor.arriving(rows, f"{root}/in", F.col("ts"), 4)).awaitTermination()
    watch.compact(spark)
    return watch.verdict(spark, 5)


_ARRIVED = "SELECT text, date_trunc('day', to_timestamp(doc_id * 3600) AT TIME ZONE 'UTC') AS day FROM documents"


_HELD = ", ".join(f"count_if({matches_sql('text', e)})::BIGINT AS {n}" for n, e in residual.RESIDUAL.items())


@query(f"WITH arrived AS ({_ARRIVED}) SELECT day::DATE AS day, count(*) AS n_rows, {_HELD} FROM arrived GROUP BY day")
def stream_residual(spark: SparkSession, d: str) -> DataFrame:
    """Residual identifiers by day of arrival, an hour between documents, from four micro-batches."""
    rows, root = t(spark, d, "documents").select(F.timestamp_seconds(F.col("doc_id") * 3600).alias("at"), "text"), scratch.folder(spark, "stream")
    watch = monitor.ResidualMonitor(root, "at", "text")
    watch.start(monitor.arriving(rows, f"{root}/in", F.col("at"), 4)).awaitTermination()
    return watch.windows(spark).select(F.col("window_start").cast("date").alias("day"), "n_rows", "ssn", "phone", "email")


# --- risk ----------------------------------------------------------------------------------

_PLACES = {"place": ["nation", "region"], "segment": ["segment"], "age": ["decade", "generation"]}


@query(f"""WITH {PEOPLE}, r AS (SELECT nation, n_regionkey AS region, segment, (age // 10)::INTEGER AS decade, (age // 30)::INTEGER AS generation FROM people JOIN nation ON n_nationkey = nation),
grid AS (SELECT p, s, a FROM range(3) x(p), range(2) y(s), range(3) z(a)),
cells AS (SELECT p, s, a, count(*) AS n FROM r, grid GROUP BY p, s, a, CASE p WHEN 0 THEN nation WHEN 1 THEN region ELSE -1 END, CASE s WHEN 0 THEN segment ELSE '*' END, CASE a WHEN 0 THEN decade WHEN 1 THEN generation ELSE -1 END),
each AS (SELECT p, s, a, min(n) AS least, count(*) AS classes, coalesce(sum(n) FILTER (n < 5), 0)::BIGINT AS risk FROM cells GROUP BY p, s, a),
found AS (SELECT *, EXISTS (FROM each f WHERE f.p <= e.p AND f.s <= e.s AND f.a <= e.a AND (f.p < e.p OR f.s < e.s OR f.a < e.a) AND f.risk = 0) AS above FROM each e)
SELECT p::INTEGER AS place_level, s::INTEGER AS segment_level, a::INTEGER AS age_level, CASE WHEN NOT above THEN least END AS min_class, CASE WHEN NOT above THEN classes END AS n_classes,
CASE WHEN NOT above THEN risk END AS at_risk, risk = 0 AS safe, risk = 0 AND NOT above AS minimal FROM found""")
def qi_lattice(spark: SparkSession, d: str) -> DataFrame:
    nation = t(spark, d, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("region"))
    rows = people(spark, d).join(nation, "nation").select("nation", "region", "segment", F.floor(F.col("age") / 10).alias("decade"), F.floor(F.col("age") / 30).alias("generation"))
    return lattice.lattice(rows, _PLACES, 5)


@query("""WITH e AS (SELECT DISTINCT o_custkey AS person, o_orderstatus AS kind, o_orderdate::DATE AS day FROM orders),
p AS (SELECT person, kind AS a, lead(kind) OVER w AS b, lead(day) OVER w - day AS gap, day FROM e WINDOW w AS (PARTITION BY person ORDER BY day, kind)),
s AS (SELECT DISTINCT * FROM p WHERE gap <= 30),
c AS (SELECT x.person, x.a, x.b, x.gap, x.day, count(DISTINCT y.person) FILTER (y.day = x.day) AS before, count(DISTINCT y.person) AS after
  FROM s x JOIN s y ON x.a = y.a AND x.b = y.b AND x.gap = y.gap AND abs(x.day - y.day) <= 90 GROUP BY ALL)
SELECT person AS o_custkey, count(*) AS n_sequences, min(before) AS before, min(after) AS after FROM c GROUP BY person""")
def linkage_risk(spark: SparkSession, d: str) -> DataFrame:
    """Two orders within thirty days, before and after a shift by up to ninety."""
    return linkage.linkage_risk(t(spark, d, "orders"), "o_custkey", "o_orderstatus", "o_orderdate", 30, 90)


# --- versions and contents -----------------------------------------------------------------

_VERSIONS = """versions AS (SELECT o_custkey AS person, min(o_orderdate)::DATE AS begins, min(o_orderdate)::DATE + 180 AS ends, max(o_orderpriority) AS grade FROM orders GROUP BY o_custkey, year(o_orderdate))"""


@query(f"""WITH {_VERSIONS}
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate::DATE <= ends THEN grade END AS grade, CASE WHEN o_orderdate::DATE <= ends THEN begins END AS valid_begins
FROM orders ASOF LEFT JOIN versions ON o_custkey = person AND o_orderdate::DATE >= begins""")
def versions_as_of(spark: SparkSession, d: str) -> DataFrame:
    """Orders with the grade that their customer had on the day."""
    o = t(spark, d, "orders")
    first = F.min(F.col("o_orderdate").cast("date"))
    grades = o.groupBy(F.col("o_custkey").alias("person"), F.year("o_orderdate").alias("y")).agg(first.alias("begins"), F.date_add(first, 180).alias("ends"), F.max("o_orderpriority").alias("grade"))
    return versions.as_of(o.select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey", "o_orderdate", grades, "person", "begins", "ends", ["grade"]).drop("o_orderdate")


_CHANGED = "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity = 7 THEN 8 ELSE l_quantity END AS l_quantity, l_returnflag FROM lineitem"
_LINES = "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem"


@query(f"""WITH a AS ({_LINES}), b AS ({_CHANGED} UNION ALL {_LINES} WHERE l_quantity = 50)
SELECT 'before' AS side, count(*) AS copies, * FROM (FROM a EXCEPT ALL FROM b) GROUP BY ALL UNION ALL SELECT 'after', count(*), * FROM (FROM b EXCEPT ALL FROM a) GROUP BY ALL""")
def content_difference(spark: SparkSession, d: str) -> DataFrame:
    """Line items against a copy in which some quantities changed and some rows came twice."""
    a = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    b = a.withColumn("l_quantity", F.when(F.col("l_quantity") == 7, 8.0).otherwise(F.col("l_quantity"))).unionByName(a.where("l_quantity = 50"))
    return contents.difference(a, b)


@query(f"WITH a AS ({_LINES}), b AS ({_CHANGED}) SELECT (SELECT count(*) FROM (FROM a EXCEPT ALL FROM b)) AS only_before, (SELECT count(*) FROM (FROM b EXCEPT ALL FROM a)) AS only_after, (SELECT count(*) FROM a) = (SELECT count(*) FROM b) AS same_count")
def content_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Two layers whose row counts agree, and whose rows do not."""
    a = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    b = a.withColumn("l_quantity", F.when(F.col("l_quantity") == 7, 8.0).otherwise(F.col("l_quantity")))
    sides = contents.difference(a, b).agg(*(F.coalesce(F.sum(F.when(F.col("side") == s, F.col("copies"))), F.lit(0)).alias(f"only_{s}") for s in ("before", "after")))
    return sides.withColumn("same_count", F.col("only_before") == F.col("only_after"))


# --- the whole scorecard, and facts over new patients --------------------------------------

_ON = ", ".join(base.QI)
_CARD = f"""WITH {base.PEOPLE}, {base.SAFE}, {base.RISKY}, {base.CLASSES}, {base.DISTANCES}, card AS ({base.CARD}
UNION ALL SELECT 'k-anonymity of at least 5 on {_ON}', min(class_size) >= 5, 'k=' || min(class_size) || '; ' || coalesce(sum(class_size) FILTER (class_size < 5), 0)::BIGINT || ' rows in ' || count_if(class_size < 5) || ' classes', true FROM classes
UNION ALL SELECT 'l-diversity of at least 2 for nation', min(n_values) >= 2, 'l=' || min(n_values) || '; ' || coalesce(sum(class_size) FILTER (n_values < 2), 0)::BIGINT || ' rows in ' || count_if(n_values < 2) || ' classes', true FROM classes
UNION ALL SELECT 't-closeness of at most 0.2 for nation', round(max(distance), 9) <= 0.2, 't=' || printf('%.3f', round(max(distance), 9)) || ' over ' || count_if(distance > 0.2) || ' classes', true FROM far
UNION ALL SELECT 'determination not expired', false, 'method safe harbor, review by 2025-01-01T00:00:00', true)"""


def _card(spark: SparkSession, d: str) -> DataFrame:
    safe = base.safe_people(spark, d)
    more = (risk.advisory(base.risky(spark, d), base.QI, base.SENSITIVE, 5, 2, 0.2), ledger.expiry_row(spark, datetime(2025, 1, 1), datetime(2026, 1, 1), "safe harbor"))
    return residual.scorecard(safe, {"people": safe}, "mrn", "PT-", "dob", "zip", ("DateOfBirth", "zip"), more)


@query(f"{_CARD} SELECT * FROM card")
def scorecard_full(spark: SparkSession, d: str) -> DataFrame:
    """Hard checks and advisory ones: k, l, t and expiry."""
    return _card(spark, d)


@query(f"{_CARD} SELECT bool_and(passed) FILTER (NOT advisory) AS passed, count(*) AS checks, count_if(advisory AND NOT passed)::BIGINT AS advisory_failures FROM card")
def scorecard_verdict(spark: SparkSession, d: str) -> DataFrame:
    """Advisory checks fail here and don't block."""
    return residual.verdict(_card(spark, d))


_NEW = "(SELECT c_custkey FROM customer UNION ALL SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER () AS c_custkey FROM customer)"
_GROWN = {"PatientKey": (_NEW, "c_custkey"), "ProviderKey": ("supplier", "s_suppkey")}


@query(base.made_sql("events", "event_id", 45, _GROWN, {"RiskModel": ("events", "event_type")}, f"""new_key AS "RiskScoreKey", "PatientKey", "ProviderKey", "RiskModel",
(100 + {base.draw_sql(45, 'RiskScore', 2401)}) / 1000 AS "RiskScore", {base.day_sql(45, 'ScoreDate', synth.SERVED)} AS "ScoreDate" """))
def gen_risk_grown(spark: SparkSession, d: str) -> DataFrame:
    """Patients are added first; new scores then draw from old and new patients."""
    e, c = t(spark, d, "events"), t(spark, d, "customer")
    everyone = c.select("c_custkey").unionByName(synth.new_rows(c, "c_custkey", "PatientKey").select(F.col("PatientKey").alias("c_custkey")))
    return synth.risk_scores(e, "event_id", {"PatientKey": (everyone, "c_custkey"), "ProviderKey": (t(spark, d, "supplier"), "s_suppkey")}, synth.pool(e, "event_type"))


# --- nested data and sketches --------------------------------------------------------------

_BY_PATH = {
    "doc_id": "passthrough",
    "record.number": {"strategy": "tokenize", "namespace": "mrn", "prefix": "PT-"},
    "record.site": "passthrough",
    "lines[].body": {"strategy": "tokenize", "namespace": "line", "length": 8},
    "lines[].size": "passthrough",
    "attrs{key}": {"strategy": "tokenize", "namespace": "attr"},
    "attrs{}.held": {"strategy": "generalize", "kind": "age_cap", "cap": 2},
}
_LINE = f"CASE WHEN x = '' THEN x ELSE {base.token_sql('x', 'line', length=8)} END"


@query(f"""SELECT doc_id, {base.token_sql('doc_id', 'mrn', 'PT-')} AS number, source AS site, NULL::VARCHAR AS n_chars,
array_to_string(list_transform(string_split(text, chr(10)), lambda x: {_LINE}), ' ') AS lines, (length(text) - length(replace(text, chr(10), '')) + 1)::INTEGER AS n_lines,
{base.token_sql("'lang'", 'attr')} AS key, least(length(lang), 2)::INTEGER AS held, NULL::VARCHAR AS lang FROM documents""")
def nested_rules(spark: SparkSession, d: str) -> DataFrame:
    """Documents as records of structs, arrays and maps, by rules of paths; shown flat."""
    line = lambda x: F.struct(x.alias("body"), F.length(x).alias("size"))
    rows = t(spark, d, "documents").select(
        "doc_id",
        F.struct(F.col("doc_id").alias("number"), F.col("source").alias("site"), "n_chars").alias("record"),
        F.transform(F.split("text", "\n"), line).alias("lines"),
        F.create_map(F.lit("lang"), F.struct(F.length("lang").alias("held"), F.col("lang").alias("name"))).alias("attrs"),
    )
    safe = nested.deidentify(rows, _BY_PATH, base.KEY)
    key = F.map_keys("attrs")[0]
    shown = F.col("attrs")[key]
    return safe.select("doc_id", "record.*", F.array_join("lines.body", " ").alias("lines"), F.when(F.col("lines").isNotNull(), F.size("lines")).alias("n_lines"), key.alias("key"), shown["held"].alias("held"), shown["name"].alias("lang"))


@query(f"""SELECT event_id, '{{"who":{{"id":"' || {base.token_sql('user_id', 'user')} || '"}},"k":[' || (props->>'$.k') || ']}}' AS seen, '{{"k":"' || {base.token_sql("(props->>'$.k')", 'k')} || '"}}' AS props, NULL::VARCHAR AS event_type FROM events""")
def nested_json(spark: SparkSession, d: str) -> DataFrame:
    """Events whose JSON text is rewritten inside: a plain object, and a nested one made from the row."""
    k = F.get_json_object("props", "$.k").cast("int")
    made = F.to_json(F.struct(F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("name")).alias("who"), F.array(k).alias("k")))
    rows = t(spark, d, "events").select("event_id", made.alias("seen"), "props", "event_type")
    by_path = {"event_id": "passthrough", "seen.who.id": {"strategy": "tokenize", "namespace": "user"}, "seen.k": "passthrough", "props.k": {"strategy": "tokenize", "namespace": "k"}}
    return nested.deidentify(rows, by_path, base.KEY, {"seen": "who struct<id: long, name: string>, k array<int>", "props": "k int"})


_LINES_RISK = "SELECT l_returnflag AS flag, l_linestatus AS status, (l_suppkey % 40)::INTEGER AS place, CASE WHEN l_partkey % 11 <> 0 THEN l_partkey END AS part FROM lineitem"


@query(f"""WITH r AS ({_LINES_RISK}), c AS (SELECT count(DISTINCT part) + max((part IS NULL)::INTEGER) AS n, count(*) AS size FROM r GROUP BY flag, status, place)
SELECT CASE WHEN min(n) < 20 THEN min(n) END::BIGINT AS l, count(*) AS n_classes, count_if(n < 20)::BIGINT AS violating_classes, coalesce(sum(size) FILTER (n < 20), 0)::BIGINT AS violating_rows, min(n) >= 20 AS passes FROM c""")
def l_diversity_sketched(spark: SparkSession, d: str) -> DataFrame:
    """The verdict on parts in lines, from merged sketches of each year."""
    rows = t(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), (F.col("l_suppkey") % 40).cast("int").alias("place"), F.when(F.col("l_partkey") % 11 != 0, F.col("l_partkey")).alias("part"), F.year("l_shipdate").alias("year"))
    qis = ["flag", "status", "place"]
    yearly = prefilter.sketches(rows, ["year", *qis], "part", prefilter.words_for(20))
    return prefilter.l_diversity(rows, qis, "part", 20, prefilter.merged(yearly, qis)).drop("doubtful_classes")


# --- layers laid out by token --------------------------------------------------------------


def _orders(spark: SparkSession, d: str) -> DataFrame:
    o = keyed.with_key(t(spark, d, "orders"), base.KEY)
    return o.select("o_orderkey", keyed.token(F.col("o_custkey"), "customer").alias("token"), F.year("o_orderdate").alias("order_year"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))


@query(f"""SELECT o_orderkey, {base.token_sql('o_custkey', 'customer')} AS token, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'""")
def token_filter_join(spark: SparkSession, d: str) -> DataFrame:
    """Orders of a crosswalk that knows one segment only: its filter, merged from a filter for each nation's half, is stored and read by version."""
    c = t(spark, d, "customer").where("c_mktsegment = 'BUILDING'")
    walk = vault.crosswalk(c, "c_custkey", base.KEY, ["c_custkey", "c_name", "c_nationkey"], "customer")
    words = tokenfilter.words_for(c.count())
    first = F.col("c_nationkey") < 12
    parts = tokenfilter.build(walk.where(first), "token", words).unionByName(tokenfilter.build(walk.where(~first), "token", words))
    root = scratch.folder(spark, "filters")
    tokenfilter.save(tokenfilter.merged(parts), root, "1")
    orders = _orders(spark, d).select("o_orderkey", "token")
    return tokenfilter.known_rows(orders, "token", walk.drop("c_nationkey"), tokenfilter.load(spark, root, "1"), words)


@query(f"""SELECT {base.token_sql('o_custkey', 'customer')} AS token, any_value(c_mktsegment) AS segment, count(*) AS n_orders, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents
FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) BETWEEN 1995 AND 1996 GROUP BY o_custkey""")
def bucketed_spend(spark: SparkSession, d: str) -> DataFrame:
    """Spend of each customer in two years, from layers bucketed by token: joined and grouped without a shuffle."""
    run, root = uuid.uuid4().hex, scratch.folder(spark, "layers")
    c = keyed.with_key(t(spark, d, "customer"), base.KEY).select(keyed.token(F.col("c_custkey"), "customer").alias("token"), F.col("c_mktsegment").alias("segment"))
    layout.save_bucketed(_orders(spark, d), f"orders_{run}", "token", 8, f"{root}/orders", "order_year")
    layout.save_bucketed(c, f"customers_{run}", "token", 8, f"{root}/customers")
    facts = spark.table(f"orders_{run}").where("order_year BETWEEN 1995 AND 1996")
    spent = layout.joined(facts, spark.table(f"customers_{run}"), "token").groupBy("token", "segment")
    return layout.require_no_shuffle(spent.agg(F.count(F.lit(1)).alias("n_orders"), F.sum("cents").alias("cents")))
