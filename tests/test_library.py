"""Known answers, awkward inputs, sources and sinks, gates and whole runs of the library."""

import hashlib
import hmac
import re
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskline.functions import keyed, strategies, text
from maskline.operators import ledger, quality, residual, risk, star, synth, vault
from maskline.plans import rules
from maskline.sources import ingest
from maskline.streaming import deid

KEY = "unit-test-pepper-not-a-real-secret-0123456789"


def one(spark, expression, value, kind="string"):
    df = keyed.with_key(spark.createDataFrame([(value,)], f"v {kind}"), KEY)
    return df.select(expression(F.col("v")).alias("x")).first()["x"]


# --- known answers ----------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("expression", "value", "want"),
    [
        (lambda v: keyed.token(v, "mrn", prefix="PT-"), "MRN12345", "PT-1b6a3b9f1e337a27"),
        (lambda v: keyed.token(v, "mrn"), "123", "795b11eedddb00c6"),
        (lambda v: keyed.token(v, "npi"), "123", "99ca8ab0bc5a78ee"),
        (keyed.token_numeric, "12345", "7065030120"),
        (lambda v: keyed.token_shaped(v, "mrn"), "A12-3456", "F30-2581"),
        (lambda v: strategies.synthesize(v, "first_name"), "John", "Reese"),
        (lambda v: strategies.synthesize(v, "last_name"), "Smith", "Kim"),
        (lambda v: strategies.synthesize(v, "name"), "Smith, John", "Haddad, Quinn"),
        (lambda v: strategies.date_shift(F.lit("2020-01-01"), v), "7", date(2020, 9, 29)),
        (lambda v: strategies.date_shift(F.lit("2020-01-01"), v), "9", date(2020, 2, 15)),
        (lambda v: strategies.date_shift(F.lit("2020-01-01"), v), "PATKEY-9", date(2020, 11, 22)),
        (lambda v: text.redact(v, text.merge(text.spans(v)), "token"), "a@b.com", "[EMAIL_ADDRESS:8fef2d9e4a03]"),
        (lambda v: strategies.zip3(v), "10021", "100"),
        (lambda v: strategies.zip3(v), "03688", "000"),
        (lambda v: strategies.zip3(v), "1-2", "000"),
        (lambda v: strategies.age_cap(v), "99", 90),
        (lambda v: strategies.age_cap(v), "41.7", None),
        (lambda v: strategies.year_of(v), "07/22/1984", 1984),
    ],
)
def test_known_answers(spark, expression, value, want):
    assert one(spark, expression, value) == want


@pytest.mark.parametrize("value", [None, ""])
def test_nothing_stays_nothing(spark, value):
    for expression in (keyed.token, keyed.token_numeric, keyed.token_shaped, strategies.zip3, lambda v: strategies.synthesize(v, "name"), lambda v: text.redact(v, text.merge(text.spans(v)))):
        assert one(spark, expression, value) == value
    for expression in (strategies.year_of, strategies.age_cap, lambda v: strategies.date_shift(v, F.lit("e"))):
        assert one(spark, expression, value) is None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs",)), min_size=1, max_size=64), min_size=1, max_size=60, unique=True))
def test_token_properties(spark, values):
    """Equal to the standard library's, sixteen hexadecimal digits, no collision, same shape."""
    df = keyed.with_key(spark.createDataFrame([(v,) for v in values], "v string"), KEY)
    got = df.select("v", keyed.token(F.col("v"), "p").alias("t"), keyed.token_shaped(F.col("v"), "p").alias("s")).collect()
    for r in got:
        assert r["t"] == hmac.new(KEY.encode(), b"p\x1f" + r["v"].encode(), hashlib.sha256).hexdigest()[:16]
        assert [c if not re.match(r"[0-9A-Za-z]", c) else "x" for c in r["v"] if ord(c) < 128] == [c if not re.match(r"[0-9A-Za-z]", c) else "x" for c, v in zip(r["s"], r["v"], strict=True) if ord(v) < 128]
    assert len({r["t"] for r in got}) == len(values)


def test_key_is_guarded(spark):
    with pytest.raises(ValueError):
        keyed.pads("short")
    with pytest.raises(ValueError):
        keyed.with_key(spark.range(1).withColumn("_KEY_inner", F.lit(1)), KEY)
    with pytest.raises(TypeError):
        rules.deidentify(spark.createDataFrame([(1.5,)], "v double"), {"v": "tokenize"}, KEY)


# --- free text --------------------------------------------------------------------------------

SAMPLE = "Call 212-555-0123 or email jane.doe@example.com; SSN 123-45-6789."


def found(spark, value, **kwargs):
    df = spark.createDataFrame([(value,)], "v string").select(text.spans(F.col("v"), **kwargs).alias("s"))
    return [(s["entity_type"], s["start"], s["end"]) for s in df.first()["s"]]


def test_spans(spark):
    assert found(spark, SAMPLE) == [("PHONE_NUMBER", 5, 17), ("EMAIL_ADDRESS", 27, 47), ("US_SSN", 53, 64)]
    assert found(spark, SAMPLE, entities=("US_SSN",)) == [("US_SSN", 53, 64)]
    assert found(spark, SAMPLE, score_threshold=1.5) == [] and found(spark, None) == [] and found(spark, "") == []
    with pytest.raises(ValueError):
        found(spark, SAMPLE, entities=("PERSON",))


def test_spans_against_the_standard_library(spark):
    odd = ["é123-45-6789", "123-45-6789é", "4111 1111 1111 1111 é", "٠١٢-٣٤-٥٦٧٨ ", "1.2.3.4, 10.0.0.1:80", "000-12-3456 666-12-3456 912-12-3456", "http://a.b/c?d=é. (x)", "a 123 45 6789", "x@y.zz x@y", "+1 (212) 555-0123 212.555.0123", "no hit", "1" * 40]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "i int, t string")
    got = {(r["i"], r["entity_type"], r["start"], r["end"]) for r in text.finding_rows(rows, "i", "t").collect()}
    assert got == {(i, n, m.start(), m.end()) for i, t in enumerate(odd) for n, p in text.PATTERNS.items() for m in re.finditer(p, t)}
    counts = {r["entity_type"]: r["findings"] for r in text.count_entities(rows, "t").collect()}
    assert counts == {n: k for n in text.PATTERNS if (k := sum(g[1] == n for g in got))}


def test_redaction(spark):
    df = spark.createDataFrame([(SAMPLE, 1), ("email a@b.com now", 2), (None, 3), ("clean", 4)], "t string, _found int")
    label = [r["t"] for r in text.redact_column(df, "t").orderBy("_found").collect()]
    assert label == ["Call [PHONE_NUMBER] or email [EMAIL_ADDRESS]; SSN [US_SSN].", "email [EMAIL_ADDRESS] now", None, "clean"]
    removed = text.redact_column(df, "t", "remove", output="clean").orderBy("_found").collect()
    assert removed[1]["clean"] == "email  now" and removed[1]["t"] == "email a@b.com now" and [r["_found"] for r in removed] == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        text.redact_column(df, "t", "blur")


@pytest.mark.parametrize(
    ("spans", "want"),
    [
        ([("A", 2, 6, 0.9), ("B", 4, 8, 0.5)], "ab[A]ij"),
        ([("A", 2, 6, 0.5), ("B", 4, 8, 0.9)], "ab[B]ij"),
        ([("A", 2, 6, 0.5), ("B", 4, 8, 0.5)], "ab[A]ij"),  # ties: the earlier
        ([("A", 2, 4, 0.5), ("B", 4, 8, 0.9)], "ab[A][B]ij"),  # touching ones stay apart
        ([("B", 3, 4, 0.5), ("A", 2, 8, 0.5)], "ab[A]ij"),
        ([("A", 0, 10, 0.5)], "[A]"),
        ([], "abcdefghij"),
    ],
)
def test_overlapping_spans(spark, spans, want):
    df = spark.createDataFrame([("abcdefghij", spans)], f"t string, s array<{text.SPAN}>")
    assert df.select(text.redact(F.col("t"), text.merge(F.col("s")))).first()[0] == want


@pytest.mark.parametrize(
    ("value", "want"),
    [("123-45-6789", ["ssn"]), ("Patient SSN 123456789 on file", ["ssn"]), ("(212) 555-0123", ["phone"]), ("+1 212-555-0123", ["phone"]), ("jane.doe@example.com", ["email"]), ("PT-a1b2c3d4e5f6a7b8", []), ("Rivera, Alex", []), (None, [])],
)
def test_residual_flags(spark, value, want):
    assert spark.createDataFrame([(value,)], "v string").select(residual.flags(F.col("v"))).first()[0] == want


# --- rules ------------------------------------------------------------------------------------


def test_patient_frame(spark):
    rows = [("MRN-1", "Ann", "Smith", "Smith, Ann", date(1984, 7, 22), 41, "10021", 7, "leak"), ("MRN-2", "Bob", "Jones", "Jones, Bob", date(1950, 1, 3), 99, "03688", 9, "leak")]
    df = spark.createDataFrame(rows, "MRN string, FirstName string, LastName string, PatientName string, DateOfBirth date, Age int, ZIP string, PatientKey int, MysteryLeak string").withColumn("_run", F.lit(1))
    plan = {
        "MRN": {"strategy": "tokenize", "namespace": "mrn", "prefix": "PT-"}, "FirstName": {"strategy": "synthesize", "kind": "first_name"}, "LastName": {"strategy": "synthesize", "kind": "last_name"},
        "PatientName": {"strategy": "synthesize", "kind": "name"}, "DateOfBirth": {"strategy": "generalize", "kind": "year"}, "Age": {"strategy": "generalize", "kind": "age_cap"},
        "ZIP": {"strategy": "generalize", "kind": "zip3"}, "PatientKey": "passthrough",
    }
    a, b = rules.deidentify(df, plan, KEY).orderBy("PatientKey").collect()
    assert a["MRN"].startswith("PT-") and a["DateOfBirth"] == 1984 and a["ZIP"] == "100" and b["ZIP"] == "000" and b["Age"] == 90
    assert a["MysteryLeak"] is None and b["MysteryLeak"] is None and a["_run"] == 1 and a["FirstName"] in strategies.FIRST_NAMES


def test_shift_keeps_gaps_and_needs_an_entity(spark):
    plan = {"PatientKey": "passthrough", "ServiceDate": {"strategy": "date_shift", "entity_column": "PatientKey"}}
    df = spark.createDataFrame([(7, date(2020, 1, 1)), (7, date(2020, 2, 1))], "PatientKey int, ServiceDate date")
    a, b = sorted(r["ServiceDate"] for r in rules.deidentify(df, plan, KEY).collect())
    assert (b - a).days == 31
    with pytest.raises(Exception, match="no entity"):
        rules.deidentify(df.withColumn("PatientKey", F.lit(None).cast("int")), plan, KEY).collect()


def test_rule_parameters(spark):
    df = spark.createDataFrame([("12345", SAMPLE)], "id string, note string")
    same = rules.deidentify(df, {"id": "tokenize", "note": {"strategy": "redact_text", "entities": ["US_SSN"]}}, KEY).first()
    other = rules.deidentify(df.withColumnRenamed("id", "customer_id"), {"customer_id": "tokenize"}, KEY).first()
    assert same["id"] == other["customer_id"]  # one namespace by default: tokens join across tables
    assert same["note"] == SAMPLE.replace("123-45-6789", "[US_SSN]")
    kept = rules.deidentify(df, {"id": {"strategy": "tokenize", "format_preserving": True}, "note": {"strategy": "redact_text", "score_threshold": 1.1}}, KEY).first()
    assert re.fullmatch(r"\d{5}", kept["id"]) and kept["note"] == SAMPLE
    a, b = (rules.deidentify(df, {"note": {"strategy": "redact_text", "replacement": "token", "namespace": n}}, KEY).first()["note"] for n in ("free_text", "other"))
    assert a != b and "[US_SSN:" in a and "[US_SSN:" in b


@pytest.mark.parametrize(
    "rule",
    [{"strategy": "blur"}, {"strategy": "generalize"}, {"strategy": "generalize", "kind": "month"}, {"strategy": "tokenize", "salt": "x"}, {"strategy": "date_shift"}, {"strategy": "redact_text", "entities": ["PERSON"]}],
)
def test_bad_rules_are_refused(rule):
    with pytest.raises(ValueError):
        rules.check({"c": rule})


def test_all_tables(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b",)], "v string")
    spark.sql("CREATE DATABASE IF NOT EXISTS lib_all")
    try:
        spark.sql("USE lib_all")
        counts = rules.deidentify_tables(spark, {"x": (df, {"v": "tokenize"})}, KEY).collect()
        assert [tuple(r) for r in counts] == [("x", 2, 2)] and spark.table("silver_deid_x").count() == 2
        bad = {"y": (df, {"v": "blur"}), "z": (df, {"v": "passthrough"})}
        with pytest.raises(RuntimeError, match="y: ValueError: .*blur"):
            rules.deidentify_tables(spark, bad, KEY)
        assert spark.table("silver_deid_z").count() == 2  # the other one was written
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE lib_all CASCADE")


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(i, f"mrn{i}") for i in range(50)], "k int, mrn string")
    df.write.parquet(f"{tmp_path}/in")
    plan = {"k": "passthrough", "mrn": {"strategy": "tokenize", "prefix": "PT-"}}
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    deid.deidentify_stream(stream, plan, KEY, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {tuple(r) for r in rules.deidentify(df, plan, KEY).collect()} and len(got) == 50


def test_coverage(spark):
    live = rules.columns_frame(spark, {"p": ["MRN", "FirstName", "MysteryCol", "_ingest_ts"]})
    got = {r["column"]: r["state"] for r in rules.coverage(live, rules.columns_frame(spark, {"p": ["MRN", "FirstName", "PatientKey"]})).collect()}
    assert got == {"MRN": "classified", "FirstName": "classified", "MysteryCol": "defaulted", "PatientKey": "missing"}


# --- sources, sinks, gates --------------------------------------------------------------------


def test_typed_csv(spark, tmp_path):
    path = f"{tmp_path}/d.csv"
    with open(path, "w") as f:
        f.write('id,name,flag,amount\n007,"a ""quoted"", name\nof two lines",Y,1.50\n008,b, t ,x\n009,c,,2\n')
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType()), T.StructField("flag", T.BooleanType()), T.StructField("amount", T.DecimalType(12, 2))])
    rows = ingest.read_csv(spark, path, schema).orderBy("id").collect()
    assert [(r["id"], r["flag"]) for r in rows] == [("007", True), ("008", True), ("009", None)]
    assert rows[0]["name"] == 'a "quoted", name\nof two lines' and str(rows[0]["amount"]) == "1.50" and rows[1]["amount"] is None
    assert rows[0]["_source_file"] == "d.csv" and rows[0]["_ingested_at"] is not None
    marked = ingest.read_csv(spark, path, schema, malformed="_bad").cache()
    assert [r["id"] for r in marked.where("_bad IS NOT NULL").collect()] == ["008"]
    assert len(ingest.read_csv(spark, path, schema, mode="DROPMALFORMED").collect()) == 2
    with pytest.raises(Exception):  # noqa: B017
        ingest.read_csv(spark, path, schema, mode="FAILFAST").collect()
    stamped = ingest.stamp(spark.range(1), "made").first()
    assert stamped["_source_file"] == "made" and stamped["_ingested_at"] is not None


def test_load_guard(spark):
    good = spark.createDataFrame([(True,), (None,)], "b boolean")
    assert ingest.require_load(good, ("b",)) is good
    for bad in (good.where("false"), good.where("b IS NULL")):
        with pytest.raises(AssertionError):
            ingest.require_load(bad, ("b",))


def test_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS lib_tables")
    try:
        spark.sql("USE lib_tables")
        ingest.save(spark.createDataFrame([(1,)], "a int"), "bronze_x")
        ingest.save(spark.createDataFrame([(1, "z")], "a int, b string"), "bronze_x")  # with another schema
        assert spark.table("bronze_x").columns == ["a", "b"]
        ingest.copy_tables(spark, ["x"], "bronze_", "silver_")
        assert spark.table("silver_x").collect() == spark.table("bronze_x").collect()
        assert ingest.missing_tables(spark, ["bronze_x", "bronze_y"]) == ["bronze_y"]
        ingest.require_tables(spark, ["bronze_x"])
        with pytest.raises(RuntimeError, match="bronze_y"):
            ingest.require_tables(spark, ["bronze_y"])
        counts = spark.createDataFrame([("x", 3, 3)], "table string, rows_in long, rows_out long")
        made = ledger.run_rows(counts, {"x": {"a": "tokenize"}}, {"x": ["a", "b", "_c"]}, "me", "v2", datetime(2025, 1, 1))
        ledger.append(made, "runs")
        ledger.append(made, "runs")
        row = spark.table("runs").first()
        assert spark.table("runs").count() == 2 and row["strategies"] == '{"passthrough":1,"suppress":1,"tokenize":1}' and row["key_version"] == "v2"
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE lib_tables CASCADE")
    spark.range(3).write.parquet(f"{tmp_path}/zone/t")
    assert ingest.load(spark, f"{tmp_path}/zone/", "t").count() == 3


def test_publish_gate(spark):
    clean, dirty = spark.createDataFrame([("fine",)], "v string"), spark.createDataFrame([("123-45-6789",)], "v string")
    ok = residual.reconcile({"a": clean}, {"a": clean})
    residual.require_clean(residual.gate(residual.scan(clean), ok))
    for bad in (residual.gate(residual.scan(dirty), ok), residual.gate(residual.scan(clean), residual.reconcile({"a": clean}, {"a": clean.where("false")})), residual.gate(residual.scan(clean), residual.reconcile({"a": clean, "b": clean}, {"a": clean}))):
        with pytest.raises(AssertionError):
            residual.require_clean(bad)
    assert residual.scan(spark.range(2)).count() == 0
    card = residual.scorecard(spark.createDataFrame([("x1", 1800, "1234")], "tok string, dob int, zip string"), {"p": dirty}, "tok", "PT-", "dob", "zip", ("dob",))
    assert [r["passed"] for r in card.collect()] == [False, False, False, False, True, False] and residual.verdict(card).first()["passed"] is False


# --- risk, quality, vault, star ---------------------------------------------------------------

PRIVACY = [(1980, "F", "100", "a"), (1980, "F", "100", "b"), (1980, "F", "100", "a"), (1990, "M", "200", "c"), (1990, "M", "200", "c"), (2000, "F", "300", "d")]


def test_risk(spark):
    df, qis = spark.createDataFrame(PRIVACY, "birth_year int, sex string, zip3 string, dx string"), ["birth_year", "sex", "zip3"]
    k = risk.k_anonymity(df, qis, 2).first()
    assert (k["k"], k["n_classes"], k["violating_classes"], k["passes"]) == (1, 3, 1, False)
    el = risk.l_diversity(df, qis, "dx", 2).first()
    assert (el["l"], el["violating_classes"], el["violating_rows"], el["passes"]) == (1, 2, 3, False)
    for how in ("join", "window"):
        assert risk.enforce_k(df, qis, 2, how).count() == 5
    nulls = df.unionByName(df.withColumn("sex", F.lit(None).cast("string")))
    assert sorted(map(tuple, risk.enforce_k(nulls, qis, 2, "join").collect()), key=str) == sorted(map(tuple, risk.enforce_k(nulls, qis, 2, "window").collect()), key=str)
    for bad in (0, -1):
        with pytest.raises(ValueError):
            risk.enforce_k(df, qis, bad)
    with pytest.raises(ValueError):
        risk.k_anonymity(df, [], 2)
    empty = df.where("false")
    assert risk.k_anonymity(empty, qis, 2).first()["k"] == 0 and risk.l_diversity(empty, qis, "dx").first()["l"] == 0 and risk.t_closeness(empty, qis, "dx").first()["t"] == 0.0
    for rows, t in (([("g1", "x"), ("g1", "y"), ("g2", "x"), ("g2", "y")], 0.0), ([("g1", "x"), ("g1", "x"), ("g2", "y"), ("g2", "y")], 0.5)):
        assert risk.t_closeness(spark.createDataFrame(rows, "g string, s string"), ["g"], "s", 0.2).first()["t"] == t
    two = spark.createDataFrame(PRIVACY[:3] + [(1990, "M", "200", x) for x in "cde"], df.schema)
    clean = residual.scan(two).agg((F.count(F.lit(1)) == 0).alias("passes"))
    assert risk.evidence(risk.k_anonymity(two, qis, 3), risk.l_diversity(two, qis, "dx", 2), risk.t_closeness(two, qis, "dx", 1.0), clean).first()["passes"]
    assert risk.evidence(k=risk.k_anonymity(two, qis, 3)).first()["passes"] and not risk.evidence(k=risk.k_anonymity(two, qis, 4)).first()["passes"]


def spans(spark, rows):
    return spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], "doc int, nth int, entity_type string, start int, end int")


@pytest.mark.parametrize(
    ("gold", "predicted", "options", "want"),
    [
        ([("PERSON", 0, 10), ("US_SSN", 20, 30)], [("PERSON", 0, 9), ("US_SSN", 40, 50)], {}, (1, 1, 1)),
        ([("PERSON", 0, 10)], [("PERSON", 0, 10), ("PERSON", 1, 9)], {}, (1, 1, 0)),
        ([("PERSON", 0, 10)], [("US_SSN", 0, 10)], {}, (0, 1, 1)),
        ([("PERSON", 0, 10)], [("US_SSN", 0, 10)], {"match_type": False}, (1, 0, 0)),
        ([("PERSON", 0, 10)], [("PERSON", 50, 60)], {"min_overlap": 0.0}, (1, 0, 0)),  # disjoint, but no overlap is asked for
        ([("P", 0, 10), ("P", 6, 12)], [("P", 5, 11), ("P", 0, 10)], {"min_overlap": 0.4, "order_col": "nth"}, (2, 0, 0)),
        ([("P", 0, 10)], [("P", 3, 10), ("P", 0, 10)], {"order_col": "nth"}, (1, 1, 0)),  # greedy in the given order
        ([], [], {}, (0, 0, 0)),
    ],
)
def test_span_scores(spark, gold, predicted, options, want):
    r = quality.evaluate_spans(spans(spark, predicted), spans(spark, gold), "doc", **options).first()
    assert (r["tp"], r["fp"], r["fn"]) == want
    if want == (0, 0, 0):
        assert (r["precision"], r["recall"], r["f1"]) == (1.0, 1.0, 1.0)


def test_set_and_flag_scores(spark):
    a, b = (spark.createDataFrame([(x,) for x in s], "x int") for s in ([1, 2, 3], [2, 3, 4]))
    r = quality.evaluate_sets(a, b, ["x"]).first()
    assert (r["tp"], r["fp"], r["fn"]) == (2, 1, 1)
    four = spark.createDataFrame([(p, g) for p in (True, False) for g in (True, False)], "p boolean, g boolean")
    r = quality.evaluate_flags(four, F.col("p"), F.col("g")).first()
    assert (r["tp"], r["fp"], r["fn"]) == (1, 1, 1)


def test_rotation_fails_closed(spark):
    raw = spark.createDataFrame([("m1",), ("m2",)], "mrn string")
    moved = vault.rotation(raw, "mrn", KEY, KEY + "2", "mrn")
    old = vault.crosswalk(raw, "mrn", KEY, ["mrn"], "mrn")
    assert vault.rekey(old, "token", moved).join(vault.crosswalk(raw, "mrn", KEY + "2", ["mrn"], "mrn"), ["mrn", "token"]).count() == 2
    stray = old.unionByName(spark.createDataFrame([("m3", "unknown"), ("m4", None)], old.schema))
    with pytest.raises(Exception, match="unknown"):
        vault.rekey(stray, "token", moved).collect()
    assert vault.rekey(stray, "token", moved, unknown="null").where("token IS NULL").count() == 2
    assert vault.reidentify(stray.select("token"), old).count() == 2


def test_star_join_roles(spark):
    fact = spark.createDataFrame([(1, 10, 20), (2, 10, None), (3, 99, 10)], "id int, attending int, referring int")
    provider = spark.createDataFrame([(10, "a"), (20, "b")], "key int, name string")
    links = [star.Relationship("attending", "attending", "provider", "key"), star.Relationship("referring", "referring", "provider", "key", active=False)]
    plain = star.star_join(fact, {"provider": provider}, links)
    assert plain.columns == ["id", "attending", "referring", "attending_key", "attending_name"]
    both = star.star_join(fact, {"provider": provider}, links, ("referring",)).orderBy("id").collect()
    assert [(r["attending_name"], r["referring_name"]) for r in both] == [("a", "b"), ("a", None), (None, "a")]
    with pytest.raises(ValueError):
        star.star_join(fact, {"provider": provider}, links, ("billing",))


def test_generators(spark):
    keys = spark.createDataFrame([(5,), (7,), (7,), (None,)], "k long")
    odd = spark.createDataFrame([("Inpatient",), ("Inpatient",), ("Office",), (None,), (" ",)], "v string")
    kinds = synth.pool(odd, "v")
    assert {(r["value"], r["weight"]) for r in kinds.collect()} == {("Inpatient", 2), ("Office", 1)}
    fks = {n: (keys, "k") for n in ("PatientKey", "AttendingProviderKey", "ReferringProviderKey", "DepartmentKey", "LocationKey", "DiagnosisKey")}
    made = synth.encounters(keys, "k", fks, kinds, n=10_000).collect()
    assert sorted(r["EncounterKey"] for r in made) == list(range(8, 10_008)) and {r["PatientKey"] for r in made} == {5, 7}
    assert all((1 <= r["LengthOfStay"] <= 14) == (r["EncounterType"] == "Inpatient") for r in made)
    assert 0.37 < sum(r["ReferringProviderKey"] is None for r in made) / 10_000 < 0.43
    assert 0.63 < sum(r["EncounterType"] == "Inpatient" for r in made) / 10_000 < 0.70
    assert synth.encounters(keys, "k", fks, kinds, n=0).count() == 0 and synth.encounters(keys.where("false"), "k", fks, kinds).count() == 0


# --- a whole run ------------------------------------------------------------------------------


def test_from_files_to_the_gate(spark, tmp_path):
    """CSV, conform, de-identify, star, gate, on a written file and generated facts."""
    with open(f"{tmp_path}/payer.csv", "w") as f:
        f.write("PayerKey,PayerName,_IsCurrent\n" + "".join(f'{i},"Payer {i}, national",{"1" if i % 3 else "0"}\n' for i in range(1, 13)))
    schema = T.StructType([T.StructField("PayerKey", T.IntegerType()), T.StructField("PayerName", T.StringType()), T.StructField("_IsCurrent", T.BooleanType())])
    payer = star.current(ingest.require_load(ingest.read_csv(spark, f"{tmp_path}/payer.csv", schema), ("_IsCurrent",)))
    assert payer.count() == 8
    people = spark.range(1, 301).selectExpr("id AS PatientKey", "concat('MRN', id) AS MRN", "lpad(cast(id * 7919 % 100000 AS string), 5, '0') AS ZIP", "concat('SSN 123-45-', 1000 + id) AS Note")
    facts = synth.claims(
        people, "PatientKey", {n: (payer if n == "PayerKey" else people, n if n == "PayerKey" else "PatientKey") for n in ("PatientKey", "BillingProviderKey", "RenderingProviderKey", "PayerKey", "ProcedureKey", "DiagnosisKey")},
        synth.pool(spark.createDataFrame([("Paid",), ("Denied",)], "s string"), "s"), n=2000,
    )
    facts = star.with_parent(star.claim_columns(facts, "ServiceDate", "ClaimStatus", "BilledAmount", "AllowedAmount", "PaidAmount"), people, "PatientKey", "PatientKey")
    plan = {"PatientKey": "passthrough", "MRN": {"strategy": "tokenize", "namespace": "mrn", "prefix": "PT-"}, "ZIP": {"strategy": "generalize", "kind": "zip3"}, "Note": {"strategy": "redact_text"}}
    safe = rules.deidentify(people, plan, KEY)
    shifted = rules.deidentify(facts, {c: "passthrough" for c in ("ClaimKey", "PatientKey", "PayerKey", "PaidAmount", "DeniedFlag")} | {"ServiceDate": {"strategy": "date_shift", "entity_column": "PatientKey"}}, KEY)
    joined = star.star_join(shifted, {"payer": payer, "patient": safe}, [star.Relationship("payer", "PayerKey", "payer", "PayerKey"), star.Relationship("patient", "PatientKey", "patient", "PatientKey")])
    assert joined.count() == 2000 and joined.where("payer_PayerName IS NULL OR patient_MRN IS NULL").count() == 0
    unpaid = facts.where("ClaimStatus <> 'Paid'")
    assert facts.where("ClaimStatus = 'Paid' AND PaidAmount <> AllowedAmount").count() == 0 and unpaid.where("PaidAmount > 0.81 * AllowedAmount").count() == 0 and unpaid.where("PaidAmount > 0").count() > 0
    counts = residual.reconcile({"people": people, "facts": facts}, {"people": safe, "facts": shifted})
    residual.require_clean(residual.gate(residual.scan_layer({"people": safe, "facts": shifted}), counts))
    with pytest.raises(AssertionError):
        residual.require_clean(residual.gate(residual.scan_layer({"people": people}), counts))
