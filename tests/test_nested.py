"""Rules by path and sketches as a prefilter: by value, on awkward rows."""

import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskline.functions import keyed
from maskline.operators import prefilter, risk
from maskline.plans import nested, rules

KEY = "k" * 40
SCHEMA = "id long, who struct<mrn: string, born: date, home: struct<zip: string, street: string>>, notes array<struct<by: string, body: string>>, tags map<string, array<string>>, raw string, _source string"
JSON = {"raw": "mrn string, visits array<struct<day: date, kind: string>>"}
BY_PATH = {
    "id": "passthrough",
    "who.mrn": {"strategy": "tokenize", "namespace": "mrn", "prefix": "PT-"},
    "who.born": {"strategy": "date_shift", "entity_column": "id", "max_days": 30},
    "who.home.zip": {"strategy": "generalize", "kind": "zip3"},
    "notes[].body": {"strategy": "redact_text"},
    "tags{key}": {"strategy": "tokenize", "namespace": "tag"},
    "tags{}[]": {"strategy": "tokenize", "namespace": "value"},
    "raw.mrn": {"strategy": "tokenize", "namespace": "mrn", "prefix": "PT-"},
    "raw.visits[].kind": "passthrough",
}
ROWS = [
    (1, ("A1", date(2000, 1, 31), ("12345", "1 Main St")), [("Ann", "mail a@b.com now"), (None, None), ("Bo", "")], {"vip": ["x", None, ""], "none": [], "null": None}, '{"mrn":"A1","visits":[{"day":"2020-01-01","kind":"er"},{"kind":"lab"}],"ssn":"123-45-6789"}', "f"),
    (2, None, None, None, None, None),
    (3, (None, None, None), [], {}, "SSN 123-45-6789", "g"),
    (3, ("", None, ("03601", None)), [None], {"vip": []}, "[1, 2]", "g"),
    (4, ("A1", None, ("9" * 40, "x" * 1000)), [("C", "word " * 20000 + "call 212-555-0123")], {}, "", ""),
]


def token(spark, value, namespace, prefix=""):
    row = spark.createDataFrame([(value,)], "v string")
    return keyed.with_key(row, KEY).select(keyed.token(F.col("v"), namespace, prefix=prefix)).first()[0]


def test_each_value_by_the_rule_of_its_path(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = nested.deidentify(df, BY_PATH, KEY, JSON)
    assert out.columns == df.columns
    a, b, c, d, e = (r.asDict(recursive=True) for r in out.collect())
    mrn, vip, x = token(spark, "A1", "mrn", "PT-"), token(spark, "vip", "tag"), token(spark, "x", "value")
    assert a["who"]["mrn"] == mrn and a["who"]["home"] == {"zip": "123", "street": None} and abs((a["who"]["born"] - date(2000, 1, 31)).days) <= 30
    assert a["notes"] == [{"by": None, "body": "mail [EMAIL_ADDRESS] now"}, {"by": None, "body": None}, {"by": None, "body": ""}]
    assert a["tags"] == {vip: [x, None, ""], token(spark, "none", "tag"): [], token(spark, "null", "tag"): None}
    assert json.loads(a["raw"]) == {"mrn": mrn, "visits": [{"kind": "er"}, {"kind": "lab"}]} and a["_source"] == "f"
    assert b == {"id": 2, "who": None, "notes": None, "tags": None, "raw": None, "_source": None}
    assert c["who"] == {"mrn": None, "born": None, "home": None} and c["notes"] == [] and c["tags"] == {} and c["raw"] in ("{}", None)
    assert d["who"]["mrn"] == "" and d["who"]["home"]["zip"] == "000" and d["notes"] == [None] and "1" not in (d["raw"] or "")
    assert e["who"]["home"] == {"zip": "999", "street": None} and e["notes"][0]["body"].endswith("call [PHONE_NUMBER]") and e["raw"] in ("{}", None, "")
    empty = nested.deidentify(df.limit(0), BY_PATH, KEY, JSON)
    assert empty.count() == 0 and empty.schema == out.schema
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "Python" not in plan and KEY not in plan


def test_flat_tables_come_out_as_by_the_flat_rules(spark):
    df = spark.createDataFrame([(1, "x y", "02139", None), (2, None, "", "z")], "id long, `a b` string, zip string, _at string")
    flat = {"id": {"strategy": "tokenize"}, "a b": {"strategy": "synthesize", "kind": "name"}, "zip": {"strategy": "generalize", "kind": "zip3"}}
    assert nested.deidentify(df, flat, KEY).collect() == rules.deidentify(df, flat, KEY).collect()


def test_a_map_without_a_rule_for_its_keys_goes(spark):
    df = spark.createDataFrame([({"Ann": "x"},)], "m map<string, string>")
    assert nested.deidentify(df, {"m{}": "passthrough"}, KEY).first()["m"] is None
    assert nested.deidentify(df, {}, KEY).first()["m"] is None
    assert nested.deidentify(df, {"m{}": {"strategy": "suppress", "redaction": "*"}}, KEY, default="passthrough").first()["m"] == {"Ann": "*"}
    assert nested.deidentify(df, {"m": "passthrough"}, KEY).first()["m"] == {"Ann": "x"}


@pytest.mark.parametrize(
    "by_path, default",
    [
        ({"who.nobody": "suppress"}, "suppress"), ({"who": {"strategy": "tokenize"}}, "suppress"), ({"who": "suppress", "who.mrn": "passthrough"}, "suppress"),
        ({"tags{key}": {"strategy": "synthesize"}}, "suppress"), ({"_source": "suppress"}, "suppress"), ({"id": "hide"}, "suppress"), ({}, "tokenize"),
    ],
)
def test_refused_rules(spark, by_path, default):
    with pytest.raises(ValueError):
        nested.deidentify(spark.createDataFrame([], SCHEMA), by_path, KEY, JSON, default)


def test_what_no_rule_names(spark):
    schema = T._parse_datatype_string(SCHEMA)
    assert nested.uncovered(schema, BY_PATH, JSON) == ["who.home.street", "notes[].by", "raw.visits[].day", "_source"]
    with pytest.raises(ValueError):
        list(nested.paths(T.StructType().add("a.b", "string")))
    with pytest.raises(TypeError):
        list(nested.paths(schema, {"id": "x int"}))


def spread(spark, seed):
    """Classes of one to forty values, among them null, repeated rows, and a class with a third of all."""
    draw = random.Random(seed)
    rows = [(q, None if draw.random() < 0.1 else f"v{draw.randrange(1 + (i % 40))}") for i in range(40) for q in [f"c{i}" if i else None] for _ in range(60)]
    rows += [("hot", f"v{draw.randrange(4)}") for _ in range(1200)]
    return spark.createDataFrame(rows, "q string, v string").withColumn("part", F.spark_partition_id())


@pytest.mark.parametrize("l", [1, 2, 5, 12, 30])
def test_verdict_equals_the_exact_one(spark, l):  # noqa: E741
    df = spread(spark, l)
    exact = risk.l_diversity(df, ["q"], "v", l).first()
    whole = prefilter.l_diversity(df, ["q"], "v", l).first()
    parts = prefilter.merged(prefilter.sketches(df, ["part", "q"], "v", prefilter.words_for(l)), ["q"])
    assert whole == prefilter.l_diversity(df, ["q"], "v", l, parts).first()
    for c in ("n_classes", "violating_classes", "violating_rows", "passes"):
        assert whole[c] == exact[c]
    assert whole["l"] == (None if exact["passes"] else exact["l"])


def test_bounds_never_say_too_much_and_few_classes_are_doubtful(spark):
    df = spread(spark, 3)
    sketch = prefilter.sketches(df, ["q"], "v", 1)
    both = sketch.withColumn("low", prefilter.at_least(sketch, ["q"])).alias("s").join(risk.diversity(df, ["q"], "v").alias("e"), F.col("s.q").eqNullSafe(F.col("e.q")))
    assert both.where("low > n_values").count() == 0 and both.count() == 41
    diverse = df.where("q = 'hot'").unionByName(spark.range(3000).select((F.col("id") % 100).cast("string").alias("q"), F.col("id").cast("string").alias("v"), F.lit(0).alias("part")))
    row = prefilter.l_diversity(diverse, ["q"], "v", 10).first()
    assert row["n_classes"] == 101 and row["violating_classes"] == 1 and row["doubtful_classes"] <= 5


def test_empty_tables_and_bad_limits(spark):
    df = spark.createDataFrame([], "q string, v string")
    row, exact = prefilter.l_diversity(df, ["q"], "v", 2).first(), risk.l_diversity(df, ["q"], "v", 2).first()
    assert (row["l"], row["n_classes"], row["violating_classes"], row["passes"]) == (exact["l"], 0, 0, exact["passes"])
    with pytest.raises(ValueError):
        prefilter.l_diversity(df, ["q"], "v", 0)
    with pytest.raises(ValueError):
        prefilter.sketches(df, [], "v", 1)
