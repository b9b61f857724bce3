"""Every registered query with SQL gives the SQL's rows; every other one runs."""

import math
from pathlib import Path

import duckdb
import pytest

from maskline import catalog_queries as cq

DATA, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TEXTS = ["eval_sets", "eval_spans", "finding_rows", "redact_label", "redact_remove", "redact_rule", "redact_token", "residual_flags", "text_spans"]
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(data):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.fixture(scope="module")
def more():
    return connect(MORE)


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, bool) or v is None:
        return str(v)
    try:
        return f"{float(v):.10g}" if not isinstance(v, str) else v
    except (TypeError, ValueError):
        return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def check(spark, con, name, data):
    df = cq.queries()[name](spark, data)
    got = df.collect()
    assert got or name == "enforce_k"
    want = con.execute(cq.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, got) == rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(cq.queries()))
def test_query(spark, duck, name):
    check(spark, duck, name, DATA)


@pytest.mark.parametrize("name", TEXTS)
def test_text_query_on_more_documents(spark, more, name):
    """Texts with letters of other alphabets next to digits, which the smallest table lacks."""
    check(spark, more, name, MORE)


def test_no_python_in_plans(spark):
    for name, f in cq.queries().items():
        plan = f(spark, DATA)._jdf.queryExecution().toString()
        assert "EvalPython" not in plan and "MapInArrow" not in plan, name


def test_keys_are_in_no_plan(spark):
    from maskline.functions import keyed

    plan = cq.deid_table(spark, DATA)._jdf.queryExecution().toString()
    for secret in (cq.KEY, *(p.hex().upper() for p in keyed.pads(cq.KEY)), *(p.hex() for p in keyed.pads(cq.KEY))):
        assert secret not in plan


def test_entry_points():
    assert Path(__file__).parent.parent.joinpath("__spark_entry__.py").exists()
