"""Monitors of streams, lattices, linkage, versions and contents: by value, on awkward rows, across restarts."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from itertools import product

import pytest
from pyspark.sql import functions as F

from maskline.operators import contents, lattice, linkage, risk, versions
from maskline.streaming import monitor


def test_class_counts_go_on_after_a_restart(spark, tmp_path):
    df = spark.range(400).select((F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("b"), F.col("id"))
    watch = monitor.ClassMonitor(f"file://{tmp_path}", df.schema, ["a", "b"])
    stream = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    seen = df.limit(0)
    for step, (low, high) in enumerate([(0, 50), (50, 51), (51, 300), (300, 400)]):
        part = df.where(F.col("id").between(low, high - 1))
        part.repartition(2).write.mode("append").parquet(f"{tmp_path}/in")
        watch.start(stream()).awaitTermination()
        seen = seen.unionByName(part)
        assert watch.verdict(spark, 19).first().asDict() == risk.k_anonymity(seen, ["a", "b"], 19).first().asDict()
        if step % 2:
            watch.compact(spark)
            watch.compact(spark)
            assert sorted(map(str, watch.classes(spark).collect())) == sorted(map(str, risk.classes(seen, ["a", "b"]).collect()))
    assert len(list((tmp_path / "changes").iterdir())) == 2  # the merged part and the last one
    watch.start(stream()).awaitTermination()  # nothing new
    assert watch.verdict(spark, 1)["n_rows"] is not None and watch.classes(spark).count() == 21


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    df = spark.createDataFrame([("x", 1)], "q string, class_size long")
    put = monitor._put(f"file://{tmp_path}")
    put(df, 0)
    put(df.withColumn("class_size", F.lit(4).cast("long")), 1)
    put(df.withColumn("class_size", F.lit(5).cast("long")), 1)
    watch = monitor.ClassMonitor(f"file://{tmp_path}", df.select("q").schema, ["q"])
    assert watch.verdict(spark, 5).first().asDict() == {"k": 5, "n_rows": 5, "n_classes": 1, "violating_classes": 0, "violating_rows": 0, "passes": True}


def test_late_rows_count_and_are_told(spark, tmp_path):
    at = lambda day, hour=0: datetime(2024, 1, day, hour)
    schema = "at timestamp, text string"
    watch = monitor.ResidualMonitor(f"file://{tmp_path}", "at", "text")
    batches = [
        [(at(1), "mail a@b.com"), (at(1, 5), None), (at(2), "call 212-555-0123")],
        [(at(1), "b@c.org, late only by the day"), (at(4, 1), "")],  # day 1 closes at the start of day 3; so far day 2 was the latest
        [(at(1, 2), "SSN 123-45-6789"), (at(3), "d@e.net")],  # day 1 had closed, day 3 not
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        watch.start(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")).awaitTermination()
    got = {r["window_start"].day: (r["n_rows"], r["late_rows"], r["ssn"], r["phone"], r["email"]) for r in watch.windows(spark).collect()}
    assert got == {1: (4, 1, 1, 0, 2), 2: (1, 0, 0, 1, 0), 3: (1, 0, 0, 0, 1), 4: (1, 0, 0, 0, 0)}


@pytest.mark.parametrize(("k", "most"), [(1, 0), (4, 0), (9, 0), (9, 25), (500, 0)])
def test_lattice_against_every_combination(spark, k, most):
    rnd = random.Random(k)
    rows = [(rnd.choice([None, 1, 2, 3, 4, 5]), rnd.choice("xyz"), rnd.choice([None, *range(8)])) for _ in range(300)]
    df = spark.createDataFrame(rows, "a int, c string, d int").select("a", F.expr("a div 3").alias("b"), "c", "d", F.expr("d div 2").alias("e"), F.expr("d div 4").alias("f"))
    hierarchies = {"p": ["a", "b"], "q": ["c"], "r": ["d", "e", "f"]}
    got = {tuple(r[:3]): r[3:] for r in lattice.lattice(df, hierarchies, k, most).collect()}
    data = [r.asDict() for r in df.collect()]
    want, safe = {}, {}
    for node in product(range(3), range(2), range(4)):
        sizes = Counter(tuple(r[h[level]] if level < len(h) else "*" for h, level in zip(hierarchies.values(), node, strict=True)) for r in data).values()
        at_risk = sum(n for n in sizes if n < k)
        want[node], safe[node] = (min(sizes), len(sizes), at_risk), at_risk <= most
    assert set(got) == set(want)
    for node, (least, n, at_risk, is_safe, minimal) in got.items():
        below = [m for m in want if m != node and all(x <= y for x, y in zip(m, node, strict=True))]
        assert is_safe == safe[node] and minimal == (safe[node] and not any(safe[m] for m in below))
        assert (least, n, at_risk) == ((None,) * 3 if any(safe[m] for m in below) else want[node])


def test_lattice_of_nothing(spark):
    got = lattice.lattice(spark.createDataFrame([], "a int"), {"p": ["a"]}, 5).collect()
    assert [(r["p_level"], r["safe"], r["minimal"]) for r in got] == [(0, True, True), (1, True, False)]
    with pytest.raises(ValueError):
        lattice.lattice(spark.range(1), {}, 5)


def test_linkage_against_every_pair(spark):
    rnd = random.Random(2)
    day0 = date(2020, 1, 1)
    rows = [(rnd.choice([None, *range(40)]), rnd.choice([None, "a", "b"]), rnd.choice([None, *(day0 + timedelta(n) for n in range(120))])) for _ in range(700)]
    rows += rows[:50]
    df = spark.createDataFrame(rows, "who int, what string, day date")
    for within, reach in ((10, 7), (3, 0), (200, 1000)):
        mine = defaultdict(set)
        for who, what, day in rows:
            if who is not None and day is not None:
                mine[who].add((day, what is not None, what))
        lists = {who: sorted(own, key=lambda v: (v[0], v[1], v[2] or "")) for who, own in mine.items()}
        found = {(who, x[2], y[2], (y[0] - x[0]).days, x[0]) for who, own in lists.items() for x, y in zip(own, own[1:], strict=False) if (y[0] - x[0]).days <= within}
        want = defaultdict(list)
        for who, *kind, day in found:
            want[who].append([len({o[0] for o in found if list(o[1:4]) == kind and abs((o[4] - day).days) <= r}) for r in (0, reach)])
        want = {who: (len(v), min(b for b, _ in v), min(a for _, a in v)) for who, v in want.items()}
        got = {r["who"]: tuple(r[1:]) for r in linkage.linkage_risk(df, "who", "what", "day", within, reach).collect()}
        assert got == want
        assert all(b <= a for _, b, a in got.values())


def test_versions_against_every_pair(spark):
    rnd = random.Random(4)
    day0 = date(2019, 12, 1)
    dims = [(rnd.choice([None, *range(5)]), day0 + timedelta(rnd.randrange(900)), rnd.choice([None, date(9999, 12, 31), day0 + timedelta(rnd.randrange(1200))]), rnd.choice([None, "u", "v"]), i) for i in range(60)]
    facts = [(i, rnd.choice([None, *range(7)]), rnd.choice([None, day0 + timedelta(rnd.randrange(-50, 1100))])) for i in range(500)]
    facts += facts[:20]
    d = spark.createDataFrame(dims, "k int, begins date, ends date, name string, v int")
    f = spark.createDataFrame(facts, "id int, k int, day date").withColumn("name", F.lit("a fact's own")).withColumnRenamed("name", "label")

    def wanted(key, day):
        if key is None or day is None:
            return None, None, None
        begun = [x for x in dims if x[0] == key and x[1] <= day]
        if not begun:
            return None, None, None
        last = max(x[1] for x in begun)
        own = max((x for x in begun if x[1] == last), key=lambda x: (x[2] or date(9999, 12, 31), x[3] is not None, x[3] or "", x[4]))
        return (own[3], own[4], own[1]) if day <= (own[2] or date(9999, 12, 31)) else (None, None, None)

    for width in (1, 64, 5000):
        got = versions.as_of(f, "k", "day", d, "k", "begins", "ends", ["name", "v"], bucket_days=width)
        assert got.columns == ["id", "k", "day", "label", "name", "v", "valid_begins"]
        assert sorted(str((r["id"], r["name"], r["v"], r["valid_begins"])) for r in got.collect()) == sorted(str((i, *wanted(k, day))) for i, k, day in facts)
    assert versions.as_of(f.limit(0), "k", "day", d, "k", "begins", "ends", ["v"]).count() == 0
    assert versions.as_of(f, "k", "day", d.limit(0), "k", "begins", "ends", ["v"]).where("v is null").count() == len(facts)
    plan = versions.as_of(f, "k", "day", d, "k", "begins", "ends", ["v"])._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan


def test_contents_as_bags(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice([None, 1, 2]), rnd.choice([None, "", "a"]), rnd.choice([None, 0.5, float("nan")])) for _ in range(200)]
    other = rows[:150] + rows[:3] + [(9, "new", 1.0)] * 2
    schema = "bucket int, side string, x double"
    a, b = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema).select("x", "side", "bucket")
    cell = lambda r: str(tuple(r))
    more, less = Counter(map(cell, rows)) - Counter(map(cell, other)), Counter(map(cell, other)) - Counter(map(cell, rows))
    for n in (1, 7, 4096):
        got = contents.difference(a, b, n).toDF("which", "copies", "bucket", "side", "x").collect()
        assert {(r["which"], cell(r[2:])): r["copies"] for r in got} == {("before", c): n for c, n in more.items()} | {("after", c): n for c, n in less.items()}
        assert contents.differing(a, a.repartition(5), n).count() == 0 and contents.difference(a, a.orderBy("x"), n).count() == 0
    assert contents.difference(a.limit(0), a.limit(0)).count() == 0
    assert contents.difference(a, a.limit(0)).agg(F.sum("copies")).first()[0] == 200
    halves = [contents.digest(h, a.columns, 5) for h in (a.limit(80), spark.createDataFrame(a.tail(120), schema))]
    merged = halves[0].unionByName(halves[1]).groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.bit_xor("mixed").alias("mixed"))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, contents.digest(a, a.columns, 5).collect()))
    with pytest.raises(ValueError):
        contents.difference(a, a.drop("x"))


def test_a_failing_advisory_row_does_not_block(spark):
    from maskline.operators import ledger, residual

    people = spark.createDataFrame([("PT-1", 1980, "100", "a", "x"), ("PT-2", 1990, "200", "b", "y")], "tok string, dob int, zip string, q string, s string")
    late = ledger.expiry_row(spark, datetime(2025, 1, 1), datetime(2025, 1, 1), "expert")
    card = residual.scorecard(people, {"p": people}, "tok", "PT-", "dob", "zip", ("name",), (risk.advisory(people, ["q"], "s", 2, 2, 0.2), late))
    rows = {r["check"]: r for r in card.collect()}
    assert [r["passed"] for r in rows.values() if r["advisory"]] == [False] * 4 and all(r["passed"] for r in rows.values() if not r["advisory"])
    assert rows["k-anonymity of at least 2 on q"]["detail"] == "k=1; 2 rows in 2 classes"
    assert rows["t-closeness of at most 0.2 for s"]["detail"] == "t=0.500 over 2 classes"
    assert residual.verdict(card).first().asDict() == {"passed": True, "checks": 10, "advisory_failures": 4}
    leaky = people.withColumn("tok", F.lit("mail a@b.com"))
    card = residual.scorecard(leaky, {"p": leaky}, "tok", "PT-", "dob", "zip", ())
    told = {r["check"]: (r["passed"], r["detail"]) for r in card.collect()}
    assert told["tokens carry the prefix"] == (False, "2 without it") and told["no identifier patterns"] == (False, "p.tok")
    assert residual.verdict(card).first()["passed"] is False
    assert ledger.expiry_row(spark, None, datetime(2025, 1, 1), "x").first()["passed"] is False


def test_a_run_books_what_its_jobs_counted(spark, tmp_path):
    from maskline.operators import ledger

    name = f"ledger_{random.randrange(10**9)}"
    df = spark.createDataFrame([(1, "secret-value"), (2, None)], "k int, v string")
    rules = {"k": "passthrough", "v": "tokenize"}
    made = [f"{name}_{t}" for t in ("a", "b")]
    try:
        for _ in range(2):
            ledger.record_run(spark, {"a": (df, rules), "b": (df.limit(1), rules)}, "a-key-of-more-than-thirty-two-characters", "me", "v1", datetime(2025, 1, 1), name, f"{name}_")
        booked = spark.table(name).collect()
        assert sorted((r["table"], r["rows_in"], r["rows_out"], r["strategies"]) for r in booked) == sorted([("a", 2, 2, '{"passthrough":1,"tokenize":1}'), ("b", 1, 1, '{"passthrough":1,"tokenize":1}')] * 2)
        bad = df.select("k", F.col("v").cast("string")).withColumn("k", F.expr("cast(if(k = 1, 'secret-value', '2') as int)"))
        with pytest.raises(RuntimeError) as told:
            ledger.record_run(spark, {"a": (bad, rules)}, "a-key-of-more-than-thirty-two-characters", "me", "v1", datetime(2025, 1, 1), name, f"{name}_")
        assert "secret-value" not in str(told.value) and "CAST_INVALID_INPUT" in str(told.value)
        assert spark.table(name).count() == 4
    finally:
        for table in (name, *made):
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_arriving_files_stay_of_a_splits_size(spark, tmp_path):
    """A micro-batch has as many files as its share of the input's splits; before, it was one file, so one task wrote a quarter of any table."""
    spark.range(0, 4000, 1, 10).select("id", F.lit("text").alias("text")).write.parquet(f"{tmp_path}/table")
    df = spark.read.parquet(f"{tmp_path}/table").repartition(10)
    batches = []
    stream = monitor.arriving(df, f"{tmp_path}/in", F.col("id"), 4)
    query = stream.writeStream.foreachBatch(lambda rows, n: batches.append((len(rows.inputFiles()), rows.count()))).option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    files = list((tmp_path / "in").glob("*.parquet"))
    assert len(files) == 12 and len(batches) == 4 and sum(n for _, n in batches) == 4000
    assert max(spark.read.parquet(str(f)).count() for f in files) < 600
