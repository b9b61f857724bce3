"""Merging and redaction of many spans: by value against plain Python, in time near their number."""

import random
import time

from pyspark.sql import functions as F

from maskline.functions import text


def plain_merge(spans):
    out = []
    for _, s in sorted(enumerate(spans), key=lambda x: (x[1][1], -x[1][2], x[0])):
        if out and s[1] < out[-1][2]:
            last = out[-1]
            best = s if s[3] > last[3] else last
            out[-1] = (best[0], last[1], max(last[2], s[2]), best[3])
        else:
            out.append(s)
    return out


def plain_redact(value, spans):
    for kind, start, end, _ in reversed(spans):
        value = value[:start] + f"[{kind}]" + value[end:]
    return value


def test_merge_and_redact_across_runs(spark):
    rnd = random.Random(8)
    rows = []
    for n in (0, 1, 2, 255, 256, 257, 511, 512, 513, 1500):
        size = max(40, n * rnd.choice([2, 5, 12]))
        value = "".join(rnd.choice("abé日\U0001f600 ") for _ in range(size))
        found = [(rnd.choice("ABC"), s, min(size, s + rnd.randrange(1, 7)), rnd.choice([0.4, 0.9, 1.0])) for s in (rnd.randrange(size) for _ in range(n))]
        rows.append((n, value, found))
    rows.append((-1, None, []))
    df = spark.createDataFrame(rows, f"n int, value string, found array<{text.SPAN}>")
    merged = text.merge(F.col("found"))
    for r, (_, value, found) in zip(df.select("n", merged.alias("m"), text.redact(F.col("value"), merged).alias("r")).orderBy(F.monotonically_increasing_id()).collect(), rows, strict=True):
        want = plain_merge(found)
        assert [tuple(s) for s in r["m"]] == want
        assert r["r"] == (None if value is None else plain_redact(value, want))


def test_time_grows_with_the_number_of_findings(spark):
    def seconds(n):
        df = spark.createDataFrame([(" ".join(f"mail user{i}@example.com" for i in range(n)),)], "t string").cache()
        df.count()
        out = text.redact_column(df, "t")
        began = time.perf_counter()
        assert out.first()["t"] == " ".join(["mail [EMAIL_ADDRESS]"] * n)
        return time.perf_counter() - began

    seconds(100)
    few, many = seconds(2_000), seconds(16_000)
    assert many < 8 * few + 10  # a quadratic fold takes some 64 times as long


def test_spread_runs_nothing_and_leaves_large_tables(spark):
    df = spark.range(10).groupBy((F.col("id") % 3).alias("g")).count()
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    text.spread(df)
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert text.spread(df, most=0) is df
