"""Structured identifiers in free text: spans, merging, redaction, counts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import keyed

# Patterns by type, in the order that decides between equal spans.
PATTERNS = {
    "US_SSN": r"\b(?!000|666|9\d\d)\d{3}[-.\s]?\d{2}[-.\s]?\d{4}\b",
    "PHONE_NUMBER": r"\b(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b",
    "EMAIL_ADDRESS": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "CREDIT_CARD": r"\b(?:\d[ -]?){13,16}\b",
    "IP_ADDRESS": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "URL": r"\bhttps?://[^\s]+\b",
}
# What a text must hold for a match of a type to be possible: a cheap look before the pattern.
HINTS = {
    "US_SSN": r"\p{Nd}{3}",
    "PHONE_NUMBER": r"\p{Nd}{3}",
    "EMAIL_ADDRESS": "@",
    "CREDIT_CARD": r"(?:\p{Nd}[ -]?){13}",
    "IP_ADDRESS": r"\p{Nd}\.\p{Nd}",
    "URL": "://",
}
SPAN = "struct<entity_type:string,start:int,end:int,score:double>"


def java(pattern: str) -> str:
    """The pattern with Unicode classes, as Python reads it."""
    return "(?U)" + pattern


def spread(df: DataFrame, most: int = 1 << 30) -> DataFrame:
    """Deal a small table of few splits to all cores, before work on its texts that costs far more than moving them.

    Splits are estimated from the plan's size, so nothing runs; a table of over ``most`` bytes stays as it is.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    cores, size = spark.sparkContext.defaultParallelism, int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores) if size <= min(most, cores // 2 * split) else df


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` reads it."""
    return F.element_at(F.transform(F.array(value), f), 1)


RUN = 256  # spans that are folded together


def runs(items: Column) -> Column:
    """An array in runs of 256."""
    starts = F.filter(F.sequence(F.lit(0), F.floor(F.size(items) / RUN).cast("int")), lambda j: j * RUN < F.size(items))
    return F.transform(starts, lambda j: F.slice(items, j * RUN + 1, RUN))


def fold(items: Column, state: Column, add: Callable[[Column, Column], Column], end: Callable[[Column], Column] | None = None) -> Column:
    """Fold an array into a state whose last field, ``out``, is an array that ``add`` appends to; the result is all of ``out``.

    An append copies the array, so a run has its own, and runs are joined once: the time stays
    near the array's length. ``end`` gives what the last state leaves to append.
    """

    def run(done: Column, own: Column) -> Column:
        begun = F.struct(done["state"].alias("state"), F.slice(done["out"][0], 1, 0).alias("out"))
        return once(F.aggregate(own, begun, add), lambda s: F.struct(s["state"].alias("state"), F.array_append(done["out"], s["out"]).alias("out")))

    first = F.struct(state["state"].alias("state"), F.array(state["out"]).alias("out"))
    finish = (lambda s: F.concat(F.flatten(s["out"]), end(s["state"]))) if end else (lambda s: F.flatten(s["out"]))
    return once(items, lambda x: F.aggregate(runs(x), first, run, finish))


def hinted(text: Column, name: str) -> Column:
    """Whether a text may hold a match of a type at all."""
    hint = HINTS[name]
    return text.contains(hint) if hint in ("@", "://") else text.rlike(hint)


def _of_type(text: Column, name: str) -> Column:
    """Spans of one type. Gaps and matches alternate; their running lengths give the offsets."""
    found = F.regexp_extract_all(text, F.lit(java(PATTERNS[name])), F.lit(0))
    gaps = F.split(text, java(PATTERNS[name]), -1)

    def add(done: Column, x: Column) -> Column:  # x: a gap and the match behind it (none behind the last)
        start = done["state"] + F.length(x["0"])
        end = start + F.length(x["1"])
        span = F.struct(F.lit(name).alias("entity_type"), start.alias("start"), end.alias("end"), F.lit(1.0).alias("score"))
        return F.when(x["1"].isNull(), done).otherwise(F.struct(end.alias("state"), F.array_append(done["out"], span).alias("out")))

    none = F.array().cast(f"array<{SPAN}>")
    found = fold(F.arrays_zip(gaps, found), F.struct(F.lit(0).alias("state"), none.alias("out")), add)
    return F.when(hinted(text, name), found).otherwise(none)


def spans(text: Column, entities: tuple[str, ...] = tuple(PATTERNS), score_threshold: float = 0.35) -> Column:
    """All spans by offset; a null or empty text has none. Equal starts keep the order of types."""
    unknown = set(entities) - set(PATTERNS)
    if unknown:
        raise ValueError(f"no pattern for {sorted(unknown)}")
    every = F.flatten(F.array(*(_of_type(F.coalesce(text, F.lit("")), e) for e in PATTERNS if e in entities)))
    every = F.filter(every, lambda s: s["score"] >= score_threshold)
    keyed_ = F.transform(every, lambda s, i: F.struct(s["start"].alias("k"), i.alias("i"), s.alias("s")))
    return F.transform(F.array_sort(keyed_), lambda x: x["s"])


def merge(found: Column) -> Column:
    """Join overlapping spans (touching ones stay apart). The higher score names the whole; ties, the earlier.

    The spans are gone through in order with the one that is still open: a span that begins
    before its end is joined to it, any other closes it.
    """
    ordered = F.array_sort(F.transform(found, lambda s, i: F.struct(s["start"].alias("a"), (-s["end"]).alias("b"), i.alias("i"), s.alias("s"))))

    def add(done: Column, x: Column) -> Column:
        s, last = x["s"], done["state"]
        best = F.when(s["score"] > last["score"], s).otherwise(last)
        joined = F.struct(best["entity_type"].alias("entity_type"), last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), best["score"].alias("score"))
        meets = F.coalesce(s["start"] < last["end"], F.lit(False))
        out = F.when(meets | last.isNull(), done["out"]).otherwise(F.array_append(done["out"], last))
        return F.struct(F.when(meets, joined).otherwise(s).alias("state"), out.alias("out"))

    none = F.array().cast(f"array<{SPAN}>")
    return fold(ordered, F.struct(F.lit(None).cast(SPAN).alias("state"), none.alias("out")), add, lambda last: F.when(last.isNull(), none).otherwise(F.array(last)))


def redact(text: Column, found: Column, replacement: str = "label", namespace: str = "free_text") -> Column:
    """Text with its merged spans replaced: ``label`` [TYPE], ``token`` [TYPE:hex] (needs the key), ``remove``. Null stays null."""
    if replacement not in ("label", "token", "remove"):
        raise ValueError(f"unknown replacement {replacement}")

    def put(s: Column, near: Column, base: Column) -> Column:
        if replacement == "remove":
            return F.lit("")
        if replacement == "label":
            return F.concat(F.lit("["), s["entity_type"], F.lit("]"))
        value = F.substring(near, s["start"] - base + 1, s["end"] - s["start"])
        message = F.encode(F.concat(F.lit(namespace + ":"), s["entity_type"], F.lit(keyed.SEPARATOR), value), "UTF-8")
        inner = F.unhex(F.sha2(F.concat(F.col(keyed.INNER), message), 256))
        return F.concat(F.lit("["), s["entity_type"], F.lit(":"), F.substring(F.sha2(F.concat(F.col(keyed.OUTER), inner), 256), 1, 12), F.lit("]"))

    before = lambda all_, i: F.coalesce(F.try_element_at(all_, F.nullif(i, F.lit(0)))["end"], F.lit(0))  # noqa: E731  where the span before the i-th ends

    def run(all_: Column, own: Column, j: Column) -> Column:  # a run of spans, and the stretch of text that they are in
        base = before(all_, j * RUN)
        near = F.substring(text, base + 1, F.element_at(own, -1)["end"] - base)
        pieces = lambda near: F.transform(own, lambda s, i: F.concat(F.substring(near, before(all_, j * RUN + i) - base + 1, s["start"] - before(all_, j * RUN + i)), put(s, near, base)))
        return once(near, lambda n: F.array_join(pieces(n), ""))

    def whole(all_: Column) -> Column:
        tail = F.substring(text, before(all_, F.size(all_)) + 1, F.length(text))
        return F.concat(F.array_join(F.transform(runs(all_), lambda own, j: run(all_, own, j)), ""), tail)

    return F.when(text.isNotNull(), once(found, whole))


def redact_column(df: DataFrame, column: str, replacement: str = "label", output: str | None = None, entities: tuple[str, ...] = tuple(PATTERNS), score_threshold: float = 0.35) -> DataFrame:
    """Redact a text column in place or into ``output``; for ``token`` the frame must carry the key.

    Only the types asked for are searched for. Rows, and all other columns, stay as they are.
    """
    value = F.col(f"`{column}`")
    return spread(df).withColumn(output or column, redact(value, merge(spans(value, entities, score_threshold)), replacement))


def count_entities(df: DataFrame, column: str, sample_limit: int | None = None) -> DataFrame:
    """Number of findings of each type that occurs, over the whole column."""
    df, value = spread(df.limit(sample_limit) if sample_limit else df), F.col(f"`{column}`")
    sums = df.agg(*(F.sum(F.when(hinted(value, e), F.regexp_count(value, F.lit(java(p))))).alias(e) for e, p in PATTERNS.items()))
    pairs = F.array(*(F.struct(F.lit(e).alias("entity_type"), F.col(e).cast("long").alias("findings")) for e in PATTERNS))
    return sums.select(F.inline(pairs)).where("findings > 0")


def finding_rows(df: DataFrame, id_col: str, column: str, include_text: bool = False) -> DataFrame:
    """A row for each finding, with its text only when asked for."""
    value = F.col(f"`{column}`")
    found = spread(df).select(F.col(id_col).alias("i"), value.alias("t"), F.explode(spans(value)).alias("s"))
    shown = [F.substring("t", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("matched")] if include_text else []
    return found.select(F.col("i").alias(id_col), "s.entity_type", "s.start", "s.end", "s.score", *shown)


def any_match(text: Column, patterns: list[str]) -> Column:
    """Whether a text matches one of the patterns, which are used as they stand."""
    return reduce(lambda a, b: a | b, (text.rlike(p) for p in patterns))


def any_entity(text: Column) -> Column:
    """Whether a text holds a finding of any type."""
    return reduce(lambda a, b: a | b, (hinted(text, e) & text.rlike(java(p)) for e, p in PATTERNS.items()))
