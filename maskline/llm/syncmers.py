"""Document fingerprints from closed syncmers [DataFrame functions only]."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared

K, S = 6, 2  # units in a k-mer and in its inner substrings
# A word of up to 16 characters is a unit; in a longer run without a blank, each character is one.
UNIT = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{1,16}+(?![^\x20\x09-\x0D])|[^\x20\x09-\x0D]"
ANCHORS = "array<struct<pos:int,hash:bigint>>"


def with_syncmers(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """Add ``name``: array of (pos, hash), the closed syncmers of a text in order.

    A k-mer (six units, word-like) is chosen if the smallest hash of its five inner two-unit
    substrings stands first or last in it. The choice looks at the k-mer alone, so equal
    passages give equal anchors wherever they stand, and at least one of any four neighbouring
    k-mers is chosen. Anchors carry 32 bits of their k-mer's hash. A text without a chosen k-mer
    (all of one to five units, some of six to eight) has one anchor, its whole; null, empty and
    blank texts have none.
    """
    units, ranks, at = f"{name}_u", f"{name}_r", f"{name}_p"
    n, last = F.size(units), K - S
    short = lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF))
    df = df.withColumn(units, F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(UNIT), F.lit(0)))
    df = df.withColumn(f"{name}_h", F.transform(units, lambda u: F.xxhash64(u)))
    df = df.withColumn(
        ranks,
        F.when(n >= K, F.transform(F.sequence(F.lit(0), n - S), lambda i: F.xxhash64(F.get(f"{name}_h", i), F.get(f"{name}_h", i + 1)))),
    )

    def edge(i: Column) -> Column:
        first, end = F.get(ranks, i), F.get(ranks, i + last)
        inner = F.least(*(F.get(ranks, i + j) for j in range(1, last)))
        return F.least(first, end) <= inner

    df = df.withColumn(at, F.filter(F.sequence(F.lit(0), F.greatest(n - K, F.lit(0))), lambda i: (n >= K) & edge(i)))
    whole = F.array(F.struct(F.lit(0).alias("pos"), short(F.xxhash64(F.array_join(units, " "))).alias("hash")))
    hashed = F.transform(
        at,
        lambda i: F.struct(i.alias("pos"), short(F.xxhash64(*(F.get(ranks, i + j) for j in range(0, K, S)))).alias("hash")),
    )
    df = df.withColumn(name, F.when(F.size(at) > 0, hashed).when(n > 0, whole).otherwise(F.array().cast(ANCHORS)))
    return df.drop(units, f"{name}_h", ranks, at)


def as_string(anchors: Column) -> Column:
    """The anchors in order, nine digits each: how many units it stands behind the one before, and its hash.

    That step is one digit, 0 to 4, since one of any four neighbouring k-mers is chosen.
    """
    step = lambda a, i: a["pos"] - F.coalesce(F.get(anchors, i - 1)["pos"], F.lit(0))
    return F.array_join(F.transform(anchors, lambda a, i: F.concat(step(a, i).cast("string"), F.lower(F.lpad(F.hex(a["hash"]), 8, "0")))), "")


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Add ``name``: how alike two texts' anchors are, 0 to 1, by positional matching.

    Of the anchors that occur in both (each by its first place), those are matched whose step
    to the common anchor before or after is the same in both texts, or that are the only one:
    a passage keeps its steps wherever it stands, chance hits do not. The likeness is the
    matched anchors over all different ones. Two texts without anchors are alike.
    """
    sided, once, at, met = f"{name}_s", f"{name}_o", f"{name}_i", f"{name}_m"
    # A number for each anchor: 32 bits of hash, one for the text, 31 of place; so they sort as numbers.
    of = lambda c, side: F.transform(c, lambda x: F.shiftleft(x["hash"], 32).bitwiseOR(F.lit(side << 31)).bitwiseOR(x["pos"].cast("long")))
    df = df.withColumn(sided, F.sort_array(F.concat(of(a, 0), of(b, 1))))
    df = df.withColumn(once, F.filter(sided, lambda x, i: (i == 0) | (F.shiftright(F.get(sided, i - 1), 31) != F.shiftright(x, 31))))
    same = lambda i: F.shiftright(F.get(once, i), 32) == F.shiftright(F.get(once, i + 1), 32)
    df = df.withColumn(at, F.when(F.size(once) > 1, F.filter(F.sequence(F.lit(0), F.size(once) - 2), same)).otherwise(F.array().cast("array<int>")))
    place = lambda x: F.coalesce(x.bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(0))
    df = df.withColumn(met, F.sort_array(F.transform(at, lambda i: F.shiftleft(place(F.get(once, i)), 32).bitwiseOR(place(F.get(once, i + 1))))))
    step = lambda x, y: F.coalesce(F.shiftright(y, 32) - F.shiftright(x, 32) == place(y) - place(x), F.lit(False))
    placed = F.size(F.filter(met, lambda x, i: step(F.get(met, i - 1), x) | step(x, F.get(met, i + 1)) | (F.size(met) == 1)))
    union = F.size(once) - F.size(met)
    return df.withColumn(name, F.when(union == 0, F.lit(1.0)).otherwise(placed / union)).drop(sided, once, at, met)


def fingerprint_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = shared.RANGE_BYTES) -> DataFrame:
    """Fingerprint every text, its edited text, and compare it with that and with the next text.

    The next document is that with the next smaller id (after the smallest: the largest, nulls
    being smallest). The edited text is the text with its last floor(n/2) code points replaced
    by the first as many of the next one. Rows are dealt to ranges of about ``range_bytes``; the
    top row of a range is also sent, as a guest, to the range above it, so one shuffle brings
    every row and its successor together and no window is wider than a range.

    Null texts count as empty; rows with one id or none follow each other in the order of a hash
    of their texts; one row alone is its own successor; other columns of ``df`` are not read.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("_tie", F.xxhash64("text"))
    cut = shared.ranges(docs, [F.col("doc_id"), F.col("_tie")], F.octet_length("text") + 16, range_bytes)
    dealt = docs.withColumn("_home", cut.index())
    home, last = F.col("_home"), len(cut.cuts)
    if last:
        top = F.from_json(F.lit(shared.json.dumps(cut.top)), cut.kind)
        guest = F.when(F.get(cut.points(), home) == cut.key(), home + 1).when(cut.key() == top, F.lit(0))
        dealt = dealt.withColumn("_in", F.explode(F.when(guest.isNull(), F.array(home)).otherwise(F.array(home, guest))))
    else:
        dealt = dealt.withColumn("_in", home)
    dealt = cut.dealt(dealt, "_in")
    dealt = with_syncmers(dealt, "text", "_a")
    order = Window.partitionBy("_in").orderBy((F.col("_in") != F.col("_home")).asc(), F.col("doc_id").desc_nulls_last(), F.col("_tie").desc())
    everyone = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pair = F.struct(F.col("text").alias("t"), F.col("_a").alias("a"))
    one = F.lit(None) if last else F.first(pair).over(everyone)
    both = dealt.withColumn("_next", F.coalesce(F.lead(pair).over(order), one)).where(F.col("_in") == F.col("_home"))
    half = F.floor(F.length("text") / 2).cast("int")
    both = both.withColumn("_edited", F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("_next.t", F.lit(1), half)))
    both = with_syncmers(both, "_edited", "_e").withColumn("_n", F.col("_next.a"))
    both = with_likeness(with_likeness(both, "_a", "_e", "near_edited"), "_a", "_n", "near_next")
    return both.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256"),
        as_string(F.col("_a")).alias("fingerprint"),
        as_string(F.col("_e")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
