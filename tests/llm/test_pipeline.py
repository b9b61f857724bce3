"""The pipeline's stages on small tables, each against brute force on its own input."""

import sys
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

P = pytest.importorskip("public_tokenizers")
corpus = pytest.importorskip("corpus_pipeline")

DATA = "/root/testdata/sf0.001"


def check_packing(before, after):
    """Every id of every row in one piece, gapless documents and sequences; before: (doc_id, text)."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = Counter()
    for i, text in before:
        want[(i, len(library.encode(text or "", add_special_tokens=False).ids) + 1)] += 1
    pieces = Counter()
    for r in after:
        pieces[(r["doc_id"], r["doc_tokens"])] += r["length"]
    assert pieces == Counter({key: key[1] * n for key, n in want.items()})
    sequences = {}
    for r in after:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048
    assert sum(sum(n for _, n in parts) < 2048 for parts in sequences.values()) <= 1  # one shard


def test_stages(spark, tmp_path):
    docs, seen = spark.read.parquet(f"{DATA}/documents.parquet"), []
    for name, stage in corpus.STAGES:
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append((docs.collect(), out.collect()))
        if name != "packing":
            assert out.columns == docs.columns
        docs = out

    toxic = {r["doc_id"] for r in spark.read.parquet(f"{DATA}/labels.parquet").where("toxic = 1").collect()}
    before, after = ({r["doc_id"] for r in rows} for rows in seen[0])
    assert after <= before and len(before - after - toxic) <= 0.02 * len(before)

    before, after = seen[1]
    assert {r["doc_id"] for r in after} >= {r["doc_id"] for r in before if len(brute.words(r["text"])) > 5 and r["lang"]}

    before, after = seen[2]
    classes = brute.near_classes([(r["doc_id"], r["text"]) for r in before], 5)
    assert sorted(r["doc_id"] for r in after) == sorted(i for i, c in classes.items() if i == c)

    before, after = seen[3]
    want = dict(zip((r["doc_id"] for r in before), brute.without_repeats([r["text"] for r in before], 50), strict=True))
    assert {r["doc_id"]: brute.words(r["text"]) for r in after} == want and all(r["n_chars"] == len(r["text"]) for r in after)

    before, after = seen[4]
    check_packing([(r["doc_id"], r["text"]) for r in before], after)


NAMES = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, p_toxic double, n_words int, n_removed int, row string, band int, component_id int"
EXTRA = ("s", 3, -7.0, "xx", 0.9, 1, 2, "r", 4, 5)


@pytest.fixture(scope="module")
def awkward(spark):
    """Null, empty and very long texts, ties, repeated rows, null ids, and columns named as the operators' own."""
    rng = np.random.default_rng(4)
    passage = " ".join(f"passage{i}" for i in range(60))
    rows = [(i, "the thing with this and that " * 5 + " ".join(f"w{x}" for x in rng.integers(0, 900, 40)), "en") for i in range(60)]
    rows += [(100, None, "en"), (101, "", None), (102, "  ", None), (103, "123 ½", None), (None, "the thing without an id and that", None), (None, None, None)]
    rows += [rows[3], (105, rows[3][1], "en"), (106, f"the thing {passage} that", "en"), (107, f"this and {passage} with", "en"), (108, "this and that thing " * 30_000, "en")]
    return rows, spark.createDataFrame([(*r, *EXTRA) for r in rows], NAMES)


def test_stages_on_awkward_rows(spark, awkward):
    rows, docs = awkward
    tuples = lambda df: Counter(tuple(r) for r in df.collect())
    whole = Counter((*r, *EXTRA) for r in rows)
    clean = corpus.drop_toxic(spark, docs, DATA)
    assert clean.columns == docs.columns and tuples(clean) == whole
    known = corpus.drop_unknown_language(spark, docs, DATA)
    assert known.columns == docs.columns and tuples(known) == Counter({t: n for t, n in whole.items() if any(c.isalpha() for c in t[1] or "")})
    apart = corpus.drop_near_duplicates(spark, docs, DATA)
    classes = brute.near_classes([r[:2] for r in rows if r[0] is not None], 5)
    assert apart.columns == docs.columns and tuples(apart) == Counter({t: n for t, n in whole.items() if t[0] is None or classes[t[0]] == t[0]})
    cut = corpus.drop_repeated_passages(spark, docs, DATA)
    want = Counter()
    for r, kept in zip(rows, brute.without_repeats([r[1] for r in rows], 50), strict=True):
        text = None if r[1] is None else " ".join(kept)
        want[(r[0], text, r[2], "s", None if text is None else len(text), *EXTRA[2:])] += 1
    assert cut.columns == docs.columns and tuples(cut) == want
    check_packing([r[:2] for r in rows], corpus.pack(spark, docs, DATA).collect())


def test_stages_on_an_empty_table(spark, awkward):
    nothing = awkward[1].where("doc_id = -5")
    for _, stage in corpus.STAGES:
        assert stage(spark, nothing, DATA).count() == 0


def test_toxic_documents_go(spark):
    data = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    gone = {r[0] for r in docs.select("doc_id").collect()} - {r[0] for r in corpus.drop_toxic(spark, docs, data).select("doc_id").collect()}
    toxic = {i for i, y in labels.items() if y == 1}
    assert len(toxic & gone) >= 0.6 * len(toxic) and not {i for i in gone if labels.get(i) == 0}


def test_language_keeps_clean_texts(spark):
    parts = ["the thing with this and that ", "der nicht für über ein schon ", "què això però aquesta llengua ", "og ikke være også når blå ", "że się jest który może był "]
    rows = [(i, parts[i % 5] * 12, str(i % 5)) for i in range(300)]
    several, one_word = "".join(p * 60 for p in parts), "nicht " * 500
    rows += [(1000, several, None), (1001, one_word, None), (1002, "12 34 " * 50, None), (1003, None, None)]
    rows += [(2000 + i, p.split()[0] + " " + (p.split()[1] + " ") * 300, str(i)) for i, p in enumerate(parts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in corpus.drop_unknown_language(spark, docs, DATA).collect()}
    assert kept == {r[0] for r in rows} - {1002, 1003}


def traced(task, batch):
    """A task's output for one batch, and its peak of memory in MB."""
    tracemalloc.start()
    out = list(task(iter([batch])))
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return out, most


def test_tasks_of_substring_dedup_are_small():
    from maskline.llm import substrings

    rng, window = np.random.default_rng(1), 50
    n = rng.integers(8, 44, substrings.SHARD)
    words = [rng.integers(0, 1 << 63, k + window - 1, dtype=np.uint64) for k in n]
    words[7] = words[8][-window:]
    n[7] = 1
    numbers, words = pa.array(np.arange(len(n))), pa.array([w.tobytes() for w in words], pa.binary())
    shard = pa.RecordBatch.from_arrays([numbers, numbers, pa.array(n, pa.int32()), pa.array(np.ones(len(n)), pa.int32()), words], ["anchor", "segment", "n", "copies", "words"])
    out, most = traced(substrings._search(window), shard)
    marked = {s: m for b in out for s, m in zip(b["segment"].to_pylist(), b["mask"].to_pylist(), strict=True) if m}
    assert marked == {7: 1, 8: 1 << int(n[8]) - 1} and most < 100  # 216 with 20,000 segments and all windows side by side

    hot = shard.select(["anchor", "segment", "n", "words"]).slice(0, 4000)
    out, most = traced(substrings._windows(window), hot)
    assert sum(b.num_rows for b in out) == int(n[:4000].sum()) and most < 40

    texts = pa.array([f"{i} " + "word " * 400 for i in range(3000)])
    marks = pa.array([[{"lo": 1, "mask": 1}]] * 3000, pa.list_(pa.struct([("lo", pa.int32()), ("mask", pa.int64())])))
    out = list(substrings._remove(window, 0)(iter([pa.RecordBatch.from_arrays([texts, marks], ["text", "marks"])])))
    assert max(b.nbytes for b in out) < 2e6 and sum(b.num_rows for b in out) == 3000 and {x for b in out for x in b["n_removed"].to_pylist()} == {window}


def test_stages_hand_rows_over_in_small_batches(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)
    docs = spark.range(6000, numPartitions=1).selectExpr("id doc_id", "repeat('some words ', 200) text")
    try:
        for given, most in (("64m", 4e6), ("300k", 6e5)):  # a smaller bound of the session stays
            for _, stage in corpus.STAGES:
                spark.conf.set(setting, given)
                stage(spark, spark.createDataFrame([], NAMES), DATA)
                assert docs.mapInArrow(sizes, "n long").agg({"n": "max"}).first()[0] < most
    finally:
        spark.conf.unset(setting)
