"""Toxicity by a chain of linear classifiers over screened words and word beginnings."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared

MAX_ROWS = 8_000  # labelled documents that the chain is fitted on, at most
CLEAR = 6.0  # standard errors above an even spread from which a word is screened
CATEGORIES = ("low_quality", "severe", "toxic")  # in the order of the chain
STEMS = (4, 5, 6)  # letters of the word beginnings that are counted like words
_WORD = re.compile(r"\w+")


@dataclass
class Chain:
    """Words and, for each category, the weights of a bias, the length, the words, and the earlier categories."""

    words: list[str]
    weights: list[np.ndarray] = field(default_factory=list)

    def features(self, counts: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(counts)), np.log1p(n_words) / 10, np.log1p(counts)])

    def scores(self, counts: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        """Probabilities of the categories, each model seeing those before it."""
        x, out = self.features(counts, n_words), np.zeros((len(counts), len(CATEGORIES)))
        for j, w in enumerate(self.weights):
            out[:, j] = _sigmoid(np.column_stack([x, out[:, :j]]) @ w)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, steps: int = 10) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the bias (column 0) is free."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(steps):
        p = _sigmoid(x @ w)
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(hessian, x.T @ (y - p) - penalty * w)
        w += move
        if np.abs(move).max() < 1e-4:
            break
    return w


def fit_chain(chain: Chain, counts: np.ndarray, n_words: np.ndarray, labels: np.ndarray, folds: int = 3) -> Chain:
    """Fit the models in order. What a later one sees of an earlier one is predicted out of fold."""
    x = chain.features(counts, n_words)
    part = np.arange(len(x)) % folds
    for j in range(labels.shape[1]):
        y = labels[:, j]
        chain.weights.append(_logistic(x, y))
        held = np.zeros(len(x))
        for k in range(folds):
            out = part == k
            held[out] = _sigmoid(x[out] @ _logistic(x[~out], y[~out])) if (~out).any() else 0
        x = np.column_stack([x, held])
    return chain


def _named(word: str) -> list[str]:
    """A word and its beginnings, each a possible feature."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


def _counts(words: list[str], texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """How often each screened word or beginning occurs in each text, and the texts' words."""
    at, counts, n_words = {w: i for i, w in enumerate(words)}, np.zeros((len(texts), len(words))), np.zeros(len(texts))
    stems = sorted({len(w) - 1 for w in words if w.endswith("*")})
    for i, text in enumerate(texts):
        seen = Counter(_WORD.findall((text or "").lower()))
        n_words[i] = seen.total()
        for w in at.keys() & seen.keys():
            counts[i, at[w]] = seen[w]
        for n in stems:
            for w in [w for w in seen if w[:n] + "*" in at and len(w) > n]:
                counts[i, at[w[:n] + "*"]] += seen[w]
    return counts, n_words


def fit_toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", quality_col: str = "quality") -> Chain:
    """Screen words and fit the chain on at most ``MAX_ROWS`` labelled documents, chosen by a hash of their ids.

    The categories come from the labels, not from the features: low_quality (quality 0), severe
    (toxic and of low quality), and at the end toxic, whose model sees the probabilities of the
    two before it. Features are words and word beginnings; all are taken that stand in more
    toxic, or more low-quality, documents than an even spread would give by six and more standard
    errors. They are counted in one aggregate over the chosen documents.

    A document labelled more than once is toxic, or of low quality, if any of its labels says so;
    a null quality counts as good. Without labels, or without features that stand out, nothing is
    toxic. Null texts count as empty; labels without an id, or of no document, are passed over.
    """
    low = F.coalesce((F.col(quality_col) == 0).cast("int"), F.lit(0)) if quality_col in labels.columns else F.lit(0)
    known = labels.where(F.col(toxic_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max((F.col(toxic_col) == 1).cast("int")).alias("_y"), F.max(low).alias("_q"))
    n = known.count()
    if not n:
        return Chain([])
    share = min(1.0, 0.95 * MAX_ROWS / n)
    chosen = known.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(share * 1_000_000)).limit(MAX_ROWS)
    chosen = F.broadcast(chosen)  # MAX_ROWS rows of three numbers
    docs = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(chosen, "_id").select("_t", "_y", "_q")

    @shared.lean
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[int, int], Counter] = {}
            for text, y, q in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = set(_WORD.findall((text.as_py() or "").lower()))
                seen.setdefault((y, q), Counter()).update({None, *(f for w in words for f in _named(w))})
            words = sorted(set().union(*seen.values()) - {None}) + [None]
            of = lambda cells: pa.array([sum(seen[c][w] for c in cells if c in seen) for w in words], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), of([(1, 0), (1, 1)]), of([(0, 1), (1, 1)]), of([(0, 0), (0, 1), (1, 0), (1, 1)])], ["word", "toxic", "low", "n"])

    seen = docs.mapInArrow(distinct, "word string, toxic long, low long, n long")
    table = seen.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("toxic", "low", "n")))
    everyone = table.where("word is null").first()
    if not everyone or not 0 < everyone["toxic"] < everyone["n"]:
        return Chain([])

    def clear(column: str) -> Column:
        expected = F.col("n") * F.lit(everyone[column] / everyone["n"])
        return (F.col(column) >= 3) & (F.col(column) - expected > CLEAR * F.sqrt(expected))

    standing = table.where(F.col("word").isNotNull() & (clear("toxic") | clear("low")))
    words = sorted(r["word"] for r in standing.select("word").collect())  # words of at most MAX_ROWS documents

    @shared.lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, n_words = _counts(words, batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([x.astype("<i4").tobytes() for x in counts], pa.binary()), pa.array(n_words), *batch.columns[1:]], ["counts", "n", "y", "q"])

    rows = docs.mapInArrow(count, "counts binary, n double, y int, q int").toPandas()
    rows = rows.sort_values(["y", "q", "n", "counts"], ignore_index=True)  # the order in which tasks end doesn't matter
    counts = np.array([np.frombuffer(x, "<i4") for x in rows["counts"]], float).reshape(len(rows), len(words))
    y, q = rows["y"].to_numpy() == 1, rows["q"].to_numpy() == 1
    return fit_chain(Chain(words), counts, rows["n"].to_numpy(), np.column_stack([q, q & y, y]).astype(float))


def with_toxicity(df: DataFrame, chain: Chain, text_col: str = "text", prefix: str = "p_") -> DataFrame:
    """Add ``p_low_quality``, ``p_severe``, ``p_toxic`` for every whole text (null: empty).

    They replace columns of these names; all others stay, whatever their names. A chain that was
    not fitted (no labels) gives zeros. Equal texts get equal values; an empty table, no rows.
    """
    names = [prefix + c for c in CATEGORIES]
    df = df.drop(*names)
    at = df.columns.index(text_col)

    @shared.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in shared.slices(whole, at)):
            p = chain.scores(*_counts(chain.words, batch.column(at).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(p[:, j]) for j in range(len(names)))], [*batch.schema.names, *names])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *(T.StructField(c, T.DoubleType()) for c in names)]))
