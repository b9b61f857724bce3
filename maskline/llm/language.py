"""Language identification by a byte convolutional network in numpy."""

from __future__ import annotations

import copy
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared

WINDOW = 256  # bytes of a window
WIDTHS, FILTERS = (2, 3, 4), 16
MAX_ROWS, PER_TEXT = 1_200, 6  # texts that the first weights come from, and windows of each, at most
HELD, RATE, SETTLED, PARTS, ONE = 4_096, 0.02, 0.01, 32, 1 << 20  # windows that are mixed at a time; step of the pass over all texts; error from which a window moves the weights; tasks that add replicas up; fixed point of a weight
_WORDLIKE = re.compile(r"[^\W\d_]")
_LETTERS = np.array([c >= 128 or chr(c).isalpha() for c in range(256)])


@dataclass
class ByteNet:
    """For each width, a table of filter weights per offset and byte; then a softmax layer."""

    langs: list[str]
    tables: list[np.ndarray]  # width, 256, filters
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def params(self) -> list[np.ndarray]:
        return [*self.tables, self.bias, self.out, self.out_bias]

    def pooled(self, x: np.ndarray, where: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response of every filter over a window (rectified), and where it stood."""
        tops, places = [], []
        for table in self.tables:
            width = len(table)
            end = x.shape[1] - width + 1
            a = table[0].take(x[:, :end], axis=0)
            for j in range(1, width):
                a += table[j].take(x[:, j : end + j], axis=0)
            if where:
                places.append(a.argmax(axis=1))
            tops.append(a.max(axis=1))
        return np.maximum(np.concatenate(tops, axis=1) + self.bias, 0), places

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.langs)), np.float32)
        for i in range(0, len(x), 64):
            z = self.pooled(x[i : i + 64])[0] @ self.out + self.out_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out[i : i + 64] = z / z.sum(axis=1, keepdims=True)
        return out


def has_letter(text: str) -> bool:
    """Whether a text has a character of a letter category (signs like ½, ① or Ⅳ are none)."""
    return any(m[0].isalpha() for m in _WORDLIKE.finditer(text))


def windows(text: str) -> np.ndarray:
    """The whole text, lower-cased, as UTF-8 windows of ``WINDOW`` bytes (the last is filled with zeros)."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    out = np.zeros(-(-len(data) // WINDOW) * WINDOW, np.uint8)
    out[: len(data)] = data
    return out.reshape(-1, WINDOW)


def _gradients(net: ByteNet, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> list[np.ndarray]:
    """Mean gradients of the cross-entropy, in the order of the parameters."""
    h, places = net.pooled(x, where=True)
    z = h @ net.out + net.out_bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(x)), y] -= 1
    if weight is not None:
        p *= weight[:, None]
    p /= len(x)
    dh = (p @ net.out.T) * (h > 0)
    grads = []
    for k, (table, place) in enumerate(zip(net.tables, places, strict=True)):
        g, d = np.zeros_like(table), dh[:, k * FILTERS : (k + 1) * FILTERS]
        for j in range(len(table)):
            np.add.at(g[j], (x[np.arange(len(x))[:, None], place + j], np.arange(FILTERS)), d)
        grads.append(g)
    return [*grads, dh.sum(axis=0), h.T @ p, p.sum(axis=0)]


def train(x: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = 4, rate: float = 0.02) -> ByteNet:
    """Adam on cross-entropy. A pooled filter passes its gradient to the bytes where it was largest."""
    rng = np.random.default_rng(3)
    tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    n = FILTERS * len(WIDTHS)
    net = ByteNet(langs, tables, np.zeros(n, np.float32), rng.normal(0, 0.2, (n, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))
    params = net.params()
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 64):
            pick = order[i : i + 64]
            grads = _gradients(net, x[pick], y[pick])
            t += 1
            for a, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                a -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
    return net


def _known(df: DataFrame, text_col: str, lang_col: str, id_col: str) -> DataFrame:
    return df.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())


def _drawn(known: DataFrame, counts: dict[str, int], lang_col: str, id_col: str) -> DataFrame:
    """About ``MAX_ROWS`` labelled texts at most, an equal number of each language (of the ``MAX_ROWS`` most frequent), chosen by a hash of their ids."""
    each = max(1, MAX_ROWS // len(counts))
    draw = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_000))
    take = F.lit(False)
    for lang, n in sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:MAX_ROWS]:
        take = take | ((F.col(lang_col) == lang) & (draw < int(min(1.0, 0.9 * each / n) * 1_000_000)))
    return known.where(take)


def _descend(net: ByteNet, counts: dict[str, int]):
    """A replica of the network goes once over all windows of a task's texts: its parameters times the windows, in fixed point."""
    number = {lang: i for i, lang in enumerate(net.langs)}
    even = sum(counts.values()) / len(counts)
    share = np.array([min(4.0, (even / counts[lang]) ** 0.5) for lang in net.langs], np.float32)

    @shared.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rng, seen = copy.deepcopy(net), np.random.default_rng(5), 0
        held: list[tuple[np.ndarray, int, float]] = []

        def learn() -> None:
            x = np.concatenate([w for w, _, _ in held])
            n = [len(w) for w, _, _ in held]
            y, weight = (np.repeat(np.array([h[c] for h in held], t), n) for c, t in ((1, np.int64), (2, np.float32)))
            order = rng.permutation(len(x))
            for i in range(0, len(x), 64):
                pick = order[i : i + 64]
                pick = pick[1 - own.probabilities(x[pick])[np.arange(len(pick)), y[pick]] > SETTLED]
                if not len(pick):
                    continue
                for a, g in zip(own.params(), _gradients(own, x[pick], y[pick], weight[pick]), strict=True):
                    a -= RATE * (len(pick) / 64) * g

        for batch in (part for whole in batches for part in shared.slices(whole, 0)):
            for value, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                x = windows(value.as_py())
                x = x[_LETTERS[x].any(axis=1)]
                for i in range(0, len(x), HELD):  # a long text counts as PER_TEXT windows
                    held.append((x[i : i + HELD], number[lang], share[number[lang]] * min(1.0, PER_TEXT / len(x))))
                    seen += len(held[-1][0])
                    if sum(len(h[0]) for h in held) >= HELD:
                        learn()
                        held.clear()
        if held:
            learn()
        if seen:
            flat = np.concatenate([a.ravel() for a in own.params()])
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([(np.rint(flat.astype(float) * ONE).astype(np.int64) * seen).tobytes()], pa.binary())], ["n", "params"])

    return run


@shared.lean
def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replicas of a task added up: whole numbers, so that their order doesn't matter."""
    seen, total = 0, None
    for batch in batches:
        for n, params in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            more = np.frombuffer(params.as_py(), np.int64)
            seen, total = seen + n, more if total is None else total + more
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["n", "params"])


def fit_language(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> ByteNet | None:
    """Fit on every window of every labelled text.

    The first weights come from at most ``MAX_ROWS`` texts, an equal number of each language,
    chosen by a hash of their ids, and ``PER_TEXT`` windows of each. From there a replica in each
    task goes once over all windows with letters of all its texts, by gradient descent (a window
    predicted right with 0.99 and more has next to no gradient and moves nothing); the mean of
    the replicas, by their windows, is the network. Languages weigh by the inverse root of their
    texts (up to four times), a text's windows together as ``PER_TEXT`` at most. Rows without
    text, language or id are passed over. None if nothing is left.
    """
    known = _known(df, text_col, lang_col, id_col)
    counts = {r[0]: r[1] for r in known.groupBy(lang_col).count().collect()}
    if not counts:
        return None
    cut = [F.substring(F.col(text_col), (F.length(text_col) * i / PER_TEXT).cast("int") + 1, F.lit(WINDOW)) for i in range(PER_TEXT)]
    rows = _drawn(known, counts, lang_col, id_col).select(F.col(lang_col).alias("lang"), F.array(*cut).alias("parts"), F.col(id_col).alias("id")).limit(MAX_ROWS).toPandas()
    rows = rows.sort_values("id")
    langs = sorted(counts)
    x, y = [], []
    for lang, parts in zip(rows["lang"], rows["parts"], strict=True):
        for part in dict.fromkeys(parts):
            if has_letter(part):
                x.append(windows(part)[:1])
                y.append(langs.index(lang))
    net = train(np.concatenate(x) if x else np.empty((0, WINDOW), np.uint8), np.array(y, np.int64), langs)
    replicas = known.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).mapInArrow(_descend(net, counts), "n long, params binary")
    done = next(_summed(replicas.repartition(PARTS).mapInArrow(_summed, "n long, params binary").toArrow().to_batches()), None)
    if done is None:  # no window of any text has a letter
        return None
    mean, first = np.frombuffer(done.column(1)[0].as_py(), np.int64) / (done.column(0)[0].as_py() * ONE), 0
    for a in net.params():
        a[...] = mean[first : first + a.size].reshape(a.shape)
        first += a.size
    return net


def sure_from(df: DataFrame, net: ByteNet, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> float:
    """The limit of ``sure`` under which a text is in no learned language, from all labelled texts left out of the fit.

    Half-way from chance to the least sure of them, so that all of them stay; 0 if there are none.
    """
    known = _known(df, text_col, lang_col, id_col)
    scored = with_language(known.select(F.col(text_col).alias("text")), net).where(F.col("lang_pred") != "und")
    least = scored.agg(F.min("sure")).first()[0]
    return 0.0 if least is None else (least + 1 / len(net.langs)) / 2


def with_language(df: DataFrame, net: ByteNet | None, text_col: str = "text") -> DataFrame:
    """Add lang_pred and score for every whole text: the mean of its windows' probabilities.

    ``sure`` is the mean of each window's own best probability, so it stays high in a text of
    several languages. Windows count by their letters; a text that is null or has no letter, or
    any text if there was nothing to learn from, is ``und`` with score and sure 0. The three
    replace columns of these names.
    """
    df = df.drop("lang_pred", "score", "sure")
    at = df.columns.index(text_col)

    @shared.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in shared.slices(whole, at)):
            langs, scores, sures = [], [], []
            for value in batch.column(at):
                text = value.as_py()
                if net is None or text is None or not has_letter(text):
                    langs.append("und")
                    scores.append(0.0)
                    sures.append(0.0)
                    continue
                x = windows(text)
                letters = _LETTERS[x].sum(axis=1)
                each = net.probabilities(x[letters > 0])
                p = letters[letters > 0] @ each / letters.sum()
                langs.append(net.langs[int(p.argmax())])
                scores.append(min(1.0, float(p.max())))
                sures.append(min(1.0, float(letters[letters > 0] @ each.max(axis=1) / letters.sum())))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(sures, pa.float64())], [*batch.schema.names, "lang_pred", "score", "sure"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("sure", T.DoubleType())]))
