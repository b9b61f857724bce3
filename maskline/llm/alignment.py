"""Token alignment of two tokenizers, with corpus-wide counts of linked id pairs."""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared
from .pieces import BYTE, NORMAL, SPACE, USER, read_model

PART = 1 << 20  # characters that are aligned at a time
KEPT = 160 << 20  # estimated bytes of links and group strings after which the known chunks are forgotten
_NO_PREFIX = b"\x1a\x02\x18\x00"  # appended to a model file: its normaliser puts no blank in front
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?|"
_CHUNK = re.compile(rf"\n(?=\S)|\s*[{_LETTERS}]+(?=[{_MARKS}])|\s*\S+(?:[^\S \n]\s*\S*)*|\s+")
_REACHING = re.compile(rf"[^▁][▁\n]|\n.|[{_LETTERS}][{_MARKS}]", re.S)
_CUT = re.compile(r"(?<=\S) (?=\S)")
_loaded: dict[tuple[str, str], Aligner] = {}


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies show each byte: itself if printable, else from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Numbers(dict):
    """Numbers chunks in the order in which they are first met."""

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = len(self)
        return n


class Aligner:
    """Aligned tokens of texts, by chunks that neither tokenizer reaches across.

    Tokenizer A (byte-level, its own special tokens read as plain text) gets a blank and the
    text; B (pieces) puts that blank in front itself. A text is cut before a single blank,
    around a single line break and before a run of blanks, always after a character that is no
    white space, and between a Latin letter and a mark: A's words end there, and B has no piece
    that reaches across (a model that has is refused). So a chunk's tokens, groups and links are
    the same in every text, and are found once.

    A link's code is ``a * n_b + b``. ``same`` holds for each A id the B id with the same bytes,
    or -1; links of such pairs are counted in vectors of the vocabulary's length.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        with open(b_path, "rb") as f:
            self.b = sentencepiece.SentencePieceProcessor(model_proto=f.read() + _NO_PREFIX)
        letters = byte_letters()
        names = {i: name for name, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.n_a = max(names) + 1
        self.a_bytes = [bytes(letters[c] for c in names[i]) if i in names else b"" for i in range(self.n_a)]
        model = read_model(b_path)
        if any(_REACHING.search(p) for p, _, kind in model.pieces if kind in (NORMAL, USER)):
            raise ValueError("pieces reach across words; texts cannot be cut there")
        self.n_b = len(model.pieces)
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if kind == BYTE else p.replace(SPACE, " ").encode() for p, _, kind in model.pieces]
        by_bytes = {self.b_bytes[i]: i for i, (_, _, kind) in reversed(list(enumerate(model.pieces))) if kind == BYTE}
        by_bytes |= {self.b_bytes[i]: i for i, (_, _, kind) in reversed(list(enumerate(model.pieces))) if kind in (NORMAL, USER)}
        self.a_lengths, self.b_lengths = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        self.shown = [f"{i}{mark}".encode() for n, marks in ((self.n_a, ",|"), (self.n_b, ",;")) for i in range(n) for mark in marks]
        self.shown_lengths = np.fromiter(map(len, self.shown), np.int64, len(self.shown))
        self.same = np.array([by_bytes.get(x, -1) for x in self.a_bytes], np.int64)
        self.forget()

    def forget(self) -> None:
        self.number = _Numbers()
        self.sizes = array("q")  # A tokens, B tokens, groups, links of each chunk; and whether its bytes differ
        self.begin, self.links = array("q", [0]), array("q")
        self.groups: list[bytes] = []  # as text
        self.held = 0

    def learn(self, chunks: list[str]) -> None:
        """Align chunks that are new, all at once.

        Their bytes are laid end to end. Between two neighbouring ends of tokens lies one link, of
        the A and the B token that cover the place; a group ends where tokens of both do.
        """
        a_lists = [e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        b_lists = self.b.encode(chunks, num_threads=1)
        raw = [c.encode("utf-8", "surrogatepass") for c in chunks]
        differs = self._differing(a_lists, b_lists, raw)
        if differs.any():
            none: list[int] = []
            a_lists = [none if d else x for x, d in zip(a_lists, differs, strict=True)]
            b_lists = [none if d else x for x, d in zip(b_lists, differs, strict=True)]
        n_tokens = [np.fromiter(map(len, x), np.int64, len(x)) for x in (a_lists, b_lists)]
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, n.sum()) for x, n in zip((a_lists, b_lists), n_tokens, strict=True))
        a_ends, b_ends = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        ends = np.concatenate([a_ends, b_ends])
        ends.sort(kind="stable")
        ends = ends[np.diff(ends, prepend=-1) > 0]
        codes = a[np.searchsorted(a_ends, ends)] * self.n_b + b[np.searchsorted(b_ends, ends)]
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        last = np.cumsum(np.where(differs, 0, np.fromiter(map(len, raw), np.int64, len(raw))))
        n_links = np.diff(np.searchsorted(ends, last, "right"), prepend=0)
        n_groups = np.diff(np.searchsorted(common, last, "right"), prepend=0)
        self.sizes.frombytes(np.column_stack([*n_tokens, n_groups, n_links, differs]).astype(np.int64).tobytes())
        self.begin.frombytes((len(self.links) + np.cumsum(n_links)).astype(np.int64).tobytes())
        self.links.frombytes(codes.tobytes())
        self.groups.extend(self._words(a, b, np.searchsorted(common, a_ends), np.searchsorted(common, b_ends), np.cumsum(n_tokens[0] + n_tokens[1])))
        self.held += 20 * len(codes) + sum(map(len, chunks)) * 4 + 200 * len(chunks)

    def _differing(self, a_lists: list[list[int]], b_lists: list[list[int]], raw: list[bytes]) -> np.ndarray:
        """Which chunks have tokens of other bytes than their own; chunk by chunk only where the bytes of all of them differ."""
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        whole, alike = b"".join(raw), True
        for lists, table, sizes in ((a_lists, self.a_bytes, self.a_lengths), (b_lists, self.b_bytes, self.b_lengths)):
            flat = list(chain.from_iterable(lists))
            ends = np.concatenate([[0], np.cumsum(sizes[np.array(flat, np.int64)])])[np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))]
            alike = alike and np.array_equal(ends, np.cumsum(lengths)) and b"".join(map(table.__getitem__, flat)) == whole
        if alike:
            return np.zeros(len(raw), bool)
        joined = ((b"".join(map(self.a_bytes.__getitem__, x)), b"".join(map(self.b_bytes.__getitem__, y))) for x, y in zip(a_lists, b_lists, strict=True))
        return np.fromiter((x != r or y != r for (x, y), r in zip(joined, raw, strict=True)), bool, len(raw))

    def _words(self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, upto: np.ndarray) -> list[bytes]:
        """The groups of each chunk as text: every token's id with the mark that follows it, A's of a group before B's.

        ``upto`` counts the tokens of both up to each chunk's end.
        """
        a_last, b_last = np.diff(a_group, append=-1) != 0, np.diff(b_group, append=-1) != 0
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        shown = np.concatenate([2 * a + a_last, 2 * self.n_a + 2 * b + b_last])[order]
        text = b"".join(map(self.shown.__getitem__, shown.tolist()))
        end = np.concatenate([[0], np.cumsum(self.shown_lengths[shown])])[upto].tolist()
        return [text[x : max(x, y - 1)] for x, y in zip([0, *end[:-1]], end, strict=True)]

    def parts(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of the chunks of texts, and of the text that each is in, about a million characters at a time.

        Numbers hold until the next part is asked for.
        """
        waiting, size = [], 0
        for i, text in enumerate(texts):
            first = 0
            while text and first < len(text):
                last = len(text)
                if last - first > PART and (cut := _CUT.search(text, first + PART)):
                    last = cut.start()
                # the blank in front belongs to the text only at its start; elsewhere the part starts with its own
                waiting.append((i, (" " if not first else "") + text[first:last]))
                size += last - first
                first = last
                if size >= PART:
                    yield self._numbers(waiting)
                    waiting, size = [], 0
        if waiting:
            yield self._numbers(waiting)

    def _numbers(self, waiting: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
        if self.held > KEPT:
            self.forget()
        found = [_CHUNK.findall(text) for _, text in waiting]
        flat = list(chain.from_iterable(found))
        known = len(self.number)
        numbers = np.fromiter(map(self.number.__getitem__, flat), np.int64, len(flat))
        if len(self.number) > known:
            self.learn(list(islice(reversed(self.number), len(self.number) - known))[::-1])
        return numbers, np.repeat([i for i, _ in waiting], [len(own) for own in found])

    def _sizes(self) -> np.ndarray:
        return np.array(self.sizes, np.int64).reshape(-1, 5)

    def _codes(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the links of chunks, one after the other, and how many each has."""
        begin = np.array(self.begin, np.int64)
        n = begin[numbers + 1] - begin[numbers]
        upto = np.cumsum(n)
        at = np.repeat(begin[numbers] - (upto - n), n) + np.arange(upto[-1] if len(upto) else 0)
        return np.array(self.links, np.int64)[at], n

    def linked(self, texts: list[str | None]) -> np.ndarray:
        """Codes of the distinct pairs that each text holds linked, one text after the other."""
        return self.described(texts)[3]

    def described(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """n_a, n_b, n_groups, n_links of each text; its groups_sha256; then the distinct pairs it holds linked.

        The pairs stand one text after the other: which text, the code, and how many of its links.
        """
        bits, found, held = np.int64(self.n_a * self.n_b).item().bit_length(), [], 0
        out, differs, begun = np.zeros((len(texts), 4), np.int64), np.zeros(len(texts), bool), np.zeros(len(texts), bool)
        hashes = [hashlib.sha256() for _ in texts]
        for numbers, text in self.parts(texts):
            each = self._sizes()[numbers]
            differs[text[each[:, 4] > 0]] = True
            codes, n = self._codes(numbers)
            found.append(_runs(np.repeat(text, n) << bits | codes))
            held += len(found[-1][0])
            if held > 4_000_000:
                found = [_counted(found)]
                held = len(found[0][0]) // 2  # merge again only after it has grown
            starts = np.flatnonzero(np.diff(text, prepend=-1))
            if len(starts):
                out[text[starts]] += np.add.reduceat(each[:, :4], starts)
            for i, first, last in zip(text[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(text)], strict=True):
                if begun[i]:
                    hashes[i].update(b";")
                begun[i] = True
                hashes[i].update(b";".join(map(self.groups.__getitem__, numbers[first:last].tolist())))
        out[differs] = 0
        keys, times = found[0] if len(found) == 1 else _counted(found)
        keep = ~differs[keys >> bits]
        keys, times = keys[keep], times[keep]
        return out, [h.hexdigest() if n else "" for n, h in zip(out[:, 0].tolist(), hashes, strict=True)], keys >> bits, keys & ((1 << bits) - 1), times


def aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of this Python worker for two vocabulary files."""
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Aligner(a_path, b_path)
    return _loaded[a_path, b_path]


def _narrow(pair: Aligner) -> type:
    return np.uint32 if pair.n_a * pair.n_b <= 1 << 32 else np.uint64


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and how often each stands there (``keys`` is sorted in place; numpy's unique hashes, which takes longer)."""
    keys.sort()
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return keys[first], np.diff(first, append=len(keys))


def _counted(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The same, of keys that were counted in several parts."""
    keys, times = (np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*found, strict=True) if found else ((), ())))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(times[order], first) if len(first) else times


_FOUND = pa.schema([
    ("where", pa.int32()), ("kind", pa.int32()), ("code", pa.int64()), ("n", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("codes", pa.binary()), ("times", pa.binary()),
])
IRREGULAR, REGULAR, TEXT = range(3)  # kinds of rows


def _rows(where: int, kind: int, size: int, **columns: pa.Array) -> pa.RecordBatch:
    columns |= {"where": pa.array([where] * size, pa.int32()), "kind": pa.array([kind] * size, pa.int32())}
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in _FOUND], schema=_FOUND)


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = shared.RANGE_BYTES) -> DataFrame:
    """Align two tokenizers' tokens of every whole text, and rate the links by corpus-wide counts.

    Byte offsets where tokens of both end cut a text into groups; a link is a pair of tokens
    whose byte ranges overlap; an id pair counts the documents that hold it linked. Returns
    doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is their A id's highest, ties
    included), count_sum (of counts over links), groups_sha256.

    Texts are dealt to ranges of about ``range_bytes`` and read once. Each range describes its
    texts, with the distinct pairs of each, and counts its links: those of two ids with the same
    bytes in a vector by A id, the others by code, so that only irregular pairs enter the
    shuffle, once for each range that holds them. Then the ranges get the totals of just their
    pairs, and rate the links of the texts by these. The driver sees two numbers for each A id.

    Null and empty texts, and those whose tokens' bytes differ from the text (U+2581 reads as a
    blank in B), have no tokens: zeros and ''. Rows with equal or null ids are separate
    documents; repeated rows each count. Very long texts are aligned a part at a time. An empty table gives no rows; other columns are not read.
    """
    tie = F.xxhash64(F.col(text_col))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), tie.alias("tie"))
    cut = shared.ranges(rows, [F.col("doc_id"), F.col("tie")], F.coalesce(F.octet_length("text"), F.lit(0)) + 16, range_bytes)
    docs = rows.select(cut.index().alias("where"), "doc_id", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = aligner(a_path, b_path)
        vector, found, held, where = np.zeros(pair.n_a, np.int64), [], 0, None

        def counts() -> Iterator[pa.RecordBatch]:
            nonlocal found, held
            alike = np.flatnonzero(vector)
            out = [(REGULAR, alike * pair.n_b + pair.same[alike], vector[alike])]
            if found:
                out.append((IRREGULAR, *_counted(found)))
            for kind, codes, n in out:
                for i in range(0, len(codes), 1 << 16):
                    m = len(codes[i : i + (1 << 16)])
                    yield _rows(where, kind, m, code=pa.array(codes[i : i + m]), n=pa.array(n[i : i + m]))
            vector[:] = 0
            found, held = [], 0

        for whole in batches:
            for batch in shared.slices(whole, 2):
                at = batch.column(0).to_numpy()
                for r in np.unique(at).tolist():
                    if where is not None and r != where:
                        yield from counts()
                    where = r
                    own = batch.filter(pa.array(at == r))
                    sizes, hashes, text, codes, times = pair.described(own.column(2).to_pylist())
                    ends = np.searchsorted(text, np.arange(own.num_rows), "right").tolist()
                    bounds = list(zip([0, *ends[:-1]], ends, strict=True))
                    columns = {n: pa.array(sizes[:, i]) for i, n in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
                    columns |= {n: pa.array([x[i:j].tobytes() for i, j in bounds], pa.binary()) for n, x in (("codes", codes.astype(_narrow(pair))), ("times", times.astype(np.uint32)))}
                    yield _rows(r, TEXT, own.num_rows, doc_id=own.column(1), groups_sha256=pa.array(hashes, pa.string()), **columns)
                    a = codes // pair.n_b
                    regular = pair.same[a] == codes % pair.n_b
                    vector += np.bincount(a[regular], minlength=pair.n_a)
                    found.append(_runs(codes[~regular]))
                    held += len(found[-1][0])
                    if held > 2_000_000:
                        found = [_counted(found)]
                        held = len(found[0][0]) // 2  # merge again only after it has grown
        if where is not None:
            yield from counts()

    kinds = ", ".join(f"{f.name} {({pa.int32(): 'int', pa.int64(): 'long', pa.string(): 'string', pa.binary(): 'binary'})[f.type]}" for f in _FOUND)
    seen = shared.stage(cut.dealt(docs, "where").sortWithinPartitions("where").select("where", "doc_id", "text").mapInArrow(count, kinds), free=True)
    counted = shared.stage(seen.where(F.col("kind") != TEXT).select("where", (F.col("kind") == REGULAR).alias("regular"), "code", "n"))
    n_b = len(read_model(b_path).pieces)
    irregular = counted.where("not regular")
    totals = irregular.groupBy("code").agg(F.sum("n").alias("total"))
    vectors = (  # at most a row for each A id
        counted.where("regular").groupBy("code").agg(F.sum("n").alias("same")).select(F.expr(f"code div {n_b}").alias("a"), "same", F.col("same").alias("best"))
        .unionByName(totals.groupBy(F.expr(f"code div {n_b}").alias("a")).agg(F.lit(0).cast("long").alias("same"), F.max("total").alias("best")))
        .groupBy("a").agg(F.max("same").alias("same"), F.max("best").alias("best"))
    ).toArrow()
    size = max(vectors["a"].to_pylist(), default=0) + 1
    same_totals, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    same_totals[vectors["a"].to_numpy()], best[vectors["a"].to_numpy()] = vectors["same"].to_numpy(), vectors["best"].to_numpy()
    known = df.sparkSession.sparkContext.broadcast((same_totals, best))

    needed = irregular.join(totals.hint("shuffle_hash"), "code").select("where", F.lit(IRREGULAR).alias("kind"), "code", F.col("total").alias("n"))
    both = seen.where(F.col("kind") == TEXT).unionByName(needed, allowMissingColumns=True)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = aligner(a_path, b_path)
        same_totals, best = known.value
        same_totals, best = (np.pad(v, (0, max(0, pair.n_a - len(v)))) for v in (same_totals, best))
        where, got = None, []  # totals of a range's pairs come before its texts
        for batch in batches:
            at, kind = batch.column("where").to_numpy(), batch.column("kind").to_numpy()
            for r in np.unique(at).tolist():
                if r != where:
                    where, got = r, []
                own = batch.filter(pa.array((at == r) & (kind == IRREGULAR)))
                if own.num_rows:
                    got.append((own.column("code").to_numpy(), own.column("n").to_numpy()))
                own = batch.filter(pa.array((at == r) & (kind == TEXT)))
                if not own.num_rows:
                    continue
                if isinstance(got, list):
                    got = _counted(got)
                codes, times = (np.frombuffer(b"".join(own.column(c).to_pylist()), width).astype(np.int64) for c, width in (("codes", _narrow(pair)), ("times", np.uint32)))
                a = codes // pair.n_b
                regular = pair.same[a] == codes % pair.n_b
                total = np.empty(len(codes), np.int64)
                total[regular] = same_totals[a[regular]]
                total[~regular] = got[1][np.searchsorted(got[0], codes[~regular])]
                ends = np.cumsum([len(x) // 4 for x in own.column("times").to_pylist()])
                rated = []
                for x in (np.where(total == best[a], times, 0), total * times):
                    upto = np.concatenate([[0], np.cumsum(x)])
                    rated.append(pa.array(np.diff(upto[ends], prepend=0)))
                yield pa.RecordBatch.from_arrays([*(own.column(n) for n in names[:5]), *rated, own.column("groups_sha256")], names)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    out = T.StructType([T.StructField(n, T.StringType() if n == "groups_sha256" else T.LongType()) for n in names])
    return cut.dealt(both, "where").sortWithinPartitions("where", "kind").mapInArrow(rate, out)
