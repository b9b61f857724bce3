"""SentencePiece encoding and decoding by a weighted finite-state transducer."""

from __future__ import annotations

import re
import struct
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import inf
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import shared

SPACE = "▁"
_loaded: dict[str, PieceTransducer] = {}


class _Ids(dict):
    """Ids of texts, found once and kept when they are short."""

    def __init__(self, find):
        super().__init__()
        self._find = find

    def __missing__(self, text: str) -> bytes:
        found = self._find(text)
        if len(text) <= 48:
            self[text] = found
        return found


@dataclass
class Model:
    """What a model file says: pieces with score and kind, the merge or unigram rule, the normaliser's switches."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    unigram: bool = True
    blank_in_front: bool = True
    single_blanks: bool = True
    escaped_blanks: bool = True
    rewrites: bool = False  # the normaliser rewrites characters by a table


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, data[at : at + size]
        at += size


# Kinds of pieces, and field numbers of the model file's public format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
PIECES, TRAINER, NORMALISER = 1, 2, 3


def read_model(path: str) -> Model:
    """The parts of a model file that encoding needs."""
    model = Model()
    with open(path, "rb") as f:
        data = f.read()
    for part, body in _fields(data):
        got = dict(_fields(body)) if part in (PIECES, TRAINER, NORMALISER) else {}
        if part == PIECES:
            model.pieces.append((got.get(1, b"").decode(), struct.unpack("<f", got[2])[0] if 2 in got else 0.0, got.get(3, NORMAL)))
        elif part == TRAINER:
            if got.get(3, 1) not in (1, 2):
                raise ValueError("only unigram and merge models are read")
            model.unigram = got.get(3, 1) == 1
        elif part == NORMALISER:
            model.rewrites = bool(got.get(2, b"") or got.get(6, b""))
            model.blank_in_front, model.single_blanks, model.escaped_blanks = (bool(got.get(i, 1)) for i in (3, 4, 5))
    return model


class PieceTransducer:
    """Normaliser, pieces and byte fallback of a model, as one weighted transducer.

    The normaliser is compiled from the model's switches: a blank becomes U+2581, one is put in
    front, runs of blanks shrink to one, or not. A model that rewrites characters by a table, or
    leaves blanks as they are, is refused.

    The piece machine has a state for each last piece. An arc reads a piece's characters and
    writes its id; a character that no piece holds is read by an arc that writes its bytes' ids
    (``arcs``). Weights lie in the tropical semiring, where paths add and the least sum wins. In
    a unigram model an arc weighs the negated score and all states are one. In a merge model the
    result is no sum of scores; there an arc weighs 0 where the merge rule leaves its piece and
    the one before as they are, and infinitely much elsewhere (such arcs are left out), so that
    one path of finite weight remains. The machine is composed with a text as it is searched:
    nodes are positions with states, made when they are reached.

    A text is composed chunk by chunk, cut where no piece reaches across (before a run of
    blanks, around a line break); chunks are kept per worker.
    """

    limit = 300_000

    def __init__(self, model: Model):
        if model.rewrites or not model.escaped_blanks:
            raise ValueError("the model's normaliser rewrites characters: not supported")
        self.model, self.unigram, n = model, model.unigram, len(model.pieces)
        self.unknown = next((i for i, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN), 0)
        self.bytes = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind == BYTE}
        self.byte_ids = [self.bytes.get(f"<0x{b:02X}>", self.unknown) for b in range(256)]
        plain = [(i, p, s) for i, (p, s, kind) in enumerate(model.pieces) if kind in (NORMAL, USER)]
        self.ids = {p: i for i, p, _ in plain}
        self.score = {p: s for _, p, s in plain}
        self.longest = max(map(len, self.ids))
        if any(SPACE in p.lstrip(SPACE) or "\n" in p and p != "\n" for p in self.ids):
            raise ValueError("pieces reach across words; chunks cannot be cut at blanks")
        self.rank = {p: k for k, p in enumerate(sorted(self.ids, key=lambda p: (-self.score[p], self.ids[p])))}
        self.last_join: dict[str, list[str]] = {}
        if not self.unigram:
            for p in list(self.ids):
                if len(p) > 1:
                    self.last_join[p] = self.merged(p, 2)
                    if len(self.last_join[p]) > 2:  # no joins lead to it
                        del self.last_join[p], self.ids[p], self.score[p], self.rank[p]
        self.worst = min(self.score.values()) - 10
        self.written = [b""] * n
        for p, i in self.ids.items():
            self.written[i] = p.replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte_ids):
            if i != self.unknown:
                self.written[i] = bytes([b])
        self.kind = np.dtype("<u2") if n <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.inside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.reach: dict[str, int] = {}  # length of the longest piece that starts with two characters
        for p in self.ids:
            self.reach[p[:2]] = max(len(p), self.reach.get(p[:2], 0))
        self._chunks, self._spans = _Ids(self._chunk_ids), _Ids(self._span_ids)
        self._follow: defaultdict[str, dict[str, bool]] = defaultdict(dict)  # arcs known so far, by last piece
        self._arcs = 0

    def merged(self, text: str, parts_left: int = 1) -> list[str]:
        """The merge rule itself: join the neighbours that give the best piece, leftmost first."""
        parts = list(text)
        while len(parts) > parts_left:
            best, at = -inf, -1
            for i in range(len(parts) - 1):
                if (s := self.score.get(parts[i] + parts[i + 1], -inf)) > best:
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stays(self, left: str, right: str) -> bool:
        """Whether the merge rule, given left + right, ends with just these two pieces.

        Walk back through the formation of the two: whichever was joined later is undone, and
        the symbols then next to each other must not have had an earlier join of their own. The
        leftmost of equal joins comes first, so on the right side an equal one counts as earlier.
        """
        if SPACE * 2 in left + right:  # runs of blanks share one score: ask the rule itself
            return self.merged(left + right, 2) == [left, right] and left + right not in self.score
        limit, rank, last = inf, self.rank, self.last_join
        while True:
            if rank.get(left + right, inf) < limit:
                return False
            l, r = rank[left] if left in last else -1, rank[right] if right in last else -1
            if l < 0 and r < 0:
                return True
            if l > r:
                limit, left = l, last[left][1]
            else:
                limit, right = r + 1, last[right][0]

    def arcs(self, state: str, chunk: str, at: int) -> Iterator[tuple[str, str, float]]:
        """Arcs that read on at a position: the piece, the state they lead to, the weight. Infinite ones are left out."""
        for end in range(at + 1, min(len(chunk), at + self.longest) + 1):
            piece = chunk[at:end]
            if piece not in self.ids and end > at + 1:
                continue
            if self.unigram:
                yield piece, "", -self.score.get(piece, self.worst)
            elif not state or self.stays(state, piece):
                yield piece, piece, 0.0

    def shortest(self, chunk: str) -> list[str]:
        """Pieces of the shortest path through a chunk composed with the machine, in the tropical semiring.

        Arcs only lead on, so positions are relaxed from left to right. Of equal paths to a node
        the one found first stays, whose last piece begins earlier.
        """
        nodes: list[dict[str, tuple[float, str, str]]] = [{} for _ in range(len(chunk) + 1)]
        nodes[0][""] = (0.0, "", "")
        for at in range(len(chunk)):
            for state, (cost, _, _) in nodes[at].items():
                for piece, leads, weight in self.arcs(state, chunk, at):
                    old = nodes[at + len(piece)].get(leads, (inf,))
                    if cost + weight < old[0]:
                        nodes[at + len(piece)][leads] = (cost + weight, piece, state)
        state, at, out = min(nodes[-1], key=lambda s: nodes[-1][s][0]), len(chunk), []
        while at:
            _, piece, before = nodes[at][state]
            out.append(piece)
            at, state = at - len(piece), before
        return out[::-1]

    def path(self, chunk: str) -> list[str]:
        """The shortest path's pieces; where weights are 0 or infinite, by the quicker search for the one finite path."""
        return self.shortest(chunk) if self.unigram else self._finite(chunk)

    def _finite(self, chunk: str) -> list[str]:
        """Weights are 0 or infinite: search the one finite path depth first, longest arcs first."""
        n, ids, reach, follow = len(chunk), self.ids, self.reach.get, self._follow
        out, at, dead, last, known = [], 0, set(), "", None
        top = min(reach(chunk[:2], 1), n)
        while at < n:
            for end in range(top, at, -1):
                piece = chunk[at:end]
                if piece in ids or end == at + 1:
                    if known is not None:
                        if (may := known.get(piece)) is None:
                            may = known[piece] = self.stays(last, piece)
                            self._arcs += 1
                        if not may:
                            continue
                    if end not in dead:
                        out.append(piece)
                        at, last, top = end, piece, min(end + reach(chunk[end : end + 2], 1), n)
                        known = follow[last]
                        break
            else:  # no arc leads on: go back, and on with the shorter ones there
                dead.add(at)
                top = at - 1
                at -= len(out.pop())
                last = out[-1] if out else ""
                known = follow[last] if out else None
        return out

    def _span_ids(self, span: str) -> bytes:
        ids: list[int] = []
        for piece in self.path(span):
            i = self.ids.get(piece)
            if i is not None:
                ids.append(i)
            else:
                ids += [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]
        return array(self.code, ids).tobytes()

    def _chunk_ids(self, chunk: str) -> bytes:
        """Ids of a chunk: of its spans between neighbours that stand together in no piece."""
        cuts = [i for i, pair in enumerate(map(add, chunk, chunk[1:]), 1) if pair not in self.inside]
        if not cuts:
            return self._span_ids(chunk)
        return b"".join([self._spans[chunk[a:b]] for a, b in zip([0, *cuts], [*cuts, len(chunk)], strict=True)])

    def normalised(self, text: str) -> str:
        if self.model.single_blanks:
            text = re.sub(" +", " ", text.strip(" "))
        return (SPACE if self.model.blank_in_front and text else "") + text.replace(" ", SPACE)

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, self.kind)
        if len(self._chunks) > self.limit:
            self._chunks.clear()
        if len(self._spans) > self.limit:
            self._spans.clear()
        if self._arcs > 2 * self.limit:
            self._follow.clear()
            self._arcs = 0
        chunks = _CHUNK.findall(self.normalised(text))
        return np.frombuffer(b"".join(map(self._chunks.__getitem__, chunks)), self.kind)

    def decode(self, ids: np.ndarray) -> str:
        """The text that the ids were written for: the machine read backwards, less the blank in front."""
        text = b"".join(map(self.written.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.model.blank_in_front and text.startswith(" ") else text


_CHUNK = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


def transducer(path: str) -> PieceTransducer:
    """The transducer of this Python worker for a model file."""
    if path not in _loaded:
        _loaded[path] = PieceTransducer(read_model(path))
    return _loaded[path]


def with_pieces(df: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """Add piece_ids (little-endian unsigned 32-bit) and decoded for every whole text.

    Null and empty texts have no ids and decode to an empty text. The two replace columns of
    these names; all others stay. Equal texts get equal ids; an empty table gives no rows.
    """
    df = df.drop("piece_ids", "decoded")
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in (part for whole in batches for part in shared.slices(whole, at)):
            ids = [machine.encode(t.as_py()) for t in batch.column(at)]
            columns = [pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), pa.array([machine.decode(x) for x in ids], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "piece_ids", "decoded"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("piece_ids", T.BinaryType()), T.StructField("decoded", T.StringType())]))
