"""Secrets in texts, and in what the texts hold encoded, layer below layer."""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import shared

# The kinds of secrets, in their order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")  # over lower-cased bytes
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(rb"[0-9a-f]{16,}")
ASSIGNED = 12

_ESCAPED_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPED_UNICODE = re.compile(r"\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}")
_BASE64 = re.compile(r"(?:[A-Za-z0-9+/]{60,}\r?\n)+[A-Za-z0-9+/]+={0,2}|(?:[A-Za-z0-9_-]{60,}\r?\n)+[A-Za-z0-9_-]+={0,2}|[A-Za-z0-9+/_-]{16,}={0,2}")
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_STEP = 1 << 20  # bytes of an unpacked layer that are read at a time
_LINE = 64 << 20  # characters of an unpacked line that are scanned as one

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def base_spans(text: str) -> list[Span]:
    """Matches of each kind that are long enough, leftmost and not overlapping in their kind, in code points.

    ``assign`` covers the whole match, name and value. A run that is too short counts as no
    match, but what an ``assign`` match has read is not read again.
    """
    data = text.encode("utf-8", "surrogatepass")
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(data.lower()) if m.end(1) - m.start(1) >= ASSIGNED]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(data)] if b"AKIA" in data else []
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(data)]
    found.sort()
    if len(data) == len(text) or not found:
        return found
    points, at, n = {}, 0, 0
    for b in sorted({b for s, _, e in found for b in (s, e)}):
        n += len(data[at:b].decode("utf-8", "surrogatepass"))
        at = b
        points[b] = n
    return [(points[s], k, points[e]) for s, k, e in found]


@dataclass
class Layer:
    """A text that was unwrapped from another one, and where its characters stand there.

    Its characters are cut into runs: run i starts at ``begins[i]`` and stands at ``stands[i]``
    to ``stands[i] + widths[i]`` of the parent. A run as long as it is wide was copied; a
    character of any other run comes from the run's whole width.
    """

    text: str
    parent: Layer | None = None
    begins: list[int] = field(default_factory=lambda: [0])
    stands: list[int] = field(default_factory=lambda: [0])
    widths: list[int] = field(default_factory=list)
    folded: bool = False  # every character comes from its run's whole width
    blob: tuple[int, int, list[int] | None] | None = None  # base64: its place, and the positions of its digits if lines break it

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The characters of the outermost text from which this layer's [start, end) comes."""
        if self.parent is None:
            return start, end
        if self.blob:  # decoded characters map to the digits that hold their bytes
            first, last, digits = self.blob
            head = len(self.text[:start].encode("utf-8", "surrogatepass"))
            tail = head + len(self.text[start:end].encode("utf-8", "surrogatepass"))
            a, b = head * 8 // 6, -(-tail * 8 // 6)
            start, end = (digits[a], digits[min(b, len(digits)) - 1] + 1) if digits else (first + a, min(first + b, last))
        else:
            i, j = bisect_right(self.begins, start) - 1, bisect_right(self.begins, max(start, end - 1)) - 1
            copied = lambda k: not self.folded and self.widths[k] == (self.begins[k + 1] if k + 1 < len(self.begins) else len(self.text)) - self.begins[k]
            s = self.stands[i] + (start - self.begins[i] if copied(i) else 0)
            end = self.stands[j] + (end - self.begins[j] if copied(j) else self.widths[j])
            start = s
        return self.parent.source(start, end)


def _rewritten(layer: Layer, pattern: re.Pattern, decode) -> Iterator[Layer]:
    """The layer with every escape replaced; escapes that ``decode`` refuses stay."""
    parts, begins, stands, widths, n, at = [], [], [], [], 0, 0

    def put(piece: str, where: int, width: int) -> None:
        nonlocal n
        if piece:
            parts.append(piece)
            begins.append(n)
            stands.append(where)
            widths.append(width)
            n += len(piece)

    for m in pattern.finditer(layer.text):
        got = decode(m[0])
        if got is None:
            continue
        put(layer.text[at : m.start()], at, m.start() - at)
        where = m.start()
        for char, width in got:
            put(char, where, width)
            where += width
        at = m.end()
    if at:
        put(layer.text[at:], at, len(layer.text) - at)
        yield Layer("".join(parts), layer, begins, stands, widths)


def _url(escape: str) -> list[tuple[str, int]] | None:
    try:
        text = bytes.fromhex(escape.replace("%", "")).decode()
    except UnicodeDecodeError:
        return None
    return [(c, 3 * len(c.encode())) for c in text]


def _unicode(escape: str) -> list[tuple[str, int]] | None:
    codes = [int(h, 16) for h in re.findall(r"[0-9A-Fa-f]{1,8}", re.sub(r"\\[uUx]", " ", escape))]
    code = 0x10000 + ((codes[0] & 0x3FF) << 10) + (codes[1] & 0x3FF) if len(codes) == 2 else codes[0]
    return None if 0xD800 <= code < 0xE000 or code > 0x10FFFF else [(chr(code), len(escape))]


class _Zstd:
    """zstandard with the interface of the other decompressors."""

    def __init__(self):
        self._one = zstandard.ZstdDecompressor(max_window_size=1 << 27).decompressobj()
        self.eof, self._rest = False, b""

    def decompress(self, data: bytes, most: int) -> bytes:
        data, self._rest = self._rest + data, b""
        out, at = [], 0
        while at < len(data) and sum(map(len, out)) < most:  # a little at a time, since the library sets no bound
            out.append(self._one.decompress(data[at : at + 256]))
            at += 256
        self._rest = data[at:]
        self.eof = not self._rest
        return b"".join(out)

    @property
    def needs_input(self) -> bool:
        return not self._rest


class _Zlib:
    def __init__(self):
        self._one = zlib.decompressobj(47)

    def decompress(self, data: bytes, most: int) -> bytes:
        return self._one.decompress(self._one.unconsumed_tail + data, most)

    eof = property(lambda self: self._one.eof)
    needs_input = property(lambda self: not self._one.unconsumed_tail)


# How compressed data of each format starts.
MAGICS = [(b"\x1f\x8b", _Zlib), (b"\x78\x01", _Zlib), (b"\x78\x5e", _Zlib), (b"\x78\x9c", _Zlib), (b"\x78\xda", _Zlib), (b"BZh", bz2.BZ2Decompressor), (b"\xfd7zXZ\x00", lzma.LZMADecompressor), (b"\x28\xb5\x2f\xfd", _Zstd)]


def _inflated(pieces: Iterator[bytes], unpack) -> Iterator[bytes]:
    """Unpacked data, a megabyte at a time; damaged data end where the damage is."""
    try:
        for piece in pieces:
            out = unpack.decompress(piece, _STEP)
            while True:
                if out:
                    yield out
                if unpack.eof or unpack.needs_input:
                    break
                out = unpack.decompress(b"", _STEP)
            if unpack.eof and not isinstance(unpack, _Zstd):
                return
    except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError):
        return


def _opened(data: bytes) -> tuple[bool, Iterator[bytes]]:
    """Data, unpacked as long as they are compressed; and whether they were.

    Layers are known again by their first megabyte: one that comes back inside itself ends the chain.
    """
    pieces, seen = iter([data]), set()
    while True:
        first = next(pieces, b"")
        kind = next((k for magic, k in MAGICS if first.startswith(magic)), None)
        digest = hashlib.sha256(first).digest()
        if kind is None or digest in seen:
            break
        seen.add(digest)
        pieces = _inflated(_chained(first, pieces), kind())
    return bool(seen), _chained(b"" if digest in seen else first, pieces)


def _chained(first: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield first
    yield from rest


def _texts(pieces: Iterator[bytes]) -> Iterator[str]:
    """UTF-8 data as texts that end with a line (no secret reaches across); other data give no more texts."""
    decoder, held = codecs.getincrementaldecoder("utf-8")(), ""
    try:
        for piece in pieces:
            got = decoder.decode(piece)
            if _CONTROL.search(got):
                return
            cut = got.rfind("\n") + 1
            if cut or len(held) + len(got) > _LINE:
                cut = cut or len(got)
                yield held + got[:cut]
                held = got[cut:]
            else:
                held += got
        decoder.decode(b"", True)
    except UnicodeDecodeError:
        return
    if held:
        yield held


def _blobs(layer: Layer) -> Iterator[Layer]:
    """Texts that base64 digits of a layer hold, unpacked where they are compressed."""
    for m in _BASE64.finditer(layer.text):
        blob = m[0]
        if ("-" in blob or "_" in blob) and ("+" in blob or "/" in blob):
            continue
        broken = "\n" in blob
        digits = blob.replace("\r", "").replace("\n", "").rstrip("=").replace("-", "+").replace("_", "/")
        if len(digits) % 4 == 1:
            digits = digits[:-1]
        try:
            data = base64.b64decode(digits + "=" * (-len(digits) % 4))
        except binascii.Error:
            continue
        packed, pieces = _opened(data)
        if packed:
            for text in _texts(pieces):
                yield Layer(text, layer, [0], [m.start()], [m.end() - m.start()], folded=True)
        elif text := "".join(_texts(pieces)):
            places = [m.start() + i for i, c in enumerate(blob) if c not in "\r\n="] if broken else None
            yield Layer(text, layer, blob=(m.start(), m.start() + len(blob.rstrip("=")), places))


def unwrapped(layer: Layer) -> Iterator[Layer]:
    """The layers right below one: URL escapes, Unicode escapes, each base64 blob."""
    if "%" in layer.text:
        yield from _rewritten(layer, _ESCAPED_URL, _url)
    if "\\" in layer.text:
        yield from _rewritten(layer, _ESCAPED_UNICODE, _unicode)
    yield from _blobs(layer)


def all_spans(text: str, base: list[Span]) -> list[Span]:
    """The base spans and those of every layer below, by start, kind and end, in code points of ``text``.

    A worklist unwraps layers until none is new. A layer is known by its text and by the place
    from which it comes, so equal texts at two places are both read and a layer that holds
    itself is read once.
    """
    found, seen, work = set(base), set(), [Layer(text)]
    while work:
        for layer in unwrapped(work.pop()):
            key = (hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest(), layer.source(0, len(layer.text)))
            if key in seen:
                continue
            seen.add(key)
            for start, kind, end in base_spans(layer.text):
                first, last = layer.source(start, end)
                found.add((first, kind, last))
            work.append(layer)
    return sorted(found)


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def with_secrets(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``base`` and ``spans``: secrets of every whole text, as it stands and in all layers below.

    Both are arrays of (kind, start, end), by start, kind (assign, access, hex) and end; places
    are code points of the text, end exclusive. A span of a lower layer is mapped to the
    characters that hold it: escapes and base64 digits exactly, compressed data to their whole
    blob. Base spans are always among ``spans``.

    Texts are unwrapped from URL escapes (%XX runs that are UTF-8), Unicode escapes
    (\\uXXXX, \\u{X}, \\UXXXXXXXX, \\xXX), base64 of either alphabet (16 digits and more, also over lines
    of 60 and more) and, inside base64, gzip, zlib, bz2, xz and zstandard data. Data that are no UTF-8 text are no layer;
    damaged data are read up to the damage. Compressed data are unpacked and scanned a
    megabyte and the rest of its line at a time, whatever their size; a line of over 64 million
    characters is scanned in parts.

    A null text is empty and has no spans; repeated rows have the same; an empty table gives no
    rows. All columns of ``df`` stay, but for any of its own named base or spans, which are replaced.
    A very long text is scanned whole, with a few copies of it in memory.
    """
    df = df.select([c for c in df.columns if c.lower() not in ("base", "spans")])
    at = df.columns.index(text_col)
    kind = T.ArrayType(T.StructType([T.StructField("kind", T.StringType(), False), T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)]), False)
    arrow = pa.list_(pa.field("element", pa.struct([pa.field("kind", pa.string(), False), pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False)]), False))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in shared.slices(whole, at):
                base, spans = [], []
                for text in batch.column(at):
                    text = text.as_py() or ""
                    own = base_spans(text)
                    base.append([(KINDS[k], s, e) for s, k, e in own])
                    spans.append([(KINDS[k], s, e) for s, k, e in all_spans(text, own)])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(base, arrow), pa.array(spans, arrow)], [*batch.schema.names, "base", "spans"])

    out = T.StructType([*df.schema.fields, T.StructField("base", kind), T.StructField("spans", kind)])
    return df.mapInArrow(scan, out)
