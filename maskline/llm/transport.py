"""Media columns: payloads in MPEG transport streams, written and read back."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import shared

PACKET, SYNC = 188, 0x47
PAT_PID, PMT_PID, DATA_PID, NULL_PID = 0x0000, 0x1000, 0x0100, 0x1FFF
PRIVATE_DATA, PRIVATE_STREAM_1 = 0x06, 0xBD  # stream type and stream id of private data
UNIT = 192  # the payload is a multiple of this
ACCESS_UNIT = 24 * UNIT  # bytes under one timestamp
TICKS, RANDOM_EVERY = 3600, 4  # 90 kHz ticks of an access unit; every fourth can be entered at


@lru_cache(4096)
def crc_mpeg(data: bytes) -> int:
    """CRC-32/MPEG-2 of a section, bit by bit (sections are short and few differ)."""
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = (crc << 1 ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


def _section(table: int, number: int, body: bytes) -> bytes:
    head = bytes([table]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\x00\x00"
    return head + body + crc_mpeg(head + body).to_bytes(4, "big")


@lru_cache(1)
def _tables() -> tuple[bytes, bytes]:
    """The packets' contents of the program association and program map tables."""
    pat = _section(0, 1, (1).to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
    stream = bytes([PRIVATE_DATA]) + (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00"
    pmt = _section(2, 1, (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00" + stream)
    return tuple(b"\x00" + s + b"\xff" * (PACKET - 5 - len(s)) for s in (pat, pmt))


def _stamp(pts: int) -> bytes:
    """A 33-bit timestamp with its marker bits."""
    return bytes([0x21 | pts >> 29 & 0x0E, pts >> 22 & 0xFF, pts >> 14 & 0xFE | 1, pts >> 7 & 0xFF, pts << 1 & 0xFE | 1])


def _head(pid: int, start: bool, counter: int, field_: bool) -> bytes:
    return bytes([SYNC, start << 6 | pid >> 8, pid & 0xFF, (0x30 if field_ else 0x10) | counter & 15])


def write(payload: bytes) -> bytes:
    """A stream of program tables, then a packetised elementary packet for each access unit.

    A unit's first transport packet carries the clock reference, and the random-access flag in
    every fourth unit, before which the tables are repeated.
    """
    out, counter, tables = [], 0, 0
    for k, at in enumerate(range(0, len(payload), ACCESS_UNIT)):
        pts, enter = k * TICKS & (1 << 33) - 1, k % RANDOM_EVERY == 0
        if enter:
            out += [_head(pid, True, tables, False) + t for pid, t in zip((PAT_PID, PMT_PID), _tables(), strict=True)]
            tables += 1
        data = payload[at : at + ACCESS_UNIT]
        pes = b"\x00\x00\x01" + bytes([PRIVATE_STREAM_1]) + (len(data) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _stamp(pts) + data
        clock = bytes([0x50 if enter else 0x10]) + (pts << 15 | 0x7E00).to_bytes(6, "big")
        sent = 0
        while sent < len(pes):
            field_ = clock if not sent else b""
            room = PACKET - 4 - (1 + len(field_) if field_ else 0)
            short = room - (len(pes) - sent)
            if short > 0 and not field_:  # stuffing needs a field of its own
                field_, short = (b"\x00", short - 2) if short > 1 else (b"", 0)
                piece = pes[sent:]
                field_ = bytes([len(field_) + short]) + field_ + b"\xff" * short
            elif short > 0:
                piece = pes[sent:]
                field_ = bytes([len(field_) + short]) + field_ + b"\xff" * short
            else:
                piece = pes[sent : sent + room]
                field_ = bytes([len(field_)]) + field_ if field_ else b""
            out.append(_head(DATA_PID, not sent, counter, bool(field_)) + field_ + piece)
            counter += 1
            sent += len(piece)
    return b"".join(out)


@dataclass
class Stream:
    """What a stream holds: payload, (timestamp, offset, can be entered) of its units, packets by PID."""

    payload: bytes = b""
    units: list[tuple[int, int, bool]] = field(default_factory=list)
    packets: dict[int, int] = field(default_factory=dict)


def _section_of(body: bytes, table: int) -> bytes:
    start = 1 + body[0]
    length = int.from_bytes(body[start + 1 : start + 3], "big") & 0xFFF
    section = body[start : start + 3 + length]
    if section[0] != table or crc_mpeg(section):  # over a section with its checksum the CRC is 0
        raise ValueError("damaged program table")
    return section


def read(data: bytes) -> Stream:
    """Parse a stream: tables, continuity, elementary packets. Damage raises ValueError."""
    if len(data) % PACKET:
        raise ValueError("not whole packets")
    got, counters, twice, map_pid, data_pid, parts, open_ = Stream(), {}, set(), None, None, [], None

    def close() -> None:
        pts, enter, bodies = open_
        pes = b"".join(bodies)
        length = int.from_bytes(pes[4:6], "big")
        if pes[:3] != b"\x00\x00\x01" or len(pes) != length + 6 or not pes[7] & 0x80:
            raise ValueError("damaged elementary packet")
        s = pes[9:14]
        pts = (s[0] & 0x0E) << 29 | s[1] << 22 | (s[2] & 0xFE) << 14 | s[3] << 7 | s[4] >> 1
        got.units.append((pts, sum(map(len, parts)), enter))
        parts.append(pes[9 + pes[8] :])

    for at in range(0, len(data), PACKET):
        b1, b2, b3 = data[at + 1], data[at + 2], data[at + 3]
        if data[at] != SYNC or b1 & 0x80:
            raise ValueError("lost synchronisation")
        pid = (b1 & 0x1F) << 8 | b2
        got.packets[pid] = got.packets.get(pid, 0) + 1
        if pid == NULL_PID:
            continue
        begin, enter, jumps = at + 4, False, False
        if b3 & 0x20:
            begin += 1 + data[begin]
            enter, jumps = data[at + 4] > 0 and bool(data[at + 5] & 0x40), data[at + 4] > 0 and bool(data[at + 5] & 0x80)
        before, counter = counters.get(pid), b3 & 15
        if not b3 & 0x10:  # no payload, no count
            if before is not None and counter != before and not jumps:
                raise ValueError(f"packets of PID {pid} are missing")
            continue
        if counter == before and not jumps and pid not in twice:  # a packet may be sent twice
            twice.add(pid)
            continue
        if before is not None and counter != (before + 1) & 15 and not jumps:
            raise ValueError(f"packets of PID {pid} are missing")
        counters[pid] = counter
        twice.discard(pid)
        body = data[begin : at + PACKET]
        if pid == PAT_PID:
            map_pid = int.from_bytes(_section_of(body, 0)[10:12], "big") & 0x1FFF
        elif pid == map_pid:
            section = _section_of(body, 2)
            info = int.from_bytes(section[10:12], "big") & 0xFFF
            data_pid = int.from_bytes(section[13 + info : 15 + info], "big") & 0x1FFF
        elif pid == data_pid:
            if b1 & 0x40:
                if open_:
                    close()
                open_ = (0, enter, [body])
            elif open_:
                open_[2].append(body)
    if open_:
        close()
    got.payload = b"".join(parts)
    return got


def payload_of(text: str | None) -> tuple[int, bytes]:
    """UTF-8 bytes of a text and their payload: padded with blanks to a positive multiple of 192."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw.ljust(max(1, -(-len(raw) // UNIT)) * UNIT)


def feature_of(stream: Stream) -> str:
    """Units, entry points, last timestamp, data packets, and mean and spread of the samples."""
    samples = np.frombuffer(stream.payload, np.uint8)
    entries = sum(e for _, _, e in stream.units)
    return f"units={len(stream.units)};entries={entries};last_pts={stream.units[-1][0]};packets={stream.packets[DATA_PID]};mean={samples.mean():.4f};std={samples.std():.4f}"


def _write(text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in shared.slices(whole, text_at)):
            made = [payload_of(t.as_py()) for t in batch.column(text_at)]
            kept = [c for i, c in enumerate(batch.columns) if i != text_at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([n for n, _ in made], pa.int64()), pa.array([write(p) for _, p in made], pa.binary())], names)

    return run


def _read(media_at: int, names: list[str]):
    point = pa.list_(pa.struct([("offset", pa.int64()), ("pts", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in shared.slices(whole, media_at)):
            streams = [read(m.as_py()) for m in batch.column(media_at)]
            points = [[{"offset": o, "pts": p} for p, o, e in s.units if e] for s in streams]
            columns = [pa.array([s.payload for s in streams], pa.binary()), pa.array(points, point), pa.array(map(feature_of, streams), pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names)

    return run


def with_transport_stream(df: DataFrame, text_col: str = "text", root: str | None = None) -> DataFrame:
    """Store every whole text as a transport stream, read the stored bytes back, and describe them.

    The streams are written as a Parquet table to ``root`` (a new folder in the shared one, the
    caller's to delete, if none is given) and parsed from there in a second pass. Returns the
    columns of ``df`` but for the text, which the payload holds, and n_bytes, media (the
    stream), payload (as read back), entry_points (offset and timestamp of the units that can
    be entered at), feature; these replace columns of their names. Null texts count as empty;
    equal texts give equal streams; an empty table gives no rows.
    """
    spark = df.sparkSession
    df = df.drop("n_bytes", "media", "payload", "entry_points", "feature")
    kept = [f for f in df.schema.fields if f.name != text_col]
    stored = T.StructType([*kept, *T.StructType.fromDDL("n_bytes long, media binary").fields])
    root = root or f"{shared.shared_dir(spark)}/media-{uuid.uuid4().hex}"
    df.mapInArrow(_write(df.columns.index(text_col), stored.names), stored).write.option("compression", "zstd").parquet(root)
    found = T.StructType([*stored.fields, *T.StructType.fromDDL("payload binary, entry_points array<struct<offset:bigint,pts:bigint>>, feature string").fields])
    return spark.read.schema(stored).parquet(root).mapInArrow(_read(len(kept) + 1, found.names), found)
