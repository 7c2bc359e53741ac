"""Byte payloads as Matroska media columns: a writer, and a parser to packet tables.

The parser reads variable-length EBML elements (also of unknown size), the
segment's tracks, clusters, simple blocks and block groups with no, Xiph, fixed
or EBML lacing, and cues.  Every packet has its track, timestamp and the byte
range of its frame, so frames are cut from the file without copying it.

The writer stores one audio track of 8-bit samples, 8000 a second (8 in each
millisecond tick).  A packet is 64 samples; up to 32 packets share a laced
block, 16 blocks a cluster, and the lacing changes from block to block.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from tessella.llm.common import map_slices, materialize, texts_of

# Fixed values of the Matroska format: element ids.
EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
DOC_TYPE, TIMESTAMP_SCALE, DURATION = 0x4282, 0x2AD7B1, 0x4489
TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID, AUDIO, RATE, CHANNELS, BIT_DEPTH = 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER_TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, BLOCK_DURATION = 0xE7, 0xA3, 0xA0, 0xA1, 0x9B
CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
NO_LACING, XIPH, FIXED, EBML_LACING = 0, 1, 2, 3

PAD, PACKET, LACED, BLOCKS_A_CLUSTER, SAMPLES_A_TICK = 64, 64, 32, 16, 8
#: Elements whose children are read; at these, an element of unknown size ends.
_TOP = {INFO, TRACKS, CLUSTER, CUES, SEGMENT, EBML}


def vint(value: int, width: int = 0) -> bytes:
    """``value`` as an EBML size of the least (or given) number of bytes."""
    width = width or next(w for w in range(1, 9) if value < (1 << 7 * w) - 1)
    return (value | 1 << 7 * width).to_bytes(width, "big")


def read_vint(data: bytes, at: int) -> tuple[int, int, int]:
    """Value without its marker, the raw number, and the width of the variable-length integer at ``at``."""
    first = data[at]
    if not first:
        raise ValueError(f"no variable-length integer at byte {at}")
    width = 9 - first.bit_length()
    if at + width > len(data):
        raise ValueError(f"the data end within an integer at byte {at}")
    raw = int.from_bytes(data[at : at + width], "big")
    return raw & ((1 << 7 * width) - 1), raw, width


def element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def unsigned(ident: int, value: int) -> bytes:
    return element(ident, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def elements(data: bytes, at: int, end: int) -> Iterator[tuple[int, int, int]]:
    """``id, first byte, end`` of the element bodies between two places."""
    while at < end:
        _, ident, width = read_vint(data, at)
        at += width
        size, _, width = read_vint(data, at)
        at += width
        if size == (1 << 7 * width) - 1:  # unknown: up to the next element of the level above
            stop, inner = end, at
            if ident not in (SEGMENT,):
                while inner < end:
                    _, child, w = read_vint(data, inner)
                    if child in _TOP:
                        stop = inner
                        break
                    length, _, w2 = read_vint(data, inner + w)
                    inner += w + w2 + length
        else:
            stop = at + size
        if stop > end:
            raise ValueError(f"element {ident:#x} at byte {at} ends after its parent")
        yield ident, at, stop
        at = stop


@dataclass
class Packet:
    track: int
    timestamp: int
    keyframe: bool
    lacing: int
    start: int
    end: int


@dataclass
class Media:
    doc_type: str = ""
    timestamp_scale: int = 1_000_000
    duration: float = 0.0
    tracks: dict[int, dict] = field(default_factory=dict)
    packets: list[Packet] = field(default_factory=list)
    clusters: int = 0
    cues: list[tuple[int, int, int]] = field(default_factory=list)


def _lace_sizes(data: bytes, at: int, end: int, lacing: int) -> tuple[int, list[int]]:
    """First byte and sizes of a block's frames."""
    if lacing == NO_LACING:
        return at, [end - at]
    n = data[at] + 1
    at += 1
    sizes: list[int] = []
    if lacing == FIXED:
        if (end - at) % n:
            raise ValueError("a fixed lace does not divide its block")
        return at, [(end - at) // n] * n
    for k in range(n - 1):
        if lacing == XIPH:
            size = 0
            while True:
                size += data[at]
                at += 1
                if data[at - 1] < 255:
                    break
        else:
            value, _, width = read_vint(data, at)
            at += width
            size = value if not k else sizes[-1] + value - ((1 << 7 * width - 1) - 1)
        sizes.append(size)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("the frames of a lace are longer than their block")
    return at, sizes


def _block(media: Media, data: bytes, at: int, end: int, base: int, keyframe: bool | None) -> None:
    track, _, width = read_vint(data, at)
    time, flags = struct.unpack_from(">hB", data, at + width)
    lacing = flags >> 1 & 3
    at, sizes = _lace_sizes(data, at + width + 3, end, lacing)
    ticks = media.tracks.get(track, {}).get("ticks_a_byte", 0)
    stamp = float(base + time)
    for size in sizes:
        media.packets.append(Packet(track, int(stamp), bool(flags & 0x80) if keyframe is None else keyframe, lacing, at, at + size))
        stamp += size * ticks
        at += size


def _number(data: bytes, at: int, end: int) -> int:
    return int.from_bytes(data[at:end], "big")


def _float(data: bytes, at: int, end: int) -> float:
    return struct.unpack(">f" if end - at == 4 else ">d", data[at:end])[0]


def parse(data: bytes) -> Media:
    """Tracks, packets and cues of a file; ``ValueError`` where it is malformed."""
    try:
        return _parse(data)
    except (IndexError, struct.error, UnicodeDecodeError, ZeroDivisionError, OverflowError) as e:
        raise ValueError(f"the file ends early or has a value out of range: {e}") from e


def _parse(data: bytes) -> Media:
    media = Media()
    for top, a, b in elements(data, 0, len(data)):
        if top == EBML:
            media.doc_type = next((data[x:y].decode() for i, x, y in elements(data, a, b) if i == DOC_TYPE), "")
        elif top == SEGMENT:
            for ident, x, y in elements(data, a, b):
                if ident == INFO:
                    for i, p, q in elements(data, x, y):
                        if i == TIMESTAMP_SCALE:
                            media.timestamp_scale = _number(data, p, q)
                        elif i == DURATION:
                            media.duration = _float(data, p, q)
                elif ident == TRACKS:
                    for i, p, q in elements(data, x, y):
                        if i == TRACK_ENTRY:
                            _track(media, data, p, q)
                elif ident == CLUSTER:
                    media.clusters += 1
                    base = 0
                    for i, p, q in elements(data, x, y):
                        if i == CLUSTER_TIMESTAMP:
                            base = _number(data, p, q)
                        elif i == SIMPLE_BLOCK:
                            _block(media, data, p, q, base, None)
                        elif i == BLOCK_GROUP:
                            for j, u, v in elements(data, p, q):
                                if j == BLOCK:
                                    _block(media, data, u, v, base, True)
                elif ident == CUES:
                    for i, p, q in elements(data, x, y):
                        if i == CUE_POINT:
                            _cue(media, data, p, q, a)
    return media


def _track(media: Media, data: bytes, a: int, b: int) -> None:
    track: dict = {"type": 0, "codec": "", "rate": 8000.0, "channels": 1, "bits": 0}
    number = 0
    for i, x, y in elements(data, a, b):
        if i == TRACK_NUMBER:
            number = _number(data, x, y)
        elif i == TRACK_TYPE:
            track["type"] = _number(data, x, y)
        elif i == CODEC_ID:
            track["codec"] = data[x:y].decode()
        elif i == AUDIO:
            for j, p, q in elements(data, x, y):
                if j == RATE:
                    track["rate"] = _float(data, p, q)
                elif j == CHANNELS:
                    track["channels"] = _number(data, p, q)
                elif j == BIT_DEPTH:
                    track["bits"] = _number(data, p, q)
    if track["bits"]:
        track["ticks_a_byte"] = 8e9 / (track["bits"] * track["channels"] * track["rate"] * media.timestamp_scale)
    media.tracks[number] = track


def _cue(media: Media, data: bytes, a: int, b: int, segment: int) -> None:
    time = 0
    for i, x, y in elements(data, a, b):
        if i == CUE_TIME:
            time = _number(data, x, y)
        elif i == CUE_POSITIONS:
            at = {j: _number(data, p, q) for j, p, q in elements(data, x, y)}
            media.cues.append((time, at.get(CUE_TRACK, 0), segment + at.get(CUE_CLUSTER, 0)))


def lace(frames: list[bytes], lacing: int) -> bytes:
    """The frames of one block with their lace header."""
    if lacing == NO_LACING:
        return frames[0]
    head = bytes([len(frames) - 1])
    if lacing == XIPH:
        head += b"".join(b"\xff" * (len(f) // 255) + bytes([len(f) % 255]) for f in frames[:-1])
    elif lacing == EBML_LACING:
        for k, f in enumerate(frames[:-1]):
            if not k:
                head += vint(len(f))
            else:
                change = len(f) - len(frames[k - 1])
                width = next(w for w in range(1, 9) if abs(change) < (1 << 7 * w - 1) - 1)
                head += vint(change + (1 << 7 * width - 1) - 1, width)
    return head + b"".join(frames)


def write(payload: bytes) -> bytes:
    """A Matroska file whose packets, end to end, are ``payload`` (whole packets of 64 bytes)."""
    scale = unsigned(TIMESTAMP_SCALE, 1_000_000)
    info = element(INFO, scale + element(DURATION, struct.pack(">d", len(payload) / SAMPLES_A_TICK)))
    audio = element(AUDIO, element(RATE, struct.pack(">d", 1000.0 * SAMPLES_A_TICK)) + unsigned(CHANNELS, 1) + unsigned(BIT_DEPTH, 8))
    entry = unsigned(TRACK_NUMBER, 1) + unsigned(TRACK_UID, 1) + unsigned(TRACK_TYPE, 2) + element(CODEC_ID, b"A_PCM/INT/LIT") + audio
    parts = [info, element(TRACKS, element(TRACK_ENTRY, entry))]
    at, cues = sum(map(len, parts)), []
    block, span = PACKET * LACED, PACKET * LACED * BLOCKS_A_CLUSTER
    for first in range(0, len(payload), span):
        time = first // SAMPLES_A_TICK
        body = [unsigned(CLUSTER_TIMESTAMP, time)]
        for k, begin in enumerate(range(first, min(first + span, len(payload)), block)):
            frames = [payload[i : i + PACKET] for i in range(begin, min(begin + block, len(payload)), PACKET)]
            lacing = NO_LACING if len(frames) == 1 else (FIXED, XIPH, EBML_LACING)[k % 3]
            head = b"\x81" + struct.pack(">hB", begin // SAMPLES_A_TICK - time, 0x80 | lacing << 1)
            body.append(element(SIMPLE_BLOCK, head + lace(frames, lacing)))
        cues.append(element(CUE_POINT, unsigned(CUE_TIME, time) + element(CUE_POSITIONS, unsigned(CUE_TRACK, 1) + unsigned(CUE_CLUSTER, at))))
        parts.append(element(CLUSTER, b"".join(body)))
        at += len(parts[-1])
    parts.append(element(CUES, b"".join(cues)))
    return element(EBML, element(DOC_TYPE, b"matroska")) + element(SEGMENT, b"".join(parts))


def payload_of(text: str | None) -> bytes:
    """UTF-8 bytes of the text (null: empty), padded with zeros to a positive multiple of 64."""
    data = (text or "").encode()
    return data + b"\0" * (-len(data) % PAD if data else PAD)


def store(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, media``: each text as a Matroska file."""

    def run(batch: pa.RecordBatch) -> dict:
        texts = texts_of(batch)
        return {"doc_id": batch.column(0), "n_bytes": [len(t.encode()) for t in texts], "media": [write(payload_of(t)) for t in texts]}

    return map_slices(docs.select("doc_id", "text"), run, "doc_id long, n_bytes long, media binary")


def packets(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """The packet table of a column ``media``: one row per packet with track, timestamp and byte range.

    Null has no packets.  A file that cannot be parsed has one row, with its
    ``error`` and nothing else; no file fails the others.  Files are parsed
    whole, one at a time if they are large.
    """
    kind = media.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        keys, found, errors = [], [], []
        for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            error = None
            try:
                p = parse(data).packets if data is not None else []
            except ValueError as e:
                p, error = [None], str(e)
            found += p
            keys += [k] * len(p)
            errors += [error] * len(p)
        columns = {c: [getattr(p, c) if p else None for p in found] for c in ("track", "timestamp", "keyframe", "lacing", "start", "end")}
        return {key: keys} | columns | {"error": errors}

    return map_slices(media.select(key, "media"), run, f"{key} {kind}, track int, timestamp long, keyframe boolean, lacing int, start long, end long, error string", "media")


def describe(media: bytes) -> tuple[bytes, str]:
    """The payload read from a file, and features of its packets and samples."""
    m = parse(media)
    payload = b"".join(media[p.start : p.end] for p in m.packets)
    lacing = [0] * 4
    for p in m.packets:
        lacing[p.lacing] += 1
    if any(m.packets[i].timestamp >= m.packets[i + 1].timestamp for i in range(len(m.packets) - 1)):
        raise ValueError("timestamps do not rise")
    # a cue must lead to a cluster of the same time
    for _, _, at in m.cues:
        if read_vint(media, at)[1] != CLUSTER:
            raise ValueError("a cue does not lead to a cluster")
    mean = sum(payload) / max(1, len(payload))
    codec = ",".join(t["codec"] for t in m.tracks.values())
    return payload, f"codec={codec};packets={len(m.packets)};clusters={m.clusters};cues={len(m.cues)};lacing={'/'.join(map(str, lacing))};duration_ms={m.duration:.0f};mean={mean:.4f}"


def media_columns(docs: DataFrame) -> DataFrame:
    """Store every text as media in the shared folder, read it back and describe it.

    One row per document: ``doc_id, n_bytes, payload_bytes, payload_sha256,
    tail_crc32, media_bytes, media_sha256, feature``; all but doc_id depend on
    the text alone.  Null text is empty (64 zero bytes).  A text of any length
    is one file.  Repeated rows and null ids are rows of their own.  Other columns are ignored.  An empty table gives
    no rows.
    """
    stored = materialize(store(docs), "media")

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")}
        for data in batch.column(2).to_pylist():
            payload, feature = describe(data)
            row = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), feature)
            for column, value in zip(out.values(), row, strict=True):
                column.append(value)
        return {"doc_id": batch.column(0), "n_bytes": batch.column(1)} | out

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return map_slices(stored, run, schema, "media")
