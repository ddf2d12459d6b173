"""Media columns: payloads stored as audio in Matroska, and a packet reader.

The writer puts the payload's bytes, as unsigned 8-bit PCM samples of one
track, into frames of FRAME bytes, eight frames to a SimpleBlock (fixed-size
lacing; EBML lacing for a shorter last frame), sixteen blocks to a cluster, and
an entry in the cues for each cluster.  Nothing in a file depends on time or
chance, so equal payloads give equal files.

The reader is general: it walks EBML elements with variable-length ids and
sizes (unknown sizes too), Info, Tracks, Cues, Clusters with SimpleBlocks and
BlockGroups, and all four lacings, and lists packets with track, timestamp,
byte range and key flag.

Cases: a null or empty text is a payload of 64 zero bytes; a text whose UTF-8
length is a positive multiple of 64 is not padded; texts of any length are
whole; equal texts give equal rows; an empty table gives an empty one; other
input columns are not looked at.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

# Element ids of the Matroska specification (RFC 9559).
EBML, SEGMENT = 0x1A45DFA3, 0x18538067
INFO, TRACKS, CUES, CLUSTER = 0x1549A966, 0x1654AE6B, 0x1C53BB6B, 0x1F43B675
TIMESTAMP_SCALE, DURATION = 0x2AD7B1, 0x4489
TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID = 0xAE, 0xD7, 0x73C5, 0x83, 0x86
AUDIO, SAMPLING_RATE, CHANNELS, BIT_DEPTH, DEFAULT_DURATION = 0xE1, 0xB5, 0x9F, 0x6264, 0x23E383
CLUSTER_TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, REFERENCE_BLOCK = 0xE7, 0xA3, 0xA0, 0xA1, 0xFB
CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1

PAD, RATE, FRAME, FRAMES_PER_BLOCK, BLOCKS_PER_CLUSTER = 64, 8000, 1024, 8, 16
FRAME_MS = FRAME * 1000 // RATE


def element_id(number: int) -> bytes:
    return number.to_bytes((number.bit_length() + 7) // 8, "big")


def vint(value: int, length: int = 0) -> bytes:
    """A variable-length number; the all-ones pattern is left for "unknown"."""
    length = length or next(n for n in range(1, 9) if value < (1 << 7 * n) - 1)
    return (value | 1 << 7 * length).to_bytes(length, "big")


def element(number: int, body: bytes) -> bytes:
    return element_id(number) + vint(len(body)) + body


def uint(number: int, value: int) -> bytes:
    return element(number, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def real(number: int, value: float) -> bytes:
    return element(number, struct.pack(">d", value))


def pad(payload: bytes) -> bytes:
    return payload + bytes(-len(payload) % PAD if payload else PAD)


def block(track: int, at: int, frames: list[bytes]) -> bytes:
    head = vint(track) + struct.pack(">h", at)
    sizes = [len(f) for f in frames]
    if len(frames) == 1:
        return head + b"\x80" + frames[0]
    if len(set(sizes)) == 1:
        return head + b"\x84" + bytes([len(frames) - 1]) + b"".join(frames)
    laced = vint(sizes[0])
    for a, b in zip(sizes, sizes[1:-1], strict=False):
        d = b - a
        length = next(n for n in range(1, 9) if abs(d) < (1 << (7 * n - 1)) - 1)
        laced += vint(d + (1 << (7 * length - 1)) - 1, length)
    return head + b"\x86" + bytes([len(frames) - 1]) + laced + b"".join(frames)


def write_matroska(payload: bytes) -> bytes:
    header = element(EBML, uint(0x4286, 1) + uint(0x42F7, 1) + uint(0x42F2, 4) + uint(0x42F3, 8) + element(0x4282, b"matroska") + uint(0x4287, 4) + uint(0x4285, 2))
    info = element(INFO, uint(TIMESTAMP_SCALE, 1_000_000) + real(DURATION, len(payload) * 1000 / RATE) + element(0x4D80, b"varloom") + element(0x5741, b"varloom"))
    audio = element(AUDIO, real(SAMPLING_RATE, float(RATE)) + uint(CHANNELS, 1) + uint(BIT_DEPTH, 8))
    tracks = element(TRACKS, element(TRACK_ENTRY, uint(TRACK_NUMBER, 1) + uint(TRACK_UID, 1) + uint(TRACK_TYPE, 2) + element(CODEC_ID, b"A_PCM/INT/LIT") + uint(DEFAULT_DURATION, FRAME_MS * 1_000_000) + audio))
    per_block, per_cluster = FRAME * FRAMES_PER_BLOCK, FRAME * FRAMES_PER_BLOCK * BLOCKS_PER_CLUSTER
    clusters, points, at = [], [], len(info) + len(tracks)
    for c in range(0, len(payload), per_cluster):
        time = c // FRAME * FRAME_MS
        body = [uint(CLUSTER_TIMESTAMP, time)]
        for b in range(c, min(c + per_cluster, len(payload)), per_block):
            frames = [payload[f : f + FRAME] for f in range(b, min(b + per_block, len(payload)), FRAME)]
            body.append(element(SIMPLE_BLOCK, block(1, b // FRAME * FRAME_MS - time, frames)))
        clusters.append(element(CLUSTER, b"".join(body)))
        points.append(element(CUE_POINT, uint(CUE_TIME, time) + element(CUE_TRACK_POSITIONS, uint(CUE_TRACK, 1) + uint(CUE_CLUSTER_POSITION, at))))
        at += len(clusters[-1])
    return header + element(SEGMENT, b"".join([info, tracks, *clusters, element(CUES, b"".join(points))]))


@dataclass
class Packet:
    track: int
    timestamp_ms: int
    start: int
    length: int
    key: bool
    lacing: int


@dataclass
class Media:
    tracks: list[dict] = field(default_factory=list)
    cues: list[tuple[int, int, int]] = field(default_factory=list)
    packets: list[Packet] = field(default_factory=list)
    clusters: list[int] = field(default_factory=list)
    duration_ms: float = 0.0
    scale: int = 1_000_000


def read_vint(data: bytes, at: int, keep: bool) -> tuple[int, int, bool]:
    """(value, position after it, all ones); ``keep`` leaves the marker in."""
    first = data[at]
    if not first:
        raise ValueError("a variable-length number of more than 8 bytes")
    length = 9 - first.bit_length()
    value = int.from_bytes(data[at : at + length], "big")
    if at + length > len(data):
        raise ValueError("the data end within a number")
    bare = value & ((1 << 7 * length) - 1)
    return (value if keep else bare), at + length, bare == (1 << 7 * length) - 1


def elements(data: bytes, at: int, end: int, stops: frozenset[int] = frozenset()) -> Iterator[tuple[int, int, int]]:
    """(id, start of body, end of body).  An element of unknown size ends where
    one of ``stops`` begins, or with its parent."""
    while at < end:
        number, at, _ = read_vint(data, at, True)
        size, at, unknown = read_vint(data, at, False)
        stop = at + size
        if unknown:
            stop = end
            if number == CLUSTER:
                for child, _, past in elements(data, at, end):
                    if child in (CLUSTER, CUES, INFO, TRACKS):
                        break
                    stop = past
        if stop > end:
            raise ValueError("an element reaches past its parent")
        yield number, at, stop
        at = stop


def lacing_sizes(data: bytes, kind: int, at: int, end: int) -> tuple[list[int], int]:
    """Sizes of a block's frames and where the first begins."""
    if kind == 0:
        return [end - at], at
    n, at = data[at] + 1, at + 1
    sizes: list[int] = []
    if kind == 2:
        return [(end - at) // n] * n, at
    if kind == 1:
        for _ in range(n - 1):
            size = 0
            while True:
                size, at = size + data[at], at + 1
                if data[at - 1] != 255:
                    break
            sizes.append(size)
    else:
        size, at, _ = read_vint(data, at, False)
        sizes.append(size)
        for _ in range(n - 2):
            length = 9 - data[at].bit_length()
            step, at, _ = read_vint(data, at, False)
            sizes.append(sizes[-1] + step - ((1 << (7 * length - 1)) - 1))
    sizes = sizes[: n - 1]
    return [*sizes, end - at - sum(sizes)], at


def read_matroska(data: bytes) -> Media:
    out = Media()
    number = lambda a, b: int.from_bytes(data[a:b], "big")
    decimal = lambda a, b: struct.unpack(">d" if b - a == 8 else ">f", data[a:b])[0] if b > a else 0.0
    frame_ns: dict[int, int] = {}

    def add_block(a: int, b: int, cluster: int, key: bool | None) -> None:
        track, p, _ = read_vint(data, a, False)
        at = cluster + struct.unpack(">h", data[p : p + 2])[0]
        flags = data[p + 2]
        kind = flags >> 1 & 3
        sizes, p = lacing_sizes(data, kind, p + 3, b)
        for i, size in enumerate(sizes):
            ms = (at * out.scale + i * frame_ns.get(track, 0)) // 1_000_000
            out.packets.append(Packet(track, ms, p, size, bool(flags & 0x80) if key is None else key, kind))
            p += size

    for top, a, b in elements(data, 0, len(data)):
        if top != SEGMENT:
            continue
        for part, c, d in elements(data, a, b):
            if part == INFO:
                for x, e, f in elements(data, c, d):
                    if x == TIMESTAMP_SCALE:
                        out.scale = number(e, f)
                    elif x == DURATION:
                        out.duration_ms = decimal(e, f) * out.scale / 1e6
            elif part == TRACKS:
                for x, e, f in elements(data, c, d):
                    if x == TRACK_ENTRY:
                        track: dict = {}
                        for y, g, h in elements(data, e, f):
                            if y == TRACK_NUMBER:
                                track["number"] = number(g, h)
                            elif y == TRACK_TYPE:
                                track["type"] = number(g, h)
                            elif y == CODEC_ID:
                                track["codec"] = data[g:h].decode()
                            elif y == DEFAULT_DURATION:
                                track["frame_ns"] = number(g, h)
                            elif y == AUDIO:
                                for z, i, j in elements(data, g, h):
                                    if z == SAMPLING_RATE:
                                        track["rate"] = decimal(i, j)
                                    elif z in (CHANNELS, BIT_DEPTH):
                                        track["channels" if z == CHANNELS else "bits"] = number(i, j)
                        out.tracks.append(track)
                        frame_ns[track.get("number", 0)] = track.get("frame_ns", 0)
            elif part == CUES:
                for x, e, f in elements(data, c, d):
                    if x == CUE_POINT:
                        time = track_no = position = 0
                        for y, g, h in elements(data, e, f):
                            if y == CUE_TIME:
                                time = number(g, h)
                            elif y == CUE_TRACK_POSITIONS:
                                for z, i, j in elements(data, g, h):
                                    if z == CUE_TRACK:
                                        track_no = number(i, j)
                                    elif z == CUE_CLUSTER_POSITION:
                                        position = a + number(i, j)
                        out.cues.append((time, track_no, position))
            elif part == CLUSTER:
                time = 0
                # a cluster's own start: its id is four bytes long, before the size
                out.clusters.append(data.rindex(element_id(CLUSTER), a, c))
                for x, e, f in elements(data, c, d):
                    if x == CLUSTER_TIMESTAMP:
                        time = number(e, f)
                    elif x == SIMPLE_BLOCK:
                        add_block(e, f, time, None)
                    elif x == BLOCK_GROUP:
                        inner = list(elements(data, e, f))
                        key = all(y != REFERENCE_BLOCK for y, _, _ in inner)
                        for y, g, h in inner:
                            if y == BLOCK:
                                add_block(g, h, time, key)
    return out


def payload_of(data: bytes, media: Media, track: int = 1) -> bytes:
    view = memoryview(data)
    return b"".join(view[p.start : p.start + p.length] for p in media.packets if p.track == track)


def store(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, media): each text's padded UTF-8 bytes as a file."""
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("_id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("_raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_raw"):
            raw = batch.column("_raw").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array([len(x) for x in raw], pa.int64()), pa.array([write_matroska(pad(x)) for x in raw], pa.binary())], ["_id", "n_bytes", "media"])

    return rows.mapInArrow(run, f"_id {kind}, n_bytes bigint, media binary").withColumnRenamed("_id", id_col)


PACKET = "track int, timestamp_ms bigint, start bigint, length bigint, key_frame boolean"


def read(df: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """(id_col, n_bytes, media, payload, feature, packets): files read back.
    ``feature`` sums a file up; ``packets`` is its packet table."""
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("_id"), "n_bytes", F.col(media_col).alias("media"))
    names = [x.split()[0] for x in PACKET.split(", ")]
    listed = pa.list_(pa.struct([("track", pa.int32()), ("timestamp_ms", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("key_frame", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media"):
            payloads, features, packets = [], [], []
            for data in batch.column("media").to_pylist():
                media = read_matroska(data)
                payload = payload_of(data, media)
                laced = sum(p.lacing > 0 for p in media.packets)
                sound = all(any(c[2] == start for c in media.cues) for start in media.clusters)
                t = media.tracks[0]
                payloads.append(payload)
                features.append(f"codec={t['codec']};rate={t['rate']:.0f};bits={t['bits']};tracks={len(media.tracks)};clusters={len(media.clusters)};cues={len(media.cues)};cues_ok={int(sound)};packets={len(media.packets)};laced={laced};last_ms={media.packets[-1].timestamp_ms};duration_us={round(media.duration_ms * 1000)};mean={sum(payload) * 1000 // len(payload)}")
                packets.append([dict(zip(names, (p.track, p.timestamp_ms, p.start, p.length, p.key), strict=True)) for p in media.packets])
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("n_bytes"), batch.column("media"), pa.array(payloads, pa.binary()), pa.array(features, pa.string()), pa.array(packets, listed)], ["_id", "n_bytes", "media", "payload", "feature", "packets"])

    return rows.mapInArrow(run, f"_id {kind}, n_bytes bigint, media binary, payload binary, feature string, packets array<struct<{PACKET.replace(' ', ':').replace(',:', ',')}>>").withColumnRenamed("_id", id_col)


def packet_table(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per packet of what ``read`` returned."""
    return df.select(id_col, F.posexplode("packets").alias("packet_no", "p")).select(id_col, "packet_no", "p.*")
