"""Media columns: MPEG audio (layer III) written and read back, byte for byte.

``encode`` stores any bytes losslessly in a valid MPEG-1 layer III stream: an ID3v2
tag names the byte count, a Xing frame carries the variable-bitrate table (frames,
bytes, seek points), and each audio frame has a checksum, silent side information
and the bytes in its main-data area; an empty ID3v1 tag ends it, so that no payload is
taken for one.  ``parse`` reads any such stream: it skips
tags, finds frame headers again after damage, verifies checksums, reads the
variable-bitrate table, and returns exact durations and the offset of every frame.

Rules for odd input: a null or empty text is one padding block of 64 zero bytes;
texts of any length are stored whole; repeated rows each get a result; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame

from .workspace import bounded_batches

# Fixed values of ISO/IEC 11172-3, layer III: kbit/s by index, Hz by index.
BITRATES = (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320)
RATES = (44100, 48000, 32000)
SAMPLES = 1152
HEAD, CRC, SIDE, SIDE_MONO = 4, 2, 32, 17
TAIL = 128  # bytes of an ID3v1 tag
RATE_INDEX = 1
XING_FLAGS = 0b0111  # frames, bytes and seek points follow


def frame_bytes(bitrate_index: int, rate_index: int = RATE_INDEX, padding: int = 0) -> int:
    return 144 * BITRATES[bitrate_index] * 1000 // RATES[rate_index] + padding


CAPACITY = [frame_bytes(i) - HEAD - CRC - SIDE if i else -1 for i in range(len(BITRATES))]
LARGEST = len(BITRATES) - 1


def _crc_table() -> list[int]:
    out = []
    for byte in range(256):
        x = byte << 8
        for _ in range(8):
            x = ((x << 1) ^ 0x8005 if x & 0x8000 else x << 1) & 0xFFFF
        out.append(x)
    return out


CRC_TABLE = _crc_table()


@functools.lru_cache(4096)
def crc16(data: bytes) -> int:
    """Checksum of header bytes 3 and 4 and the side information."""
    x = 0xFFFF
    for b in data:
        x = ((x << 8) & 0xFFFF) ^ CRC_TABLE[(x >> 8) ^ b]
    return x


@functools.lru_cache(64)
def frame_start(bitrate_index: int) -> bytes:
    """Header (protected, stereo), checksum and silent side information."""
    head = bytes([0xFF, 0xFA, bitrate_index << 4 | RATE_INDEX << 2, 0x00])
    return head + struct.pack(">H", crc16(head[2:] + bytes(SIDE))) + bytes(SIDE)


def syncsafe(n: int) -> bytes:
    return bytes([(n >> s) & 0x7F for s in (21, 14, 7, 0)])


def encode(payload: bytes) -> bytes:
    """The payload in full frames of the highest bitrate and a last one of the least that holds the rest."""
    full, rest = divmod(len(payload), CAPACITY[LARGEST])
    top = frame_start(LARGEST)
    step = CAPACITY[LARGEST]
    frames = [top + payload[i * step : (i + 1) * step] for i in range(full)]
    if rest:
        index = next(i for i in range(1, LARGEST + 1) if CAPACITY[i] >= rest)
        frames.append(frame_start(index) + payload[full * step :] + bytes(CAPACITY[index] - rest))
    body = sum(map(len, frames))
    table = frame_start(LARGEST)
    audio = len(table) + CAPACITY[LARGEST] + body
    seek = bytes(min(255, (frame_bytes(LARGEST) + (i * len(frames) // 100) * frame_bytes(LARGEST)) * 256 // audio) for i in range(100))
    xing = b"Xing" + struct.pack(">III", XING_FLAGS, len(frames), audio) + seek
    text = b"\x00payload_bytes\x00" + str(len(payload)).encode()
    tag = b"TXXX" + struct.pack(">IH", len(text), 0) + text
    return b"".join([b"ID3\x03\x00\x00", syncsafe(len(tag)), tag, table, xing.ljust(CAPACITY[LARGEST], b"\x00"), *frames, b"TAG".ljust(TAIL, b"\x00")])


def header(data: bytes, at: int) -> tuple[int, int, int, bool, bool] | None:
    """Length, bitrate index, rate index, protected, mono of an MPEG-1 layer III header at a byte, or None."""
    if at + HEAD > len(data) or data[at] != 0xFF or data[at + 1] & 0xFE != 0xFA:
        return None
    third = data[at + 2]
    bitrate, rate = third >> 4, third >> 2 & 3
    if not 0 < bitrate < 15 or rate == 3:
        return None
    return frame_bytes(bitrate, rate, third >> 1 & 1), bitrate, rate, not data[at + 1] & 1, data[at + 3] >> 6 == 3


def parse(data: bytes) -> dict:
    """Tags, table, checksums, payload, exact duration and frame offsets of a stream."""
    at, end, tag, stored = 0, len(data), {}, []
    out = {"frames": 0, "bad_crc": 0, "skipped": 0, "samples": 0, "rate": 0, "offsets": [], "xing": None, "tag": tag, "bitrates": set()}
    if data[:3] == b"ID3" and end >= 10:
        size = sum((b & 0x7F) << s for b, s in zip(data[6:10], (21, 14, 7, 0), strict=True))
        p, stop = 10, min(end, 10 + size)
        while p + 10 <= stop and data[p]:
            n = struct.unpack(">I", data[p + 4 : p + 8])[0]
            if data[p : p + 4] == b"TXXX":
                name, _, value = data[p + 11 : p + 10 + n].partition(b"\x00")
                tag[name.decode("latin-1")] = value.decode("latin-1")
            p += 10 + n
        at = stop
    if data[-TAIL:][:3] == b"TAG":
        end -= TAIL
    synced = False
    while at < end:
        h = header(data, at)
        ok = h is not None and at + h[0] <= end and (synced or at + h[0] == end or header(data, at + h[0]) is not None)
        if not ok:
            out["skipped"] += 1
            later = data.find(b"\xff", at + 1, end)
            out["skipped"] += (later if later > 0 else end) - at - 1
            at, synced = (later if later > 0 else end), False
            continue
        size, bitrate, rate, protected, mono = h
        side = SIDE_MONO if mono else SIDE
        start = at + HEAD + CRC * protected + side
        good = not protected or crc16(data[at + 2 : at + 4] + data[at + 6 : start]) == data[at + 4] << 8 | data[at + 5]
        if not good:
            out["bad_crc"] += 1
        elif out["xing"] is None and not out["frames"] and data[start : start + 4] in (b"Xing", b"Info"):
            flags, frames, length = struct.unpack(">III", data[start + 4 : start + 16])
            out["xing"] = {"flags": flags, "frames": frames, "bytes": length, "seek": data[start + 16 : start + 116]}
        else:
            out["offsets"].append(at)
            out["frames"] += 1
            out["samples"] += SAMPLES
            out["rate"] = RATES[rate]
            out["bitrates"].add(BITRATES[bitrate])
            stored.append(data[start : at + size])
        at, synced = at + size, True
    payload = b"".join(stored)
    out["payload"] = payload[: int(tag["payload_bytes"])] if tag.get("payload_bytes", "").isdigit() else payload
    return out


def padded(text: str | None) -> tuple[int, bytes]:
    """UTF-8 length, and the bytes with zeros up to a positive multiple of 64."""
    raw = (text or "").encode()
    return len(raw), raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\x00")


def features(found: dict) -> str:
    """Exact figures of a parsed stream."""
    rates = sorted(found["bitrates"])
    seek = hashlib.md5(",".join(map(str, found["offsets"])).encode()).hexdigest()
    return f"frames={found['frames']};samples={found['samples']};rate={found['rate']};kbps={rates[0] if rates else 0}-{rates[-1] if rates else 0};vbr={int(found['xing'] is not None)};bad_crc={found['bad_crc']};skipped={found['skipped']};seek={seek}"


NAMES = ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "duration_ms", "seek_offsets")
TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.int64()))


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its stream's digests, the payload as read back, duration and frame offsets."""
    schema = pa.schema(list(zip(NAMES, TYPES, strict=True)))

    def one(doc: int, text: str | None) -> tuple:
        n, payload = padded(text)
        media = encode(payload)
        found = parse(media)
        back = found["payload"]
        if back != payload:
            raise ValueError(f"document {doc}: the stream does not give back its {len(payload)} bytes")
        return (doc, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), features(found), found["samples"] * 1000 / found["rate"], found["offsets"])

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at in range(0, len(ids), 500):
                rows = [one(d, t.as_py()) for d, t in zip(ids[at : at + 500], batch.column(1).slice(at, 500), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], schema=schema)

    bounded_batches(docs.sparkSession)
    picked = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return picked.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, duration_ms double, seek_offsets array<long>")
