"""MPEG audio media columns (operator 8).

`parse` reads streams of MPEG-1, 2 and 2.5, Layers I to III, mono and stereo,
with and without checksums. It reads tags (ID3v2.2 to 2.4, ID3v1), passes over
what is no frame, resynchronises on headers that a second one confirms, follows
chains of frames, verifies each checksum, reads the tables of variable bit
rates (Xing, Info, VBRI) and gives the exact duration and the byte offset of
every audio frame. Encoder delay and padding, where stored, are no part of the
duration. Streams of free-format frames (no bit rate in the header) have no
frame sizes and count as bytes passed over.

A payload is stored as an MPEG-1 Layer III stream: an ID3v2 tag, a Xing frame
(frame count, byte count and seek table) and mono frames with checksums whose
main data carry the payload; part2_3_length of the two granules says how many
bytes of a frame are used.

Edge cases: null text counts as empty; a payload of no bytes has no audio
frame; frames whose checksum fails keep their place in time but give no
payload, and are counted in `bad_crc`; bytes passed over are counted in
`skipped`; bytes that are no stream at all give an empty payload and zero
frames. Equal texts, and so repeated rows, give equal values in every column;
texts of any length are stored whole; an empty table gives no row; columns
other than doc_id and text are not looked at. The work is row-wise inside
tasks, so no key can be hot.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from docfacts.llm.shared import arrow_schema, read, rows_to_batch, texts

# Fixed values of the format: kbit/s by header index per (MPEG-1?, layer), samples a second by index (MPEG-1; the others have a half or a quarter).
BITRATES = {
    (True, 1): [32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448],
    (True, 2): [32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384],
    (True, 3): [32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320],
    (False, 1): [32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256],
    (False, 2): [8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160],
    (False, 3): [8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160],
}
RATES = [44100, 48000, 32000]
# Bits of a Layer II allocation by subband, as (bits, subbands) runs: high rates of 48 kHz and middle ones of the others, high ones of
# the others, low rates, low rates of 32 kHz, and MPEG-2.
ALLOCATIONS = {
    "a": [(4, 11), (3, 12), (2, 4)], "b": [(4, 11), (3, 12), (2, 7)], "c": [(4, 2), (3, 6)], "d": [(4, 2), (3, 10)], "lsf": [(4, 4), (3, 7), (2, 19)],
}
ID3V1 = [("title", 3, 33), ("artist", 33, 63), ("album", 63, 93), ("year", 93, 97), ("comment", 97, 127)]
ENCODINGS = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}

SAMPLES = 1152
RATE_INDEX = 1  # 48 kHz: a frame of b kbit/s has exactly 3 b bytes
OVERHEAD = 4 + 2 + 17  # header, checksum, side information of a mono frame
KBITS = [0, *BITRATES[True, 3]]
CAPACITY = [max(0, 3 * b - OVERHEAD) for b in KBITS]
FULL = CAPACITY[-1]


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32) << 8
    for _ in range(8):
        table = np.where(table & 0x8000, (table << 1) ^ 0x8005, table << 1) & 0xFFFF
    return table.astype(np.uint16)


CRC = _crc_table()


def crc16(rows: np.ndarray) -> np.ndarray:
    """CRC-16 (0x8005, start 0xFFFF) of each row of a byte matrix."""
    crc = np.full(len(rows), 0xFFFF, dtype=np.uint16)
    for j in range(rows.shape[1]):
        crc = (crc << np.uint16(8)) ^ CRC[(crc >> np.uint16(8)) ^ rows[:, j]]
    return crc


def _heads(bitrate_index: int, used: np.ndarray) -> np.ndarray:
    """Header, checksum and side information of frames that hold the given numbers of bytes."""
    out = np.zeros((len(used), OVERHEAD), dtype=np.uint8)
    out[:, 0], out[:, 1], out[:, 2], out[:, 3] = 0xFF, 0xFA, bitrate_index << 4 | RATE_INDEX << 2, 0xC0
    first = np.minimum(used * 8, 4088)
    second = used * 8 - first
    # side information: main_data_begin 9 bits, private 5, scfsi 4, then part2_3_length (12 of 59 bits) a granule
    bits = np.zeros((len(used), 17 * 8), dtype=np.uint8)
    for at, value in ((18, first), (18 + 59, second)):
        for j in range(12):
            bits[:, at + j] = value >> (11 - j) & 1
    out[:, 6:] = np.packbits(bits, axis=1)
    crc = crc16(np.concatenate([out[:, 2:4], out[:, 6:]], axis=1))
    out[:, 4], out[:, 5] = crc >> 8, crc & 0xFF
    return out


def encode(payload: bytes) -> bytes:
    full, rest = divmod(len(payload), FULL)
    parts = []
    if full:
        frames = np.empty((full, FULL + OVERHEAD), dtype=np.uint8)
        frames[:, :OVERHEAD] = _heads(14, np.full(full, FULL))
        frames[:, OVERHEAD:] = np.frombuffer(payload, dtype=np.uint8, count=full * FULL).reshape(full, FULL)
        parts.append(frames.tobytes())
    if rest:
        index = next(i for i in range(1, 15) if CAPACITY[i] >= rest)
        parts.append(_heads(index, np.array([rest])).tobytes() + payload[full * FULL:] + bytes(CAPACITY[index] - rest))
    audio = b"".join(parts)
    n, head = full + bool(rest), _heads(8, np.array([0])).tobytes()  # 112 kbit/s holds the Xing table
    size = 3 * KBITS[8]
    total = size + len(audio)
    # seek table: 256ths of the stream at each hundredth of the duration
    at = np.minimum(np.arange(100) * (n + 1) // 100, n)
    offsets = np.where(at == 0, 0, size + (at - 1) * (FULL + OVERHEAD))
    toc = np.minimum(255, offsets * 256 // max(total, 1)).astype(np.uint8).tobytes()
    xing = b"Xing" + struct.pack(">III", 7, n, total) + toc
    first = head + xing + bytes(size - len(head) - len(xing))
    title = b"\x03payload\x00" + str(len(payload)).encode()
    frame = b"TXXX" + _syncsafe(len(title)) + b"\0\0" + title
    return b"ID3\x04\0\0" + _syncsafe(len(frame)) + frame + first + audio


def _syncsafe(n: int) -> bytes:
    return bytes((n >> s) & 0x7F for s in (21, 14, 7, 0))


class Header(NamedTuple):
    """What four header bytes say; `side` is where the main data of Layer III begins, after header, checksum and side information."""

    version: int  # 1, 2, or 25 for 2.5
    layer: int
    checked: bool
    kbits: int
    rate: int
    channels: int
    extension: int  # of joint stereo
    joint: bool
    size: int
    samples: int
    side: int


@functools.lru_cache(maxsize=4096)
def header(word: int) -> Header | None:
    """The header in the last three of four bytes (the first is 0xFF); None if it is none."""
    b1, b2, b3 = word >> 16 & 255, word >> 8 & 255, word & 255
    version, layer = {0: 25, 2: 2, 3: 1}.get(b1 >> 3 & 3), 4 - (b1 >> 1 & 3)
    index, rate = b2 >> 4, b2 >> 2 & 3
    if b1 & 0xE0 != 0xE0 or version is None or layer == 4 or index in (0, 15) or rate == 3 or b3 & 3 == 2:
        return None
    kbits, rate = BITRATES[version == 1, layer][index - 1], RATES[rate] // {1: 1, 2: 2, 25: 4}[version]
    samples = 384 if layer == 1 else 576 if layer == 3 and version != 1 else 1152
    padding, mode = b2 >> 1 & 1, b3 >> 6
    size = (12000 * kbits // rate + padding) * 4 if layer == 1 else samples // 8 * 1000 * kbits // rate + padding
    channels, checked = 1 if mode == 3 else 2, not b1 & 1
    information = (17 if channels == 1 else 32) if version == 1 else (9 if channels == 1 else 17)
    return Header(version, layer, checked, kbits, rate, channels, b3 >> 4 & 3, mode == 1, size, samples, 4 + 2 * checked + information)


def header_at(b: bytes, i: int, end: int) -> Header | None:
    """The header of a whole frame that stands at i; None if there is none."""
    if i + 4 > end or b[i] != 0xFF:
        return None
    h = header(b[i + 1] << 16 | b[i + 2] << 8 | b[i + 3])
    return h if h and i + h.size <= end else None


def _bits_of_layer_2(b: bytes, at: int, h: Header) -> int:
    """Checked bits of a Layer II frame's allocations and scale factor selections, which begin at `at`."""
    if h.version != 1:
        table = "lsf"
    elif h.kbits // h.channels <= 48:
        table = "d" if h.rate == 32000 else "c"
    else:
        table = "a" if h.rate == 48000 or h.kbits // h.channels <= 80 else "b"
    widths = [w for w, n in ALLOCATIONS[table] for _ in range(n)]
    bound = min(4 * (h.extension + 1), len(widths)) if h.joint else len(widths)
    value, read, selections = int.from_bytes(b[at:at + 64].ljust(64, b"\0"), "big"), 0, 0
    for k, width in enumerate(widths):
        for _ in range(h.channels if k < bound else 1):
            used = value >> (512 - read - width) & (1 << width) - 1
            read += width
            selections += (used > 0) * (1 if k < bound else h.channels)
    return read + 2 * selections


def checksum_holds(b: bytes, i: int, h: Header) -> bool:
    """Whether the checksum of a frame at i that has one is that of its header, and of its allocations or side information."""
    at = i + 6
    if h.layer == 3:
        bits = 8 * (h.side - 6)
    elif h.layer == 1:
        bits = 4 * (32 + min(4 * (h.extension + 1), 32) if h.joint else 32 * h.channels)
    else:
        bits = _bits_of_layer_2(b, at, h)
    crc = 0xFFFF
    for byte in b[i + 2:i + 4] + b[at:at + bits // 8]:
        crc = (crc << 8 & 0xFFFF) ^ int(CRC[crc >> 8 ^ byte])
    for k in range(bits % 8):
        bit = b[at + bits // 8] >> (7 - k) & 1 if at + bits // 8 < len(b) else 0
        crc = (crc << 1 & 0xFFFF) ^ (0x8005 if (crc >> 15) ^ bit else 0)
    return crc == b[i + 4] << 8 | b[i + 5]


def _plain(b: bytes) -> int:
    return int.from_bytes(b, "big")


def _safe(b: bytes) -> int:
    n = 0
    for c in b:
        n = n << 7 | c & 0x7F
    return n


def _text(b: bytes) -> str:
    return b[1:].decode(ENCODINGS.get(b[0], "latin-1"), "replace").strip("\0") if b else ""


def id3v2(b: bytes, i: int) -> tuple[int, dict[str, str]]:
    """(end, text fields) of a tag that begins at i; i itself if none does."""
    if b[i:i + 3] != b"ID3" or i + 10 > len(b) or b[i + 3] not in (2, 3, 4):
        return i, {}
    version, flags = b[i + 3], b[i + 5]
    end = min(len(b), i + 10 + _safe(b[i + 6:i + 10]))
    body, tags = b[i + 10:end], {}
    if flags & 0x80 and version < 4:
        body = body.replace(b"\xff\x00", b"\xff")
    at = 0
    if flags & 0x40 and version > 2:
        at = _safe(body[:4]) if version == 4 else 4 + _plain(body[:4])
    wide, size = (3, _plain) if version == 2 else (4, _safe if version == 4 else _plain)
    step = 6 if version == 2 else 10
    while at + step <= len(body) and body[at]:
        name, n = body[at:at + wide].decode("latin-1"), size(body[at + wide:at + 2 * wide])
        value = body[at + step:at + step + n]
        if version == 4 and body[at + 9] & 2:
            value = value.replace(b"\xff\x00", b"\xff")
        if version == 4 and body[at + 9] & 1:
            value = value[4:]
        if name in ("TXXX", "TXX"):
            key, _, value = _text(value).partition("\0")
            tags[f"{name}:{key}"] = value.lstrip("\ufeff")
        elif name[0] == "T":
            tags[name] = _text(value)
        at += step + n
    return end + 10 * bool(flags & 0x10 and version == 4), tags


def id3v1(b: bytes) -> dict[str, str]:
    """Fields of a tag in the last 128 bytes, none if there is no tag."""
    own = b[-128:]
    if len(own) < 128 or own[:3] != b"TAG":
        return {}
    fields = {f"ID3v1:{name}": own[a:z].split(b"\0")[0].decode("latin-1").rstrip() for name, a, z in ID3V1}
    if not own[125] and own[126]:
        fields["ID3v1:track"] = str(own[126])
    return {k: v for k, v in fields.items() if v}


def rate_table(b: bytes, i: int, h: Header) -> dict | None:
    """The Xing, Info or VBRI table in a frame at i: frames, bytes, seek table, encoder delay and padding in samples; None if it holds none."""
    at, end = i + h.side, i + h.size
    if h.layer == 3 and b[at:at + 4] in (b"Xing", b"Info"):
        flags, out, at = _plain(b[at + 4:at + 8]), {"kind": b[at:at + 4].decode(), "frames": None, "bytes": None, "toc": b""}, at + 8
        for bit, name, size in ((1, "frames", 4), (2, "bytes", 4), (4, "toc", 100), (8, "quality", 4)):
            if flags & bit:
                out[name] = b[at:at + size] if name == "toc" else _plain(b[at:at + size])
                at += size
        if at + 24 <= end and b[at:at + 4] in (b"LAME", b"Lavc", b"Lavf"):
            both = _plain(b[at + 21:at + 24])
            out |= {"delay": both >> 12, "padding": both & 0xFFF}
        return out
    at = i + 36
    if h.layer == 3 and b[at:at + 4] == b"VBRI":
        entries, scale, size, step = (_plain(b[at + k:at + k + 2]) for k in (18, 20, 22, 24))
        own = b[at + 26:at + 26 + entries * size]
        return {"kind": "VBRI", "frames": _plain(b[at + 14:at + 18]), "bytes": _plain(b[at + 10:at + 14]), "toc": own, "scale": scale, "entry_bytes": size, "entry_frames": step}
    return None


def frames(b: bytes, i: int, end: int) -> tuple[list[int], list[Header], int]:
    """Offsets and headers of the frames between i and end, and how many bytes were passed over."""
    offsets, heads, skipped, chain = [], [], 0, -1
    while i < end - 3:
        h = header_at(b, i, end)
        if h and i != chain:  # in doubt: the next header has to be of the same kind, or the stream ends here
            after = header_at(b, i + h.size, end)
            if i + h.size != end and not (after and (after.version, after.layer, after.rate) == (h.version, h.layer, h.rate)):
                h = None
        if h:
            offsets.append(i)
            heads.append(h)
            i = chain = i + h.size
        else:
            at = b.find(b"\xff", i + 1, end)
            at = end if at < 0 else at
            skipped += at - i
            i = at
    return offsets, heads, skipped + max(0, end - i)


def parse(media: bytes) -> dict:
    """Tags, the table of the bit rate, offsets of the audio frames, exact duration and the payload of a stream."""
    i, tags = 0, {}
    while True:
        end, own = id3v2(media, i)
        if end == i:
            break
        i, tags = end, tags | own
    last = id3v1(media)
    end = len(media) - 128 * bool(last)
    offsets, heads, skipped = frames(media, i, end)
    table = rate_table(media, offsets[0], heads[0]) if offsets else None
    first = int(table is not None)
    own = "TXXX:payload" in tags and all(h.layer == 3 and h.version == 1 and h.channels == 1 and h.checked for h in heads)
    if own and offsets:
        # streams of `encode`: all frames at once
        view = np.frombuffer(media, dtype=np.uint8)
        rows = view[np.minimum(np.array(offsets)[:, None] + np.arange(OVERHEAD), len(view) - 1)]
        good = crc16(np.concatenate([rows[:, 2:4], rows[:, 6:]], axis=1)) == rows[:, 4].astype(np.uint16) * 256 + rows[:, 5]
        bits = np.unpackbits(rows[:, 6:], axis=1)
        weights = 1 << np.arange(11, -1, -1)
        used = (bits[:, 18:30] @ weights + bits[:, 77:89] @ weights) // 8
        good &= used <= np.array([h.size for h in heads]) - OVERHEAD
        starts = [o + OVERHEAD for o in offsets]
        payload = b"".join(media[starts[k]:starts[k] + int(used[k])] for k in range(first, len(offsets)) if good[k])
        bad = int((~good).sum())
    else:
        payload, bad = b"", sum(not checksum_holds(media, o, h) for o, h in zip(offsets, heads, strict=True) if h.checked)
    samples = Counter()
    for h in heads[first:]:
        samples[h.rate] += h.samples
    cut = ((table or {}).get("delay", 0) + (table or {}).get("padding", 0)) if samples else 0
    rate = heads[0].rate if heads else RATES[RATE_INDEX]
    duration = sum(Fraction(n, r) for r, n in samples.items()) - Fraction(cut, rate)
    return {
        "tags": tags | last, "table": table, "offsets": offsets[first:], "payload": payload, "bad_crc": bad, "skipped": skipped,
        "samples": sum(samples.values()) - cut, "rate": rate, "duration_us": int(max(duration, 0) * 1_000_000),
        "layers": sorted({(h.version, h.layer, h.channels) for h in heads[first:]}),
    }


SCHEMA = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
    "media_sha256 string, feature string, frames int, duration_us long, seek_offsets array<long>, media binary"
)


def media_columns(docs: DataFrame, keep_media: bool = True) -> DataFrame:
    """One row per document: the stored stream, what is read back from it, duration and seek offsets (every frame)."""
    fields = SCHEMA if keep_media else SCHEMA.replace(", media binary", "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(fields)
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = b"" if not text.is_valid else text.as_buffer().to_pybytes()
                padded = raw + bytes((-len(raw)) % 64 or (64 if not raw else 0))
                media = encode(padded)
                got = parse(media)
                back = got["payload"]
                us, table = got["duration_us"], got["table"]
                digest = hashlib.sha256(media).hexdigest()
                feature = f"mp3:frames={len(got['offsets'])};us={us};rate={got['rate']};bad={got['bad_crc']};skipped={got['skipped']};vbr={table['frames']}/{table['bytes']}"
                rows.append((doc_id, len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), digest, feature, len(got["offsets"]), us, got["offsets"], media)[: len(schema)])
                size += len(media)
                if size > 8 << 20:
                    yield rows_to_batch(rows, schema)
                    rows, size = [], 0
            if rows:
                yield rows_to_batch(rows, schema)

    return texts(docs, "doc_id", "text").mapInArrow(run, fields)


def op8_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest columns with duration and frame offsets; the streams themselves stay out of the result."""
    return media_columns(read(spark, sf_dir, "documents"), keep_media=False)
