"""Streams made by hand, bit by bit, of all versions, layers and channels, with known durations."""

import struct

import pytest

from docfacts.llm import audio


def bit_crc(bits: str) -> int:
    """CRC-16 of a string of bits, one bit at a time."""
    crc = 0xFFFF
    for b in bits:
        top = crc >> 15 ^ int(b)
        crc = crc << 1 & 0xFFFF
        if top:
            crc ^= 0x8005
    return crc


VERSION, LAYER = {1: 3, 2: 2, 25: 0}, {1: 3, 2: 2, 3: 1}


def frame(version, layer, index, rate, mode, checked=False, padding=0, extension=0, body=b"", fill=0):
    head = bytes([0xFF, 0xE0 | VERSION[version] << 3 | LAYER[layer] << 1 | (not checked), index << 4 | rate << 2 | padding << 1, mode << 6 | extension << 4])
    h = audio.header(int.from_bytes(head[1:], "big"))
    out = bytearray(head + bytes(2 * bool(checked)) + body)
    out += bytes([fill]) * (h.size - len(out))
    if checked:
        channels = 1 if mode == 3 else 2
        if layer == 3:
            n = 8 * ((17 if channels == 1 else 32) if version == 1 else (9 if channels == 1 else 17))
        elif layer == 1:
            n = 4 * (32 + 4 * (extension + 1)) if mode == 1 else 128 * channels
        else:
            n = checked  # the caller says how many bits are checked
        bits = "".join(f"{b:08b}" for b in out[2:4]) + "".join(f"{b:08b}" for b in out[6:])[:n]
        out[4:6] = struct.pack(">H", bit_crc(bits))
    return bytes(out), h


@pytest.mark.parametrize("version, layer, index, rate, size, samples, hertz", [
    (1, 1, 12, 0, 416, 384, 44100), (1, 2, 10, 1, 576, 1152, 48000), (1, 3, 9, 0, 417, 1152, 44100), (1, 3, 14, 2, 1440, 1152, 32000),
    (2, 1, 8, 0, 276, 384, 22050), (2, 2, 8, 0, 417, 1152, 22050), (2, 3, 8, 0, 208, 576, 22050), (25, 3, 8, 2, 576, 576, 8000),
])
@pytest.mark.parametrize("mode", [0, 1, 3])
@pytest.mark.parametrize("checked", [False, True])
def test_all_kinds_of_frames(version, layer, index, rate, size, samples, hertz, mode, checked):
    if layer == 2:
        # nothing is allocated: allocation bits alone, of all subbands and channels
        h = frame(version, layer, index, rate, mode)[1]
        runs = audio.ALLOCATIONS["lsf" if version != 1 else "a" if h.rate == 48000 or h.kbits // h.channels <= 80 else "b"]
        widths = [w for w, n in runs for _ in range(n)]
        checked = checked and sum(w * (h.channels if mode != 1 or k < 4 else 1) for k, w in enumerate(widths))
    one, h = frame(version, layer, index, rate, mode, checked)
    assert (len(one), h.samples, h.rate) == (size, samples, hertz)
    got = audio.parse(one * 20)
    assert (len(got["offsets"]), got["bad_crc"], got["skipped"]) == (20, 0, 0)
    assert got["offsets"] == [size * k for k in range(20)] and got["duration_us"] == 20 * samples * 1_000_000 // hertz
    if checked:
        broken = bytearray(one * 20)
        broken[3 * size + 7] ^= 0x80
        got = audio.parse(bytes(broken))
        assert got["bad_crc"] == 1 and len(got["offsets"]) == 20  # its time stays


def test_layer_2_selections_are_checked():
    """One allocated subband in each of two channels: 2 more bits each."""
    body = bytes([0b0001_0001]) + bytes(60)
    widths = [w for w, n in audio.ALLOCATIONS["a"] for _ in range(n)]
    one, h = frame(1, 2, 10, 1, 0, checked=2 * sum(widths) + 4, body=body)
    assert h.channels == 2 and audio.parse(one * 3)["bad_crc"] == 0


def test_padding_and_changing_bit_rates():
    parts = [frame(1, 3, 9, 0, 0, padding=k % 2)[0] for k in range(10)] + [frame(1, 3, 5, 0, 0)[0] for _ in range(7)]
    got = audio.parse(b"".join(parts))
    assert len(got["offsets"]) == 17 and got["samples"] == 17 * 1152 and got["offsets"][2] == 417 + 418


def table_frame(tag, body, mode=0, version=1):
    at = {(1, 0): 36, (1, 3): 21, (2, 0): 21, (2, 3): 13}[version, mode]
    own = bytes(at - 4) + tag + body
    return frame(version, 3, 9, 0, mode, body=own)[0]


@pytest.mark.parametrize("mode, version", [(0, 1), (3, 1), (0, 2), (3, 2)])
@pytest.mark.parametrize("tag", [b"Xing", b"Info"])
def test_tables_of_frames(mode, version, tag):
    audio_frames = [frame(version, 3, 6, 0, mode)[0] for _ in range(30)]
    body = struct.pack(">III", 7, 30, 9999) + bytes(range(100))
    lame = b"LAME3.100" + bytes(12) + (576 << 12 | 1000).to_bytes(3, "big")
    got = audio.parse(table_frame(tag, body + lame, mode, version) + b"".join(audio_frames))
    assert (got["table"]["frames"], got["table"]["bytes"], got["table"]["kind"], got["table"]["toc"][5]) == (30, 9999, tag.decode(), 5)
    samples, rate = (1152, 44100) if version == 1 else (576, 22050)
    assert got["samples"] == 30 * samples - 1576 and got["duration_us"] == (30 * samples - 1576) * 1_000_000 // rate and len(got["offsets"]) == 30
    plain = audio.parse(table_frame(tag, struct.pack(">II", 1, 30), mode, version) + b"".join(audio_frames))
    assert plain["table"]["bytes"] is None and plain["samples"] == 30 * samples


def test_vbri_table():
    body = struct.pack(">HHHIIHHHH", 1, 0, 80, 4000, 12, 3, 1, 2, 4) + struct.pack(">HHH", 100, 200, 300)
    got = audio.parse(table_frame(b"VBRI", body) + frame(1, 3, 6, 0, 0)[0] * 12)
    assert (got["table"]["kind"], got["table"]["frames"], got["table"]["bytes"], got["table"]["entry_frames"], len(got["table"]["toc"])) == ("VBRI", 12, 4000, 4, 6)
    assert got["samples"] == 12 * 1152


def safe(n):
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def test_tags():
    stream = frame(1, 3, 9, 0, 0)[0] * 4
    v3 = b"TIT2" + struct.pack(">IH", 6, 0) + b"\0Title" + b"TXXX" + struct.pack(">IH", 9, 0) + b"\x03key\0word" + b"APIC" + struct.pack(">IH", 3, 0) + b"\xff\x00\xfb"
    unsynchronised = v3.replace(b"\xff\x00", b"\xff\x00\x00")
    v4 = b"TPE1" + safe(9) + b"\0\0" + b"\x01" + "Nïx".encode("utf-16")[:8] + bytes(0)
    extended = safe(6) + b"\1\0"
    v2 = b"TT2" + (5).to_bytes(3, "big") + b"\0Song"
    cases = [
        (b"ID3\3\0\0" + safe(len(v3)) + v3, {"TIT2": "Title", "TXXX:key": "word"}),
        (b"ID3\3\0\x80" + safe(len(unsynchronised)) + unsynchronised, {"TIT2": "Title", "TXXX:key": "word"}),
        (b"ID3\4\0\x50" + safe(len(extended + v4)) + extended + v4 + b"3DI\4\0\x50" + safe(len(v4)), {"TPE1": "Nïx"}),
        (b"ID3\2\0\0" + safe(len(v2)) + v2, {"TT2": "Song"}),
    ]
    for tag, want in cases:
        got = audio.parse(tag + stream)
        assert got["tags"] == want and got["offsets"][0] == len(tag) and got["skipped"] == 0 and len(got["offsets"]) == 4
    both = audio.parse(cases[3][0] + cases[0][0] + stream)
    assert both["tags"] == {"TT2": "Song", "TIT2": "Title", "TXXX:key": "word"}
    last = b"TAG" + b"Old title".ljust(30, b"\0") + b"Someone".ljust(30) + bytes(30) + b"1999" + bytes(28) + b"\0\x07" + b"\x11"
    got = audio.parse(stream + last)
    assert got["tags"] == {"ID3v1:title": "Old title", "ID3v1:artist": "Someone", "ID3v1:year": "1999", "ID3v1:track": "7"} and len(got["offsets"]) == 4 and got["skipped"] == 0


def test_resynchronisation():
    one, other = frame(1, 3, 9, 0, 0)[0], frame(1, 1, 9, 1, 0)[0]
    lone = frame(2, 3, 9, 0, 0)[0][:30]  # a header that nothing confirms
    got = audio.parse(b"\xff\xfb\x00junk" + one * 3 + b"\xff\xff\xff" + lone + one * 2)
    assert len(got["offsets"]) == 5 and got["skipped"] == 7 + 3 + 30
    assert audio.parse(one * 3 + one[:200])["skipped"] == 200  # a torn last frame
    assert len(audio.parse(other * 5)["offsets"]) == 5
    for junk in (b"", b"\xff", b"\xff" * 5000, bytes(5000), b"ID3", b"ID3\4\0\0\x7f\x7f\x7f\x7f", b"TAG" + bytes(125)):
        got = audio.parse(junk)
        assert got["offsets"] == [] and got["duration_us"] == 0 and got["payload"] == b""
