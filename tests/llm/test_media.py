import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from veritrail.llm import media
from veritrail.llm.base import table


def gif(width, height, frames, palette=None, version=b"GIF89a"):
    """A GIF of (left, top, w, h, samples, disposal, clear, delay, interlaced, own palette)."""
    palette = palette if palette is not None else media.GREY
    out = [version, np.array([width, height], "<u2").tobytes(), b"\xf7\0\0", palette.tobytes()]
    for left, top, w, h, samples, disposal, clear, delay, interlaced, own in frames:
        flags = (disposal << 2) | (clear is not None)
        out += [b"\x21\xf9\x04", bytes([flags]), np.array([delay], "<u2").tobytes(), bytes([clear or 0]), b"\0"]
        out += [b"\x21\xfe\x03abc\0", b"\x2c", np.array([left, top, w, h], "<u2").tobytes(), bytes([(0x87 if own is not None else 0) | (0x40 if interlaced else 0)])]
        if own is not None:
            out.append(own.tobytes())
        out += [b"\x08", media.blocked(media.packed(media.codes(bytes(samples))))]
    return b"".join([*out, b"\x3b"])


def table_decode(runs, base):
    """The textbook decoder."""
    out = bytearray()
    for run in runs:
        entries = [bytes([i]) for i in range(1 << base)] + [b"", b""]
        before = b""
        for c in run:
            entry = entries[c] if c < len(entries) else before + before[:1]
            out += entry
            if before and len(entries) < 4096:
                entries.append(before + entry[:1])
            before = entry
    return bytes(out)


@settings(max_examples=80, deadline=None)
@given(st.binary(min_size=1, max_size=3000))
def test_streams(data):
    runs = media.unpacked(media.packed(media.codes(data)), 8)
    assert media.expanded(runs, 8).tobytes() == data == table_decode([r.tolist() for r in runs], 8)


@pytest.mark.parametrize("data", [b"a" * 100_000, bytes(range(256)) * 300, np.random.default_rng(1).bytes(80_000), b"ab" * 30_000])
def test_long_streams(data):
    assert media.expanded(media.unpacked(media.packed(media.codes(data)), 8), 8).tobytes() == data


def test_code_before_its_entry():
    with pytest.raises(ValueError, match="before its entry"):
        media.expanded([np.array([65, 300])], 8)


@pytest.mark.parametrize("text", [b"", b"a", b"x" * 64, b"y" * 65, b"long " * 60_000])
def test_payload_round_trip(text):
    payload = media.padded(text)
    assert len(payload) % 64 == 0 and payload and payload.startswith(text)
    assert b"".join(f.samples.tobytes() for f in media.read(media.written(payload))) == payload


def test_disposal_transparency_and_delays():
    full = (0, 0, 2, 2, [10, 20, 30, 40], 1, None, 7, False, None)
    frames = list(media.read(gif(2, 2, [full, (0, 0, 1, 2, [5, 6], 3, 6, 2, False, None), (1, 1, 1, 1, [9], 2, None, 0, False, None), (0, 0, 1, 1, [8], 0, None, 0, False, None)])))
    shown = [f.canvas[..., 0].tolist() for f in frames]
    assert shown == [[[10, 20], [30, 40]], [[5, 20], [30, 40]], [[10, 20], [30, 9]], [[8, 20], [30, 0]]]
    assert [f.delay_ms for f in frames] == [70, 20, 0, 0]
    assert not frames[3].painted[1, 1] and frames[2].painted.all()


def test_local_palette_interlace_and_clipping():
    own = np.zeros((256, 3), np.uint8)
    own[1] = [200, 100, 50]
    rows = np.arange(10, dtype=np.uint8)
    order = [*range(0, 10, 8), *range(4, 10, 8), *range(2, 10, 4), *range(1, 10, 2)]
    a, b = media.read(gif(4, 10, [(0, 0, 1, 10, rows[order], 1, None, 0, True, None), (3, 9, 5, 5, [1] * 25, 1, None, 0, False, own)]))
    assert a.canvas[:, 0, 0].tolist() == rows.tolist()
    assert b.canvas[9, 3].tolist() == [200, 100, 50] and b.samples.shape == (5, 5)
    assert media.histogram(b).sum() == b.painted.sum() == 11


@pytest.mark.parametrize("data", [b"", b"GIF", b"not a gif at all....", media.written(bytes(64))[:-30], b"GIF89a" + b"\0" * 7 + b"\x99"])
def test_broken(data):
    with pytest.raises(ValueError):
        list(media.read(data))


def test_query(spark, odd):
    docs = table(spark, odd[0], "documents").select("doc_id", "text").collect()
    rows = media.op5_gif_media(spark, odd[0]).collect()
    assert len(rows) == len(docs)
    want = sorted((str(d["doc_id"]), len((d["text"] or "").encode()), hashlib.sha256(p := media.padded((d["text"] or "").encode())).hexdigest(), zlib.crc32(p[-64:]), len(p)) for d in docs)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["payload_sha256"], r["tail_crc32"], r["payload_bytes"]) for r in rows) == want
    assert len({(r["media_sha256"], r["feature"]) for r in rows if r["doc_id"] in (6, 7)}) == 1
    assert media.op5_gif_media(spark, odd[1]).count() == 0


def test_frame_rows(spark):
    df = spark.createDataFrame([(1, bytearray(media.written(bytes(64 * 1500)))), (2, None), (3, bytearray(b"bad"))], "doc_id long, media binary")
    rows = sorted(media.frames(df).collect(), key=lambda r: r["frame"])
    assert [(r["doc_id"], r["frame"], r["delay_ms"], r["width"], r["height"]) for r in rows] == [(1, 0, 100, 64, 1024), (1, 1, 100, 64, 1024)]
    assert sum(rows[0]["histogram"]) == 64 * 1024 and len(rows[0]["rgb"]) == 64 * 1024 * 3
