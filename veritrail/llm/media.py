"""Media columns: GIF, written and read.

A payload of bytes is stored as the 8-bit samples of a grey GIF, WIDTH samples a row, at most ROWS rows a frame, each frame
one LZW stream. The reader takes any GIF: global and local palettes, interlace, transparency, the disposal rules and delays.

LZW streams are read without a table. A code of the table stands for the output of the code that made its entry and one
byte more, so every output byte is a literal or a copy of an earlier one; the copies are resolved by pointer doubling over whole arrays.

Defined cases: a null text is an empty one, stored as one row of zeros; equal texts give equal values; bytes that are no GIF raise ValueError in
`read` and become no frames in `frames`; repeated rows are stored each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import stored

WIDTH, ROWS, DELAY = 64, 1024, 10
CLEAR, END, FIRST, MOST = 256, 257, 258, 4096
GREY = np.repeat(np.arange(256, dtype=np.uint8), 3).reshape(256, 3)
#: Levels of a channel in the histogram.
LEVELS = 4


def widths(base: int, n: int) -> np.ndarray:
    """Bits of the codes after a clear code."""
    after = (1 << base) + 2 + np.maximum(0, np.arange(n) - 1)
    return np.clip(np.floor(np.log2(after)).astype(np.int64) + 1, base + 1, 12)


_WIDTHS = {b: widths(b, MOST + 8) for b in range(2, 9)}
_STARTS = {b: np.concatenate(([0], np.cumsum(w))) for b, w in _WIDTHS.items()}


def codes(data: bytes) -> list[list[int]]:
    """The codes of the bytes by greedy LZW, in runs that each end with a clear code or the end code."""
    runs, out, table, following = [], [], {}, FIRST
    add, find = out.append, table.get
    it = iter(data)
    w = next(it)
    for b in it:
        key = w << 8 | b
        found = find(key)
        if found is not None:
            w = found
        else:
            add(w)
            w = b
            if following < MOST:
                table[key] = following
                following += 1
            else:
                add(CLEAR)
                runs.append(out)
                out, table, following = [], {}, FIRST
                add, find = out.append, table.get
    add(w)
    add(END)
    runs.append(out)
    return runs


def packed(runs: list[list[int]]) -> bytes:
    """The codes as bits, the lowest first, after a clear code."""
    values = np.array([CLEAR] + [c for r in runs for c in r], np.uint64)
    bits = np.concatenate([[9]] + [_WIDTHS[8][: len(r)] for r in runs])
    at = np.cumsum(bits) - bits
    out = np.zeros((int(at[-1] + bits[-1]) + 7) // 8 + 3, np.uint8)
    shifted = values << (at % 8).astype(np.uint64)
    for k in range(3):
        part = ((shifted >> np.uint64(8 * k)) & np.uint64(255)).astype(np.uint8)
        # several codes meet in a byte; each sets other bits of it
        byte = at // 8 + k
        first = np.concatenate(([0], np.nonzero(np.diff(byte))[0] + 1))
        out[byte[first]] |= np.bitwise_or.reduceat(part, first)
    return out[: (int(at[-1] + bits[-1]) + 7) // 8].tobytes()


def blocked(data: bytes) -> bytes:
    """The data in sub-blocks of up to 255 bytes, with the empty one at the end."""
    return b"".join(bytes([len(p)]) + p for p in (data[k : k + 255] for k in range(0, len(data), 255))) + b"\0"


def written(payload: bytes) -> bytes:
    """A GIF of the payload, whose length is a positive multiple of WIDTH."""
    rows = len(payload) // WIDTH
    height = min(rows, ROWS)
    out = [b"GIF89a", np.array([WIDTH, height], "<u2").tobytes(), b"\xf7\0\0", GREY.tobytes()]
    for top in range(0, rows, ROWS):
        n = min(ROWS, rows - top)
        data = payload[top * WIDTH : (top + n) * WIDTH]
        out += [b"\x21\xf9\x04\x08", np.array([DELAY], "<u2").tobytes(), b"\0\0", b"\x2c", np.array([0, 0, WIDTH, n], "<u2").tobytes(), b"\0\x08", blocked(packed(codes(data)))]
    return b"".join([*out, b"\x3b"])


def unpacked(data: bytes, base: int) -> list[np.ndarray]:
    """The codes of an LZW stream, in runs between clear codes, without clear and end codes."""
    clear, buffer, total = 1 << base, np.frombuffer(data + bytes(4), np.uint8).astype(np.uint32), 8 * len(data)
    bit, runs, starts, bits = 0, [], _STARTS[base], _WIDTHS[base]
    while bit + base + 1 <= total:
        n = int(np.searchsorted(starts, total - bit, "right")) - 1
        n = min(n, MOST + 7)
        if n <= 0:
            break
        at = bit + starts[:n]
        byte = at >> 3
        window = buffer[byte] | buffer[byte + 1] << 8 | buffer[byte + 2] << 16
        found = (window >> (at & 7).astype(np.uint32)) & ((1 << bits[:n]) - 1).astype(np.uint32)
        stop = np.nonzero((found == clear) | (found == clear + 1))[0]
        if len(stop):
            k = int(stop[0])
            runs.append(found[:k])
            bit += int(starts[k + 1])
            if found[k] == clear + 1:
                break
        else:
            runs.append(found)  # a full table without a clear code, or the stream's end
            bit += int(starts[n])
            if n == MOST + 7:
                more = []
                while bit + 12 <= total:  # codes of 12 bits until a clear code comes
                    window = int(buffer[bit >> 3]) | int(buffer[(bit >> 3) + 1]) << 8 | int(buffer[(bit >> 3) + 2]) << 16
                    code, bit = (window >> (bit & 7)) & 0xFFF, bit + 12
                    if code in (clear, clear + 1):
                        break
                    more.append(code)
                runs[-1] = np.concatenate((found, np.array(more, np.uint32)))
                if more and code == clear + 1:
                    break
    return [r for r in runs if len(r)]


def expanded(runs: list[np.ndarray], base: int) -> np.ndarray:
    """The samples that the codes stand for."""
    if not runs:
        return np.zeros(0, np.uint8)
    code = np.concatenate(runs).astype(np.int64)
    first = (1 << base) + 2
    begin = np.repeat(np.cumsum([0, *map(len, runs[:-1])]), list(map(len, runs)))
    copy = code >= first
    maker = np.where(copy, begin + code - first, np.arange(len(code)))  # the code whose output the entry repeats
    if (maker[copy] >= np.nonzero(copy)[0]).any() or (code[~copy] >= first - 2).any():
        raise ValueError("a code before its entry")
    length, up = copy.astype(np.int64), maker
    while True:  # length: steps to the literal at the root
        more = length[up]
        if not more.any():
            break
        length, up = length + more, up[up]
    length += 1
    at = np.cumsum(length) - length
    total = int(at[-1] + length[-1])
    source = np.arange(total)
    value = np.zeros(total, np.uint8)
    value[at[~copy]] = code[~copy]
    source += np.repeat(np.where(copy, at[maker] - at, 0), length)
    while True:
        new = source[source]
        if (new == source).all():
            break
        source = new
    return value[source]


class Frame(NamedTuple):
    """A frame as stored, and the canvas as shown: colours, and which pixels are painted."""

    samples: np.ndarray
    delay_ms: int
    canvas: np.ndarray
    painted: np.ndarray


def read(gif: bytes) -> Iterator[Frame]:
    """The frames of a GIF in their order."""
    try:
        yield from _read(gif)
    except (IndexError, _Short) as e:
        raise ValueError("not a whole GIF") from e


class _Short(Exception):
    """The bytes end too early."""


def _read(gif: bytes) -> Iterator[Frame]:
    if gif[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")

    def palette(place: int, flags: int) -> tuple[np.ndarray | None, int]:
        if not flags & 0x80:
            return None, place
        n = 3 << ((flags & 7) + 1)
        if place + n > len(gif):
            raise _Short
        colours = np.zeros((256, 3), np.uint8)
        colours[: n // 3] = np.frombuffer(gif, np.uint8, n, place).reshape(-1, 3)
        return colours, place + n

    def number(place: int) -> int:
        return gif[place] | gif[place + 1] << 8

    def blocks(place: int) -> tuple[bytes, int]:
        out = []
        while n := gif[place]:
            out.append(gif[place + 1 : place + 1 + n])
            place += 1 + n
        return b"".join(out), place + 1

    width, height = number(6), number(8)
    shared, place = palette(13, gif[10])
    canvas, painted = np.zeros((height, width, 3), np.uint8), np.zeros((height, width), bool)
    delay, disposal, clear = 0, 0, None
    while gif[place] != 0x3B:
        kind = gif[place]
        if kind == 0x21:
            label = gif[place + 1]
            body, place = blocks(place + 2)
            if label == 0xF9 and len(body) >= 4:
                disposal, delay, clear = body[0] >> 2 & 7, 10 * (body[1] | body[2] << 8), body[3] if body[0] & 1 else None
            continue
        if kind != 0x2C:
            raise ValueError("an unknown block")
        left, top, w, h, flags = number(place + 1), number(place + 3), number(place + 5), number(place + 7), gif[place + 9]
        own, place = palette(place + 10, flags)
        base = gif[place]
        if not 2 <= base <= 8:
            raise ValueError("a code size that no GIF has")
        body, place = blocks(place + 1)
        samples = expanded(unpacked(body, base), base)
        if len(samples) < w * h:
            raise ValueError("too few samples")
        samples = samples[: w * h].reshape(h, w)
        if flags & 0x40:
            order = np.concatenate([np.arange(a, h, s) for a, s in ((0, 8), (4, 8), (2, 4), (1, 2))])
            straight = np.empty_like(samples)
            straight[order] = samples
            samples = straight
        before = (canvas.copy(), painted.copy()) if disposal == 3 else None
        bottom, right = min(top + h, height), min(left + w, width)
        part = samples[: max(0, bottom - top), : max(0, right - left)]
        colours = (own if own is not None else shared if shared is not None else GREY)[part]
        if clear is None:
            canvas[top:bottom, left:right], painted[top:bottom, left:right] = colours, True
        else:
            seen = part != clear
            canvas[top:bottom, left:right][seen], painted[top:bottom, left:right][seen] = colours[seen], True
        yield Frame(samples, delay, canvas.copy(), painted.copy())
        if disposal == 2:
            canvas[top:bottom, left:right], painted[top:bottom, left:right] = 0, False
        elif before:
            canvas, painted = before
        delay, disposal, clear = 0, 0, None


def histogram(frame: Frame) -> np.ndarray:
    """Painted pixels by colour, LEVELS levels a channel."""
    shift = 8 - (LEVELS - 1).bit_length()
    level = frame.canvas[frame.painted] >> shift
    return np.bincount((level[:, 0] * LEVELS + level[:, 1]) * LEVELS + level[:, 2], minlength=LEVELS**3)


def padded(text: bytes) -> bytes:
    return text + bytes(-len(text) % WIDTH if text else WIDTH)


def store(docs: DataFrame) -> DataFrame:
    """Writes (doc_id, n_bytes, media) of every text into the shared folder; returns what was written."""

    @F.pandas_udf("n_bytes long, media binary")
    def write(texts: pd.Series) -> pd.DataFrame:
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        return pd.DataFrame({"n_bytes": [len(r) for r in raw], "media": [written(padded(r)) for r in raw]})

    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), write(F.col("text")).alias("m")).select("doc_id", "m.*"), "media")


def frames(media: DataFrame) -> DataFrame:
    """(doc_id, frame, delay_ms, width, height, histogram, rgb): a row for each frame of the GIFs in column media, as shown.

    Null media and bytes that are no GIF give no row."""

    def show(batches):
        for b in batches:
            for doc, gif in zip(b.column("doc_id").to_pylist(), b.column("media").to_pylist(), strict=True):
                try:
                    found = list(read(gif)) if gif is not None else []
                except ValueError:
                    found = []
                for k, f in enumerate(found):
                    h, w = f.painted.shape
                    yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([k], pa.int32()), pa.array([f.delay_ms], pa.int32()), pa.array([w], pa.int32()), pa.array([h], pa.int32()), pa.array([histogram(f).tolist()], pa.list_(pa.int64())), pa.array([f.canvas.tobytes()], pa.binary())], names=["doc_id", "frame", "delay_ms", "width", "height", "histogram", "rgb"])

    return media.select("doc_id", "media").mapInArrow(show, "doc_id long, frame int, delay_ms int, width int, height int, histogram array<long>, rgb binary")


def features(media: DataFrame) -> DataFrame:
    """What the stored bytes say: payload and media digests, and a feature string of frames, time and colours."""
    kinds = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    @F.pandas_udf(kinds)
    def of(gifs: pd.Series) -> pd.DataFrame:
        out = []
        for gif in gifs:
            shown, counts, time, n = [], np.zeros(LEVELS**3, np.int64), 0, 0
            for f in read(gif):
                shown.append(f.samples.tobytes())
                counts += histogram(f)
                time, n = time + f.delay_ms, n + 1
            payload = b"".join(shown)
            colours = ",".join(f"{i}:{counts[i]}" for i in np.nonzero(counts)[0])
            out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(gif), hashlib.sha256(gif).hexdigest(), f"frames={n};ms={time};colours={colours}"))
        return pd.DataFrame(out, columns=[k.split()[0] for k in kinds.split(", ")])

    return media.select("doc_id", "n_bytes", of(F.col("media")).alias("f")).select("doc_id", "n_bytes", "f.*")


def op5_gif_media(spark, sf_dir: str) -> DataFrame:
    from .base import table

    return features(store(table(spark, sf_dir, "documents")))
