"""Media columns: GIF images with timed frames, written and read in Python.

``encode`` makes an animation of 8-bit samples, ``decode`` reads any GIF87a or GIF89a stream: global and local palettes, LZW code streams of 2 to 8 bits, interlaced rows, delays,
disposal methods 0 to 3 and transparent indexes. Each frame comes as the whole screen in RGB, as a viewer shows it, with its delay. ``table`` stores a column of
byte strings so; ``frames`` turns a column of GIF streams into a row per frame with its time and colour histogram.

Defined results: a null or empty text is a payload of no bytes and, like every payload, is padded with byte 255 to a positive multiple of 576. Equal payloads
make equal streams. Long texts make many frames; each is coded on its own. A stream that breaks off gives the frames that are whole; one without a GIF header gives
none. Repeated rows give equal results, an empty table an empty one. Only the named columns are read, so further columns never clash.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Payloads are padded to a multiple of UNIT bytes; a frame of stored bytes is SIDE wide and up to ROWS high.
SIDE, ROWS = 24, 384
UNIT = SIDE * SIDE
_GREY = bytes(x for i in range(256) for x in (i, i, i))


class Frame(NamedTuple):
    delay: int  # hundredths of a second
    pixels: np.ndarray  # the whole screen, height x width x 3
    box: tuple[int, int, int, int]  # the part that the frame's image covers: x, y, width, height


@cache
def schedule(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The width of code number k after a clear code (itself not counted), and the bits in front of it. Before it is read the table has (1 << bits) + 1 + k entries."""
    k = np.arange(1 << 14)
    width = np.clip(np.floor(np.log2((1 << bits) + 1 + k)).astype(np.int64) + 1, bits + 1, 12)
    width[0] = bits + 1
    return width, np.r_[0, np.cumsum(width)]


@cache
def frozen() -> tuple[np.ndarray, np.ndarray]:
    """As ``schedule``, for codes behind a full table."""
    return np.full(1 << 14, 12), 12 * np.arange((1 << 14) + 1)


def packed(runs: list[list[int]], bits: int) -> bytes:
    """Runs of codes, each of which ends with a clear code or the end code, as a bit stream, low bits first. A clear code goes before them."""
    parts = [((1 << bits) >> np.arange(bits + 1)) & 1]
    widths, _ = schedule(bits)
    for codes in runs:
        c, w = np.array(codes), widths[: len(codes)]
        for n in range(bits + 1, int(w[-1]) + 1):
            parts.append(((c[w == n, None] >> np.arange(n)) & 1).ravel())
    return np.packbits(np.concatenate(parts).astype(np.uint8), bitorder="little").tobytes()


def lzw_encode(samples: bytes, bits: int = 8) -> bytes:
    clear = 1 << bits
    runs, codes, table, free = [], [], {}, clear + 2
    it = iter(samples)
    prefix = next(it, None)
    if prefix is None:
        return packed([[clear + 1]], bits)
    get, put = table.get, codes.append
    for c in it:
        key = prefix << 8 | c
        code = get(key)
        if code is None:
            put(prefix)
            if free < 4096:
                table[key] = free
                free += 1
            else:
                put(clear)
                runs.append(codes)
                codes, free = [], clear + 2
                put = codes.append
                table.clear()
            prefix = c
        else:
            prefix = code
    codes += [prefix, clear + 1]
    return packed([*runs, codes], bits)


def lzw_decode(stream: bytes, bits: int, want: int) -> bytes:
    """The samples of a code stream, ``want`` at most; of a broken stream as many as can be read. Codes up to the next clear code are unpacked at once, those of a table
    that stays full in blocks. An entry is the output of the code that made it and the sample after that, so a code is a copy of output that is there already."""
    clear, end, base = 1 << bits, (1 << bits) + 1, (1 << bits) + 2
    if not 1 < bits < 9:
        return b""
    raw = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.uint32)
    out, at, total, full = bytearray(), 0, 8 * len(stream), False
    start: list[int] = []
    while len(out) < want:
        widths, ahead = frozen() if full else schedule(bits)
        n = min(int(np.searchsorted(ahead, total - at, "right")) - 1, want - len(out) + 2, len(widths))
        if n <= 0:
            break
        o = at + ahead[:n]
        i = o >> 3
        codes = (raw[i] | raw[i + 1] << 8 | raw[i + 2] << 16) >> (o & 7).astype(np.uint32) & ((1 << widths[:n]) - 1).astype(np.uint32)
        stop = np.flatnonzero((codes == clear) | (codes == end))
        last = int(stop[0]) if len(stop) else n
        pos = len(out)
        if full:
            del start[4097:]  # a full table has no entries behind these
        else:
            start = [pos]  # where each code's output begins, and at last where the next one's will
        add, put = start.append, out.append
        for c in codes[:last].tolist():
            if c < clear:
                put(c)
                pos += 1
            else:
                c -= base
                if c >= len(start) - 1:
                    return bytes(out[:want])
                a, b = start[c], start[c + 1]
                if b < pos:
                    out += out[a : b + 1]
                else:  # the entry that this very code completes
                    out += out[a:b]
                    put(out[a])
                pos += b + 1 - a
            add(pos)
        full = last == n == len(widths)  # no clear code for very long: the table is full, it and the width stay
        if not full and (last == n or codes[last] == end):
            break
        at += int(ahead[n if full else last + 1])
    return bytes(out[:want])


def blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


def encode(frames: list[bytes], width: int, height: int, delay: int = 10) -> bytes:
    """An animation of frames of 8-bit grey samples, each coded losslessly; frames replace each other and loop. A frame of fewer rows than ``height`` covers the screen's top."""
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF7, 0, 0), _GREY, b"\x21\xff\x0bNETSCAPE2.0\x03\x01\x00\x00\x00"]
    control = b"\x21\xf9\x04\x04" + struct.pack("<H", delay) + b"\0\0"
    for f in frames:
        out += [control, b"\x2c" + struct.pack("<HHHHB", 0, 0, width, len(f) // width, 0) + b"\x08", blocks(lzw_encode(f))]
    return b"".join(out) + b"\x3b"


def unblocked(data: bytes, at: int) -> tuple[bytes, int]:
    out = []
    while at < len(data) and data[at]:
        out.append(data[at + 1 : at + 1 + data[at]])
        at += 1 + data[at]
    return (out[0] if len(out) == 1 else b"".join(out)), at + 1


def palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray | None, int]:
    if not flags & 0x80:
        return None, at
    n = 2 << (flags & 7)
    got = np.zeros((256, 3), np.uint8)
    raw = np.frombuffer(data[at : at + 3 * n], np.uint8)
    got[: len(raw) // 3] = raw[: len(raw) // 3 * 3].reshape(-1, 3)
    return got, at + 3 * n


def rows_of(height: int, interlaced: bool) -> np.ndarray:
    return np.concatenate([np.arange(a, height, s) for a, s in ((0, 8), (4, 8), (2, 4), (1, 2))]) if interlaced else np.arange(height)


def decode(data: bytes) -> Iterator[Frame]:
    """The screens that a viewer shows, one after the other."""
    if len(data) < 13 or data[:6] not in (b"GIF87a", b"GIF89a"):
        return
    w, h, flags = struct.unpack_from("<HHB", data, 6)
    common, at = palette(data, 13, flags)
    screen = np.zeros((h, w, 3), np.uint8)
    delay, clear_index, disposal = 0, -1, 0
    while at < len(data):
        kind = data[at]
        if kind == 0x3B:
            return
        if kind == 0x21 and at + 2 < len(data):
            body, after = unblocked(data, at + 2)
            if data[at + 1] == 0xF9 and len(body) >= 4:
                delay, disposal = body[1] | body[2] << 8, body[0] >> 2 & 7
                clear_index = body[3] if body[0] & 1 else -1
            at = after
        elif kind == 0x2C and at + 10 < len(data):
            x, y, fw, fh, flags = struct.unpack_from("<HHHHB", data, at + 1)
            own, at = palette(data, at + 10, flags)
            if at >= len(data):
                return
            bits = data[at]
            stream, at = unblocked(data, at + 1)
            samples = lzw_decode(stream, bits, fw * fh)
            if len(samples) < fw * fh:
                return
            index = np.empty((fh, fw), np.uint8)
            index[rows_of(fh, bool(flags & 0x40))] = np.frombuffer(samples, np.uint8).reshape(fh, fw)
            before = screen.copy() if disposal == 3 else None
            part = screen[y : y + fh, x : x + fw]
            index = index[: part.shape[0], : part.shape[1]]
            colours = (own if own is not None else common if common is not None else np.zeros((256, 3), np.uint8))[index]
            if clear_index >= 0:
                part[index != clear_index] = colours[index != clear_index]
            else:
                part[:] = colours
            yield Frame(delay, screen.copy(), (x, y, fw, fh))
            if disposal == 2:
                part[:] = 0
            elif before is not None:
                screen = before
            delay, clear_index, disposal = 0, -1, 0
        else:
            return


def histogram(pixels: np.ndarray, levels: int = 4) -> np.ndarray:
    """How many pixels have each of levels**3 colours."""
    q = pixels.reshape(-1, 3).astype(np.int64) * levels >> 8
    return np.bincount((q[:, 0] * levels + q[:, 1]) * levels + q[:, 2], minlength=levels**3)


def store(payload: bytes, side: int = SIDE, rows: int = ROWS, delay: int = 10) -> bytes:
    size = side * rows
    return encode([payload[i : i + size] for i in range(0, len(payload), size)], side, min(rows, len(payload) // side), delay)


def padded(payload: bytes, unit: int = UNIT) -> bytes:
    return payload + b"\xff" * (-len(payload) % unit if payload else unit)


def feature(total: np.ndarray, n_frames: int, length: int) -> str:
    """Frames, time in hundredths of a second, and the grey levels' shares in 16 classes, in thousandths."""
    shares = ",".join(str(1000 * int(x) // int(total.sum())) for x in total)
    return f"frames={n_frames};time={length};hist={shares}"


def table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, the GIF stream that stores the text's bytes, and what was read back from it: the payload, the number of frames and a
    histogram of 16 grey levels over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col, n = b.column(1), b.num_rows
            for i in range(0, n, 64):
                got = [stored(x.as_py() or b"") for x in col.slice(i, 64)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 64), *(pa.array(c, t) for c, t in zip(zip(*got, strict=True), _KINDS, strict=True))], [id_col, *_NAMES])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, F.col(text_col).cast("string").cast("binary").alias("__text")).mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, media binary, payload binary, n_frames bigint, time bigint, histogram array<bigint>")


_NAMES = ["n_bytes", "media", "payload", "n_frames", "time", "histogram"]
_KINDS = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())]


def stored(payload: bytes) -> tuple:
    media = store(padded(payload))
    back, n, time = [], 0, 0
    for f in decode(media):
        x, y, w, h = f.box
        back.append(f.pixels[y : y + h, x : x + w, 0].tobytes())
        n += 1
        time += f.delay
    read = b"".join(back)
    levels = np.bincount(np.frombuffer(read, np.uint8) >> 4, minlength=16)
    return len(payload), media, read, n, time, levels


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the digests of what ``table`` gives; streams and payloads stay in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x in b.column(1):
                size, media, read, n, time, levels = stored(x.as_py() or b"")
                rows.append((size, len(read), hashlib.sha256(read).hexdigest(), zlib.crc32(read[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature(levels, n, time)))
            cols = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], [id_col, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, F.col(text_col).cast("string").cast("binary").alias("__text")).mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")


def frames(media: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """A row per frame of each stream of ``media_col``: the id, frame number, start and delay in hundredths of a second, width, height, RGB pixels and a 64-colour histogram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                rows, time = [], 0
                for i, f in enumerate(decode(b.column(1)[r].as_py() or b"")):
                    h, w, _ = f.pixels.shape
                    rows.append((i, time, f.delay, w, h, f.pixels.tobytes(), histogram(f.pixels).tolist()))
                    time += f.delay
                if rows:
                    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
                    yield pa.RecordBatch.from_arrays([pa.array([b.column(0)[r].as_py()] * len(rows), b.column(0).type), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], [id_col, "frame", "start", "delay", "width", "height", "pixels", "histogram"])

    kind = dict(media.dtypes)[id_col]
    return media.select(id_col, F.col(media_col).alias("__media")).mapInArrow(run, f"`{id_col}` {kind}, frame int, start bigint, delay int, width int, height int, pixels binary, histogram array<bigint>")


#: What is stored and read back.
PAYLOAD_ORACLE = """
SELECT doc_id, n AS n_bytes, greatest((n + 575) // 576, 1) * 576 AS payload_bytes, sha256(unhex(h || repeat('FF', (greatest((n + 575) // 576, 1) * 576 - n)::BIGINT))) AS payload_sha256
FROM (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents)
"""
