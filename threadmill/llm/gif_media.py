"""GIF media columns: timed frames decoded from LZW code streams, with palettes, disposal and transparency, and colour histograms.

A text is stored as an animation of 24 x 24 frames: its UTF-8 bytes, filled up with 255, are the frames' colour indices in a
palette of 256 greys, so the decoded frames hold every byte.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate, groupby, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices, text_of, to_batch

SIDE = 24
UNIT = SIDE * SIDE
FILL = 255
#: Hundredths of a second that a text's frame is shown.
DELAY = 4
#: Bins of a colour histogram for each of red, green and blue.
BINS = 16
#: Frames that are coded together.
FRAMES = 1024

#: Bytes of files that are decoded together.
FILE_BYTES = 2_000_000

_GREYS = np.repeat(np.arange(256, dtype=np.uint8), 3).reshape(256, 3)


class _Part(NamedTuple):
    """An image block as it is stored."""

    left: int
    top: int
    width: int
    height: int
    palette: np.ndarray
    interlaced: bool
    delay: int
    disposal: int
    transparent: int | None
    min_bits: int
    data: bytes


# LZW as GIF has it: codes of min_bits + 1 bits at first, one bit more whenever the table outgrows them, 12 at most.


def _widths(min_bits: int, count: int) -> np.ndarray:
    """Bits of the codes after a clear code, the first of them included."""
    entries = (1 << min_bits) + 2 + np.maximum(np.arange(count), 1) - 1
    return np.minimum(np.maximum(min_bits + 1, np.frexp(entries)[1]), 12)


_SCHEDULES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _schedule(min_bits: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Widths and bit offsets of at least that many codes."""
    if min_bits not in _SCHEDULES or len(_SCHEDULES[min_bits][0]) < count:
        w = _widths(min_bits, max(count, 8192))
        _SCHEDULES[min_bits] = w, np.concatenate(([0], np.cumsum(w)))
    return _SCHEDULES[min_bits]


def _parse(pixels: bytes, min_bits: int) -> list[list[int]]:
    """The codes of a stream, a list for each clear code that it needs."""
    first, full = ((1 << min_bits) + 2) << 8, 4095 << 8
    runs: list[list[int]] = []
    table: dict[int, int] = {}  # a code's place in it and the codes here are shifted by 8 bits, to hold the next pixel
    get, codes, free = table.get, [], first
    pixel = iter(pixels)
    w = next(pixel, 0) << 8
    for b in pixel:
        v = get(w | b)
        if v is not None:
            w = v
            continue
        codes.append(w)
        if free == full:
            runs.append(codes)
            table.clear()
            codes, free = [], first
        else:
            table[w | b] = free
            free += 256
        w = b << 8
    codes.append(w)
    runs.append(codes)
    return runs


_PLACES = np.arange(12, dtype=np.uint16)


def lzw_encode(images: list[bytes], min_bits: int = 8) -> list[bytes]:
    """The code stream of each image, packed for all of them at once."""
    clear = 1 << min_bits
    values, widths, ends = [], [], []
    for pixels in images:
        width = min_bits + 1
        for codes in _parse(pixels, min_bits):
            values += ([clear << 8], codes)
            w, _ = _schedule(min_bits, len(codes) + 1)
            widths += (np.array([width]), w[: len(codes)])
            width = w[len(codes)]
        values.append([clear + 1 << 8])
        widths.append(np.array([width]))
        ends.append(len(values))
    v = np.concatenate([np.array(x, dtype=np.uint32) for x in values]) >> 8
    w = np.concatenate(widths)
    # Each image's stream ends with a whole byte: zero bits come as a further code of as many bits.
    counts = np.cumsum([len(x) for x in values])[np.array(ends) - 1]
    spare = -np.diff(np.concatenate(([0], np.cumsum(w)[counts - 1]))) % 8
    v, w = np.insert(v, counts, 0).astype(np.uint16), np.insert(w, counts, spare)
    bits = (v[:, None] >> _PLACES & 1).astype(np.uint8)[_PLACES < w[:, None]]
    packed = np.packbits(bits, bitorder="little").tobytes()
    stops = np.cumsum(w)[counts + np.arange(len(counts))] // 8
    return [packed[a:b] for a, b in zip(np.concatenate(([0], stops)).tolist(), stops.tolist())]


def _codes(data: np.ndarray, bit: int, min_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes from a bit on, up to a clear or end code, and where the next ones start. data ends in three spare bytes."""
    room = (len(data) - 3) * 8 - bit
    width, offset = _schedule(min_bits, room // (min_bits + 1) + 2)
    n = int(np.searchsorted(offset, room, side="right")) - 1
    at = bit + offset[:n]
    byte = at >> 3
    value = data[byte] | data[byte + 1] << 8 | data[byte + 2] << 16
    return value >> (at & 7) & (1 << width[:n]) - 1, bit + offset[1 : n + 1]


def lzw_decode(data: bytes, min_bits: int, count: int) -> bytes:
    """Up to count pixels of a code stream."""
    clear, first = 1 << min_bits, (1 << min_bits) + 2
    raw = np.zeros(len(data) + 3, dtype=np.uint32)
    raw[:-3] = np.frombuffer(data, np.uint8)
    single = [bytes([i]) for i in range(min(clear, 256))] + [b"\0"] * max(0, clear - 256) + [b"", b""]
    out: list[bytes] = []
    bit = got = 0
    while got < count:
        codes, ends = _codes(raw, bit, min_bits)
        stops = np.flatnonzero((codes == clear) | (codes == clear + 1))
        stop = int(stops[0]) if len(stops) else len(codes)
        table, before = single.copy(), b""
        for c in codes[:stop].tolist():
            if c < len(table):
                entry = table[c]
                if before and len(table) < 4096:
                    table.append(before + entry[:1])
            elif before:
                entry = before + before[:1]
                if len(table) < 4096:
                    table.append(entry)
            else:
                raise ValueError("broken LZW stream")
            out.append(entry)
            got += len(entry)
            before = entry
        if stop == len(codes) or codes[stop] == clear + 1:
            break
        bit = int(ends[stop])
    pixels = b"".join(out)[:count]
    return pixels + bytes(count - len(pixels))


def lzw_decode_all(streams: list[tuple[bytes, int, int]]) -> list[bytes]:
    """lzw_decode() for many streams (data, min_bits, count) at once.

    Streams without a clear code in their middle, of one min_bits, are decoded together: a code made by the table stands for a
    place in what is decoded already, so lengths and bytes come from following such references, all of them at each step."""
    out: list[bytes | None] = [None] * len(streams)
    for min_bits in {s[1] for s in streams}:
        own = [k for k, s in enumerate(streams) if s[1] == min_bits]
        for k, pixels in zip(own, _decode_together([streams[k] for k in own], min_bits)):
            out[k] = pixels if pixels is not None else lzw_decode(*streams[k])
    return out


def _followed(ref: np.ndarray) -> np.ndarray:
    """Where references end; what refers to itself is an end."""
    while True:
        further = ref[ref]
        if np.array_equal(further, ref):
            return ref
        ref = further


def _decode_together(streams: list[tuple[bytes, int, int]], min_bits: int) -> list[bytes | None]:
    clear, first = 1 << min_bits, (1 << min_bits) + 2
    raw = np.frombuffer(b"".join([s[0] + b"\0\0\0" for s in streams]), np.uint8)
    size = np.array([len(s[0]) for s in streams])
    base = np.concatenate(([0], np.cumsum(size + 3)[:-1]))
    width, offset = _schedule(min_bits, int(size.max()) * 8 // (min_bits + 1) + 3)
    width, offset = np.concatenate(([min_bits + 1], width)), np.concatenate(([0], offset + min_bits + 1))  # the clear code first
    room = np.searchsorted(offset, size * 8, side="right") - 1
    most = int(room.max())
    # One row for each stream; cells past a stream's room hold the end code.
    at = offset[:most]
    byte = np.minimum(base[:, None] + (at >> 3), len(raw) - 3)
    codes = raw[byte].astype(np.int32) | raw[byte + 1].astype(np.int32) << 8 | raw[byte + 2].astype(np.int32) << 16
    codes = codes >> (at & 7).astype(np.int32) & ((1 << width[:most]) - 1).astype(np.int32)
    codes[np.arange(most) >= room[:, None]] = clear + 1
    good = (codes[:, 0] == clear) if most else np.zeros(len(streams), bool)
    codes = codes[:, 1:]
    stop = (codes == clear) | (codes == clear + 1)
    stop = np.concatenate((stop, np.ones((len(streams), 1), bool)), axis=1)
    n = stop.argmax(axis=1)
    places = np.arange(codes.shape[1], dtype=np.int32)
    inside = places < n[:, None]
    made = inside & (codes >= first)
    good &= ~(made & (codes - first >= places)).any(axis=1) & (n <= 4096 - first)
    made &= good[:, None]
    # A made code is as long as the one before its entry was made, and one more; that one is code number codes - first.
    cell = np.arange(codes.size, dtype=np.int32).reshape(codes.shape)
    up = np.where(made, cell - places + codes - first, cell).ravel()
    length, ref = np.where(made, 1, 0).ravel().astype(np.int32), up
    while True:
        further = ref[ref]
        if np.array_equal(further, ref):
            break
        length += length[ref]
        ref = further
    length = np.where((inside & good[:, None]).ravel(), length + 1, 0)
    start = np.cumsum(length) - length
    owner = np.repeat(np.arange(len(length), dtype=np.int32), length)
    byte = np.arange(len(owner), dtype=np.int32)
    source = np.where(made.ravel()[owner], start[up[owner]].astype(np.int32) + byte - start[owner].astype(np.int32), byte)
    pixels = codes.ravel()[owner].astype(np.uint8)[_followed(source)].tobytes()
    total = length.reshape(codes.shape).sum(axis=1)
    end = np.cumsum(total)
    return [pixels[e - t : e] if g and t == s[2] else None for e, t, g, s in zip(end.tolist(), total.tolist(), good.tolist(), streams)]


def _blocks(data: bytes) -> bytes:
    return b"".join(x for k in range(0, len(data), 255) for x in (bytes([min(255, len(data) - k)]), data[k : k + 255])) + b"\0"


def encode(payloads: list[bytes], width: int = SIDE, height: int = SIDE, delay: int = DELAY) -> list[bytes]:
    """For each payload an animation whose frames hold it, width * height bytes each, as greys."""
    head = b"GIF89a" + struct.pack("<HHBBB", width, height, 0xF7, 0, 0) + _GREYS.tobytes() + b"\x21\xff\x0bNETSCAPE2.0\x03\x01\0\0\0"
    control = b"\x21\xf9\x04" + struct.pack("<BHB", 1 << 2, delay, 0) + b"\0" + b"\x2c" + struct.pack("<HHHHB", 0, 0, width, height, 0) + b"\x08"
    unit, files = width * height, [[head] for _ in payloads]
    images = ((k, p[a : a + unit]) for k, p in enumerate(payloads) for a in range(0, len(p), unit))
    while group := list(islice(images, FRAMES)):
        for (k, _), stream in zip(group, lzw_encode([x for _, x in group])):
            files[k] += control, _blocks(stream)
    return [b"".join([*f, b"\x3b"]) for f in files]


def _parts(data: bytes) -> tuple[int, int, Iterator[_Part]]:
    """The screen's size and the stored images."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF file")
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    at = 13
    palette = _GREYS
    if flags & 0x80:
        n = 2 << (flags & 7)
        palette = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
        at += 3 * n

    def blocks(at: int) -> tuple[bytes, int]:
        found = []
        while n := data[at]:
            found.append(data[at + 1 : at + 1 + n])
            at += 1 + n
        return b"".join(found), at + 1

    def images(at: int) -> Iterator[_Part]:
        delay, disposal, transparent = 0, 0, None
        while at < len(data) and data[at] != 0x3B:
            if data[at] == 0x21:
                label = data[at + 1]
                body, at = blocks(at + 2)
                if label == 0xF9 and len(body) >= 4:
                    delay, disposal, transparent = body[1] | body[2] << 8, body[0] >> 2 & 7, body[3] if body[0] & 1 else None
            elif data[at] == 0x2C:
                left, top, w, h, local = struct.unpack_from("<HHHHB", data, at + 1)
                at += 10
                own = palette
                if local & 0x80:
                    n = 2 << (local & 7)
                    own = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
                    at += 3 * n
                min_bits = data[at]
                body, at = blocks(at + 1)
                yield _Part(left, top, w, h, own, bool(local & 0x40), delay, disposal, transparent, min_bits, body)
                delay, disposal, transparent = 0, 0, None
            else:
                raise ValueError("broken GIF file")

    return width, height, images(at)


def _rows_in_order(height: int) -> np.ndarray:
    """The rows of an interlaced image in the order in which they are stored."""
    return np.concatenate([np.arange(a, height, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])


class _Canvas:
    """What a file's images are drawn on."""

    def __init__(self, width: int, height: int):
        self.pixels, self.start = np.zeros((height, width, 4), dtype=np.uint8), 0

    def draw(self, p: _Part, index: np.ndarray) -> np.ndarray:
        """The picture once p is drawn over what the image before it left; then p is disposed of in its own way."""
        height, width = self.pixels.shape[:2]
        kept = self.pixels.copy() if p.disposal == 3 else None
        if p.interlaced:
            stored, index = index, np.empty_like(index)
            index[_rows_in_order(p.height)] = stored
        y, x = max(0, min(p.height, height - p.top)), max(0, min(p.width, width - p.left))
        index, area = index[:y, :x], self.pixels[p.top : p.top + y, p.left : p.left + x]
        shown = np.full(index.shape, True) if p.transparent is None else index != p.transparent
        area[shown] = _colours(p.palette)[index[shown]]
        picture = self.pixels.copy()
        if p.disposal == 2:
            area[:] = 0
        elif p.disposal == 3:
            self.pixels = kept
        return picture

    def covered_by(self, p: _Part) -> bool:
        return (p.top, p.left, p.height, p.width) == (0, 0, *self.pixels.shape[:2]) and p.transparent is None and p.disposal < 2 and not p.interlaced


def _colours(palette: np.ndarray) -> np.ndarray:
    """RGBA of all 256 indices; those that the palette lacks are black."""
    out = np.zeros((256, 4), np.uint8)
    out[: len(palette), :3], out[:, 3] = palette, 255
    return out


class Frames(NamedTuple):
    """Some frames of one file, in order: start and delay of each (hundredths of a second), pictures (frames, height, width, RGBA)."""

    file: int
    start: list[int]
    delay: list[int]
    pixels: np.ndarray


def decode(files: list[bytes]) -> Iterator[Frames]:
    """The frames of files as they are shown, some at a time: their code streams are decoded together, FRAMES of them."""
    canvases: dict[int, _Canvas] = {}

    def images() -> Iterator[tuple[int, _Part]]:
        for k, data in enumerate(files):
            width, height, parts = _parts(data)
            canvases[k] = _Canvas(width, height)
            for p in parts:
                yield k, p

    every = images()
    while group := list(islice(every, FRAMES)):
        indices = lzw_decode_all([(p.data, p.min_bits, p.width * p.height) for _, p in group])
        for k, own in groupby(zip(group, indices), key=lambda x: x[0][0]):
            own, canvas = [(p, i) for (_, p), i in own], canvases[k]
            if all(canvas.covered_by(p) and p.palette is own[0][0].palette for p, _ in own):
                index = np.frombuffer(b"".join([i for _, i in own]), np.uint8)
                pixels = _colours(own[0][0].palette).view(np.uint32)[:, 0][index].view(np.uint8).reshape(len(own), *canvas.pixels.shape)
                canvas.pixels = pixels[-1].copy()
            else:
                pixels = np.stack([canvas.draw(p, np.frombuffer(i, np.uint8).reshape(p.height, p.width)) for p, i in own])
            delay = [p.delay for p, _ in own]
            ends = list(accumulate(delay, initial=canvas.start))
            canvas.start = ends[-1]
            yield Frames(k, ends[:-1], delay, pixels)


def histogram(pixels: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Counts of red, green and blue, bins each, over the pixels that aren't transparent; pixels: (..., RGBA)."""
    flat = pixels.reshape(-1, 4)
    flat = flat[flat[:, 3] > 0]
    return np.concatenate([np.bincount(flat[:, c] >> (8 - bins.bit_length() + 1), minlength=bins) for c in range(3)])


def payload_of(text: str) -> tuple[int, bytes]:
    """Unpadded length, and the UTF-8 bytes filled up to a positive multiple of UNIT."""
    raw = text.encode("utf-8", "surrogatepass")
    return len(raw), raw + bytes([FILL]) * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and media (the GIF file) of every row; no shuffle.

    A null or empty text is one frame of FILL; equal texts give equal files; a null id stays null; an empty table gives no
    rows. No other column is read."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            both = [payload_of(t) for t in texts]
            yield to_batch(schema, [ids, [n for n, _ in both], encode([p for _, p in both])])

    return text_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, media binary")


FRAME_SCHEMA = "doc_id long, frame long, start_cs long, delay_cs long, width int, height int, pixels binary, histogram array<long>"


def frames(media: DataFrame) -> DataFrame:
    """One row for each shown frame of each file: its place, time, RGBA pixels and colour histogram."""
    schema = pa.schema([("doc_id", pa.int64()), ("frame", pa.int64()), ("start_cs", pa.int64()), ("delay_cs", pa.int64()), ("width", pa.int32()), ("height", pa.int32()), ("pixels", pa.binary()), ("histogram", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, files in _held(batch.column(0).to_pylist(), batch.column(1)):
                shown = [0] * len(files)
                for f in decode(files):
                    n, h, w, _ = f.pixels.shape
                    at = range(shown[f.file], shown[f.file] + n)
                    shown[f.file] += n
                    yield to_batch(schema, [[ids[f.file]] * n, at, f.start, f.delay, [w] * n, [h] * n, [p.tobytes() for p in f.pixels], [histogram(p).tolist() for p in f.pixels]])

    return media.select("doc_id", "media").mapInArrow(run, FRAME_SCHEMA)


def _held(rows: list, media: pa.Array) -> Iterator[tuple[list, list[bytes]]]:
    """Rows and their files, about FILE_BYTES of files at a time."""
    own, files, size = [], [], 0
    for r, m in zip(rows, media):
        own.append(r)
        files.append(m.as_py())
        size += len(files[-1])
        if size >= FILE_BYTES:
            yield own, files
            own, files, size = [], [], 0
    if files:
        yield own, files


def _digests(files: list[bytes]) -> list[tuple]:
    sha = [hashlib.sha256() for _ in files]
    tail, size, count, time, total = [b""] * len(files), [0] * len(files), [0] * len(files), [0] * len(files), np.zeros((len(files), 3 * BINS), np.int64)
    for f in decode(files):
        k, raw = f.file, f.pixels[..., 0].tobytes()
        sha[k].update(raw)
        tail[k], size[k], count[k], time[k] = (tail[k] + raw)[-32:], size[k] + len(raw), count[k] + len(f.pixels), f.start[-1] + f.delay[-1]
        total[k] += histogram(f.pixels)
    feature = [f"frames={n};cs={t};hist={'-'.join(map(str, h[:BINS].tolist()))};rgb={hashlib.sha256(h.astype('<i8').tobytes()).hexdigest()[:16]}" for n, t, h in zip(count, time, total)]
    return list(zip(size, [x.hexdigest() for x in sha], map(zlib.crc32, tail), map(len, files), [hashlib.sha256(m).hexdigest() for m in files], feature))


def digest(media: DataFrame) -> DataFrame:
    """What op3 returns, from stored files: payload figures are of the bytes that their decoded frames hold.

    feature: frames, their time, the red histogram over all frames, and a digest of all three histograms."""
    names = ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
    schema = pa.schema([(n, pa.string() if n.endswith("sha256") or n == "feature" else pa.int64()) for n in names])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, files in _held(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())), batch.column(2)):
                yield to_batch(schema, list(zip(*[(*r, *d) for r, d in zip(rows, _digests(files))])))

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in schema))
