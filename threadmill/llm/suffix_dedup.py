"""Removal of repeated passages with suffix arrays built by two-stage sorting.

Every 50-byte string of a document belongs to the 20-byte piece in it that hashes least; strings next to each other that
belong to the same piece make a segment (80 bytes at most). Equal strings belong to equal pieces, so dealing segments by their
piece brings all copies of any 50-byte string to one shard, and pieces that just one document has are done with. The segments of
the others are cut from their documents and meet by their bytes: copies of a segment are compared byte by byte and count once;
different ones are joined into one text whose suffix array puts equal strings side by side, and the adjacent common prefixes tell
which are. What is repeated goes by the smallest doc_id that has it. Hashes only deal segments out: no string is taken for
another without its bytes being compared.

A piece that has very many segments (the ends of a common passage, with other text around it each time) is hot: its strings
are dealt by their own 50 bytes instead, each alone, and those that are equal meet inside tasks before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import stored, to_batch

LENGTH = 50
PIECE = 20
#: Text for one shard, in bytes; the number of shards follows the input.
SHARD_BYTES = 1_000_000
#: Text whose segments a task sends on together, in bytes.
SEND_BYTES = 12_000_000
#: Text that is hashed together, in bytes.
HASHED_BYTES = 1_500_000
#: Segments of a piece, in one parcel (different ones) or after they have met, from which it is hot.
SENT_HOT, MET_HOT = 500, 20_000
#: Text to sort in one shard, in bytes; the number of these shards follows what there is to sort.
SORT_BYTES = 1_000_000
#: Text of whole pieces in one suffix array, in bytes: it takes some hundred bytes for each of the text.
ARRAY_BYTES = 2_000_000
#: Strings that a task cuts out and deals on together, and segments whose bytes are compared at once.
CUT_STRINGS, _COMPARED = 150_000, 20_000
#: Bytes of the longest segment: as many strings as there are places of a piece in one string.
_WIDEST = LENGTH - PIECE + LENGTH
_LAST = 2**63 - 1
_U = np.uint64
#: A byte that UTF-8 never has stands between segments.
_GAP = 255
#: Bits of a hash of contents that count; tests take fewer, so that hashes clash.
_MASK = 2**64 - 1

# The suffix array.


def _rising(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors; the last one isn't."""
    n = len(text)
    differs = np.concatenate((text[:-1] != text[1:], [True]))
    up = np.concatenate((text[:-1] < text[1:], [False]))
    nearest = np.where(differs, np.arange(n), n)
    return up[np.minimum.accumulate(nearest[::-1])[::-1]]


def _prefix_words(text: np.ndarray, at: np.ndarray, depth: int) -> list[np.ndarray]:
    """The first depth bytes of suffixes as big-endian words of 8, zeros past the end."""
    padded = np.concatenate((text, np.zeros(depth + 8, np.uint8)))
    words = np.zeros(len(text), _U)
    for k in range(8):
        words = words << _U(8) | padded[k : k + len(text)]
    words = np.concatenate((words, np.zeros(depth + 8, _U)))
    return [words[at + k] for k in range(0, depth, 8)]


def _sorted_directly(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first depth bytes (at least), ties in the order given: by 8 bytes, then ties by the next 8."""
    words = _prefix_words(text, at, depth)
    order = np.argsort(words[0], kind="stable")
    group = np.cumsum(np.concatenate(([0], np.diff(words[0][order]) != 0))) if len(order) else order
    for w in words[1:]:
        size = np.bincount(group) if len(group) else np.zeros(0, np.int64)
        tied = size[group] > 1
        if not tied.any():
            break
        slot = np.flatnonzero(tied)
        sub, g = order[slot], group[slot]
        by = np.lexsort((w[sub], g))
        order[slot] = sub[by]
        value = w[order[slot]]
        new = np.ones(len(order), bool)
        new[1:] = group[1:] != group[:-1]
        new[slot[1:]] |= value[1:] != value[:-1]
        group = np.cumsum(new) - 1
    return at[order]


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Starts of all suffixes, sorted by their first depth bytes at least (None: wholly), by two-stage sorting.

    Stage one sorts only the suffixes that are smaller than their successors. Stage two places the rest: buckets (by first byte)
    are scanned in order, and a suffix found there puts the one that starts a byte earlier at the next free place of its
    bucket's front, if that one is larger than its successor. A bucket is scanned as a whole, but for runs of its own byte,
    whose suffixes are placed a run's byte at a time."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    rising = _rising(text)
    direct = _sorted_directly(text, np.flatnonzero(rising), n if depth is None else depth)
    size = np.bincount(text, minlength=256)
    start = np.cumsum(size) - size
    out = np.empty(n, np.int64)
    # Within a bucket the suffixes larger than their successors come before those that are smaller.
    per = np.bincount(text[direct], minlength=256)
    front = start.copy()
    for c in np.flatnonzero(per):
        out[start[c] + size[c] - per[c] : start[c] + size[c]] = direct[np.cumsum(per)[c] - per[c] : np.cumsum(per)[c]]
    last = n - 1  # the suffix of one byte is larger than the empty one and comes first in its bucket
    out[front[text[last]]] = last
    front[text[last]] += 1
    for c in np.flatnonzero(size):
        wave = out[start[c] : front[c]]
        while len(wave):  # those that a run of c puts into this very bucket
            before = wave.take(np.flatnonzero(wave > 0)) - 1
            before = before.take(np.flatnonzero((text.take(before) == c) & ~rising.take(before)))
            out[front[c] : front[c] + len(before)] = before
            front[c] += len(before)
            wave = before
        before = out[start[c] : start[c] + size[c]]
        before = before.take(np.flatnonzero(before > 0)) - 1
        first = text.take(before)
        good = np.flatnonzero((first > c) & ~rising.take(before))
        before, first = before.take(good), first.take(good)
        by = np.argsort(first, kind="stable")
        before, counts = before.take(by), np.bincount(first, minlength=256)
        ends = np.cumsum(counts)
        for d in np.flatnonzero(counts):
            out[front[d] : front[d] + counts[d]] = before[ends[d] - counts[d] : ends[d]]
            front[d] += counts[d]
    return out


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each suffix in order, the bytes it has in common with the one before, counted up to most; 0 for the first."""
    words = _prefix_words(text, order, most)
    out, going = np.zeros(len(order), np.int64), np.ones(max(0, len(order) - 1), bool)
    for k, w in enumerate(words):
        x = w[1:] ^ w[:-1]
        zero = x == 0
        same = np.where(zero, 8, (64 - np.frexp(x.astype(np.float64))[1]) // 8)
        # frexp of a rounded number may be a bit too high; then the byte before decides
        same = np.where(zero, 8, np.where((x >> (_U(64) - (np.minimum(same, 7).astype(_U) + _U(1)) * _U(8))) == 0, np.minimum(same, 7) + 1, same))
        out[1:] += np.where(going, same, 0)
        going &= zero
    return np.minimum(out, most)


# Segments.


def segments(buffers: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All segments of some documents: document, first string's start in it, number of strings, hashes of piece and of contents."""
    size = np.array([len(b) for b in buffers], np.int64)
    b = np.frombuffer(b"".join(buffers), np.uint8)
    if len(b) < LENGTH:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, _U),) * 2
    h = (b.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15)
    h ^= h >> _U(32)
    hashes, span = {1: h}, 1
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F):
        h = h[:-span] * _U(factor) + h[span:]
        h ^= h >> _U(29)
        span *= 2
        hashes[span] = h
    whole16, four = hashes[16], hashes[4]
    piece = whole16[: len(b) - PIECE + 1] * _U(0xE7037ED1A0B428DB) + four[16 : 16 + len(b) - PIECE + 1] * _U(0x8EBC6AF09C88C6E3)
    piece ^= piece >> _U(31)
    del h, hashes, four
    # The least piece of each window and where it stands, the leftmost of equal ones.
    value, place, span = piece, np.arange(len(piece), dtype=np.int32), 1
    width = LENGTH - PIECE + 1
    while 2 * span <= width:
        right = value[span:] < value[:-span]
        value, place = np.where(right, value[span:], value[:-span]), np.where(right, place[span:], place[:-span])
        span *= 2
    if rest := width - span:
        right = value[rest:] < value[:-rest]
        value, place = np.where(right, value[rest:], value[:-rest]), np.where(right, place[rest:], place[:-rest])
    # Strings that lie in one document.
    ends = np.cumsum(size)
    doc = np.repeat(np.arange(len(size), dtype=np.int32), size)[: len(value)]
    inside = np.arange(len(value)) + LENGTH <= ends[doc]
    fresh = np.concatenate(([True], (place[1:] != place[:-1]) | ~inside[:-1])) & inside
    first = np.flatnonzero(fresh)
    if not len(first):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, _U),) * 2
    count = np.add.reduceat(inside.astype(np.int64), first)
    stop = first + count + LENGTH - 1
    contents = (stop - first).astype(_U)
    for at, factor in ((first, 0x9E3779B97F4A7C15), (first + 16, 0xBF58476D1CE4E5B9), (first + 32, 0x94D049BB133111EB), (np.minimum(first + 48, stop - 16), 0xD6E8FEB86659FD93), (stop - 16, 0xA0761D6478BD642F)):
        contents = (contents ^ (contents >> _U(31))) * _U(factor) + whole16[at]
    contents ^= contents >> _U(32)
    d = doc[first].astype(np.int64)
    return d, first - (ends - size)[d], count, value[first] * _U(0x2545F4914F6CDD1D), contents * _U(0x9FB21C651E98DF25)


@lru_cache(1)
def _zstd():
    """Compressor and decompressor of this process: making them takes longer than a small table."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress


def _packed(columns: dict[str, np.ndarray], more: bytes = b"") -> bytes:
    """Columns as planes of bytes, and more, compressed: high bytes of small or sorted numbers take hardly any room."""
    n = len(next(iter(columns.values())))
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(n, c.dtype.itemsize).T.tobytes() for c in columns.values()]
    return n.to_bytes(8, "little") + _zstd()[0](b"".join([*planes, more]))


def _unpacked(data: bytes, kinds: dict[str, str]) -> dict[str, np.ndarray]:
    """Columns, and in "" what was packed with them."""
    n, at, out = int.from_bytes(data[:8], "little"), 0, {}
    raw = np.frombuffer(_zstd()[1](data[8:]), np.uint8)
    for name, kind in kinds.items():
        size = np.dtype(kind).itemsize
        out[name] = np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind)[:, 0] if n else np.zeros(0, kind)
        at += n * size
    return out | {"": raw[at:]}


def _joined(blobs: Iterable[bytes], kinds: dict[str, str], more: bool = False) -> dict[str, np.ndarray]:
    parts = [_unpacked(b, kinds) for b in blobs]
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kinds.get(k, "u1")) for k in (*kinds, *[""] * more)}


#: by: doc_id with the largest number for null; text: the text's hash, which tells rows of one doc_id apart.
_SEG = {"piece": "<u8", "by": "<i8", "text": "<i8", "start": "<u4", "count": "u1", "hot": "u1"}
_SPANS = np.dtype([("start", "<u4"), ("count", "<u4")])
_FOUND = pa.schema([("by", pa.int64()), ("text", pa.int64()), ("kind", pa.int32()), ("content", pa.binary()), ("n_bytes", pa.int64())])
_FOUND_SQL = "by long, text long, kind int, content binary, n_bytes long"
_REMOVED, _UNSURE = 0, 1


def _grouped(columns: dict[str, np.ndarray], kind: int) -> pa.RecordBatch:
    """A row for each document among the segments; n_bytes is of what there is to sort, hot segments as single strings."""
    order = np.lexsort((columns["start"], columns["text"], columns["by"]))
    c = {k: v.take(order) for k, v in columns.items()}
    n = len(order)
    fresh = np.concatenate(([True], (c["by"][1:] != c["by"][:-1]) | (c["text"][1:] != c["text"][:-1]))) if n else np.zeros(0, bool)
    first = np.flatnonzero(fresh)
    records = np.empty(n, _ASKED if kind == _UNSURE else _SPANS)
    for k in records.dtype.names:
        records[k] = c[k]
    offsets = np.append(first, n).astype(np.int32) * np.int32(records.dtype.itemsize)
    content = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(records.tobytes())])
    count = c["count"].astype(np.int64)
    n_bytes = np.where(c["hot"] == 1, count * LENGTH, count + LENGTH - 1) if kind == _UNSURE else np.zeros(n, np.int64)
    return to_batch(_FOUND, [c["by"].take(first), c["text"].take(first), [kind] * len(first), content, np.add.reduceat(n_bytes, first)])


def _padded(parts: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join([*parts, bytes(_WIDEST)]), np.uint8)


def _rows_of(raw: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Stretches of a padded text as rows of one table, zeros past their ends."""
    rows = np.lib.stride_tricks.sliding_window_view(raw, _WIDEST)[at]
    rows *= np.arange(_WIDEST) < size[:, None]
    return rows


def _differ(raw: np.ndarray, one: np.ndarray, two: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which of the stretches at one and at two have different bytes; compared a bounded number at a time."""
    out = np.zeros(len(one), bool)
    for k in range(0, len(one), _COMPARED):
        part = slice(k, k + _COMPARED)
        out[part] = (_rows_of(raw, one[part], size[part]) != _rows_of(raw, two[part], size[part])).any(axis=1)
    return out


def _copies_of_earlier(s: dict[str, np.ndarray], raw: np.ndarray) -> np.ndarray:
    """Which segments have the bytes of one of an earlier document among them, as far as their hashes bring them together.

    s has their place in raw. Of one hash each is compared with the first; what differs from it stands for itself."""
    later = np.zeros(len(s["by"]), bool)
    key = (s["piece"] ^ s["piece"] >> _U(32)) * _U(0xBF58476D1CE4E5B9) + s["contents"]
    order = np.argsort(key)
    same = key.take(order[1:]) == key.take(order[:-1])
    some = order.take(np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same))))
    if not len(some):
        return later
    some = some.take(np.lexsort((s["start"].take(some), s["text"].take(some), s["by"].take(some), key.take(some))))
    fresh = np.concatenate(([True], key.take(some[1:]) != key.take(some[:-1])))
    first = some.take(np.maximum.accumulate(np.where(fresh, np.arange(len(some)), 0)))
    at = np.flatnonzero(s["by"].take(some) > s["by"].take(first))
    some, first = some.take(at), first.take(at)
    size = s["count"].take(some).astype(np.int64) + LENGTH - 1
    equal = (s["count"].take(first) == s["count"].take(some)) & ~_differ(raw, s["place"].take(some), s["place"].take(first), size)
    later[some.take(np.flatnonzero(equal))] = True
    return later


def _per_piece(piece: np.ndarray) -> np.ndarray:
    """The number of each segment's piece; segments are in order of it."""
    return np.cumsum(np.concatenate(([0], piece[1:] != piece[:-1]))) if len(piece) else np.zeros(0, np.int64)


def _send(docs: DataFrame, shards: int, hot: int, mask: int = _MASK) -> DataFrame:
    """shard, content: the segments of each task's documents, equal ones once. What that settles goes to any shard.

    So do the segments of pieces that are hot already (asked): just one of each such piece goes to the piece's own shard, marked."""
    schema = pa.schema([("shard", pa.int64()), ("content", pa.binary()), ("settled", pa.binary()), ("asked", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0

        def parcel(bys: list, hashes: list, parts: list[tuple], raws: list[bytes]) -> pa.RecordBatch | None:
            nonlocal turn
            doc, start, count, piece, contents = (np.concatenate(x) for x in zip(*parts))
            by, text = np.array(bys, np.int64), np.array(hashes, np.int64)
            begin = np.cumsum([len(r) for r in raws]) - [len(r) for r in raws]
            s = {"piece": piece, "contents": contents & _U(mask), "by": by[doc], "text": text[doc], "start": start.astype("<u4"), "count": count.astype("u1"), "place": begin[doc] + start}
            later = _copies_of_earlier(s, _padded(raws))
            # Later copies of a segment in the same parcel are repeats already.
            at, left = np.flatnonzero(later), np.flatnonzero(~later)
            done = _merged({k: s[k].take(at) for k in ("by", "text", "start", "count")})
            left = left.take(np.argsort(piece.take(left), kind="stable"))
            left = {k: s[k].take(left) for k in ("piece", "by", "text", "start", "count")}
            group = _per_piece(left["piece"])
            left["hot"] = (np.bincount(group)[group] > hot).astype("u1") if len(group) else np.zeros(0, "u1")
            spared = (left["hot"] == 1) & np.concatenate(([False], group[1:] == group[:-1]))[: len(group)]
            asked = np.flatnonzero(spared)
            ask = _to_ask({k: v.take(asked) for k, v in left.items()})
            if len(asked):
                rest = np.flatnonzero(~spared)
                left = {k: v.take(rest) for k, v in left.items()}
            del s, group, spared, later
            shard = (left["piece"] >> _U(32)) * _U(shards) >> _U(32)
            rows = [(k, _packed({c: v[a:b] for c, v in left.items()}), None, None) for k, a, b in _stretches(shard)]
            if len(done["by"]) or len(ask["by"]):
                turn += 1
                rows.append(((turn * 7919 + int(by[0])) % shards, None, _packed(done), _packed(ask)))
            return to_batch(schema, list(zip(*rows))) if rows else None

        def some(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list, list[bytes]]]:
            """Rows, about HASHED_BYTES of text at a time: hashing takes some hundred bytes for each of the text."""
            rows, size = ([], [], []), 0
            for batch in batches:
                for by, text_hash, text in zip(*batch.columns):
                    raw = text.as_py().encode("utf-8", "surrogatepass")
                    for column, v in zip(rows, (by.as_py(), text_hash.as_py(), raw)):
                        column.append(v)
                    size += len(raw)
                    if size >= HASHED_BYTES:
                        yield rows
                        rows, size = ([], [], []), 0
            if rows[0]:
                yield rows

        bys, hashes, parts, raws, size = [], [], [], [], 0
        for own_by, own_hash, raw in some(batches):
            doc, *rest = segments(raw)
            parts.append((doc + len(bys), *rest))
            bys += own_by
            hashes += own_hash
            raws += raw
            size += sum(map(len, raw))
            if size >= SEND_BYTES:
                if (out := parcel(bys, hashes, parts, raws)) is not None:
                    yield out
                bys, hashes, parts, raws, size = [], [], [], [], 0
        if parts and (out := parcel(bys, hashes, parts, raws)) is not None:
            yield out

    return docs.mapInArrow(run, "shard long, content binary, settled binary, asked binary")


_DONE = {"by": "<i8", "text": "<i8", "start": "<u4", "count": "<u4"}


def _merged(s: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Strings that follow each other, or lie so close that their bytes do, as one: count is of bytes from here on."""
    order = np.lexsort((s["start"], s["text"], s["by"]))
    by, text, start = s["by"][order], s["text"][order], s["start"][order].astype(np.int64)
    stop = start + s["count"][order] + LENGTH - 1
    if not len(order):
        return {"by": by, "text": text, "start": start.astype("<u4"), "count": start.astype("<u4")}
    doc = np.cumsum(np.concatenate(([0], (by[1:] != by[:-1]) | (text[1:] != text[:-1]))))
    far = int(stop.max()) + 1
    reach = np.maximum.accumulate(stop + doc * far) - doc * far
    fresh = np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])))
    first = np.flatnonzero(fresh)
    end = reach[np.append(first[1:], len(order)) - 1]
    return {"by": by[first], "text": text[first], "start": start[first].astype("<u4"), "count": (end - start[first]).astype("<u4")}


#: Of a piece's hash the upper half goes on: it deals segments out, no more.
_ASKED = np.dtype([("start", "<u4"), ("count", "u1"), ("piece", "<u4"), ("hot", "u1")])
_ASKED_SEG = {"by": "<i8", "text": "<i8", **{k: _ASKED[k].str for k in _ASKED.names}}


def _to_ask(s: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {k: (s[k] >> _U(32)).astype("<u4") if k == "piece" else s[k] for k in _ASKED_SEG}


def _stretches(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """key, start and end of each run of equal keys."""
    if len(keys):
        first = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
        yield from zip(keys[first].tolist(), first.tolist(), [*first[1:].tolist(), len(keys)])


def _meet(sent: DataFrame, most: int) -> DataFrame:
    """Per shard: what tasks have settled, and the segments whose piece several documents have, which are left to compare.

    A piece is hot if a parcel has marked it or more than `most` segments of it are left."""

    def run(table: pa.Table) -> pa.Table:
        out = []
        settled = _joined([c.as_py() for c in table.column("settled") if c.is_valid], _DONE)
        asked = [_joined([c.as_py() for c in table.column("asked") if c.is_valid], _ASKED_SEG)]
        s = _joined([c.as_py() for c in table.column("content") if c.is_valid], _SEG)
        if len(s["by"]):
            order = np.argsort(s["piece"], kind="stable")
            s = {k: v.take(order) for k, v in s.items()}
            group = _per_piece(s["piece"])
            first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            several = np.minimum.reduceat(s["by"], first) < np.maximum.reduceat(s["by"], first)
            marked = np.maximum.reduceat(s["hot"], first) > 0
            marked |= several & (np.diff(np.append(first, len(group))) > most)
            s["hot"] = marked.take(group).astype("u1")
            shared = np.flatnonzero((several | marked).take(group))
            asked.append(_to_ask({k: v.take(shared) for k, v in s.items()}))
            del s, group, shared, order
        ask = {k: np.concatenate([x.pop(k) for x in asked]) for k in _ASKED_SEG}
        if len(ask["by"]):
            out.append(_grouped(ask, _UNSURE))
        if len(settled["by"]):
            out.append(_grouped(settled, _REMOVED))
        return pa.Table.from_batches(out, _FOUND)

    return sent.groupBy("shard").applyInArrow(run, _FOUND_SQL)


_LINE = {"piece": "<u4", "by": "<i8", "text": "<i8", "start": "<u4", "size": "u1"}


def _strings(raws: list[bytes], size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All strings of some segments of that many bytes: their segment, their start in it, and their bytes as rows of a table."""
    count = size - LENGTH + 1
    owner = np.repeat(np.arange(len(size)), count)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    every = np.lib.stride_tricks.sliding_window_view(np.frombuffer(b"".join(raws), np.uint8), LENGTH)
    return owner, offset, every[(np.cumsum(size) - size)[owner] + offset]


def _first_strings(strings: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each string, and which are of a later document than another that has the same bytes: those are compared."""
    words = np.zeros((len(strings), -(-LENGTH // 8) * 8), np.uint8)
    words[:, :LENGTH] = strings
    key = np.zeros(len(strings), _U)
    for w in words.view("<u8").T:
        key = (key ^ w) * _U(0x9E3779B97F4A7C15)
        key ^= key >> _U(29)
    key = (key ^ key >> _U(32)) * _U(0xD6E8FEB86659FD93)
    order = np.lexsort((by, key))
    same = (strings[order[1:]] == strings[order[:-1]]).all(axis=1)
    fresh = np.concatenate(([True], ~same))[: len(order)]
    least = by[order][np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
    later = np.zeros(len(order), bool)
    later[order] = by[order] > least
    return key, later


def _cut_out(docs: DataFrame, asked: DataFrame, shards: int) -> DataFrame:
    """shard, lines: the asked segments and their bytes, of each document from its own text; settled: what is known by then.

    Segments of hot pieces come as their strings, dealt by their own bytes; those that an earlier document of the parcel has too
    are settled, so a string that very many documents have comes once from each parcel."""
    per = asked.groupBy("by", "text").agg(F.collect_list("content").alias("contents")).select(F.col("by").alias("_by"), F.col("text").alias("_text"), "contents")
    both = docs.join(per, (F.col("by") == F.col("_by")) & (F.col("text_hash") == F.col("_text"))).select("by", "text_hash", "text", "contents")
    schema = pa.schema([("shard", pa.int64()), ("lines", pa.binary()), ("settled", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def parcel() -> pa.RecordBatch:
            piece, by, text, start, hot = (np.concatenate([h[k] for h in held]) for k in range(5))
            chunks = [c for h in held for c in h[5]]
            settled = None
            if hot.any():
                at = np.flatnonzero(hot)
                owner, offset, strings = _strings(raws := [chunks[i] for i in at.tolist()], np.array([len(c) for c in raws]))
                owner = at[owner]
                key, later = _first_strings(strings, by[owner])
                found = {"by": by[owner], "text": text[owner], "start": start[owner] + offset}
                settled = _merged({**{k: v[later] for k, v in found.items()}, "count": np.ones(int(later.sum()), np.int64)})
                cold, kept = ~hot, ~later
                chunks = [c for c, h in zip(chunks, hot.tolist()) if not h] + [x.tobytes() for x in strings[kept]]
                piece = np.concatenate((piece[cold], (key[kept] >> _U(32)).astype("<u4")))
                by, text, start = (np.concatenate((x[cold], found[k][kept])) for k, x in (("by", by), ("text", text), ("start", start)))
            shard = piece.astype(_U) * _U(shards) >> _U(32)
            order = np.argsort(shard, kind="stable")
            length = np.array([len(c) for c in chunks], "u1").take(order)
            lines = {"piece": piece.take(order), "by": by.take(order), "text": text.take(order), "start": start.take(order).astype("<u4"), "size": length}
            every = b"".join([chunks[i] for i in order.tolist()])
            ends = np.concatenate(([0], np.cumsum(length, dtype=np.int64))).tolist()
            rows = [(k, _packed({c: v[a:b] for c, v in lines.items()}, every[ends[a] : ends[b]]), None) for k, a, b in _stretches(shard.take(order))]
            if settled is not None and len(settled["by"]):
                rows.append((int(settled["start"][0]) % shards, None, _packed(settled)))
            return to_batch(schema, list(zip(*rows)))

        for batch in batches:
            for by, text_hash, text, contents in zip(*[batch.column(k) for k in range(4)]):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                asked_of = np.frombuffer(b"".join(contents.as_py()), _ASKED)
                start, count, piece, hot = (asked_of[k] for k in _ASKED.names)
                ends = start.astype(np.int64) + count + LENGTH - 1
                chunks = [raw[a:b] for a, b in zip(start.tolist(), ends.tolist())]
                n = len(start)
                held.append((piece, np.full(n, by.as_py()), np.full(n, text_hash.as_py()), start, hot == 1, chunks))
                size += int(np.where(hot == 1, count, 1).sum())
                if size >= CUT_STRINGS:
                    yield parcel()
                    held, size = [], 0
        if held:
            yield parcel()

    return both.mapInArrow(run, "shard long, lines binary, settled binary")


def repeats(raw: np.ndarray, size: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings of LENGTH bytes in segments that also start in a segment of a smaller document: (segment, start in it).

    raw holds the segments one after another, size their lengths, by their documents."""
    at = np.cumsum(size) - size
    gapped = np.full(len(raw) + len(size), _GAP, np.uint8)
    place = np.arange(len(raw)) + np.repeat(np.arange(len(size)), size)
    gapped[place] = raw
    begin = at + np.arange(len(size))
    owner = np.repeat(np.arange(len(size)), size + 1)
    offset = np.arange(len(gapped)) - begin[owner]
    valid = offset <= size[owner] - LENGTH
    depth = -(-LENGTH // 8) * 8
    order = suffix_array(gapped, depth)
    order = order.take(np.flatnonzero(valid.take(order)))
    same = common_prefixes(gapped, order, LENGTH) >= LENGTH
    group = np.cumsum(~same) - 1 if len(order) else np.zeros(0, np.int64)
    docs = by[owner[order]]
    least = np.full(int(group[-1]) + 1 if len(group) else 0, _LAST)
    np.minimum.at(least, group, docs)
    hit = order[docs > least[group]] if len(order) else order
    return owner[hit], offset[hit]


def _copies(raw: np.ndarray, at: np.ndarray, size: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Which segments have all the bytes of one of an earlier document; the bytes are compared."""
    rows = _rows_of(raw, at, size)
    key = np.zeros(len(at), _U)
    for w in rows.view("<u8").T:
        key = (key ^ w) * _U(0x9E3779B97F4A7C15)
        key ^= key >> _U(29)
    order = np.lexsort((by, size, key))
    sorted_rows = rows[order]
    same = (sorted_rows[1:] == sorted_rows[:-1]).all(axis=1) & (np.diff(size.take(order)) == 0)
    fresh = np.concatenate(([True], ~same))[: len(order)]
    least = by.take(order).take(np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0)))
    later = np.zeros(len(order), bool)
    later[order] = by.take(order) > least
    return later


def _shared(piece: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Which segments, in order of their pieces, have a piece that several documents have."""
    if not len(piece):
        return np.zeros(0, bool)
    first = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
    several = np.minimum.reduceat(by, first) < np.maximum.reduceat(by, first)
    return np.repeat(several, np.diff(np.append(first, len(piece))))


def _sort(parcels: DataFrame) -> DataFrame:
    """Per shard the suffix array of its different segments, and from it what a smaller document has as well."""

    def run(table: pa.Table) -> pa.Table:
        line = _joined([c.as_py() for c in table.column("lines") if c.is_valid], _LINE, more=True)
        raw = _padded([line.pop("").tobytes()])
        settled = [_joined([c.as_py() for c in table.column("settled") if c.is_valid], _DONE)]
        size = line["size"].astype(np.int64)
        begin, order = np.cumsum(size) - size, np.argsort(line["piece"], kind="stable")
        # Equal strings are of one piece: whole pieces at a time find the same.
        first = np.concatenate(([True], np.diff(line["piece"].take(order)) != 0))[: len(order)]
        before = np.cumsum(size.take(order)) - size.take(order)
        part = before.take(np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))) // ARRAY_BYTES
        for own in np.split(order, np.flatnonzero(np.diff(part)) + 1) if len(order) else []:
            copy = _copies(raw, begin.take(own), size.take(own), line["by"].take(own))
            again, own = own.take(np.flatnonzero(copy)), own.take(np.flatnonzero(~copy))
            settled.append(_merged({"by": line["by"].take(again), "text": line["text"].take(again), "start": line["start"].take(again), "count": size.take(again) - LENGTH + 1}))
            # A piece of which just one document's segments are left has no other strings to be told from.
            own = own.take(np.flatnonzero(_shared(line["piece"].take(own), line["by"].take(own))))
            n = size.take(own)
            at = np.cumsum(n) - n
            index = np.arange(int(n.sum())) + np.repeat(begin.take(own) - at, n)
            k, offset = repeats(raw.take(index), n, line["by"].take(own))
            k = own.take(k)
            settled.append(_merged({"by": line["by"].take(k), "text": line["text"].take(k), "start": line["start"].take(k) + offset, "count": np.ones(len(k), np.int64)}))
        done = {c: np.concatenate([x[c] for x in settled]) for c in _DONE}
        return pa.Table.from_batches([_grouped(done, _REMOVED)] if len(done["by"]) else [], _FOUND)

    return parcels.groupBy("shard").applyInArrow(run, _FOUND_SQL)


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _spans(contents: list[bytes] | None) -> list[tuple[int, int]]:
    """Maximal removed runs (start, end) from a document's found ones."""
    if not contents:
        return []
    found = np.frombuffer(b"".join(contents), _SPANS)
    start = found["start"].astype(np.int64)
    stop = start + found["count"]
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    first = np.flatnonzero(np.concatenate(([True], start[1:] > reach[:-1])))
    return list(zip(start[first].tolist(), reach[np.append(first[1:], len(start)) - 1].tolist()))


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sent_hot: int = SENT_HOT, met_hot: int = MET_HOT, mask: int = _MASK) -> DataFrame:
    """doc_id, text and contents (packed runs to remove, null if none) of each row; see digest() and spans()."""
    plain = docs.select(F.coalesce(F.col(id_col), F.lit(_LAST)).alias("by"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).alias("doc_id"))
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    found = stored(_meet(_send(plain.select("by", "text_hash", "text"), shards, sent_hot, mask), met_hot), "segments")
    asked = found.filter(f"kind = {_UNSURE}")
    ways = max(shards, -(-(asked.agg(F.sum("n_bytes")).first()[0] or 0) // SORT_BYTES))
    sure = stored(_sort(_cut_out(plain.select("by", "text_hash", "text"), asked, ways)), "repeats")
    both = found.filter(f"kind = {_REMOVED}").select("by", "text", "content").union(sure.select("by", "text", "content"))
    per = both.groupBy("by", "text").agg(F.collect_list("content").alias("contents")).select(F.col("by").alias("_by"), F.col("text").alias("_text"), "contents")
    return plain.join(per, (F.col("by") == F.col("_by")) & (F.col("text_hash") == F.col("_text")), "left").select("doc_id", "text", "contents")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row of found_spans()."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text, contents in zip(*[batch.column(k) for k in range(3)]):
                raw, sha, at, gone = text.as_py().encode("utf-8", "surrogatepass"), hashlib.sha256(), 0, 0
                runs = _spans(contents.as_py())
                for a, b in runs:
                    sha.update(raw[at:a])
                    at, gone = b, gone + b - a
                sha.update(raw[at:])
                rows.append((i.as_py(), len(raw), gone, len(runs), sha.hexdigest()))
            if rows:
                yield to_batch(_RESULT, list(zip(*rows)))

    return found.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Removed is each byte that lies in a 50-byte string which also starts in a row of a smaller doc_id; strings are those of the
    input, within one document. A null or empty text has no strings; rows of one doc_id don't remove from each other, and a null
    id counts as the largest; an empty table gives no rows; no other column is read. Equal segments meet inside tasks before they
    are dealt out, so a passage that a third of all rows have comes once from each parcel."""
    return digest(found_spans(docs, id_col, text_col))
