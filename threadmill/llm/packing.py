"""Packing documents into windows of a fixed number of tokens, by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WordEncoder, slices, text_of, to_batch

CAPACITY = 1024
END_ID = 0
#: Open windows that one packer holds at most; beyond it the fullest one is topped up with what the emptiest one holds.
OPEN_WINDOWS = 2048

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])


class Piece(NamedTuple):
    doc_id: int | None
    start: int
    ids: memoryview
    doc_tokens: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[: 4 * at]), self._replace(start=self.start + at, ids=self.ids[4 * at :])

    @property
    def length(self) -> int:
        return len(self.ids) // 4


class SumOfSquaresPacker:
    """Places pieces one after another, in the order they come.

    levels[h] counts the open windows that hold h tokens. A piece of s tokens goes to the level h (0: a new window) at which
    the sum of squares of levels ends up least; of equal levels to the fullest. Full windows leave. Memory is bounded by
    OPEN_WINDOWS windows of CAPACITY tokens: one more, and the fullest window takes tokens from the emptiest, as many as it
    lacks, and leaves; all others stay as they are, at their levels. At the end this goes on until one window is left, which is
    cut into windows whose sizes are powers of two."""

    def __init__(self, capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS):
        self.capacity, self.open_windows = capacity, open_windows
        self.levels = np.zeros(capacity + 1, dtype=np.int64)
        self.windows: dict[int, list[list[Piece]]] = defaultdict(list)
        self.n_open = 0

    def level(self, size: int) -> int:
        """The fill level where a piece of that size goes."""
        n, top = self.levels, self.capacity - size
        cost = np.where(n[: top + 1] > 0, 1 - 2 * n[: top + 1], np.iinfo(np.int64).max // 4)  # what leaving level h changes
        cost[0] = 0
        after = 2 * n[size:] + 1  # what coming to level h + size changes
        after[-1] = 0  # full windows leave
        cost = cost + after
        return int(top - np.argmin(cost[::-1]))

    def place(self, piece: Piece) -> Iterator[list[Piece]]:
        """Yields the windows that this piece completes."""
        while piece.length > self.capacity:
            head, piece = piece.cut(self.capacity)
            yield [head]
        if piece.length == self.capacity:
            yield [piece]
            return
        h = self.level(piece.length)
        window = self._take(h) if h else []
        window.append(piece)
        fill = h + piece.length
        if fill == self.capacity:
            yield window
            return
        self.levels[fill] += 1
        self.windows[fill].append(window)
        self.n_open += 1
        while self.n_open > self.open_windows:
            yield from self._top_up()

    def _take(self, level: int) -> list[Piece]:
        self.levels[level] -= 1
        self.n_open -= 1
        return self.windows[level].pop()

    def _top_up(self) -> Iterator[list[Piece]]:
        """Tokens of the emptiest window go to the fullest, which leaves if that fills it."""
        held = np.flatnonzero(self.levels)
        fill, least = int(held[-1]), int(held[0])
        window, other = self._take(fill), self._take(least)
        lacks = min(self.capacity - fill, least)
        fill, least = fill + lacks, least - lacks
        while lacks:
            piece = other.pop()
            if piece.length > lacks:
                piece, rest = piece.cut(lacks)
                other.append(rest)
            window.append(piece)
            lacks -= piece.length
        if fill == self.capacity:
            yield window
        for level, w in ((fill, window), (least, other)):
            if 0 < level < self.capacity:
                self.levels[level] += 1
                self.n_open += 1
                self.windows[level].append(w)

    def flush(self) -> Iterator[list[Piece]]:
        while self.n_open > 1:
            yield from self._top_up()
        if not self.n_open:
            return
        left = int(np.flatnonzero(self.levels)[0])
        pieces = self._take(left)[::-1]
        while left:
            size = 1 << (left.bit_length() - 1)
            window, room = [], size
            while room:
                piece = pieces.pop()
                if piece.length > room:
                    piece, rest = piece.cut(room)
                    pieces.append(rest)
                window.append(piece)
                room -= piece.length
            yield window
            left -= size


def _rows(windows: Iterable[list[Piece]], first: int) -> tuple[list[tuple], int]:
    rows = []
    for window in windows:
        at = 0
        for p in window:
            rows.append((p.doc_id, p.start, p.length, zlib.crc32(p.ids), p.doc_tokens, first, at))
            at += p.length
        first += 1
    return rows, first


def pack(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, start (ids of its document before it), length, ids_crc32, doc_tokens, sequence_id, offset.

    Each task packs the rows of its own input split as it reads them, so there is no shuffle, and memory doesn't grow with the
    split. Only the last windows of a split fall short of capacity; their sizes are powers of two, which need no padding.
    A null or empty text is the end id alone. Equal rows are packed each for itself; a null id stays null; an empty table gives
    no rows; no other column is read. sequence_id is unique over all tasks: the task's partition number is in its upper bits,
    so a task that runs again gives the same ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, packer = WordEncoder.of(tokenizer, "byte"), SumOfSquaresPacker(capacity)
        first = TaskContext.get().partitionId() << 36

        def placed(ids: list, texts: list[str]) -> Iterator[list[Piece]]:
            for i, b in zip(ids, encoder.encode(texts, end_id)):
                yield from packer.place(Piece(i, 0, memoryview(b), len(b) // 4))

        for ids, texts in slices(batches):
            rows, first = _rows(placed(ids, texts), first)
            if rows:
                yield to_batch(_ARROW, list(zip(*rows)))
        rows, first = _rows(packer.flush(), first)
        if rows:
            yield to_batch(_ARROW, list(zip(*rows)))

    return text_of(docs, id_col, text_col).mapInArrow(run, SCHEMA)
