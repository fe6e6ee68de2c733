"""Token ids in wavelet matrix files: one compressed file a shard, with access, counting and occurrence lookup.

A file is: the magic, a header (count of tokens, of documents, of distinct ids, of planes), then zstd frames of the alphabet
(sorted distinct ids), the documents' ids, presence of those ids and lengths, and of each bit-plane with its rank samples.
Each part's compressed size stands in the header, so a reader can take single planes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import WordEncoder, slices, stored, to_batch

MAGIC = b"TMWM0001"
END_ID = 1
#: Tokens after which a shard ends with the document at hand.
SHARD_TOKENS = 1 << 20
#: Bits between two rank samples.
SAMPLE = 512


class WaveletMatrix:
    """A sequence of symbols 0 <= s < 2**planes as bit-planes; each plane sorts the sequence stably by one bit, top bit first."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros
        self._samples: list[np.ndarray] | None = None

    @classmethod
    def build(cls, symbols: np.ndarray, width: int) -> WaveletMatrix:
        a, planes, zeros = symbols, [], []
        for level in reversed(range(width)):
            bit = (a >> level) & 1 == 1
            planes.append(np.packbits(bit))
            low = a.take(np.flatnonzero(~bit))
            zeros.append(len(low))
            a = np.concatenate((low, a.take(np.flatnonzero(bit))))
        return cls(len(symbols), planes, zeros)

    def _bits(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level], count=self.n).view(bool)

    def symbols(self) -> np.ndarray:
        """The whole sequence: the planes' sorts undone from the last to the first."""
        a = np.zeros(self.n, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        for k in reversed(range(len(self.planes))):
            bit, before = self._bits(k), np.empty_like(a)
            before[np.flatnonzero(~bit)] = a[: self.zeros[k]]
            before[np.flatnonzero(bit)] = a[self.zeros[k] :] | a.dtype.type(1 << (len(self.planes) - 1 - k))
            a = before
        return a

    def samples(self) -> list[np.ndarray]:
        """Per plane the count of ones before every SAMPLE bits."""
        if self._samples is None:
            self._samples = []
            for p in self.planes:
                ones = np.bitwise_count(np.pad(p, (0, -len(p) % (SAMPLE // 8)))).reshape(-1, SAMPLE // 8).sum(axis=1)
                self._samples.append(np.concatenate(([0], np.cumsum(ones))))
        return self._samples

    def rank(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        whole, plane = i // SAMPLE, self.planes[level]
        start, at = whole * SAMPLE // 8, i // 8
        count = int(self.samples()[level][whole]) + int(np.bitwise_count(plane[start:at]).sum())
        return count + (int(plane[at]) >> (8 - i % 8)).bit_count() if i % 8 else count

    def select(self, level: int, bit: int, k: int) -> int:
        """Where the k-th (from 0) such bit of a plane stands."""
        s = self.samples()[level]
        held = s if bit else np.minimum(np.arange(len(s)) * SAMPLE, self.n) - s
        block = int(np.searchsorted(held, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][block * SAMPLE // 8 : (block + 1) * SAMPLE // 8])
        return block * SAMPLE + int(np.flatnonzero(bits == bit)[k - int(held[block])])

    def access(self, i: int) -> int:
        s = 0
        for k in range(len(self.planes)):
            bit = int(self.planes[k][i // 8]) >> (7 - i % 8) & 1
            ones = self.rank(k, i)
            i = self.zeros[k] + ones if bit else i - ones
            s = s << 1 | bit
        return s

    def _range(self, s: int, lo: int, hi: int) -> tuple[int, int]:
        for k in range(len(self.planes)):
            a, b = self.rank(k, lo), self.rank(k, hi)
            lo, hi = (self.zeros[k] + a, self.zeros[k] + b) if s >> (len(self.planes) - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, s: int, lo: int, hi: int) -> int:
        lo, hi = self._range(s, lo, hi)
        return hi - lo

    def find(self, s: int, k: int) -> int:
        """Where the k-th (from 0) s stands, or -1."""
        lo, hi = self._range(s, 0, self.n)
        if not 0 <= k < hi - lo:
            return -1
        i = lo + k
        for level in reversed(range(len(self.planes))):
            bit = s >> (len(self.planes) - 1 - level) & 1
            i = self.select(level, bit, i - self.zeros[level] if bit else i)
        return i


def dump(ids: np.ndarray, doc_ids: list, lengths: list[int]) -> bytes:
    """The file's bytes of one shard."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=1).compress
    seen = np.zeros(int(ids.max()) + 1 if len(ids) else 0, dtype=bool)
    seen[ids] = True
    alphabet = np.flatnonzero(seen).astype(np.uint32)
    width = max(1, (len(alphabet) - 1).bit_length()) if len(alphabet) else 1
    names = np.zeros(len(seen), dtype=np.uint16 if width <= 16 else np.uint32)
    names[alphabet] = np.arange(len(alphabet), dtype=names.dtype)
    m = WaveletMatrix.build(names.take(ids), width)
    head = [alphabet.astype("<u4").tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is not None for d in doc_ids], "u1").tobytes(), np.array(lengths, "<u8").tobytes()]
    parts = [squeeze(x) for x in head] + [squeeze(np.uint64(z).tobytes() + s.astype("<u4").tobytes() + p.tobytes()) for z, s, p in zip(m.zeros, m.samples(), m.planes)]
    return b"".join([MAGIC, struct.pack("<QQQI", len(ids), len(doc_ids), len(alphabet), width), struct.pack(f"<{len(parts)}Q", *map(len, parts)), *parts])


class Shard:
    """A file read back."""

    def __init__(self, data: bytes):
        import zstandard

        if data[:8] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        self.n, n_docs, n_alphabet, width = struct.unpack_from("<QQQI", data, 8)
        at = 8 + struct.calcsize("<QQQI")
        sizes = struct.unpack_from(f"<{4 + width}Q", data, at)
        at += 8 * len(sizes)
        parts = []
        for s in sizes:
            parts.append(zstandard.decompress(data[at : at + s]))
            at += s
        self.alphabet = np.frombuffer(parts[0], "<u4")
        there = np.frombuffer(parts[2], "u1")
        self.doc_ids = [int(d) if t else None for d, t in zip(np.frombuffer(parts[1], "<i8"), there)]
        self.lengths = np.frombuffer(parts[3], "<u8").astype(np.int64)
        n_samples = -(-self.n // SAMPLE) + 1
        self.matrix = WaveletMatrix(self.n, [np.frombuffer(p, "u1", offset=8 + 4 * n_samples) for p in parts[4:]], [int(np.frombuffer(p, "<u8", count=1)[0]) for p in parts[4:]])
        self.matrix._samples = [np.frombuffer(p, "<u4", offset=8, count=n_samples).astype(np.int64) for p in parts[4:]]

    def ids(self) -> np.ndarray:
        return self.alphabet.take(self.matrix.symbols())

    def access(self, i: int) -> int:
        return int(self.alphabet[self.matrix.access(i)])

    def _symbol(self, token: int) -> int | None:
        k = int(np.searchsorted(self.alphabet, token))
        return k if k < len(self.alphabet) and self.alphabet[k] == token else None

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        s = self._symbol(token)
        return 0 if s is None else self.matrix.count(s, lo, self.n if hi is None else hi)

    def find(self, token: int, k: int) -> int:
        s = self._symbol(token)
        return -1 if s is None else self.matrix.find(s, k)


FILE_SCHEMA = "part long, shard long, start long, n_tokens long, content binary"
_FILE = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("content", pa.binary())])
_READ = pa.schema([(c, pa.int64()) for c in ("part", "doc_id", "start", "n_tokens", "ids_crc32")])


def write_shards(docs: DataFrame, tokenizer: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes texts in ascending doc_id order and stores wavelet matrix files; returns them as a table.

    The texts are dealt into ranges of doc_id and sorted there, then each task encodes its range and cuts it into shards of about
    shard_tokens tokens (a longer document makes a longer shard). A row holds one file: part and shard (its place in the
    order), start (tokens of this part before it), n_tokens, content. Executors share no folder but those that Spark writes to,
    so files travel as a binary column of a table in the shared folder; its rows can be saved as single files anywhere."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = WordEncoder.of(tokenizer, "word"), TaskContext.get().partitionId()
        held, doc_ids, lengths, n, start, shard = [], [], [], 0, 0, 0

        def file() -> pa.RecordBatch:
            ids = np.concatenate(held)
            return to_batch(_FILE, [[part], [shard], [start], [len(ids)], [dump(ids, doc_ids, lengths)]])

        for ids, texts in slices(batches):
            tokens, counts = encoder.encode_all(texts, end_id)
            stops, done = np.cumsum(counts), 0
            while done < len(ids):
                # Up to the document with which the shard at hand is full.
                at = int(stops[done] - counts[done])
                stop = min(len(ids), int(np.searchsorted(stops, at + shard_tokens - n)) + 1)
                held.append(tokens[at : stops[stop - 1]])
                doc_ids += ids[done:stop]
                lengths += counts[done:stop].tolist()
                n, done = n + int(stops[stop - 1]) - at, stop
                if n >= shard_tokens:
                    yield file()
                    held, doc_ids, lengths, n, start, shard = [], [], [], 0, start + n, shard + 1
        if doc_ids:
            yield file()

    kept = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = kept.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return stored(ordered.mapInArrow(run, FILE_SCHEMA), "wavelet")


def read_shards(files: DataFrame) -> DataFrame:
    """One row per document, from the files alone: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                shard = Shard(content.as_py())
                ids = shard.ids().astype("<u4")
                ends = np.cumsum(shard.lengths)
                crcs = [zlib.crc32(ids[e - k : e]) for e, k in zip(ends, shard.lengths)]
                yield to_batch(_READ, [[part] * len(ends), shard.doc_ids, start + ends - shard.lengths, shard.lengths, crcs])

    rows = files.select("part", "start", "content").mapInArrow(run, "part long, doc_id long, start long, n_tokens long, ids_crc32 long")
    # One row per part: the only thing that is put in order on one machine is as long as the list of parts.
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select(F.col("part").alias("of"), F.expr("coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0)").alias("before"))
    return rows.join(before, F.col("part") == F.col("of")).select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def encode_and_read(docs: DataFrame, tokenizer: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files, reads them back: one row per document with doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A null or empty text is the end id alone. Null ids come first; rows of one id are ordered by text, and equal rows are stored
    each for itself. An empty table gives no rows. No other column is read."""
    return read_shards(write_shards(docs, tokenizer, end_id, shard_tokens, id_col, text_col))
