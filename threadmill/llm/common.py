"""Helpers that the corpus operators share."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Text handled at once inside a task, in characters; bounds a worker's memory whatever Arrow batch it is handed.
SLICE_CHARS = 2_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share.

    The cluster names it in spark.checkpoint.dir; where that is unset on one machine (tests), it is /tmp/checkpoints."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "/tmp/checkpoints"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Sessions that write at the moment: how many writes, and the setting before the first of them.
_writing: dict[int, tuple[int, str | None]] = {}
_lock = threading.Lock()


@contextmanager
def _dropping_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that end in here are dropped at once; writes side by side in one session share the setting."""
    with _lock:
        n, before = _writing.get(id(spark), (0, spark.conf.get(_CLEANUP, None)))
        _writing[id(spark)] = n + 1, before
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            n, before = _writing.pop(id(spark))
            if n > 1:
                _writing[id(spark)] = n - 1, before
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: cuts the lineage, and outlives the executors that made it.

    The shuffle files behind it aren't needed any more then, and are dropped at once."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    with _dropping_shuffle_files(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes the files of a table that stored() made, once nothing reads it any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def unused(name: str, columns: Iterable[str]) -> str:
    """name, or it with marks behind, so that no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns, doc_id and text; a null text counts as empty. Other columns, whatever their names, are left out."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of the batches' rows, about SLICE_CHARS of text at a time."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for i, t in zip(batch.column(0), batch.column(1)):
            i, t = i.as_py(), t.as_py() or ""
            ids.append(i)
            texts.append(t)
            size += len(t)
            if size >= SLICE_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def to_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


# What follows encodes texts with a file of the tokenizers library. Such a tokenizer first cuts a text into words and then works
# on each alone, so a text's ids are those of its words, and most words recur. Texts of ASCII and Latin letters are cut here as
# the tokenizer would; others only after white space, where none of these tokenizers has a word that goes on.

_CHUNK = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
#: \x1c-\x1f are white space to Python's re but not to the tokenizers.
_ODD = re.compile(r"[^\x00-\x1b\x20-\x7fÀ-ÖØ-öø-ɏ]")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_WORDS = {
    "byte": re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+"),
    "word": re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+"),
}
#: Words whose ids a worker remembers, and their ids in all.
CACHE_ENTRIES, CACHE_IDS = 400_000, 8_000_000
CACHED_CHARS = 48
_END = "</w>"


class _Index(dict):
    """Numbers of words in the order of their first lookup; new lists the words numbered since it was last emptied."""

    def __init__(self) -> None:
        super().__init__()
        self.n, self.new = 0, []

    def __missing__(self, word: str) -> int:
        k = self[word] = self.n
        self.n = k + 1
        self.new.append(word)
        return k


class WordEncoder:
    """Ids of texts as little-endian integers, equal to Tokenizer.encode(text, add_special_tokens=False).

    kind: "byte" for byte-level BPE whose words may begin with a blank, "word" for lower-case BPE whose words end in </w>.
    A word is looked up once, in a table that gives its number; ids of all words stand in one array, from which those of many
    texts are gathered at once."""

    _made: dict = {}

    def __init__(self, path: str, kind: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.kind = Tokenizer.from_file(path), kind
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # The model alone, for words that are cut already: one a line.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\n", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        #: Bytes that each id stands for.
        self.size = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for t, k in vocabulary.items():
            self.size[k] = len(t.removesuffix(_END) if kind == "word" else t)
        self._forget()

    def _forget(self) -> None:
        self.index = _Index()
        self.start, self.count, self.flat, self.n_flat = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.uint32), 0

    @classmethod
    def of(cls, path: str, kind: str) -> WordEncoder:
        """One for each worker process."""
        key = (path, kind)
        if key not in cls._made:
            cls._made[key] = cls(path, kind)
        return cls._made[key]

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of texts, one after another, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.array([len(x) for x in found], np.int64)
        return np.fromiter((k for x in found for k in x), np.uint32, int(count.sum())), count

    def _word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """_ids() of single words: encoded as one text, and told apart by how many bytes their ids stand for."""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for k in range(0, len(words), 20_000):
            some = words[k : k + 20_000]
            joined = "\n".join(some)
            got = np.array(self.model.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
            # Without a character beyond ASCII a word has as many bytes as characters.
            ends = np.cumsum(list(map(len, some)) if joined.isascii() else [len(w.encode()) for w in some])
            at = np.cumsum(self.size[got])
            stops = np.searchsorted(at, ends) + 1
            if not len(at) or at[-1] != ends[-1] or (at[stops - 1] != ends).any():
                got, count = self._ids(some)
            else:
                count = np.diff(stops, prepend=0)
            ids.append(got)
            counts.append(count)
        return np.concatenate(ids), np.concatenate(counts)

    def _learn(self, new: list[str], chunks: set[str]) -> None:
        """Appends the ids of new words, whose numbers follow each other; chunks among them may hold several words."""
        plain = [w not in chunks and "\n" not in w for w in new] if chunks or any("\n" in w for w in new) else []
        ids, count = self._word_ids([w for w, p in zip(new, plain) if p] if plain else new)
        if not all(plain):
            is_plain = np.array(plain)
            more, more_count = self._ids([w for w, p in zip(new, plain) if not p])
            total = np.zeros(len(new), np.int64)
            total[is_plain], total[~is_plain] = count, more_count
            own = np.repeat(is_plain, total)
            every = np.zeros(int(total.sum()), np.uint32)
            every[own], every[~own] = ids, more
            ids, count = every, total
        first, n = self.index.n - len(new), self.n_flat + len(ids)
        if self.index.n > len(self.start):
            room = 2 * self.index.n
            self.start, self.count = (np.concatenate((x[:first], np.zeros(room - first, np.int64))) for x in (self.start, self.count))
        if n > len(self.flat):
            self.flat = np.concatenate((self.flat[: self.n_flat], np.zeros(2 * n - self.n_flat, np.uint32)))
        self.flat[self.n_flat : n] = ids
        self.count[first : self.index.n] = count
        self.start[first : self.index.n] = self.n_flat + np.cumsum(count) - count
        self.n_flat = n

    def encode_all(self, texts: list[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another (unsigned 32-bit), the end id after each if one is given, and how many each text has."""
        if self.index.n > CACHE_ENTRIES or self.n_flat > CACHE_IDS:
            self._forget()
        number, words, sizes, chunks, cut_words = self.index.__getitem__, [], [], set(), _WORDS[self.kind].findall
        for t in texts:
            # A text with a special token is one chunk.
            whole = any(s in t for s in self.special)
            if whole or _ODD.search(t):
                cut = [t] if whole else _CHUNK.findall(t)
                chunks.update(cut)
            else:
                cut = cut_words(t.lower() if self.kind == "word" else t)
            sizes.append(len(cut))
            words += map(number, cut)
        new, self.index.new = self.index.new, []
        if new:
            self._learn(new, chunks)
        of = np.array(words, np.int64)
        count = self.count[of]
        sums = np.concatenate(([0], np.cumsum(count)))
        ids = self.flat[np.repeat(self.start[of] - sums[:-1], count) + np.arange(sums[-1])]
        for w in new:
            if len(w) > CACHED_CHARS:
                del self.index[w]
        stops = np.cumsum(sizes, dtype=np.int64)
        per = sums[stops] - sums[stops - sizes] if texts else stops
        if end is None:
            return ids, per
        closed = np.full(len(ids) + len(texts), end, np.uint32)
        closed[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), per)] = ids
        return closed, per + 1

    def encode(self, texts: list[str], end: int | None = None) -> list[bytes]:
        """Little-endian ids of each text."""
        ids, per = self.encode_all(texts, end)
        raw, stops = ids.astype("<u4").tobytes(), (4 * np.cumsum(per)).tolist()
        return [raw[a:b] for a, b in zip([0, *stops], stops)]
