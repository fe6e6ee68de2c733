"""Near-equal lines by deletion neighbourhoods: lines that share a variant are joined, verified, and the earliest is kept.

The edit bound is one character. A line's variants are itself and it less one character, as hashes. Lines of one length differ
in at most one character if they share a variant at the same place, and all lines that do are within the bound of each other, so
the earliest of them stands for their pairs. Lines whose lengths differ by one are within the bound if the shorter one is a
variant of the longer. Before variants are made, half-line keys tell which lines can have a partner at all: of two lines within
the bound, the halves on one side of the edit are equal, and variants are needed on its other side only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import discard, stored, to_batch

#: Characters from which lines are compared with others than equal ones: all are.
LEAST_CHARS = 1
_LAST = 2**63 - 1
_U = np.uint64
#: Which half-line key a partner was found by: own length and one less, first and second half.
OWN_FIRST, OWN_SECOND, LESS_FIRST, LESS_SECOND = 1, 2, 4, 8


def lines_of(text: str) -> Iterator[tuple[int, str]]:
    """Number and content of the lines that aren't blank; runs of white space in them count as one blank."""
    for k, line in enumerate(text.split("\n")):
        line = " ".join(line.split())
        if line:
            yield k, line


def half_keys(line: str) -> list[int]:
    """Keys that two lines within the bound share at least one of, in the order of the flags above."""
    import xxhash

    n, out = len(line), []
    for base in (n, n - 1):
        h = base // 2
        out.append(xxhash.xxh3_64_intdigest(f"{base} {line[:h]}".encode("utf-8", "surrogatepass"), 1))
        out.append(xxhash.xxh3_64_intdigest(f"{base} {line[n - base + h :]}".encode("utf-8", "surrogatepass"), 2))
    return out


_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)


def variants(line: str, flags: int) -> tuple[int, np.ndarray, np.ndarray]:
    """The line's own hash; hashes of it less a character with that character's place; hashes of it less a character."""
    from .near_dedup import mixed

    code = mixed(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(_U) + _U(0x51ED270B))
    n = len(code)
    power = np.cumprod(np.full(n, _BASE, _U))
    before = np.concatenate((np.zeros(1, _U), np.cumsum(code * power, dtype=_U)))
    less = before[:-1] + (before[-1] - before[1:]) * _U(_BACK)
    place = np.arange(n)
    at = np.zeros(n, bool)
    if flags & OWN_FIRST:
        at |= place >= n // 2
    if flags & OWN_SECOND:
        at |= place < n // 2
    same = mixed(less[at] + mixed(place[at].astype(_U) + _U(1)) + _U(n))
    at = np.zeros(n, bool)
    if flags & LESS_FIRST:
        at |= place >= (n - 1) // 2
    if flags & LESS_SECOND:
        at |= place <= (n - 1) // 2
    own, shorter = mixed(np.array([before[-1] + _U(n)])), np.unique(mixed(less[at] + _U(n - 1)))
    return int(own.view(np.int64)[0]), same.view(np.int64), shorter.view(np.int64)


_LINES = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("by", pa.int64()), ("text_hash", pa.int64()), ("line", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("keys", pa.list_(pa.int64()))])


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _lines(docs: DataFrame, least: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            rows: list[tuple] = []
            for row, i, by, text_hash, text in zip(*[c for c in batch.columns]):
                own = (row.as_py(), i.as_py(), by.as_py(), text_hash.as_py())
                for k, line in lines_of(text.as_py()):
                    h = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
                    keys = [_signed(x) for x in half_keys(line)] if len(line) >= least else []
                    rows.append((*own, k, _signed(h >> 64), _signed(h & 2**64 - 1), keys))
                if len(rows) >= 20_000:
                    yield to_batch(_LINES, list(zip(*rows)))
                    rows = []
            if rows:
                yield to_batch(_LINES, list(zip(*rows)))

    return docs.mapInArrow(run, "row long, doc_id long, by long, text_hash long, line long, h1 long, h2 long, keys array<long>")


_TEXTS = pa.schema([("node", pa.int64()), ("flags", pa.int32()), ("content", pa.string())])


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, flags, content of the wanted lines, cut from their documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, asked in zip(batch.column(0), batch.column(1)):
                place = {a["line"]: (a["node"], a["flags"]) for a in asked.as_py()}
                rows += [(*place[k], line) for k, line in lines_of(text.as_py()) if k in place]
            if rows:
                yield to_batch(_TEXTS, list(zip(*rows)))

    per = wanted.groupBy("by", "text_hash").agg(F.collect_list(F.struct("line", "node", "flags")).alias("asked")).withColumnsRenamed({"by": "_by", "text_hash": "_hash"})
    # The documents asked for grow with the input: never broadcast, also where a small input would allow it.
    both = docs.join(per.hint("merge"), (F.col("by") == F.col("_by")) & (F.col("text_hash") == F.col("_hash"))).select("text", "asked")
    return both.mapInArrow(run, "node long, flags int, content string")


def _variants(texts: DataFrame) -> DataFrame:
    schema = pa.schema([("node", pa.int64()), ("own", pa.int64()), ("same", pa.list_(pa.int64())), ("shorter", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = [(node, *variants(line, flags)) for node, flags, line in zip(*[c.to_pylist() for c in part.columns])]
                yield to_batch(schema, list(zip(*rows)))

    return texts.select("node", "flags", "content").mapInArrow(run, "node long, own long, same array<long>, shorter array<long>")


def _links(texts: DataFrame, made: DataFrame) -> DataFrame:
    """a, b, n: lines within the bound, b the first node of those that share a's variant; n: how many links of a that stands for."""
    same = made.select("node", F.explode("same").alias("key"))
    groups = same.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("c")).filter("c > 1")
    alike = same.join(groups, "key").select(F.col("node").alias("a"), F.col("first").alias("b"), (F.col("c") - 1).alias("n"))
    longer = made.select(F.col("node").alias("long"), F.explode("shorter").alias("own")).join(made.select(F.col("node").alias("short"), "own"), "own")
    both = longer.select(F.col("long").alias("a"), F.col("short").alias("b")).union(longer.select(F.col("short").alias("a"), F.col("long").alias("b")))
    pairs = alike.union(both.withColumn("n", F.lit(1).cast("long")))
    one, two = (texts.select(F.col("node").alias(c), F.col("content").alias(f"t{c}")) for c in "ab")
    return pairs.join(one, "a").join(two, "b").filter((F.col("a") == F.col("b")) | (F.levenshtein("ta", "tb", 1) == 1)).select("a", "b", "n")


def kept_lines(docs: DataFrame, least: int = LEAST_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each line that isn't blank: doc_id, line (its number in the text), keep_doc, keep_line, copies, n_links, kept.

    Lines are compared with runs of white space as one blank. keep_doc and keep_line name the earliest line (by doc_id, then
    place) that is equal or within one edited character; a line is kept if that is itself. copies counts equal lines, n_links the
    different lines within the bound. Lines of all lengths are compared; a caller may
    ask that those of fewer than `least` characters go by equality alone. A null or empty text has no
    lines; a null id counts as the largest; rows that repeat come one after another; an empty table gives no rows; no other
    column is read. A line that a third of all rows have is counted inside tasks before it is dealt out."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col), F.lit(_LAST)).alias("by"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    lines = stored(_lines(plain, least), "lines")
    first = F.min(F.struct("by", "row", "line", "doc_id", "text_hash")).alias("first")
    nodes = lines.groupBy("h1", "h2").agg(first, F.count("*").alias("copies"), F.first("keys").alias("keys"))
    nodes = stored(nodes.sortWithinPartitions("h1", "h2").withColumn("node", F.monotonically_increasing_id()), "nodes")
    keys = nodes.select("node", F.posexplode("keys").alias("k", "key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most").select("key")
    flags = keys.join(shared, "key").groupBy("node").agg(F.expr("cast(bit_or(shiftleft(1, k)) as int)").alias("flags"))
    wanted = stored(nodes.join(flags, "node").select("node", "flags", "first"), "wanted")
    # Those with a partner, perhaps, are numbered by their first occurrence: the least number of some is the earliest.
    ranked = stored(wanted.orderBy("first").withColumn("rank", F.monotonically_increasing_id()), "ranked")
    asked = ranked.select(F.col("rank").alias("node"), "flags", "first.by", "first.text_hash", "first.line")
    texts = stored(_texts(plain.select("by", "text_hash", "text"), asked).dropDuplicates(["node"]), "texts")
    made = stored(_variants(texts), "variants")
    near = stored(_links(texts, made).groupBy(F.col("a").alias("rank")).agg(F.min("b").alias("near"), F.sum("n").alias("n_links")), "near")
    discard(made)
    found = ranked.join(near, "rank").select("node", "near", "n_links").join(ranked.select(F.col("rank").alias("near"), F.col("first").alias("before")), "near")
    named = nodes.drop("keys").join(found, "node", "left")
    best = F.when(F.col("before") < F.col("first"), F.col("before")).otherwise(F.col("first"))
    named = stored(named.select("h1", "h2", "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), best.alias("best")), "named")
    for t in (nodes, wanted, ranked, texts, near):
        discard(t)
    itself = (F.col("best.row") == F.col("row")) & (F.col("best.line") == F.col("line"))
    return lines.join(named, ["h1", "h2"]).select("doc_id", "line", F.col("best.doc_id").alias("keep_doc"), F.col("best.line").alias("keep_line"), "copies", "n_links", itself.alias("kept"))
