"""Near duplicates by DartMinHash: weighted signatures of five-word shingles, banded joining, exact verification, components.

A shingle that a text has c times is an element of weight c, seen as c regions of weight 1. Darts fall on each region as a Poisson
process over the rank axis whose seeds are the region's hash, so all documents with that region see the same darts; each dart has
one of K coordinates, and a document keeps the earliest dart of each. Two documents keep the same dart at a coordinate with a
probability of their weighted Jaccard similarity. Only ranks up to about (ln K + c) / weight are thrown: a document costs its
shingles and K ln K darts, not their product.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import discard, slices, stored, text_of, to_batch, unused

WORDS = 5
SIMILARITY = 0.8
#: Bands and darts in each: at a similarity of 0.8 a pair shares no band with probability (1 - 0.8**5)**26, 0.00003.
BANDS, ROWS = 26, 5
_LAST = 2**63 - 1

_U = np.uint64
_BYTES = np.random.Generator(np.random.PCG64(20240501)).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit hashes of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's shingles with their copy's number mixed in, and how many each text has.

    Words lie between white space of ASCII; a text of fewer words than a shingle has one of all its words, an empty one none."""
    raw = [t.encode("utf-8", "surrogatepass") + b" " for t in texts]
    b = np.frombuffer(b"".join(raw), np.uint8)
    stops = np.cumsum([len(r) for r in raw])
    blank = (b == 32) | ((b >= 9) & (b <= 13))
    inside = ~blank
    begin = np.flatnonzero(inside & np.concatenate(([True], blank[:-1]))) if len(b) else np.zeros(0, np.int64)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    end = np.flatnonzero(inside & np.concatenate((blank[1:], [True]))) + 1
    size = end - begin
    powers = np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64)
    powers = np.cumprod(powers)
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    word = mixed(np.add.reduceat(_BYTES[b[inside]] * powers[place], np.cumsum(size) - size) ^ size.astype(np.uint64))
    doc = np.searchsorted(stops, begin, side="right")
    count = np.bincount(doc, minlength=len(texts))
    whole = np.zeros(len(word), np.uint64)
    for k in range(min(words, len(word))):
        part = word * _U((0xD6E8FEB86659FD93 * (2 * k + 1)) % 2**64)
        whole[: len(word) - k] += part[k:] if k else part
    first = np.cumsum(count) - count
    starts = np.arange(len(word)) - first[doc] <= (count - words)[doc]
    short = (count < words) & (count > 0)
    if short.any():
        for d in np.flatnonzero(short):
            own = word[first[d] : first[d] + count[d]]
            whole[first[d]] = sum(int(w) * (0xD6E8FEB86659FD93 * (2 * k + 1)) for k, w in enumerate(own)) % 2**64
            starts[first[d]] = True
    found, of = mixed(whole[starts]), doc[starts]
    order = np.lexsort((found, of))
    found, of = found[order], of[order]
    fresh = np.concatenate(([True], (found[1:] != found[:-1]) | (of[1:] != of[:-1])))
    at = np.arange(len(found))
    copy = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return np.where(copy > 0, mixed(found + copy.astype(np.uint64) * _U(0xA0761D6478BD642F)), found), np.bincount(of, minlength=len(texts))


def _exponential(seed: np.ndarray) -> np.ndarray:
    return -np.log(((mixed(seed) >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53)


def signatures(regions: np.ndarray, count: np.ndarray, k: int = BANDS * ROWS) -> np.ndarray:
    """The earliest dart of each coordinate, a row for each document; zeros for a document without shingles."""
    out = np.zeros((len(count), k), np.uint64)
    todo, reach = np.flatnonzero(count > 0), np.log(k) + 3
    first = np.cumsum(count) - count
    while len(todo):
        n = count[todo]
        doc = np.repeat(np.arange(len(todo)), n)
        h = regions[np.repeat(first[todo] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        limit = (reach / n)[doc]
        rank, docs, darts, ranks, step = np.zeros(len(h)), [], [], [], 0
        while len(h):
            seed = h + _U((step * 0xE7037ED1A0B428DB + 0x8EBC6AF09C88C6E3) % 2**64)
            rank = rank + _exponential(seed) / k
            near = rank <= limit
            h, rank, limit, doc = h[near], rank[near], limit[near], doc[near]
            docs.append(doc)
            ranks.append(rank)
            darts.append(mixed(seed[near] ^ _U(0x589965CC75374CC3)))
            step += 1
        doc, dart, rank = np.concatenate(docs), np.concatenate(darts), np.concatenate(ranks)
        cell = doc * k + ((dart >> _U(20)) % _U(k)).astype(np.int64)
        order = np.argsort(-rank, kind="stable")
        kept, hit = np.zeros(len(todo) * k, np.uint64), np.zeros(len(todo) * k, bool)
        kept[cell[order]] = dart[order]  # the earliest comes last and stays
        hit[cell] = True
        full = hit.reshape(-1, k).all(axis=1)
        out[todo[full]] = kept.reshape(-1, k)[full]
        todo, reach = todo[~full], reach * 2
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    keys = np.zeros((len(signature), bands), np.uint64)
    for r in range(rows):
        keys = mixed(keys * _U(3) + signature[:, r::rows][:, :bands] + _U(r))
    return mixed(keys + np.arange(bands, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def _digests(regions: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each document's weighted set, whatever its order."""
    ends = np.concatenate(([0], np.cumsum(count)))
    sums = []
    for salt in (0x2545F4914F6CDD1D, 0x632BE59BD9B4E019):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(regions ^ _U(salt)), dtype=np.uint64)))
        sums.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
    return sums[0], sums[1]


_FEATURES = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("n", pa.int64()), ("bands", pa.list_(pa.int64()))])


def _features(docs: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(2).to_pylist()
            at = 0
            for ids, texts in slices([batch]):
                regions, count = shingles(texts)
                d1, d2 = _digests(regions, count)
                keys = band_keys(signatures(regions, count)).view(np.int64)
                yield to_batch(_FEATURES, [ids, numbers[at : at + len(ids)], d1, d2, count, list(keys)])
                at += len(ids)

    return docs.mapInArrow(run, "doc_id long, row long, d1 long, d2 long, n long, bands array<long>")


_SETS = pa.schema([("node", pa.int64()), ("regions", pa.list_(pa.int64()))])


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, regions for the wanted nodes: their documents' texts are read once more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            more = list(zip(*[batch.column(c).to_pylist() for c in (2, 3, 4)]))
            at = 0
            for _, texts in slices([batch]):
                regions, count = shingles(texts)
                own = np.split(regions.view(np.int64), np.cumsum(count)[:-1])
                rows = [(node, r) for (node, a, b), r, d1, d2 in zip(more[at : at + len(texts)], own, *_digests(regions, count)) if (a, b) == (d1, d2)]
                at += len(texts)
                if rows:
                    yield to_batch(_SETS, list(zip(*rows)))

    both = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["rep_doc"])).select(docs["doc_id"], "text", "node", "d1", "d2")
    return both.mapInArrow(run, "node long, regions array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity is that or more."""
    one = sets.select(F.col("node").alias("b"), F.col("regions").alias("rb"))
    two = sets.select(F.col("node").alias("a"), F.col("regions").alias("ra"))
    both = pairs.join(one, "b").join(two, "a")
    common = F.size(F.array_intersect("ra", "rb"))
    return both.filter(common >= similarity * (F.size("ra") + F.size("rb") - common)).select("a", "b").distinct()


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
#: Nodes of a bucket that one task compares with others at a time.
BLOCK = 256


def linked(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> Iterator[tuple[int, int]]:
    """Pairs (of left, of right) of sets whose similarity is that or more; every left set is looked up in all right ones at once."""
    size = np.array([len(r) for r in right])
    every, owner = np.concatenate(right), np.repeat(np.arange(len(right)), size)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    for k, own in enumerate(left):
        lo, hi = np.searchsorted(every, own, "left"), np.searchsorted(every, own, "right")
        n = hi - lo
        hit = owner[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        common = np.bincount(hit, minlength=len(right))
        for j in np.flatnonzero(common >= similarity * (len(own) + size - common)):
            yield k, int(j)


def _across(split: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links between nodes of one bucket that have different labels. split: band, node, label of buckets with several labels.

    In each bucket the label that most nodes have is set apart; the nodes of others (few, as a rule) meet all nodes, and none of
    that label meets another. Nodes meet in blocks of about BLOCK, a group for each two blocks, so a group's size is bounded
    whatever the bucket's; each set is sent once for each block of the others, not once for each pair."""
    counts = split.groupBy("band", "label").agg(F.count("*").alias("c"))
    per = counts.groupBy("band").agg(F.max_by("label", F.struct("c", "label")).alias("most"), F.sum("c").alias("m"), F.max("c").alias("c"))
    known = split.join(per, "band").withColumn("odd", F.col("label") != F.col("most"))
    rows, columns = (F.greatest(F.lit(1), F.ceil(x / BLOCK)).cast("int") for x in (F.col("m") - F.col("c"), F.col("m")))
    place = F.abs(F.xxhash64("node"))
    as_row = known.filter("odd").select("band", "node", "label", F.lit(True).alias("first"), (place % rows).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), columns - 1)).alias("j"))
    as_column = known.select("band", "node", "label", F.lit(False).alias("first"), F.explode(F.sequence(F.lit(0), rows - 1)).alias("i"), (place % columns).cast("int").alias("j"))
    dealt = as_row.unionByName(as_column).join(sets.select("node", "regions"), "node")

    def run(table: pa.Table) -> pa.Table:
        node, label, first = (np.asarray(table.column(c)) for c in ("node", "label", "first"))
        regions = [np.sort(np.asarray(r.values)) for r in table.column("regions")]
        left, right = np.flatnonzero(first), np.flatnonzero(~first)
        found = []
        if len(left) and len(right):
            for k, j in linked([regions[x] for x in left], [regions[x] for x in right], similarity):
                x, y = left[k], right[j]
                if label[x] != label[y]:
                    found.append((min(node[x], node[y]), max(node[x], node[y])))
        return pa.Table.from_batches([to_batch(_LINKS, list(zip(*found)) or [[], []])], _LINKS)

    return dealt.groupBy("band", "i", "j").applyInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node that it is connected to; and old, the same) for all nodes of links (a, b).

    Each round takes the least label around and then the label's own label, so chains halve; labels stay in stored tables."""
    edges = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        around = edges.join(labels.select("node", "label"), edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("around"))
        near = labels.join(around, labels["node"] == around["a"], "left").select("node", F.col("label").alias("old"), F.least("label", "around").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = stored(near.join(up, "label", "left").select("node", "old", F.least("label", "up").alias("label")), "labels")
        discard(labels)
        if not new.filter("label <> old").limit(1).count():
            discard(edges)
            return new
        labels = new


def classes(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, class_id (the smallest doc_id of its class), class_size, kept, and row (row_col, or a
    number made here that no other read of docs repeats for sure).

    Documents whose weighted sets of shingles are equal are one node, however many; nodes are compared where they share a band:
    first each with the smallest of its bucket, which joins large groups without their pairs, then, in blocks, those that are not
    of their bucket's largest class with all others, so no link is lost that a bucket shows. Each comparison is exact. A class is a connected
    component. Its kept row is that of the smallest doc_id; of rows that agree in it, one. A null or empty text has no shingle;
    such rows are one class. A null id counts as the largest. An empty table gives no rows; no other column is read."""
    plain = text_of(docs, id_col, text_col)
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = stored(_features(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), row.alias("row"))), "features")
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("by"), "row", "doc_id"))
    nodes = rows.groupBy("d1", "d2", "n").agg(first.alias("rep"), F.count("*").alias("copies"))
    nodes = stored(nodes.select("d1", "d2", "n", "rep", "copies", F.col("rep.doc_id").alias("rep_doc"), F.monotonically_increasing_id().alias("node")), "nodes")
    banded = rows.join(nodes.select("node", F.col("rep.row").alias("row")), "row").filter("n > 0").select("node", "n", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("c")).filter("c > 1").drop("c")
    buckets = stored(banded.join(shared, "band"), "buckets")
    pairs = stored(buckets.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    wanted = nodes.join(buckets.select("node").distinct(), "node", "left_semi").select("node", "rep_doc", "d1", "d2")
    sets = stored(_sets(plain, wanted), "sets")
    links = stored(_verified(pairs, sets, similarity), "links")
    labels = components(links)
    discard(pairs)
    known = buckets.join(labels.select("node", "label"), "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    mixed_up = known.groupBy("band").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least <> most").select("band")
    split = stored(known.join(mixed_up, "band", "left_semi"), "split")
    more = stored(_across(split, sets, similarity), "links")
    for t in (split, buckets, sets):
        discard(t)
    if more.limit(1).count():
        discard(labels)
        labels = components(links.union(more))
    named = nodes.join(labels.select("node", "label"), "node", "left").select("d1", "d2", "n", "rep", "copies", F.coalesce("label", "node").alias("label"))
    groups = stored(named.groupBy("label").agg(F.min("rep").alias("best"), F.sum("copies").alias("class_size")), "groups")
    place = stored(named.join(groups, "label").select("d1", "d2", "n", "best", "class_size"), "places")
    for t in (groups, labels, links, more, nodes):
        discard(t)
    return rows.join(place, ["d1", "d2", "n"]).select("doc_id", F.col("best.doc_id").alias("class_id"), "class_size", (F.col("best.row") == F.col("row")).alias("kept"), "row")


def without_near_copies(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each class; all columns stay, whatever their names, and the values of kept rows.

    docs is stored once with its row numbers, for classes() and for the join. Null and empty texts are one class; of rows that
    agree in id and text one stays; a null id counts as the largest; an empty table gives no rows."""
    row = unused("_row", docs.columns)
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    kept = classes(numbered, similarity, id_col, text_col, row).filter("kept").select(F.col("row").alias(row))
    return numbered.join(kept, row, "left_semi").select(*docs.columns)
