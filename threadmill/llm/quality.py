"""Quality grades by ordinal regression: one weight for each hashed text feature, ordered thresholds between the grades."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices, text_of, to_batch

#: Places of the hashed features.
DIMENSIONS = 1 << 18
#: The labelled rows that a model is fitted on: at most so many, those of the smallest hash of doc_id.
SAMPLE = 8000
#: A document is kept from this probability of the highest grade on.
KEEP = 0.5
GRADES = 3
#: Regularisation, with the L1 term: a feature that fewer rows of the labelled sample have keeps weight 0.
LEAST_ROWS = 12

#: Lengths of the word beginnings that are features too: one stem stands in many forms.
STEMS = (4, 5)

_WORD = re.compile(r"[^\W\d_]+")
_MARKS = re.compile(r"[^\w\s]+")
#: Upper ends of the bins in which shares are features.
_BINS = (0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75)
_place: dict[str, int] = {}


def _hashed(name: str) -> int:
    k = _place.get(name)
    if k is None:
        if len(_place) > 300_000:
            _place.clear()
        k = zlib.crc32(name.encode("utf-8", "surrogatepass")) % DIMENSIONS
        if len(name) <= 64:  # longer ones aren't remembered
            _place[name] = k
    return k


def _share(name: str, part: int, whole: int) -> str:
    x = part / max(1, whole)
    return f"\0{name}:{next((k for k, b in enumerate(_BINS) if x < b), len(_BINS))}"


def features(text: str) -> np.ndarray:
    """Places of the features that a whole text has: its words in lower case, their beginnings, and bins of what marks prose off from other text
    (shares of repeated neighbours, of different words, of words in capitals, of blanks, of each run of marks, and the words' number)."""
    raw = _WORD.findall(text)
    words = list(map(str.lower, raw))
    distinct = set(words)
    stems = {w[:k] + "*" for k in STEMS for w in distinct if len(w) > k}
    found = list(map(_hashed, distinct | stems))
    n = len(words)
    marks: dict[str, int] = {}
    for m in _MARKS.findall(text):
        marks[m] = marks.get(m, 0) + 1
    shares = [
        _share("repeat", sum(map(eq, words, words[1:])), n),
        _share("distinct", len(distinct), n),
        _share("upper", sum(map(str.isupper, raw)), n),
        _share("letters", sum(map(len, words)), len(text)),
        f"\0length:{min(n, 1 << 20).bit_length()}",
        *[_share(f"marks {m}", c, n) for m, c in marks.items()],
    ]
    return np.array(sorted({*found, *map(_hashed, shares)}), dtype=np.int32)


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, places: list[np.ndarray]) -> np.ndarray:
        size = np.array([len(p) for p in places])
        at = np.concatenate(places) if len(places) else np.zeros(0, np.int32)
        return np.bincount(np.repeat(np.arange(len(places)), size), self.weights[at], len(places))

    def tails(self, score: np.ndarray) -> np.ndarray:
        """Probability of more than each grade but the last: a column for each threshold."""
        return _sigmoid(score[:, None] - self.thresholds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(places: list[np.ndarray], grades: np.ndarray, n_grades: int = GRADES, sparse: float = 4e-4, steps: int = 200, least_rows: int = LEAST_ROWS) -> Model:
    """Cumulative-link logistic regression: P(grade > j) = sigmoid(w.x - threshold j).

    Proximal steps over all rows; an L1 term keeps weights of chance features at 0, and so does least_rows. Deterministic."""
    n = len(places)
    size = np.array([len(p) for p in places], dtype=np.int64)
    every = np.concatenate(places) if n else np.zeros(0, np.int32)
    used = np.flatnonzero(np.bincount(every, minlength=DIMENSIONS) >= least_rows)
    short = np.full(DIMENSIONS, -1)
    short[used] = np.arange(len(used))
    row, col = np.repeat(np.arange(n), size), short[every]
    row, col = row[col >= 0], col[col >= 0]
    share = np.array([(grades > j).mean() if n else 0.5 for j in range(n_grades - 1)]).clip(1e-3, 1 - 1e-3)
    # Thresholds are free but for their order: the first one, and logarithms of the gaps.
    start = -np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(start), 0.05))
    w, first = np.zeros(len(used)), start[0]
    # Steps as Adam takes them: features differ a thousandfold in how often they occur.
    push, square, push_t, square_t = np.zeros_like(w), np.zeros_like(w), np.zeros(n_grades - 1), np.zeros(n_grades - 1)
    low, high = grades > 0, grades < n_grades - 1
    for step in range(1, steps + 1) if n and len(np.unique(grades)) > 1 else ():
        t = first + np.concatenate(([0], np.cumsum(np.exp(gaps))))
        s = np.bincount(row, w[col], n)
        tail = _sigmoid(s[:, None] - t)
        a = np.where(low, tail[np.arange(n), np.maximum(grades - 1, 0)], 1.0)
        b = np.where(high, tail[np.arange(n), np.minimum(grades, n_grades - 2)], 0.0)
        g = np.bincount(col, (a + b - 1)[row] / n, len(used))
        p = np.maximum(a - b, 1e-9)
        gt = np.bincount(np.maximum(grades - 1, 0), np.where(low, a * (1 - a) / p, 0), n_grades - 1)[: n_grades - 1] / n
        gt -= np.bincount(np.minimum(grades, n_grades - 2), np.where(high, b * (1 - b) / p, 0), n_grades - 1)[: n_grades - 1] / n
        gt = np.concatenate(([gt.sum()], np.exp(gaps) * (gt.sum() - np.cumsum(gt)[:-1])))
        push, square = 0.9 * push + 0.1 * g, 0.99 * square + 0.01 * g * g
        push_t, square_t = 0.9 * push_t + 0.1 * gt, 0.99 * square_t + 0.01 * gt * gt
        size_w = 0.1 / (np.sqrt(square / (1 - 0.99**step)) + 1e-4) * (1 - 0.5 * step / steps)
        w = w - size_w * push / (1 - 0.9**step)
        w = np.sign(w) * np.maximum(np.abs(w) - size_w * sparse, 0)
        move = 0.05 * (push_t / (1 - 0.9**step)) / (np.sqrt(square_t / (1 - 0.99**step)) + 1e-6)
        first, gaps = first - move[0], gaps - move[1:]
    weights = np.zeros(DIMENSIONS)
    weights[used] = w
    return Model(weights, first + np.concatenate(([0], np.cumsum(np.exp(gaps)))))


def graded(labels: DataFrame) -> DataFrame:
    """doc_id and grade: 0 of bad quality, 1 good but toxic, 2 good. Of several rows of a document the worst counts; rows without
    doc_id or quality don't."""
    bad = F.col("quality") < 1
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) > 0
    grade = F.when(bad, 0).when(toxic, 1).otherwise(2)
    return labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min(grade).alias("grade"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fits on at most `sample` labelled documents, those of the smallest hashes of doc_id; what comes to the driver and is
    broadcast is bounded by that number.

    Of rows that repeat a doc_id the one of the smallest hash of text (then the smallest text) counts, so the fit is the same
    however rows are dealt. A null or empty text has the features of no words; without labelled rows all weights are 0; no other
    column is read."""
    chosen = graded(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = text_of(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
    one = rows.groupBy("doc_id", "grade").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")).select("doc_id", F.col("first.text").alias("text"), "grade")
    # Places come as bytes: lists of numbers would take the driver many times the room.
    schema = pa.schema([("doc_id", pa.int64()), ("grade", pa.int32()), ("places", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                yield to_batch(schema, [part.column(0), part.column(2), [features(t).tobytes() for t in part.column(1).to_pylist()]])

    got = sorted(one.mapInArrow(run, "doc_id long, grade int, places binary").collect(), key=lambda r: r.doc_id)
    return fit([np.frombuffer(r.places, dtype=np.int32) for r in got], np.array([r.grade for r in got], dtype=np.int64))


def score(docs: DataFrame, model: Model, keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, expected_grade, p_top (probability of the highest grade) and keep of every row; whole texts, no shuffle.

    A null or empty text is scored by the features it has (no words); equal texts score the same; a null id stays null; an
    empty table gives no rows."""
    schema = pa.schema([("doc_id", pa.int64()), ("expected_grade", pa.float64()), ("p_top", pa.float64()), ("keep", pa.bool_())])
    small = Model(model.weights.astype(np.float32), model.thresholds)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            tails = small.tails(small.score([features(t) for t in texts]))
            yield to_batch(schema, [ids, np.round(tails.sum(axis=1), 6), np.round(tails[:, -1], 6), tails[:, -1] >= keep])

    return text_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, expected_grade double, p_top double, keep boolean")


def kept(docs: DataFrame, model: Model, keep: float = KEEP, text_col: str = "text") -> DataFrame:
    """docs without the rows that score() rejects; all columns stay, whatever their names, and values too (nulls stay null).

    A null or empty text is judged by the features it has (no words), equal texts alike, so repeated rows stay or go together; an
    empty table gives no rows."""
    small = Model(model.weights.astype(np.float32), model.thresholds)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                tails = small.tails(small.score([features(t or "") for t in part.column(k).to_pylist()]))
                yield part.filter(pa.array(tails[:, -1] >= keep))

    return docs.mapInArrow(run, docs.schema)
