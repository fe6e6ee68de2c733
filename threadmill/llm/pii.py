"""Personal data in whole texts: patterns propose, checksums confirm, words nearby move the score."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SLICE_CHARS, slices, text_of, to_batch

BASE_KINDS = ("email", "ip", "card", "phone")
#: In the order in which spans that start together are listed.
KINDS = (*BASE_KINDS, "iban", "card_near", "phone_near", "national_id", "secret")
_RANK = {k: n for n, k in enumerate(KINDS)}
#: A further span is kept if its score reaches this; base spans always are.
KEEP_SCORE = 0.6
#: Characters before and after a span in which context words count, and what one such word adds.
CONTEXT_CHARS, CONTEXT_ADDS = 48, 0.3

# Words that make a kind likelier when they stand nearby (English, German, French, Spanish).
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel"),
    "ip": ("ip", "address", "server", "host", "adresse"),
    "card": ("card", "credit", "visa", "mastercard", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "card_near": ("card", "credit", "visa", "mastercard", "amex", "karte", "carte", "tarjeta"),
    "phone_near": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono", "whatsapp"),
    "national_id": ("ssn", "social security", "national id", "passport", "sozialversicherung", "dni"),
    "secret": ("key", "secret", "token", "aws", "password"),
}

_AT = re.compile("@")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
#: Characters of an IBAN by country; that end is tried first, then all others.
_IBAN_CHARS = {"AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HU": 28, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SK": 24}
_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|ghp_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{16,64})(?![A-Za-z0-9])")
_PHONE_NEAR = re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])")
_STRIP = str.maketrans("", "", " -")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @: a local part reaches back as far as its characters do, or to the last match."""
    last = 0
    for at in _AT.finditer(text):
        a = at.start()
        if a < last:
            continue
        s = a
        while s > last and text[s - 1] in _LOCAL_CHARS:
            s -= 1
        if s < a and (m := _HOST.match(text, a + 1)):
            last = m.end()
            yield s, last


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        if run[0].count(".") >= 3:
            for m in _IP.finditer(text, run.start(), run.end()):
                if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in m[0].split(".")):
                    yield m.span()


def _digit_runs(text: str, least: int, most: int) -> Iterator[tuple[int, int, str]]:
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= least and least <= len(d := m[0].translate(_STRIP)) <= most:
            yield m.start(), m.end(), d


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                yield m.span()


def _base(text: str) -> Iterator[tuple[str, int, int, float]]:
    for s, e in _emails(text):
        yield "email", s, e, 0.9
    if any(d in text for d in "0123456789"):
        for s, e in _ips(text):
            yield "ip", s, e, 0.6
        for s, e, d in _digit_runs(text, 14, 19):
            if luhn(d):
                yield "card", s, e, 0.8
        for s, e in _phones(text):
            yield "phone", s, e, 0.7


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """From each head the end, where a word ends, at which the checksum is right: the country's, else the farthest."""
    last = 0
    for head in _IBAN_HEAD.finditer(text):
        if head.start() < last or not (m := _IBAN.match(text, head.start())):
            continue
        ends, n = [], 0
        for k, c in enumerate(m[0], m.start() + 1):
            n += c != " "
            if c != " " and n >= 15 and not (text[k : k + 1].isascii() and text[k : k + 1].isalnum()):
                ends.append((n != _IBAN_CHARS.get(head[0][:2]), -k))
        for _, k in sorted(ends):
            if mod97(text[m.start() : -k].replace(" ", "")):
                last = -k
                yield m.start(), last
                break


def _further(text: str) -> Iterator[tuple[str, int, int, float]]:
    for m in _SECRET.finditer(text):
        yield "secret", *m.span(), 0.7
    if not any(d in text for d in "0123456789"):
        return
    for s, e in _ibans(text):
        yield "iban", s, e, 0.8
    for s, e, d in _digit_runs(text, 12, 13):
        if luhn(d):
            yield "card_near", s, e, 0.3
    for m in _PHONE_NEAR.finditer(text):
        yield "phone_near", *m.span(), 0.4
    for m in _ID.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "national_id", *m.span(), 0.5


_NEAR = {k: re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, words))})(?!\w)") for k, words in CONTEXT.items()}


def _context(kind: str, text: str, start: int, end: int) -> float:
    near = (text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]).lower()
    return CONTEXT_ADDS * bool(_NEAR[kind].search(near))


def find(text: str) -> list[Span]:
    """All spans by start, then kind; offsets count code points, ends are exclusive.

    A span's score is its pattern's own, more if a word of CONTEXT stands nearby, 1 at most. Base kinds are kept at any score;
    a further kind is kept from KEEP_SCORE on and only where it doesn't overlap a base span."""
    base = [Span(k, s, e, min(1.0, x + _context(k, text, s, e))) for k, s, e, x in _base(text)]
    more = [Span(k, s, e, min(1.0, x + _context(k, text, s, e))) for k, s, e, x in _further(text)]
    base.sort(key=lambda x: (x.start, _RANK[x.kind]))
    # Of the base spans that begin before a span's end, none may reach past its start.
    starts, reach = [b.start for b in base], list(accumulate((b.end for b in base), max))
    clear = lambda m: not (k := bisect_left(starts, m.end)) or reach[k - 1] <= m.start
    more = [m for m in more if m.score >= KEEP_SCORE and clear(m)]
    return sorted(base + more, key=lambda x: (x.start, _RANK[x.kind]))


def redact(text: str, spans: Iterable[Span]) -> str:
    """Each span replaced by its kind in brackets; of overlapping spans the first stands for all."""
    out, at = [], 0
    for s in sorted(spans, key=lambda x: (x.start, -x.end)):
        if s.start >= at:
            out += text[at : s.start], f"[{s.kind.upper()}]"
        at = max(at, s.end)
    return "".join([*out, text[at:]])


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_FOUND = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))])


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end, score) of every row; no shuffle.

    A null or empty text has no spans; a null id stays null; equal rows are handled each for itself; an empty table gives no
    rows. No other column is read."""

    schema = pa.schema([_FOUND.field(0), _FOUND.field(2)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            yield to_batch(schema, [ids, [[x._asdict() for x in find(t)] for t in texts]])

    return text_of(docs, id_col, text_col).mapInArrow(run, f"doc_id long, spans {SPANS}")


def digest(found: DataFrame) -> DataFrame:
    """What op1 returns, from detect()'s spans: counts, the base spans' digest and all spans as text."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the personal data in its texts replaced; the other columns, whatever their names, their order and the rows stay.

    A null text stays null, an empty one empty; equal rows are handled each for itself; an empty table gives no rows. About
    SLICE_CHARS of text are held at a time."""

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            texts, first, size = [], 0, 0
            for n, t in enumerate(batch.column(k), 1):
                t = t.as_py()
                texts.append(None if t is None else redact(t, find(t)))
                size += len(t or "")
                if size >= SLICE_CHARS or n == batch.num_rows:
                    part = batch.slice(first, n - first)
                    yield pa.RecordBatch.from_arrays([pa.array(texts, type=pa.string()) if j == k else c for j, c in enumerate(part.columns)], names=batch.schema.names)
                    texts, first, size = [], n, 0

    return docs.mapInArrow(apply, docs.schema)
