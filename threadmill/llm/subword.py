"""SentencePiece encoding and decoding by a Viterbi walk whose forward states are shared among words that begin alike.

The public model is a merge model (BPE), for which the path of the largest score sum isn't the library's. So the lattice's edges
aren't weighed with the pieces' scores: a step from one piece to the next scores 0 if merging their joined text gives these two
again, and minus infinity otherwise. Then at most one piece that ends at a place of a word is reached at all, and the forward
state of a prefix is that piece alone, without a sum. It depends on the prefix only: distinct words are sorted, which makes them
a trie, and walked depth first; each new character costs one step, whose candidate pieces come from an automaton over all pieces
(the longest piece that ends here, the next longest, and so on). Results equal the library's.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, text_of, to_batch

MARK = "▁"
#: Words whose pieces a worker remembers, and fits of pieces; beyond it they are found anew.
WORDS, FITS = 300_000, 1_000_000
#: Longer words aren't remembered.
LONG_WORD = 64
#: Steps of the automaton that a worker remembers besides those of the pieces themselves.
STEPS = 500_000

_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Characters besides Latin letters, digits, the mark and the rest of ASCII: words with them aren't cut further.
_OTHER = re.compile(rf"[^\x00-\x7f{_LATIN}{MARK}]")
#: A run of marks with what follows it.
_WORD = re.compile(rf"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Parts of such a run: letters, one digit, or other characters, each with the marks before it.
_PART = re.compile(rf"{MARK}*[{_LATIN}]+|{MARK}+(?=[0-9])|[0-9]|{MARK}*[^{MARK}0-9{_LATIN}]+|{MARK}+")


def _kind(c: str) -> str:
    if c == MARK:
        return "mark"
    if c in "0123456789":
        return "digit"
    return "letter" if re.match(f"[{_LATIN}]", c) else "other" if _OTHER.match(c) else "sign"


class Subwords:
    """A SentencePiece BPE model with byte fallback, as pieces and scores."""

    _made: dict[str, Subwords] = {}

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [sp.id_to_piece(k) for k in range(sp.get_piece_size())]
        plain = [k for k in range(len(self.pieces)) if not (sp.is_unknown(k) or sp.is_control(k) or sp.is_byte(k) or sp.is_unused(k))]
        self.ids = {self.pieces[k]: k for k in plain}
        self.score = {self.pieces[k]: sp.get_score(k) for k in plain}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.raw = {k: b for b, k in enumerate(self.byte)}
        self._shown = [p.replace(MARK, " ") for p in self.pieces]
        self._is_byte = np.zeros(len(self.pieces), dtype=bool)
        self._is_byte[self.byte] = True
        self._fits: dict[int, bool] = {}
        self._words: dict[str, bytes] = {}
        # Words may be cut where no piece has these kinds of characters side by side.
        beside = {(_kind(a), _kind(b)) for p in self.ids for a, b in zip(p, p[1:])}
        kinds = ("mark", "digit", "letter", "sign")
        cuts = {(a, "digit") for a in kinds} | {("digit", a) for a in kinds} | {("letter", "sign"), ("sign", "letter"), ("letter", "mark"), ("sign", "mark")}
        self._in_parts = not cuts & beside
        self._automaton()

    @classmethod
    def of(cls, path: str) -> Subwords:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _automaton(self) -> None:
        """A trie of all pieces; for each of its nodes the node of its longest proper suffix, and the pieces that end there.

        A piece that merging doesn't make of its own text never comes out, so it isn't listed."""
        self._next: list[dict[str, int]] = [{}]
        piece, depth = [-1], [0]
        for p, k in self.ids.items():
            at = 0
            for c in p:
                to = self._next[at].get(c)
                if to is None:
                    to = self._next[at][c] = len(self._next)
                    self._next.append({})
                    piece.append(-1)
                    depth.append(depth[at] + 1)
                at = to
            piece[at] = k
        self._own = [dict(x) for x in self._next]
        self._back = [0] * len(self._next)
        #: Per node (characters, piece) of the pieces that end there, longest first.
        self._ending: list[list[tuple[int, int]]] = [[] for _ in self._next]
        queue = [0]
        for at in queue:
            for c, to in self._own[at].items():
                back = self._back[at]
                while at and c not in self._own[back] and back:
                    back = self._back[back]
                self._back[to] = self._own[back].get(c, 0) if at else 0
                k = piece[to]
                own = [(depth[to], k)] if k >= 0 and (depth[to] == 1 or self.merged(self.pieces[k]) == [self.pieces[k]]) else []
                self._ending[to] = own + self._ending[self._back[to]]
                queue.append(to)
        self._learned = 0

    def _go(self, at: int, c: str) -> int:
        """The node of the longest suffix of node and character that a piece begins with; remembered."""
        back = at
        while (to := self._own[back].get(c)) is None and back:
            back = self._back[back]
        if to is None:
            return 0
        self._learned += 1
        if self._learned > STEPS:
            self._next = [dict(x) for x in self._own]
            self._learned = 0
        self._next[at][c] = to
        return to

    def merged(self, text: str) -> list[str]:
        """The merge rule itself, on a short text: of adjacent parts that make a piece the best-scored join first, leftmost if equal."""
        parts = list(text)
        score = self.score.get
        joins = [score(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for k, s in enumerate(joins):
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del joins[at]
            if at:
                joins[at - 1] = score(parts[at - 1] + parts[at])
            if at < len(joins):
                joins[at] = score(parts[at] + parts[at + 1])

    def _fit(self, key: int) -> bool:
        """Whether two pieces (their ids in one number) stay apart in their joined text; remembered."""
        if len(self._fits) >= FITS:
            self._fits.clear()
        a, b = self.pieces[key >> 20], self.pieces[key & 0xFFFFF]
        fits = self._fits[key] = self.merged(a + b) == [a, b]
        return fits

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Each distinct word with its ids: in sorted order, so the states of a common prefix are those of the word before.

        For each prefix of the word at hand: the automaton's node, the last piece (-1: a character that no piece has, which is
        one by itself) and that piece's length."""
        nodes, last, size = [0], [-1], [0]
        order = sorted(set(words))
        flat: list[int] = []
        stops: list[int] = []
        before, fits, ending = "", self._fits, self._ending
        for word in order:
            common = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                common += 1
            del nodes[common + 1 :], last[common + 1 :], size[common + 1 :]
            node, follow = nodes[common], self._next
            for end, c in enumerate(word[common:], common + 1):
                to = follow[node].get(c)
                if to is None:
                    to = self._go(node, c)
                    follow = self._next
                node = to
                for n, k in ending[node]:
                    if n == end:
                        break
                    if n < end:
                        b = last[end - n]
                        if b < 0:  # nothing merges with a character that no piece has
                            break
                        key = b << 20 | k
                        fit = fits.get(key)
                        if fit or fit is None and self._fit(key):
                            break
                else:
                    n, k = 1, -1
                nodes.append(node)
                last.append(k)
                size.append(n)
            before, at, pieces = word, len(word), []
            while at:
                k = last[at]
                if k >= 0:
                    pieces.append(k)
                else:
                    pieces += [self.byte[b] for b in reversed(word[at - 1].encode("utf-8", "surrogatepass"))]
                at -= size[at]
            pieces.reverse()
            flat += pieces
            stops.append(len(flat))
        raw, start = np.array(flat, dtype="<u4").tobytes(), 0
        for word, stop in zip(order, stops):
            yield word, raw[4 * start : 4 * stop]
            start = stop

    def _cut(self, text: str) -> list[str]:
        """Words of a text, each of which is encoded for itself: no piece has a mark after another character, or what _PART parts."""
        if not text:
            return []
        # A mark stands for each blank and one more goes in front.
        marked = MARK + text.replace(" ", MARK)
        if not self._in_parts:
            return _WORD.findall(marked)
        if not _OTHER.search(marked):
            return _PART.findall(marked)
        out: list[str] = []
        for w in _WORD.findall(marked):
            if _OTHER.search(w):
                out.append(w)
            else:
                out += _PART.findall(w)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian unsigned 32-bit."""
        if len(self._words) > WORDS:
            self._words.clear()
        known = self._words
        split = [self._cut(t) for t in texts]
        found = dict(self.encode_words(set().union(*split).difference(known)))
        known.update((w, b) for w, b in found.items() if len(w) <= LONG_WORD)
        if any(len(w) > LONG_WORD for w in found):
            return [b"".join([found[w] if w in found else known[w] for w in ws]) for ws in split]
        get = known.__getitem__
        return [b"".join(map(get, ws)) for ws in split]

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text: pieces joined, byte pieces as UTF-8, marks as blanks, the mark in front gone."""
        ids = np.asarray(ids, dtype=np.int64)
        shown = self._shown.__getitem__
        if not self._is_byte[ids].any():
            text = "".join(map(shown, ids.tolist()))
            return text[1:] if text.startswith(" ") else text
        out, raw = [], bytearray()
        for k in ids.tolist():
            if k in self.raw:
                raw.append(self.raw[k])
                continue
            if raw:
                out.append(raw.decode("utf-8", "surrogatepass"))
                raw = bytearray()
            out.append(shown(k))
        if raw:
            out.append(raw.decode("utf-8", "surrogatepass"))
        text = "".join(out)
        return text[1:] if text.startswith(" ") else text


SCHEMA = "doc_id long, n_pieces long, ids_crc32 long, n_words long, decoded_sha256 string, same boolean"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("n_words", pa.int64()), ("decoded_sha256", pa.string()), ("same", pa.bool_())])


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every row; no shuffle.

    A null or empty text has no ids; equal rows are encoded each for itself; a null id stays null; an empty table gives no rows.
    No other column is read."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            found = [np.frombuffer(b, "<u4").astype(np.int32) for b in Subwords.of(model).encode(texts)]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(ends, np.concatenate(found))], schema=schema)

    return text_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of encode()'s rows."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                yield to_batch(schema, [part.column(0).to_pylist(), [Subwords.of(model).decode(x.values if x.is_valid else []) for x in part.column(1)]])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digest(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every text: doc_id, n_pieces, ids_crc32, n_words, decoded_sha256, same (the text came back).

    A null or empty text has no pieces and decodes to the empty text; equal rows are handled each for itself; a null id stays
    null; an empty table gives no rows; no other column is read."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = Subwords.of(model)
        for ids, texts in slices(batches):
            rows = []
            for i, t, b in zip(ids, texts, subwords.encode(texts)):
                back = subwords.decode(np.frombuffer(b, "<u4"))
                rows.append((i, len(b) // 4, zlib.crc32(b), len(t.split()), hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(), back == t))
            yield to_batch(_ARROW, list(zip(*rows)))

    return text_of(docs, id_col, text_col).mapInArrow(run, SCHEMA)
