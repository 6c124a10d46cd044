"""SentencePiece encoding by streaming Viterbi search, and decoding.

A text's pieces are those of the highest total score.  A model of merges has
ranks for scores; they count as log-probabilities by Zipf's law.  Between equal
scores the longer last piece wins.  A character without a piece becomes its UTF-8
bytes' pieces, at ten below the worst score.

The search (``Search``) reads the text left to right in any portions.  An
Aho-Corasick automaton names the pieces that end at each character, and scores are
kept for the last ``longest`` boundaries only: no piece reaches further back.
The best paths to these boundaries form a tree.  A boundary that leaves the window
without a path through it is pruned, and while the root has one branch left, all paths
have converged on that branch's first boundary: its ids are final and the root
moves there.  Every boundary is added, pruned and committed once, so the time is linear
in the text, whatever it holds.  Where paths never meet (a long run of one character,
say) the tree keeps 13 bytes a character until they do.

No piece holds a space mark after another character, so before a space there always is
a common boundary; where pieces hold letters only or none (checked), there is one
between these, too.  The search is run on what stands between, and its results for short
stretches are kept in a bounded memo.

Defined cases: a null or empty text has no ids and decodes to the empty text.
A text that holds the space mark itself (U+2581) decodes with a space there,
as the format has it.  Repeated rows encode alike.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from .common import Out, prepare, rows_of
from .tokens import MAX_VOCABULARY_BYTES

MARK = "▁"
MEMO_ENTRIES = 600_000
MEMO_LENGTH = 18
_TRIM = 4096  # committed boundaries that may stay in the arrays
_PORTION = 4096  # characters read at a time
_UNKNOWN_PENALTY = 10.0
_SPACES = re.compile(" +[^ ]*|[^ ]+")
#: Spaces, then a run of letters or a run of anything else.
_CLASSES = re.compile(r" *(?:[^\W\d_²³¹¼-¾]+|(?:[^\w ]|[\d_²³¹¼-¾])+)| +")


@dataclass
class Model:
    """Pieces with their ids and scores."""

    pieces: dict[str, tuple[int, float]]
    texts: list[str]
    bytes_of: dict[int, int]  # ids of single bytes
    skip: frozenset[int]  # control ids, which decode to nothing
    prefix: bool  # a space is put before the text
    longest: int = field(init=False)
    unknown: float = field(init=False)
    byte_ids: list[int] = field(init=False)
    automaton: ahocorasick.Automaton = field(init=False)

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.pieces), default=1)
        self.unknown = min((s for _, s in self.pieces.values()), default=0.0) - _UNKNOWN_PENALTY
        to_id = {b: i for i, b in self.bytes_of.items()}
        self.byte_ids = [to_id[b] for b in range(256)] if len(to_id) == 256 else []
        self.automaton = ahocorasick.Automaton()
        for t, (i, score) in self.pieces.items():
            self.automaton.add_word(t, (len(t), score, i))
        self.automaton.make_automaton()

    def spelt(self, char: str) -> list[int]:
        """A character as its bytes' pieces."""
        if not self.byte_ids:
            raise ValueError("the model has no byte pieces for an unknown character")
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]

    @staticmethod
    def load(data: bytes) -> Model:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_proto=data)
        n = m.vocab_size()
        texts = [m.id_to_piece(i) for i in range(n)]
        bytes_of = {i: int(texts[i][3:5], 16) for i in range(n) if m.is_byte(i)}
        skip = frozenset(i for i in range(n) if m.is_control(i) or m.is_unknown(i) or m.is_unused(i))
        pieces = {t: (i, m.get_score(i)) for i, t in enumerate(texts) if i not in bytes_of and i not in skip}
        ranks = [-s for _, s in pieces.values()]
        if ranks and all(r >= 0 and r == int(r) for r in ranks):
            pieces = {t: (i, -math.log(2.0 + min(-s, n))) for t, (i, s) in pieces.items()}
        inner = [t for t in pieces if MARK in t.lstrip(MARK)]
        if inner:
            raise ValueError(f"pieces that cross a space are not supported: {inner[:3]}")
        return Model(pieces, texts, bytes_of, skip, m.decode([m.piece_to_id(MARK + "a")]) == "a" if MARK + "a" in pieces else True)


class Search:
    """Streaming Viterbi: ``feed`` text in any portions, take ids as they become final."""

    def __init__(self, model: Model):
        self.model = model
        self.size = model.longest + 1
        # The tree of paths, from boundary ``base`` on: the length and the id of the
        # piece that ends there (-1: an unknown character), branches, and their
        # boundaries' exclusive or, which is the branch where there is one.
        self.back, self.ids, self.branches, self.toward = array("H", [0]), array("i", [-1]), array("H", [0]), array("q", [0])
        self.unknown: dict[int, str] = {}  # characters without a piece on some path, by boundary
        self._begin()

    def _begin(self) -> None:
        self.tail = ""  # the last characters that a later piece may hold
        self.score = [0.0]  # of the best paths to the last ``size`` boundaries
        self.end = self.root = self.base = 0  # characters read; the last boundary that all paths share
        self.unknown.clear()
        for a in (self.back, self.ids, self.branches, self.toward):
            del a[1:]
        self.branches[0] = self.toward[0] = 0

    def feed(self, more: str) -> list[int]:
        done: list[int] = []
        for at in range(0, len(more), _PORTION):
            first = self.end
            self._read(more[at : at + _PORTION])
            # Each of these boundaries let the one ``longest`` before it out of the window.
            for end in range(max(first + 1, self.size), self.end + 1):
                self._settle(end, done)
        return done

    def _read(self, more: str) -> None:
        """The best path to each boundary of ``more``."""
        score, first, least, unknown = self.score, self.end, self.model.unknown, self.unknown
        push, back, name = score.append, self.back.append, self.ids.append
        here, before = len(score) - 1, len(self.tail)
        text = self.tail + more if before else more
        at, best, length, piece = 0, 0.0, 0, 0

        def skip(to: int) -> None:
            """Characters that no piece ends with."""
            for k in range(len(score) - here, to):
                push(score[-1] + least)
                back(1)
                name(-1)
                unknown[first + k] = more[k - 1]

        for last, (n, worth, i) in self.model.automaton.iter(text):  # by end; of one end the longest first
            last -= before - 1
            if last != at:
                if last <= 0:
                    continue
                if at:
                    push(best)
                    back(length)
                    name(piece)
                    if piece < 0:
                        unknown[first + at] = more[at - 1]
                if last != at + 1:
                    skip(last)
                at = last
                best, length, piece = score[-1] + least, 1, -1
            s = score[here + at - n] + worth
            if s > best or piece < 0 and s >= best:
                best, length, piece = s, n, i
        if at:
            push(best)
            back(length)
            name(piece)
            if piece < 0:
                unknown[first + at] = more[at - 1]
        skip(len(more) + 1)
        self.end = first + len(more)
        self.tail = text[max(len(text) - self.model.longest + 1, 0) :]
        del score[: -self.size]

    def _settle(self, end: int, done: list[int]) -> None:
        """Prune the boundary that leaves the window at ``end``, and commit what all paths share."""
        base, branches, toward, back = self.base, self.branches, self.toward, self.back
        for new in range(len(branches), end - base + 1):  # branches of the tree up to here
            branches.append(0)
            toward.append(0)
            branches[new - back[new]] += 1
            toward[new - back[new]] ^= new + base
        old = last = end - self.model.longest - base  # no later piece starts here
        root = self.root - base
        while old > root and not branches[old]:
            up = old - back[old]
            branches[up] -= 1
            toward[up] ^= old + base
            old = up
        # A root that has left the window gets no more branches.
        while root <= last and branches[root] == 1:
            root = toward[root] - base
            done += self._final(root)
        self.root = root + base
        if root > _TRIM and 2 * root > len(branches):
            for a in (back, self.ids, branches, toward):
                del a[:root]
            self.base += root

    def _final(self, at: int) -> list[int]:
        i = self.ids[at]
        char = self.unknown.pop(at + self.base, None) if self.unknown else None
        return [i] if i >= 0 else self.model.spelt(char)

    def finish(self) -> list[int]:
        """The rest of the ids; the search is at its beginning again."""
        at, root, back = self.end - self.base, self.root - self.base, self.back
        path = []
        while at > root:
            path.append(at)
            at -= back[at]
        path.reverse()
        ids = self.ids
        done = [ids[at] for at in path]
        if -1 in done:
            done = [i for at in path for i in self._final(at)]
        self._begin()
        return done


def encode(model: Model, text: str) -> list[int]:
    """Ids of a stretch or a whole text that is marked already."""
    s = Search(model)
    return s.feed(text) + s.finish()


class _Memo(dict):
    """Stretch -> ids, as the search gives them."""

    def __init__(self, model: Model):
        super().__init__()
        self.search = Search(model)

    def __missing__(self, stretch: str) -> bytes:
        s = self.search
        ids = array("I", s.feed(stretch.replace(" ", MARK)) + s.finish()).tobytes()
        if len(stretch) <= MEMO_LENGTH:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[stretch] = ids
        return ids


class Coder:
    def __init__(self, data: bytes):
        self.model = m = Model.load(data)
        self.memo = _Memo(m)
        pieces = [t.replace(MARK, " ") for t in m.pieces]
        self.cut = _CLASSES if all(map(_CLASSES.fullmatch, pieces)) else _SPACES
        self.spelt = [bytes([m.bytes_of[i]]) if i in m.bytes_of else b"" if i in m.skip else t.encode() for i, t in enumerate(m.texts)]

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        if not text:
            return b""
        text = " " * self.model.prefix + text
        if MARK in text:  # it counts as a space, and is not one
            return array("I", encode(self.model, text.replace(" ", MARK))).tobytes()
        return b"".join(map(self.memo.__getitem__, self.cut.findall(text)))

    def decode(self, ids: bytes) -> str:
        out = b"".join(map(self.spelt.__getitem__, array("I", ids)))
        text = out.decode("utf-8", "surrogatepass").replace(MARK, " ")
        return text[1:] if self.model.prefix and text.startswith(" ") else text


_CODERS: dict[int, Coder] = {}


def coder(model: Broadcast) -> Coder:
    key = hash(model.value)
    if key not in _CODERS:
        _CODERS[key] = Coder(model.value)
    return _CODERS[key]


def broadcast_model(spark: SparkSession, path: str) -> Broadcast:
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is no model file: over {MAX_VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(data)


def encode_texts(docs: DataFrame, model_path: str, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_crc32, round_trip (the ids
    decode to the text), and with ``with_ids`` the ids.  No shuffle."""
    spark = docs.sparkSession
    prepare(spark)
    model = broadcast_model(spark, model_path)
    names = "doc_id bigint, n_tokens bigint, ids_crc32 bigint, round_trip boolean" + ", ids array<int>" * with_ids
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("round_trip", pa.bool_()), *([("ids", pa.list_(pa.int32()))] if with_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, out = coder(model), Out(schema)
        for part in rows_of(batches, "doc_id", "text"):
            for doc_id, text in part:
                text = text or ""
                ids = c.encode(text)
                row = (doc_id, len(ids) // 4, zlib.crc32(ids), c.decode(ids) == text)
                out.add(*row, *((list(array("I", ids)),) if with_ids else ()), size=len(ids))
                if out.full():
                    yield out.take()
        yield out.take()

    return docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(run, names)


def decode_ids(rows: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids are the empty text."""
    spark = rows.sparkSession
    prepare(spark)
    model = broadcast_model(spark, model_path)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, out = coder(model), Out(schema)
        for part in rows_of(batches, "doc_id", "ids"):
            for doc_id, ids in part:
                text = c.decode(array("I", ids or []).tobytes())
                out.add(doc_id, text, size=len(text))
                if out.full():
                    yield out.take()
        yield out.take()

    return rows.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{ids_col}` as array<int>) ids").mapInArrow(run, "doc_id bigint, text string")
