"""Alignment of two tokenizers over the same texts.

Both token sequences of a text cut its bytes (a space before the text included) into
intervals.  Interval coalescing, for a chunk of texts at once: all A and B tokens are
lexsorted by start, ``maximum.accumulate`` runs over their ends, and a group
breaks where a start reaches the running maximum, that is where tokens of both
sides end.  Within a group the overlaps of A with B tokens are expanded to links.

* ``align`` gives each document its ids and its groups.
* ``link_counts`` counts, for each pair of ids, the documents that hold it linked:
  different pairs of each document, summed within a task before Spark sums them.
* ``score_links`` adds to each document how its links fare in these counts.  The
  most frequent pairs are broadcast, at most ``FREQUENT`` of them (17 bytes each); a
  document's links to all other pairs are joined to the counts, so nothing is left out.

Texts of plain characters (``tokens``) are cut into stretches: white space, then letters
(with apostrophes inside) or a run of anything else.  No pre-token of the byte-level rule
spans two of these, and no piece does either (checked on the model), so a stretch's ids do not
depend on its neighbours.  Those that the bounded memo lacks are encoded by the
libraries, and short ones are kept.  Other texts and tokenizers are encoded whole.

Defined cases: a text that is null, empty or not valid UTF-8, or whose tokens'
joined bytes of either side differ from space + text (it holds U+2581, say), has no tokens: all
counts are 0 and the groups are the empty string.  Special tokens' strings inside a
text are plain text.  Repeated rows are aligned and counted each.  Columns beside
id and text are not read.  An empty table gives no rows.  A document is aligned
whole in a task, at about 300 bytes a token of the longest document.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Out, prepare, rows_of, shared_folder
from .sentence_pieces import MARK, broadcast_model
from .tokens import _BYTE_LEVEL, _L, _ODD, Encoder, _byte_letters, broadcast_vocabulary

#: Pairs of the broadcast table, at most; a table of so many takes 17 MB.
FREQUENT = 1_000_000
CHUNK = 1_500_000  # bytes of text handled at once
HELD_PAIRS = 2_000_000  # different pairs a task sums up before it hands them on
MEMO_ENTRIES = 250_000
MEMO_LENGTH = 20

_STRETCH = re.compile(rf"\s*[{_L}]+(?:'[{_L}]+)*|\s*[^\s{_L}]+(?:(?<=')[{_L}]+)*|\s+")
#: Not plain: also carriage returns, which stand behind other characters in some pieces.
_OTHER = re.compile(_ODD.pattern + "|\r")
#: What a piece of plain characters may be: spaces, then letters only or none.
_PIECE = re.compile(rf" *(?:[{_L}]+|[^\s{_L}]+)| +")


class _PlainEncoder(Encoder):
    """Special tokens' strings are ordinary text."""

    def __init__(self, spec: str):
        super().__init__(spec)
        self.library.encode_special_tokens = True
        self.added = re.compile(r"(?!)")


def _table(entries: list[bytes], own: str, other: str) -> np.ndarray:
    """Decimal ids with the separator ``own`` (even rows) or ``other`` (odd rows), zero-padded."""
    n = len(str(len(entries))) + 1
    rows = b"".join(f"{i}{s}".encode().ljust(n, b"\0") for i in range(len(entries)) for s in (own, other))
    return np.frombuffer(rows, np.uint8).reshape(-1, n)


class Pair:
    """Both tokenizers, their entries' bytes, and the memo of stretches."""

    def __init__(self, spec: str, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.a = _PlainEncoder(spec)
        self.b = SentencePieceProcessor(model_proto=model)
        back = {chr(b): bytes([b]) for b in range(256)} | {c: bytes([b]) for b, c in _byte_letters().items()}
        vocabulary = self.a.library.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = b"".join(back.get(c, c.encode()) for c in token)
        #: With an entry for every byte, byte-level tokens always spell the text.
        self.spells = self.a.pattern is _BYTE_LEVEL and len({x for x in self.a_bytes if len(x) == 1}) == 256
        b, n = self.b, self.b.get_piece_size()
        pieces = [b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        own = [p.replace(MARK, " ") for i, p in enumerate(pieces) if not (b.is_byte(i) or b.is_control(i) or b.is_unknown(i))]
        self.cuttable = self.a.pattern is _BYTE_LEVEL and all(_PIECE.fullmatch(p) for p in own if not _OTHER.search(p))
        self.before = b.encode("\n")  # what stands before a stretch that is encoded alone
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int32)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int32)
        # In the groups' text an A id is followed by another or by its group's B ids.
        self.a_text = _table(self.a_bytes, ",", "|")
        self.b_text = _table(self.b_bytes, ",", ";")
        self.memo: dict[str, tuple[bytes, bytes]] = {}

    def _same(self, text: str, a: bytes, b: list[int]) -> bool:
        """Both sides spell the text."""
        data = text.encode()
        return b"".join(map(self.b_bytes.__getitem__, b)) == data and (self.spells or b"".join(map(self.a_bytes.__getitem__, array("I", a))) == data)

    def _encoded(self, stretches: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Both sides' ids of stretches of plain texts; ``_NONE`` where they spell something else."""
        skip, memo, pieces = len(self.before), self.a.memo, self.a.pattern.findall
        for s, ids in zip(stretches, self.b.encode(["\n" + s for s in stretches], num_threads=1)):
            a, b = b"".join(map(memo.__getitem__, pieces(s))), ids[skip:]
            yield (a, array("I", b).tobytes()) if ids[:skip] == self.before and self._same(s, a, b) else _NONE

    def ids(self, texts: list[bytes | None]) -> list[tuple[bytes, bytes]]:
        """Of each text the little-endian unsigned 32-bit ids of both sides; none where
        they do not spell space + text."""
        memo, out, cut = self.memo, [], []
        missing: dict[str, tuple[bytes, bytes] | None] = {}
        for t in map(_decoded, texts):
            text = " " + t
            if not t or MARK in t:
                out.append(_NONE)
            elif not self.cuttable or _OTHER.search(t):
                a, b = self.a.ids(text), self.b.encode(t)
                out.append((a, array("I", b).tobytes()) if self._same(text, a, b) else _NONE)
            else:
                stretches = _STRETCH.findall(text)
                found = [*map(memo.get, stretches)]
                lacking = [i for i, x in enumerate(found) if x is None]
                own = [stretches[i] for i in lacking]
                missing.update(dict.fromkeys(own))
                cut.append((len(out), found, lacking, own))
                out.append(_NONE)
        for at in range(0, len(missing), 1000):
            some = [*islice(missing, at, at + 1000)]
            missing.update(zip(some, self._encoded(some)))
        for k, found, lacking, own in cut:
            for i, s in zip(lacking, own):
                found[i] = missing[s]
            if _NONE not in found:
                out[k] = (b"".join([a for a, _ in found]), b"".join([b for _, b in found]))
        for s, x in missing.items():
            if len(memo) >= MEMO_ENTRIES:
                break
            if len(s) <= MEMO_LENGTH:
                memo[s] = x
        return out


_NONE = (b"", b"")


def _decoded(text: bytes | None) -> str:
    try:
        return (text or b"").decode()
    except UnicodeDecodeError:
        return ""


class Aligned:
    """Links and groups of a chunk of documents: ``a`` and ``b`` hold all ids, the
    documents' shares are ``n_a`` and ``n_b``.  Both sides spell the same bytes, so
    documents end where groups end."""

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray):
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        self.a_doc = np.repeat(np.arange(len(n_a)), n_a)
        a_end, b_end = np.cumsum(a_size[a], dtype=np.int64), np.cumsum(b_size[b], dtype=np.int64)
        self.start = np.concatenate((a_end - a_size[a], b_end - b_size[b]))
        self.end = np.concatenate((a_end, b_end))
        a_start, b_start = self.start[: len(a)], self.start[len(a) :]
        # An A token meets the B tokens that end after its start and start before its end.
        self.low = np.searchsorted(b_end, a_start, "right")
        self.n = np.searchsorted(b_start, a_end, "left") - self.low

    @cached_property
    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """The group of each A and of each B token."""
        order = np.lexsort((self.start,))  # stable: of one start, A first
        reach = np.maximum.accumulate(self.end[order])
        first = np.ones(len(order), bool)
        first[1:] = self.start[order][1:] >= reach[:-1]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(first) - 1
        return group[: len(self.a)], group[len(self.a) :]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(place of the A token, place of the B token) of every link."""
        i = np.repeat(np.arange(len(self.a)), self.n)
        return i, np.arange(len(i)) - np.repeat(np.cumsum(self.n) - self.n, self.n) + self.low[i]

    def by_document(self, values: np.ndarray) -> np.ndarray:
        """Sums over documents of values that belong to the A tokens."""
        upto = np.concatenate(([0], np.cumsum(values)))
        ends = np.cumsum(self.n_a)
        return upto[ends] - upto[ends - self.n_a]

    def n_groups(self) -> np.ndarray:
        new = np.ones(len(self.a), np.int64)
        group, _ = self.groups
        new[1:] = group[1:] != group[:-1]
        return self.by_document(new)

    def group_texts(self, a_text: np.ndarray, b_text: np.ndarray) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each document."""
        a_group, b_group = self.groups
        a_last, b_last = (np.append(g[1:] != g[:-1], True) if len(g) else np.empty(0, bool) for g in (a_group, b_group))
        a_at = np.arange(len(self.a)) + np.searchsorted(b_group, a_group, "left")
        b_at = np.arange(len(self.b)) + np.searchsorted(a_group, b_group, "right")
        cells = np.zeros((len(self.a) + len(self.b), max(a_text.shape[1], b_text.shape[1])), np.uint8)
        cells[a_at, : a_text.shape[1]] = a_text[self.a * 2 + a_last]
        cells[b_at, : b_text.shape[1]] = b_text[self.b * 2 + b_last]
        text = cells.ravel()
        text = text[text != 0].tobytes()
        # An id's text is as long as its digits, and one character.
        size = np.empty(len(cells), np.int64)
        size[a_at], size[b_at] = (np.searchsorted(_POWERS, x, "right") + 2 for x in (self.a, self.b))
        upto = np.concatenate(([0], np.cumsum(size)))
        edge = upto[np.concatenate(([0], np.cumsum(self.n_a + self.n_b)))].tolist()
        return [text[i : max(j - 1, i)] for i, j in zip(edge[:-1], edge[1:])]


_POWERS = 10 ** np.arange(1, 10)


_PAIRS: dict[tuple[int, int], Pair] = {}


def pair_of(spec: Broadcast, model: Broadcast) -> Pair:
    key = (hash(spec.value), hash(model.value))
    if key not in _PAIRS:
        _PAIRS[key] = Pair(spec.value, model.value)
    return _PAIRS[key]


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(parts), np.uint32).astype(np.int32), np.array([len(p) // 4 for p in parts], np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], sized: str) -> Iterator[list[tuple]]:
    held, size, at = [], 0, columns.index(sized)
    for part in rows_of(batches, *columns):
        for row in part:
            held.append(row)
            size += len(row[at] or b"") + 50
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


_ALIGNED = pa.schema(
    [("row_id", pa.int64()), ("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("groups", pa.string()), ("a_ids", pa.binary()), ("b_ids", pa.binary())]
)


class Tokenizers:
    """Two public vocabulary files, read once on the driver: A by the ``tokenizers``
    library (byte-level entries), B by ``sentencepiece`` (a space before the text)."""

    def __init__(self, spark, a_path: str, b_path: str):
        prepare(spark)
        self.spec, self.model = broadcast_vocabulary(spark, a_path), broadcast_model(spark, b_path)

    def pair(self) -> Pair:
        return pair_of(self.spec, self.model)


def align(docs: DataFrame, tokenizers: Tokenizers, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: row_id (of its own, within one evaluation), doc_id,
    n_a, n_b, n_groups, n_links, groups, a_ids, b_ids (little-endian unsigned 32 bits)."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, out = tokenizers.pair(), Out(_ALIGNED)
        for chunk in _chunks(batches, ("row_id", "doc_id", "text"), "text"):
            ids = p.ids([text for *_, text in chunk])
            (a, n_a), (b, n_b) = _joined([x for x, _ in ids]), _joined([x for _, x in ids])
            found = Aligned(a, b, n_a, n_b, p.a_size, p.b_size)
            counts = zip(n_a.tolist(), n_b.tolist(), found.n_groups().tolist(), found.by_document(found.n).tolist())
            for (row_id, doc_id, _), count, groups, (x, y) in zip(chunk, counts, found.group_texts(p.a_text, p.b_text), ids):
                out.add(row_id, doc_id, *count, groups.decode(), x, y, size=len(groups) + len(x) + len(y))
                if out.full():
                    yield out.take()
        yield out.take()

    return rows.mapInArrow(run, "row_id bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, a_ids binary, b_ids binary")


def _links_of(p: Pair, chunk: list[tuple]) -> tuple[Aligned, np.ndarray, np.ndarray]:
    """(aligned chunk, document of each link, pair of each link as one number)."""
    (a, n_a), (b, n_b) = _joined([r[-2] for r in chunk]), _joined([r[-1] for r in chunk])
    found = Aligned(a, b, n_a, n_b, p.a_size, p.b_size)
    i, j = found.links()
    return found, found.a_doc[i], found.a[i].astype(np.int64) * len(p.b_size) + found.b[j]


def _distinct(doc: np.ndarray, pair: np.ndarray, pairs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (document, pair) and how often each occurs."""
    both, n = np.unique(doc * pairs + pair, return_counts=True)
    return both // pairs, both % pairs, n


def _summed(pair: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pair, kind="stable")
    pair, n = pair[order], n[order]
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.empty(0, np.int64)
    return pair[first], np.add.reduceat(n, first) if len(first) else n


def link_counts(aligned: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """(a, b, n_docs, best): how many rows hold the ids linked, and whether no
    other pair of the same A id is held by more."""
    schema = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = tokenizers.pair()
        n_b = len(p.b_size)
        held = [(np.empty(0, np.int64),) * 2]

        def hand_on() -> Iterator[pa.RecordBatch]:
            pair, n = held.pop()
            for at in range(0, len(pair), 50_000):
                k = pair[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(k // n_b, pa.int32()), pa.array(k % n_b, pa.int32()), pa.array(n[at : at + 50_000])], schema=schema)

        waiting = 0
        for chunk in _chunks(batches, ("a_ids", "b_ids"), "a_ids"):
            _, doc, pair = _links_of(p, chunk)
            _, pair, _ = _distinct(doc, pair, len(p.a_size) * n_b)
            held.append(_summed(pair, np.ones(len(pair), np.int64)))
            waiting += len(held[-1][0])
            if waiting > HELD_PAIRS // 4:
                held[:] = [_summed(*map(np.concatenate, zip(*held)))]
                waiting = 0
                if len(held[0][0]) > HELD_PAIRS:
                    yield from hand_on()
                    held.append((np.empty(0, np.int64),) * 2)
        held[:] = [_summed(*map(np.concatenate, zip(*held)))]
        yield from hand_on()

    n = aligned.select("a_ids", "b_ids").where("length(a_ids) > 0").mapInArrow(run, "a int, b int, n bigint")
    summed = n.groupBy("a", "b").agg(F.sum("n").alias("n_docs"))
    # An A id has at most as many pairs as B has entries.
    return summed.withColumn("best", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a")))


def _frequent(counts: DataFrame, most: int) -> int:
    """The least power of two so that at most ``most`` pairs are held by that many documents."""
    power, total = 63, 0
    by_power = {r["p"]: r["n"] for r in counts.groupBy(F.floor(F.log2("n_docs")).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    while power >= 0 and total + by_power.get(power, 0) <= most:
        total += by_power.get(power, 0)
        power -= 1
    return 1 << (power + 1)


_SCORED = pa.schema(
    [("row_id", pa.int64()), ("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_best", "count_sum")), ("rare", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])))]
)


def score_links(aligned: DataFrame, counts: DataFrame, tokenizers: Tokenizers, most: int = FREQUENT) -> DataFrame:
    """(row_id, doc_id, n_best, count_sum): links whose pair is its A id's best, and
    the sum of ``n_docs`` over the links.  ``aligned`` and ``counts`` are written tables."""
    spark = aligned.sparkSession
    least = _frequent(counts, most)
    table = counts.where(F.col("n_docs") >= least).toPandas()
    n_b = tokenizers.pair().b.get_piece_size()
    pair = table["a"].to_numpy(np.int64) * n_b + table["b"].to_numpy(np.int64)
    order = np.argsort(pair)
    sent = spark.sparkContext.broadcast((pair[order], table["n_docs"].to_numpy(np.int64)[order], table["best"].to_numpy(bool)[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, out = tokenizers.pair(), Out(_SCORED)
        pairs, n_docs, best = sent.value
        for chunk in _chunks(batches, ("row_id", "doc_id", "a_ids", "b_ids"), "a_ids"):
            _, doc, pair = _links_of(p, chunk)
            doc, pair, n = _distinct(doc, pair, len(p.a_size) * n_b)
            at = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
            known = pairs[at] == pair if len(pairs) else np.zeros(len(pair), bool)
            held = np.where(known, n_docs[at], 0) * n if len(pairs) else np.zeros(len(pair), np.int64)
            good = np.where(known, best[at], False) * n if len(pairs) else held
            edge = np.searchsorted(doc, np.arange(len(chunk) + 1))
            upto = [np.concatenate(([0], np.cumsum(x)))[edge] for x in (good, held)]
            sums = [np.diff(x).tolist() for x in upto]
            rest = np.flatnonzero(~known)
            rare_edge = np.searchsorted(doc[rest], np.arange(len(chunk) + 1)).tolist()
            rare = [{"a": k // n_b, "b": k % n_b, "n": m} for k, m in zip(pair[rest].tolist(), n[rest].tolist())]
            for k, (row_id, doc_id, *_) in enumerate(chunk):
                own = rare[rare_edge[k] : rare_edge[k + 1]]
                out.add(row_id, doc_id, sums[0][k], sums[1][k], own, size=16 * len(own))
                if out.full():
                    yield out.take()
        yield out.take()

    folder = shared_folder(spark, "alignment")
    aligned.select("row_id", "doc_id", "a_ids", "b_ids").mapInArrow(run, "row_id bigint, doc_id bigint, n_best bigint, count_sum bigint, rare array<struct<a: int, b: int, n: bigint>>").write.parquet(f"{folder}/scored")
    scored = spark.read.parquet(f"{folder}/scored")
    rare = scored.select("row_id", F.inline("rare"))
    few = counts.where(F.col("n_docs") < least)
    more = rare.join(few, ["a", "b"]).groupBy("row_id").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("n_docs")).alias("more_sum"))
    both = scored.drop("rare").join(more, "row_id", "left")
    return both.select("row_id", "doc_id", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))


def compare(docs: DataFrame, tokenizers: Tokenizers, most: int = FREQUENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of the alignment with the corpus-wide counts: doc_id, n_a, n_b, n_groups,
    n_links, n_best, count_sum, groups_sha256 (the empty string without tokens)."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "alignment")
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    align(docs, tokenizers, id_col, text_col).withColumn("groups_sha256", digest).drop("groups").write.option("compression", "zstd").parquet(f"{folder}/aligned")
    aligned = spark.read.parquet(f"{folder}/aligned")
    link_counts(aligned, tokenizers).write.parquet(f"{folder}/counts")
    scored = score_links(aligned, spark.read.parquet(f"{folder}/counts"), tokenizers, most)
    own = aligned.select("row_id", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return own.join(scored.drop("doc_id"), "row_id").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
