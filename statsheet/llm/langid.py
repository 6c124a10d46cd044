"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent character n-grams (one to
three letters; words are padded with a space), most frequent first.  A document
is ranked the same way over its whole text, and its distance to a language is
the sum, over the document's top n-grams, of how far each stands out of place
in that language's profile (absent ones count the profile's length).  The
nearest language wins; equal distances go to the name that sorts first.

Defined cases: a null text or one without letters is ``und`` with score 0, and
so is every text when nothing was learned.  The score is one minus the distance
over the largest possible distance.  Rows with a null language are not learned
from.  Only text decides a prediction.  Texts are read in pieces of a bounded
length, so one very long text needs no more memory than its own size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Out, cut_lineage, prepare, rows_of, slices

PROFILE = 400  # n-grams of a profile
UNKNOWN = "und"
#: Least scores lie this far under this quantile of the learned rows' scores.
LOW, MARGIN = 0.001, 0.1
LEAST_ROWS = 100  # for a quantile
_STEPS = 1000  # of scores in a histogram

_PIECE = 1 << 20
_BITS = 21  # a code point plus one, so three fit into 63 bits


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, the lower-case letter's code point plus 2; 1 for anything else."""
    table = np.ones(0x110000, np.int64)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low if len(low) == 1 else ch) + 2
    return table


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams of a text as integers, ascending, and their counts."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    tail = np.array([1], np.int64)  # the last two codes so far; a text starts after a space
    letters = _letters()
    for at in range(0, len(text) + 1, _PIECE):
        piece = text[at : at + _PIECE]
        codes = letters[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)]
        if at + _PIECE > len(text):
            codes = np.append(codes, 1)  # and ends before one
        before = np.concatenate((tail[-1:], codes[:-1]))
        codes = codes[(codes != 1) | (before != 1)]  # one space for a run of others
        if not len(codes):
            continue
        s = np.concatenate((tail, codes))
        two = (s[:-1] << _BITS) | s[1:]
        keys = [codes[codes != 1], two[len(tail) - 1 :]]
        if len(s) > 2:
            three = (two[:-1] << _BITS) | s[2:]
            keys.append(three[s[1:-1] != 1])
        found.append(np.unique(np.concatenate(keys), return_counts=True))
        tail = s[-2:]
    return merge_counts(found)


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], np.concatenate([c for _, c in parts])[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def ranked(keys: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams first; equal counts by value."""
    return keys[np.argsort(-counts, kind="stable")[:top]]


@dataclass
class Profiles:
    """All profiles as one table: rank of each known n-gram in each language."""

    languages: list[str]
    keys: np.ndarray
    ranks: np.ndarray  # [n-gram, language]; ``size`` where absent
    size: int

    @staticmethod
    def of(profiles: dict[str, list[int]], size: int) -> Profiles:
        languages = sorted(profiles)
        keys = np.array(sorted({k for p in profiles.values() for k in p}), np.int64)
        ranks = np.full((len(keys), len(languages)), size, np.int32)
        for j, name in enumerate(languages):
            own = np.array(profiles[name], np.int64)
            ranks[np.searchsorted(keys, own), j] = np.arange(len(own))
        return Profiles(languages, keys, ranks, size)

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.nearest(text)[:2]

    def nearest(self, text: str | None) -> tuple[str, float, int]:
        """(language, score, n-grams ranked)."""
        keys, counts = ngrams(text or "")
        if not len(keys) or not self.languages:
            return UNKNOWN, 0.0, len(keys)
        own = ranked(keys, counts, self.size)
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        known = self.keys[at] == own
        here = self.ranks[at[known]]
        place = np.flatnonzero(known)[:, None]
        out = np.where(here < self.size, np.abs(here - place), self.size)
        distance = out.sum(axis=0, dtype=np.int64) + self.size * int((~known).sum())
        best = int(np.argmin(distance))
        return self.languages[best], float(1 - distance[best] / (self.size * len(own))), len(own)


_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


def _learned(labelled: DataFrame, text_col: str, lang_col: str) -> tuple[DataFrame, list[str]]:
    """All rows (lang, text) with both, and the languages: as many as there are values,
    each of which is a part of the model."""
    rows = labelled.selectExpr(f"cast(`{text_col}` as string) text", f"cast(`{lang_col}` as string) lang").where("lang is not null and text is not null")
    return rows.select("lang", "text"), sorted(r["lang"] for r in rows.select("lang").distinct().collect())


def learn(labelled: DataFrame, size: int = PROFILE, text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles from all of the labelled rows' texts."""
    prepare(labelled.sparkSession)
    rows, languages = _learned(labelled, text_col, lang_col)
    if not languages:
        return Profiles.of({}, size)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        load = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                keys, counts = merge_counts(parts)
                for i in range(0, len(keys), 100_000):
                    k = keys[i : i + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k), pa.array(counts[i : i + 100_000])], schema=_COUNTS)
            held.clear()

        for part in rows_of(batches, "lang", "text"):
            for lang, text in part:
                found = ngrams(text)
                held.setdefault(lang, []).append(found)
                load += len(found[0])
                if load > 2_000_000:
                    held.update({k: [merge_counts(v)] for k, v in held.items()})
                    load = sum(len(v[0][0]) for v in held.values())
                    if load > 1_000_000:
                        yield from flush()
                        load = 0
        yield from flush()

    counts = cut_lineage(rows.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    # The model itself: ``size`` rows of each language.
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("place", F.row_number().over(best)).where(F.col("place") <= size)
    profiles: dict[str, list[int]] = {lang: [] for lang in languages}
    for r in sorted(top.select("lang", "place", "gram").collect()):
        profiles[r["lang"]].append(r["gram"])
    return Profiles.of(profiles, size)


_OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predict(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score; no shuffle.  The model's
    size is bounded by languages and profile length, so it is broadcast."""
    spark = docs.sparkSession
    prepare(spark)
    model = spark.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, p = Out(_OUT), model.value
        for part in rows_of(batches, "doc_id", "text"):
            for doc_id, text in part:
                out.add(doc_id, *p.predict(text))
                if out.full():
                    yield out.take()
        yield out.take()

    return docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")


@dataclass
class Least:
    """The least score of a text that reads as a language, by the number of its
    n-grams (short texts score differently)."""

    of: dict[tuple[str, int], float]  # language, bit length of the number
    otherwise: dict[str, float]
    floor: float

    def __call__(self, lang: str, grams: int) -> float:
        return self.of.get((lang, grams.bit_length()), self.otherwise.get(lang, self.floor))


_SCORES = pa.schema([("lang", pa.string()), ("bits", pa.int32()), ("step", pa.int32())])


def least_scores(labelled: DataFrame, profiles: Profiles, floor: float, text_col: str = "text", lang_col: str = "lang") -> Least:
    """Least scores from all rows that were learned from and read as their own
    language: their ``LOW`` quantile less ``MARGIN``, and ``floor`` at least.
    A language or size with too few rows takes the wider group's quantile, or
    its own lowest score where that is lower."""
    prepare(labelled.sparkSession)
    rows, languages = _learned(labelled, text_col, lang_col)
    model = labelled.sparkSession.sparkContext.broadcast(profiles)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, p = Out(_SCORES), model.value
        for part in rows_of(batches, "lang", "text"):
            for lang, text in part:
                found, score, grams = p.nearest(text)
                if found == lang:
                    out.add(lang, grams.bit_length(), int(score * _STEPS))
                    if out.full():
                        yield out.take()
        yield out.take()

    # A histogram: at most languages * sizes * steps rows.
    steps = rows.mapInArrow(scores, "lang string, bits int, step int").groupBy("lang", "bits", "step").count().collect() if languages else []

    def low(rows: list, wider: float | None) -> float | None:
        n = {}
        for r in rows:
            n[r["step"]] = n.get(r["step"], 0) + r["count"]
        total, below = sum(n.values()), 0
        if not total or total < LEAST_ROWS and wider is None:
            return wider
        if total < LEAST_ROWS:
            return min(wider, min(n) / _STEPS)
        for step in sorted(n):
            below += n[step]
            if below > LOW * total:
                return step / _STEPS

    def less(x: float | None) -> float:
        return floor if x is None else max(floor, x - MARGIN)

    every = low(steps, None)
    own = {lang: low([r for r in steps if r["lang"] == lang], every) for lang in languages}
    sizes = {(r["lang"], r["bits"]): [] for r in steps}
    for r in steps:
        sizes[r["lang"], r["bits"]].append(r)
    return Least({k: less(low(rows, own[k[0]])) for k, rows in sizes.items()}, {k: less(x) for k, x in own.items()}, floor)


def accept(docs: DataFrame, profiles: Profiles, least_score: float | Least, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text reads as a learned language
    with at least that score; where no language was learned, those with a
    letter.  The text goes to Python beside the row, so the filter needs no join
    and keeps repeated rows."""
    spark = docs.sparkSession
    prepare(spark)
    model = spark.sparkContext.broadcast(profiles)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model.value

        def good(text: str | None) -> bool:
            if not p.languages:
                return bool(len(ngrams(text or "")[0]))
            lang, score, grams = p.nearest(text)
            return lang != UNKNOWN and score >= (least_score(lang, grams) if isinstance(least_score, Least) else least_score)

        for b in slices(batches):
            yield b.filter(pa.array(list(map(good, b.column(at).to_pylist())), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
