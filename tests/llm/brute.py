"""Plain-Python statements of what the operators compute, for small inputs."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, words):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()


def near_components(rows, words, percent):
    """{doc_id: (set size, component)} by comparing all pairs."""
    sets = {i: shingle_set(t, words) for i, t in rows}
    part = {i: i for i in sets}
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and part[i] != part[j] and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((part[i], part[j]))
                part = {k: low if v == high else v for k, v in part.items()}
    return {i: (len(sets[i]), part[i]) for i in ids}


def repeats(rows, length):
    """[(doc_id, n_bytes, n_removed, n_spans, sha256, kept bytes)] in order."""
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[j : j + length] for _, b in data for j in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                gone[j : j + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def rows(df, *cols):
    """Sorted tuples of a DataFrame, nulls first."""
    cols = cols or df.columns
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(got, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.fixture(scope="session")
def docs(spark):
    """Make a documents table of (doc_id, text[, lang]) rows, with a clashing extra column."""

    def make(data, parts=3):
        data = [(*r, None)[:3] for r in data]
        df = spark.createDataFrame(data, "doc_id bigint, text string, lang string").repartition(parts)
        return df.selectExpr("*", "'x' as source", "cast(length(text) as bigint) as n_chars", "1 as kept", "2 as start")

    return make
