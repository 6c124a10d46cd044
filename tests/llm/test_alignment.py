import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from brute import docs, rows  # noqa: F401
from statsheet.llm import alignment
from statsheet.llm.alignment import Pair, Tokenizers, align, compare
from statsheet.llm.queries import REGISTRY, vocabulary_path
from tokenizers import Tokenizer

A, B = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
TEXTS = [
    "Hello  world, it's 3 o'clock.\n\n Ärger über Maß", "", None, "a b\t\tc \n", "日本語 mixed тест ﬁ", "x" * 3000, " lead  and trail  ", "don't'll  ²½ £5 «q»\r\nœuvre",
    "<|endoftext|> a <s> </s> <unk> <0x0A>", "a▁b", "tab\x00nul \x85 　 wide ᠎ x", "é é \U0001f600 \U0001f600", " ", "  ", "foo\n\n  bar \n baz", "foo\n bar", " x   y",
    "a b c", "1 2 33 4444 55555", "word " * 400, "﻿ bom",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(libraries, text):
    """([(id, bytes)] of A, of B), straight from the libraries."""
    a, b = libraries
    letters = {}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    for x in range(256):
        letters[chr(x) if x in plain else chr(256 + len([y for y in range(x) if y not in plain]))] = x
    if not text:
        return [], []
    one = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    whole = (" " + text).encode()
    return (one, two) if b"".join(x for _, x in one) == whole == b"".join(x for _, x in two) else ([], [])


def spans(found):
    at, out = 0, []
    for i, x in found:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def brute(libraries, data):
    """Rows of the query, from all token pairs of each text."""
    each, counts = [], Counter()
    for i, text in data:
        one, two = map(spans, tokens(libraries, text))
        links = [(a, b) for a, s, e in one for b, t, u in two if s < u and t < e]
        counts.update(set(links))
        ends = sorted({e for *_, e in one} & {e for *_, e in two})
        groups, last = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(x) for x, s, f in side if last <= s and f <= e) for side in (one, two)))
            last = e
        each.append((i, one, two, groups, links))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(
        (i, len(one), len(two), len(groups), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if one else "")
        for i, one, two, groups, links in each
    )


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("most", [alignment.FREQUENT, 100, 0])
def test_equals_all_pairs(spark, docs, libraries, most):  # noqa: F811
    data = [*enumerate(TEXTS)] + [(3, TEXTS[3]), (50, "Hello  world, it's"), (51, "Hello world")]
    df = docs(data).withColumnsRenamed({"kept": "row_id", "start": "a_ids"})
    got = compare(df, Tokenizers(spark, A, B), most).select(*COLUMNS)
    assert rows(got) == brute(libraries, data)


def test_stretches_have_the_librarys_ids(libraries):
    p = Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())
    assert p.cuttable and p.spells
    rng = random.Random(2)
    mixed = ["".join(rng.choice(["den", ".", "\n", " ", "Teer", "é", "日", "\t", "1", "'s", "\r\n", "<0x0A>", "a b"]) for _ in range(60)) for _ in range(200)]
    for texts in (TEXTS, TEXTS + mixed, mixed):
        for t, ids in zip(texts, p.ids([None if t is None else t.encode() for t in texts])):
            one, two = tokens(libraries, t)
            assert [memoryview(x).cast("I").tolist() for x in ids] == [[i for i, _ in one], [i for i, _ in two]], t
    assert p.ids([b"ab\xff"]) == [(b"", b"")] and p.memo


def test_memo_is_bounded(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "MEMO_ENTRIES", 5)
    p = Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())
    p.ids([b"one two three four five six seven eight nine"])
    assert len(p.memo) == 5
    assert p.ids([b"nine " + b"x" * 99]) == p.ids([b"nine " + b"x" * 99]) and len(p.memo) == 5


def test_other_tokenizers_get_texts_whole(libraries):
    import json

    spec = json.loads(open(A, encoding="utf-8").read())
    spec["normalizer"] = {"type": "Lowercase"}
    p = Pair(json.dumps(spec), open(B, "rb").read())
    assert not p.spells
    p.cuttable = False
    got = p.ids([b"Some Text", b"some text", "日本 x".encode()])
    assert got[0] == (b"", b"") and [memoryview(x).cast("I").tolist() for x in got[1]] == [[i for i, _ in side] for side in tokens(libraries, "some text")]
    assert memoryview(got[2][1]).cast("I").tolist() == [i for i, _ in tokens(libraries, "日本 x")[1]]


def test_groups_are_given_as_text(spark, docs, libraries):  # noqa: F811
    got = align(docs([(1, "tokenizers disagree"), (2, None)]), Tokenizers(spark, A, B)).collect()
    groups = {r["doc_id"]: r["groups"] for r in got}
    assert groups[2] == "" and groups[1].count(";") + 1 == {r["doc_id"]: r["n_groups"] for r in got}[1]
    ids = [[int(i) for g in groups[1].split(";") for i in g.split("|")[s].split(",")] for s in (0, 1)]
    assert ids == [[i for i, _ in side] for side in tokens(libraries, "tokenizers disagree")]


def test_null_ids_and_empty_tables(spark, docs, libraries):  # noqa: F811
    both = Tokenizers(spark, A, B)
    got = rows(compare(docs([(None, "a b"), (None, "a b"), (4, "a")]), both).select(*COLUMNS))
    assert [r[0] for r in got] == [None, None, 4] and got[0] == got[1]
    assert compare(docs([(1, "a")]).limit(0), both).count() == 0


def test_many_pairs_are_handed_on(spark, docs, libraries, monkeypatch):  # noqa: F811
    data = [(i, " ".join(TEXTS[j % len(TEXTS)] or "q" for j in range(i, i + 3))) for i in range(12)]
    data = [(i, t.replace("▁", "")[:400]) for i, t in data]
    monkeypatch.setattr(alignment, "CHUNK", 500)
    monkeypatch.setattr(alignment, "HELD_PAIRS", 40)
    p = Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())

    class Local:
        def pair(self):
            return p

    import pyarrow as pa

    ids = p.ids([t.encode() for _, t in data])
    taken = {}

    class Frame:  # the function that a task runs
        def select(self, *_):
            return self

        where = select

        def mapInArrow(self, run, _):
            taken["rows"] = [r for b in run(iter([pa.record_batch({"a_ids": [x for x, _ in ids], "b_ids": [y for _, y in ids]})])) for r in b.to_pylist()]
            raise StopIteration

    with pytest.raises(StopIteration):
        alignment.link_counts(Frame(), Local())
    got, counts = Counter(), Counter()
    for r in taken["rows"]:
        got[r["a"], r["b"]] += r["n"]
    for _, t in data:
        one, two = map(spans, tokens(libraries, t))
        counts.update({(a, b) for a, s, e in one for b, x, y in two if s < y and x < e})
    assert got == counts and len(taken["rows"]) > len(counts)


def test_query_equals_all_pairs_on_some_documents(spark, root, libraries):
    got = {r["doc_id"]: r for r in REGISTRY["op13_alignment"](spark, root).collect()}
    read = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(read)
    for doc_id, text in read:
        one, two = tokens(libraries, text)
        assert (got[doc_id]["n_a"], got[doc_id]["n_b"]) == (len(one), len(two))
