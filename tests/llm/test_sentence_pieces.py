import random
import re
import time

import pytest
import sentencepiece
from array import array
from brute import docs, rows  # noqa: F401
from statsheet.llm import sentence_pieces
from statsheet.llm.queries import vocabulary_path
from statsheet.llm.sentence_pieces import MARK, Coder, Model, Search, decode_ids, encode, encode_texts

PATH = vocabulary_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def coder():
    return Coder(open(PATH, "rb").read())


def whole_search(m, text):
    """Scores for every boundary of the text, all pieces tried, then one walk back."""
    best, back = [0.0], [None]
    for end in range(1, len(text) + 1):
        options = [(best[end - 1] + m.unknown, 1, -1)]
        for n in range(1, min(m.longest, end) + 1):
            p = m.pieces.get(text[end - n : end])
            if p:
                options.append((best[end - n] + p[1], n, p[0]))
        s, n, i = max(options)
        best.append(s)
        back.append((n, i))
    out, end = [], len(text)
    while end:
        n, i = back[end]
        out += [i] if i >= 0 else [m.byte_ids[b] for b in reversed(text[end - n : end].encode())]
        end -= n
    return out[::-1]


TEXTS = ["", " ", "a", "Hello world, this is text.", "  two  spaces ", "line\nfeed \n x", "日本語 тест 🙂🙂", "aaaaaaaaaaaaaaaaaaaaaaaa" * 20, "\u0000\x7f", "über Maß – œuvre"]


def test_stretches_against_whole_search_and_round_trip(coder, spark, root):
    texts = TEXTS + [r["text"] for r in spark.read.parquet(f"{root}/documents.parquet").where("doc_id % 10 = 0").collect()]
    for t in texts:
        marked = (" " + t).replace(" ", MARK) if t else ""
        want = [i for s in re.findall(f"{MARK}+[^{MARK}]*", marked) for i in whole_search(coder.model, s)]
        assert list(array("I", coder.encode(t))) == want, t[:40]
        assert coder.decode(coder.encode(t)) == t
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert all(library.decode(list(array("I", coder.encode(t)))) == t for t in texts if "\u0000" not in t)


def test_stream_in_any_pieces(coder):
    rng = random.Random(3)
    for _ in range(30):
        t = "".join(rng.choice(["the", "ing", MARK, "a", "語", "er", "\n", "qq"]) for _ in range(rng.randint(0, 200)))
        s, got, at = Search(coder.model), [], 0
        while at < len(t):
            n = rng.randint(1, 50)
            got += s.feed(t[at : at + n])
            at += n
        assert got + s.finish() == whole_search(coder.model, t)


def held(search):
    return len(search.back)


def test_window_stays_small(coder):
    s = Search(coder.model)
    committed, most = 0, 0
    text = "the cat sat on the mat " * 4000
    for at in range(0, len(text), 1000):
        committed += len(s.feed(text[at : at + 1000]))
        most = max(most, held(s))
    assert committed > 20_000 and len(s.score) <= coder.model.longest + 1 and most < 3 * sentence_pieces._TRIM
    assert s.end - s.root < 2 * coder.model.longest


def test_paths_that_never_meet():
    m = Model({"aa": (1, -1.0)}, ["", "aa", *map(str, range(256))], {2 + b: b for b in range(256)}, frozenset({0}), False)
    s = Search(m)
    assert s.feed("a" * 4001) == [] and len(s.score) == 3 and s.end - s.root == 4001
    assert s.finish() == whole_search(m, "a" * 4001) and s.end == 0
    # One more character settles which of the two it was.
    got = s.feed("a" * 4000 + "ba")
    assert len(got) >= 1999 and got + s.finish() == whole_search(m, "a" * 4000 + "ba")


@pytest.mark.parametrize("text", ["a" * 1_000_000, " " * 300_000, "\n" * 300_000, "ab" * 200_000, "日" * 200_000])
def test_time_is_linear(coder, text):
    """Long runs without a common boundary: a character costs the same at any length."""
    marked = text.replace(" ", MARK)

    def seconds(t):
        s, began = Search(coder.model), time.process_time()
        ids = [i for at in range(0, len(t), 50_000) for i in s.feed(t[at : at + 50_000])] + s.finish()
        return time.process_time() - began, ids

    short, _ = seconds(marked[: len(marked) // 10])
    long, ids = seconds(marked)
    assert long < 30 * short + 1
    assert coder.decode(array("I", ids).tobytes()).strip(" ") == text.strip(" ")
    assert ids[:500] == whole_search(coder.model, marked[:20_000])[:500]


def test_random_models_against_whole_search():
    rng = random.Random(11)
    for _ in range(40):
        pieces = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 5))): 0 for _ in range(rng.randint(1, 9))}
        pieces = {t: (k + 1, -float(rng.randint(1, 6))) for k, t in enumerate(pieces)}
        n = len(pieces) + 1
        m = Model(pieces, ["", *pieces, *map(str, range(256))], {n + b: b for b in range(256)}, frozenset({0}), False)
        t = "".join(rng.choice("ab" if rng.random() < 0.99 else "c") for _ in range(rng.randint(0, 300)))
        s, got, at = Search(m), [], 0
        while at < len(t):
            k = rng.randint(1, 40)
            got += s.feed(t[at : at + k])
            at += k
        assert got + s.finish() == whole_search(m, t)


def test_unigram_scores_against_the_library():
    """With log-probabilities as scores the search is SentencePiece's own unigram search."""
    m = Model({"a": (1, -1.0), "b": (2, -1.5), "ab": (3, -2.2), "aba": (4, -2.0), MARK: (5, -0.5)}, ["", "a", "b", "ab", "aba", MARK], {}, frozenset({0}), False)
    assert encode(m, "abab") == [4, 2] and encode(m, "ab") == [3]


def test_spark_edges(spark, docs):
    data = [(i, t) for i, t in enumerate(TEXTS)] + [(1, "a"), (None, "null id"), (50, None), (51, f"with {MARK} mark"), (52, "word " * 20_000)]
    coded = encode_texts(docs(data), PATH)
    got = {(r["doc_id"], r["n_tokens"], r["round_trip"]) for r in coded.collect()}
    assert coded.count() == len(data) and (50, 0, True) in got and {r for r in got if not r[2]} == {next(r for r in got if r[0] == 51)}
    back = rows(decode_ids(coded, PATH), "doc_id", "text")
    assert back == sorted(((i, (t or "").replace(MARK, " ")) for i, t in data), key=lambda r: (r[0] is not None, r))
    assert encode_texts(docs(data).limit(0), PATH).count() == 0
