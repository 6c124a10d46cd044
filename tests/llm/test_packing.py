import struct
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from brute import docs  # noqa: F401
from statsheet.llm.packing import Packer, pack, powers_of_two, step_groups
from statsheet.llm.queries import vocabulary_path
from statsheet.llm.tokens import Encoder


def covered(windows):
    """Lengths of the documents if their pieces are gapless and unshared."""
    got = {}
    for doc, start, length in sorted(p for _, parts in windows for p in parts):
        assert length > 0 and start == got.get(doc, 0)
        got[doc] = start + length
    return got


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60), st.integers(1, 20))
def test_packer_places_each_token_once(lengths, every):
    p, windows = Packer((4, 8, 16)), []
    for i, n in enumerate(lengths):
        p.add(i, n)
        if i % every == 0:
            windows += p.flush()
    windows += p.flush(last=True)
    assert covered(windows) == dict(enumerate(lengths))
    for size, parts in windows:
        total = sum(x[2] for x in parts)
        assert total == size and size & (size - 1) == 0 and size <= 16  # no padding at all
    assert not any(p.waiting)


def test_routing_and_best_fit():
    p = Packer((4, 8))
    for i, n in enumerate((6, 2, 3, 19)):
        p.add(i, n)
    windows = p.flush(last=True)
    assert (8, [(3, 0, 8)]) in windows and (8, [(3, 8, 8)]) in windows
    assert (8, [(0, 0, 6), (1, 0, 2)]) in windows  # the gap of 2 takes the document of 2


def test_powers_of_two():
    assert [s for s, _ in powers_of_two([(0, 0, 5), (1, 0, 6)])] == [8, 2, 1]


def test_step_groups_are_even():
    windows = [(8, [(i, 0, 8)]) if i % 2 else (8, [(i, 0, 1)] * 8) for i in range(16)] + [(4, [(99, 0, 4)])]
    group = step_groups(windows, step=4)
    sizes = Counter(group)
    assert max(sizes.values()) <= 4 and len({g for g, w in zip(group, windows) if w[0] == 4}) == 1
    cost = Counter()
    for g, (size, parts) in zip(group, windows):
        cost[g] += sum(p[2] ** 2 for p in parts) * (size == 8)
    own = [c for c in cost.values() if c]
    assert max(own) == min(own)


def test_pack_against_library_ids(spark, docs):
    texts = ["Hello world " * n for n in (1, 40, 700, 3000)] + ["", None, "tail"]
    data = [(i % 9, t) for i, t in enumerate(texts * 3)] + [(None, "nameless")]
    path = vocabulary_path("word_bpe_49k.json")
    got = pack(docs(data), path, end_id=1, buffer_tokens=4000, with_ids=True).collect()
    e = Encoder(open(path, encoding="utf-8").read())
    want = Counter((i, e.whole(t or "") + struct.pack("<I", 1)) for i, t in data)
    assert sum(r["length"] for r in got) == sum(len(x) // 4 * n for (_, x), n in want.items())
    sequences, whole = {}, Counter()
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append(r)
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        ids = next(x for (i, x) in want if i == r["doc_id"] and len(x) == 4 * r["doc_tokens"] and x[4 * r["start"] : 4 * (r["start"] + r["length"])] == bytes(r["ids"]))
        whole[(r["doc_id"], ids)] += r["length"]
    assert whole == Counter({k: len(k[1]) // 4 * n for k, n in want.items()})
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == parts[0]["window_size"] <= 2048
    assert pack(docs(data).limit(0), path, end_id=1).count() == 0
