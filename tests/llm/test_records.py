import io
import json
import os
import struct
import tempfile
import zlib
from array import array

import pytest
from brute import docs, rows  # noqa: F401
from statsheet.llm.queries import vocabulary_path
from statsheet.llm.records import frame, masked_crc, read_at, read_index, read_record, read_records, write_records
from statsheet.llm.tokens import Encoder
from tokenizers import Tokenizer

TEXTS = ["Hello  world, it's 3 o'clock.\n\n Ärger über Maß", "", "a b\t\tc \n", "日本語 mixed тест ﬁ", "x" * 3000, " lead  and trail  ", "don't'll  ²½ £5 «q»\r\nœuvre", "<|endoftext|> a"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_memo_gives_the_librarys_ids(name):
    e = Encoder(open(vocabulary_path(name), encoding="utf-8").read())
    assert e.pattern is not None
    for t in TEXTS * 2:
        assert e.ids(t) == e.whole(t), t
    e.memo.clear()
    assert [e.ids(t) for t in TEXTS] == [e.whole(t) for t in TEXTS]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_an_untouched_tokenizer(name):
    path = vocabulary_path(name)
    plain, e = Tokenizer.from_file(path), Encoder(open(path, encoding="utf-8").read())
    added = [t["content"] for t in json.loads(open(path, encoding="utf-8").read())["added_tokens"]]
    texts = TEXTS + [x for t in added for x in (t, f"ab{t}cd", f"one {t}\n{t} two", f"é {t.upper()} {t[:-1]}", f"日本{t}")]
    assert added
    for t in texts * 2:
        assert array("I", e.ids(t)).tolist() == plain.encode(t, add_special_tokens=False).ids, t
    for t in added:
        assert len(e.ids(t)) == 4


def test_added_tokens_of_the_normalized_text():
    path = vocabulary_path("word_bpe_49k.json")
    spec = json.loads(open(path, encoding="utf-8").read())
    spec["added_tokens"] = [{**t, "normalized": True, "special": False} for t in spec["added_tokens"]]
    text = json.dumps(spec)
    plain, e = Tokenizer.from_str(text), Encoder(text)
    for t in TEXTS + ["a <|ENDOFTEXT|> b"]:
        assert array("I", e.ids(t)).tolist() == plain.encode(t, add_special_tokens=False).ids, t


def test_frames_round_trip_and_damage_raises():
    many = struct.pack("<3I", 1, 2, 70000)
    data = frame(-5, struct.pack("<2I", 7, 65535)) + frame(None, b"") + frame(2**62, many)
    f = io.BytesIO(data)
    assert [read_record(f) for _ in range(4)] == [(-5, struct.pack("<2I", 7, 65535)), (None, b""), (2**62, many), None]
    for at in (0, 9, 20):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            read_record(io.BytesIO(bytes(broken)))
    with pytest.raises(ValueError):
        read_record(io.BytesIO(data[:10]))
    assert 0 <= masked_crc(b"") < 1 << 32


def test_write_and_read_back(spark, docs):
    folder = tempfile.mkdtemp(prefix="records-test-")
    data = [(i * 7 % 50, TEXTS[i % len(TEXTS)]) for i in range(40)] + [(None, "no id"), (3, None), (14, TEXTS[2])]
    path = vocabulary_path("byte_bpe_50k.json")
    manifest = write_records(docs(data), path, end_id=2, folder=folder)
    got = read_records(spark, manifest)
    e = Encoder(open(path, encoding="utf-8").read())
    end = struct.pack("<I", 2)
    want = sorted((None if i is None else i, len(x) // 4, zlib.crc32(x)) for i, x in ((i, e.whole(t or "") + end) for i, t in data) if i is not None)
    assert [r for r in rows(got, "doc_id", "n_tokens", "ids_crc32") if r[0] is not None] == want
    # starts are running sums in ascending id order, nulls first
    at = 0
    for r in sorted(got.collect(), key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    in_order = [r["doc_id"] for r in sorted(got.collect(), key=lambda r: r["start"])]
    assert in_order == sorted(in_order, key=lambda i: (i is not None, i or 0))
    # the index finds single records
    one = manifest.first()
    offsets = read_index(one["uri"][:-4] + ".idx")
    assert offsets[-1] == os.path.getsize(one["uri"]) and len(offsets) == one["records"] + 1
    k = len(offsets) - 2
    doc_id, ids = read_at(one["uri"], offsets[k])
    assert array("I", ids)[-1] == 2 and (doc_id, len(ids) // 4) in {(r["doc_id"], r["n_tokens"]) for r in got.collect()}


def test_empty_table(spark, docs):
    manifest = write_records(docs([(1, "x")]).limit(0), vocabulary_path("byte_bpe_50k.json"), end_id=2)
    assert read_records(spark, manifest).count() == 0
