import base64
import gzip
import hashlib
import io
import os
import tempfile

import pytest
from brute import rows
from statsheet.llm.warc import info_record, page_record, read_archive, read_archives, write_archives


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def want(pages, least=0):
    out = []
    for page_id, _, html in pages:
        b = (html or "").encode()
        ids = [p for p, _, h in pages if (h or "") == (html or "") and p is not None]
        last = max(ids, default=None)
        revisit = last is not None and page_id != last and len(b) >= least
        out.append((page_id, len(b), digest(b), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


PAGES = [(1, "http://a/ x\n", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "u", "big" * 50_000), (6, "u", "\r\n\r\n"), (None, "u", "<p>é</p>"), (7, "v", "one"), (7, "v", "one"), (None, "w", "alone"), (None, "w", "alone")]


@pytest.mark.parametrize("least", [0, 5])
def test_write_and_read_back(spark, least):
    folder = tempfile.mkdtemp(prefix="warc-test-")
    df = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id bigint, url string, html string, record_type int").repartition(3)
    manifest = write_archives(df, least, folder)
    got = read_archives(spark, manifest, with_payload=True)
    assert rows(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == want(PAGES, least)
    for r in got.collect():
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
        if r["payload"] is not None:
            assert digest(bytes(r["payload"])) == r["payload_digest"]
    # any gzip reader sees the same records
    for f in os.listdir(folder):
        if f.endswith(".warc.gz"):
            assert gzip.open(f"{folder}/{f}").read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert read_archives(spark, write_archives(df)).count() == 0


def test_sequential_reader_checks_what_it_reads():
    payload = b"x" * 300_000
    good = info_record() + page_record(1, "u", digest(payload), len(payload), payload) + page_record(2, "u", digest(payload), len(payload), None, 1)
    kinds = [r.kind for r in read_archive(io.BytesIO(good))]
    assert kinds == ["warcinfo", "response", "revisit"]
    with pytest.raises(ValueError):
        list(read_archive(io.BytesIO(good[:-5])))
    with pytest.raises(ValueError):
        list(read_archive(io.BytesIO(page_record(1, "u", digest(b"other"), 3, b"abc"))))
    with pytest.raises(ValueError):
        list(read_archive(io.BytesIO(gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))))
