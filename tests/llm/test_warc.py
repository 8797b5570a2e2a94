import base64
import gzip
import hashlib
import io

import pytest

from tunemill.llm import warc
from tunemill.session import scratch_path

PAGES = "page_id long, url string, html string, digest string, first string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


ROWS = [(3, "http://www.a.com/x?q=1", "same"), (1, "https://b.org/y", "same"), (2, None, None), (7, "", ""),
        (9, "http://A.com:80/ÿ é\n", "ünique"), (4, "http://a.com/x", "same"), (12, "no scheme", "z" * 100_000),
        (-5, "http://neg.net/", "negative"), (11, "http://a.com/x", "other"), (11, "http://a.com/x", "other"),
        (None, "http://n.com/", "same"), (None, "http://n.com/", "lonely")]


def plain(rows, least=0):
    out = []
    for page, url, html in rows:
        data = (html or "").encode()
        alike = [p for p, _, h in rows if (h or "") == (html or "") and p is not None and len(data) >= least]
        first = min(alike, default=None)
        refers = None if first is None or first == page else first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 4, 5])
def test_pages_come_back_through_the_index(spark, least):
    got = warc.archived(pages_of(spark, ROWS), least, block_lines=2)
    assert sorted((tuple(r) for r in got.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr) == plain(ROWS, least)
    texts = {r.page_id: r.payload for r in got.where("record_type = 'response'").collect()}
    assert bytes(texts[9]) == "ünique".encode()


def test_empty_table(spark):
    assert warc.archived(pages_of(spark, ROWS).limit(0)).count() == 0


def test_files_are_archives_of_single_members(spark):
    folder = scratch_path(spark, "archives")
    captures = warc.write_archives(pages_of(spark, ROWS), folder, file_bytes=500).collect()
    assert len({c.file for c in captures}) > 1
    for c in captures:
        data = open(f"{folder}/{c.file}", "rb").read()[c.begin:c.begin + c.length]
        fields, block = warc.parsed(gzip.GzipFile(fileobj=io.BytesIO(data)).read())
        assert warc.page_of(fields["warc-record-id"]) == c.page_id
        assert int(fields["content-length"]) == len(block)


def test_lookup_of_missing_and_repeated_keys(spark):
    folder = scratch_path(spark, "archives")
    captures = warc.write_archives(pages_of(spark, ROWS), folder)
    directory = warc.write_index(captures, folder, block_lines=1)
    wanted = [warc.capture_key("http://a.com/x", 11), warc.capture_key("http://a.com/x", 5), "zzz", "",
              warc.capture_key("https://b.org/y", 1)]
    keys = spark.createDataFrame([(k,) for k in wanted], "key string")
    got = sorted(tuple(r) for r in warc.look_up(keys, directory, folder).collect())
    want = sorted((c.file, c.begin, c.length) for c in captures.collect() if c.page_id in (11, 1))
    assert got == want


def test_keys_sort_hosts_from_the_end():
    assert warc.url_key("http://www.A.com:80/x?y#z") == "com,a,www)/x?y#z"
    ids = [None, -(1 << 63), -1, 0, 1, (1 << 63) - 1]
    assert [warc.page_of(warc.record_id(i)) for i in ids] == ids
    keys = [warc.capture_key("http://a.b/", i) for i in ids]
    assert keys == sorted(keys)
