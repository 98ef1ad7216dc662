import gzip
import hashlib
import random

import pytest

from registrum.llm import warc
from registrum.llm.loser_tree import merge


def test_loser_tree():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13, 40):
        runs = [sorted((rng.randrange(30),) for _ in range(rng.randrange(12))) for _ in range(k)]
        assert list(merge([[(x, x) for x in run] for run in runs])) == sorted(x for run in runs for x in run)


def test_tree_keeps_the_order_of_runs_on_ties():
    assert list(merge([[((1,), "a")], [((1,), "b")], [((0,), "c"), ((1,), "d")]])) == ["c", "a", "b", "d"]


def brute(pages):
    first = {}
    for page, _, html in pages:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, _, html in pages:
        payload = (html or "").encode()
        own = first.get(html or "")
        again = len(payload) >= 100 and own is not None and (page is None or page > own)
        digest = hashlib.sha256(payload).hexdigest()
        out.append((page, len(payload), digest, "revisit" if again else "response", own if again else None))
    return sorted(map(repr, out))


@pytest.mark.parametrize("fan_in", [2, 256])
def test_round_trip_and_global_order(spark, monkeypatch, fan_in):
    monkeypatch.setattr(warc, "FAN_IN", fan_in)
    monkeypatch.setattr(warc, "FILE_BYTES", 3000)
    rng = random.Random(6)
    bodies = ["x" * 99, "é" * 50, "<html>" + "body \r\n\r\n" * 40, "", None, "same body " * 30, "l" * 300_000]
    pages = [(i, f"https://{rng.choice('abc')}.Example.com/p{i % 7}?q=%20", rng.choice(bodies)) for i in range(150)]
    pages += [(None, "http://x.com/", bodies[2]), (160, None, bodies[2]), (161, "odd\r\nurl é", "z" * 100)]
    pages += [pages[3], pages[3]]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, urlkey string")
    runs = warc.read_runs(warc.write_archives(df.repartition(5)))
    rows = warc.merged(runs, slice_rows=40).collect()
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(map(repr, found)) == brute(pages)
    rows.sort(key=lambda r: (r.slice, r.place))
    keys = [tuple(r[c] for c in warc.ORDER) for r in rows]
    assert keys == sorted(keys)
    assert len({r.slice for r in rows}) > 2


def test_records_can_be_read_at_their_offset(spark):
    df = spark.createDataFrame([(i, f"http://a.com/{i}", f"page {i} " * 30) for i in range(20)], "page_id long, url string, html string")
    for r in warc.read_runs(warc.write_archives(df)).collect():
        with open(r.file.removeprefix("file:"), "rb") as file:
            file.seek(r.offset)
            content = next(warc.members(file))[1]
        assert content.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
        assert f"WARC-Record-ID: <urn:page:{r.page_id}>".encode() in content
        with gzip.open(r.file.removeprefix("file:")) as whole:
            assert whole.read(8) == b"WARC/1.1"


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.capture_index(df).count() == 0
