from __future__ import annotations

from hashlib import sha1

import pytest

from skyledger.llm import queries, warc
from tests.compare import difference, duck

D = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, record_type string"


def test_chunked_framing():
    for n in (0, 1, 4095, 4096, 4097, 20_000):
        data = bytes(i % 251 for i in range(n))
        assert warc.unchunked(warc.chunked(data)) == data
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: t\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def brute(rows):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        refers = None
        if len(data) >= warc.MIN_REVISIT and page_id is not None and page_id != max(same):
            refers = max(same)
        kind = "response" if refers is None else "revisit"
        out.append((page_id, len(data), sha1(data).hexdigest(), kind, refers))
    return sorted(out, key=repr)


def digests(df):
    names = "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_edge_rows(spark):
    long = "line\r\n\r\nWARC/1.1\r\n" * 4000 + "é\U0001f600"
    rows = [
        (1, "u\r\nX: y", None), (2, "u", ""), (3, None, long), (9, "u", long), (9, "u", long),
        (4, "u", "x" * 999), (5, "u", "x" * 999), (6, "u", "é" * 500), (7, "u", "é" * 500),
        (None, "u", "y" * 2000), (None, "u", "y" * 2000),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    back = warc.round_trip(pages)
    assert digests(back) == brute(rows)
    payloads = {r.page_id: r.payload for r in back.where("record_type = 'response'").collect()}
    assert payloads[9].decode() == long and payloads[3 - 1] == b""
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_whole_table(spark):
    pages = spark.read.parquet(f"{D}/pages.parquet").select("page_id", "url", "html")
    assert digests(warc.round_trip(pages)) == brute([tuple(r) for r in pages.collect()])


@pytest.fixture
def archive(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "z" * 9000, "")], SCHEMA)
    path = f"{tmp_path}/archive"
    warc.write_archive(pages, path, segment_bytes=1000)
    name = next(p for p in (tmp_path / "archive").glob("part-*") if p.stat().st_size)
    return path, name


def test_segments_are_records_of_the_format(spark, archive):
    path, name = archive
    found = list(warc.records(name.read_bytes()))
    kinds = [f["warc-type"] for f, _ in found]
    assert kinds == ["response"] + ["continuation"] * (len(kinds) - 1) and len(kinds) > 5
    assert [int(f["warc-segment-number"]) for f, _ in found] == list(range(1, len(kinds) + 1))
    total = int(found[-1][0]["warc-segment-total-length"])
    assert total == sum(len(b) for _, b in found)
    assert warc.read_archive(spark, path).first().payload == b"z" * 9000


@pytest.mark.parametrize("lost", [0, 3, -1])
def test_a_lost_segment_is_an_error(spark, archive, tmp_path, lost):
    _, name = archive
    found = [warc.record([(k, v) for k, v in f.items() if k != "content-length"], b)
             for f, b in warc.records(name.read_bytes())]
    del found[lost]
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "part-0").write_bytes(b"".join(r + b"\r\n\r\n" for r in found))
    with pytest.raises(Exception, match="missing or cut short"):
        warc.read_archive(spark, f"{tmp_path}/cut").collect()


def test_query_equals_oracle(spark):
    df = queries.op8_warc(spark, D)
    assert difference(df, duck(D), queries.ORACLE["op8_warc"]) is None


def test_records_name_what_they_belong_to(spark, tmp_path):
    """Continuations carry their page's address, revisits that of the page they repeat."""
    html = "<p>copied</p>" * 300
    rows = [(i, f"http://x/{i}", html) for i in range(3)] + [(9, None, "x" * 50_000), (10, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = f"{tmp_path}/archive"
    warc.write_archive(pages, path)
    files = (tmp_path / "archive").glob("part-*")
    found = [f for file in files for f, _ in warc.records(file.read_bytes())]
    revisits = [f for f in found if f["warc-type"] == "revisit"]
    assert {f["warc-refers-to-target-uri"] for f in revisits} == {"http://x/2"} and len(revisits) == 2
    assert all(f["warc-refers-to-date"] == warc.DATE for f in revisits)
    segmented = spark.createDataFrame([(1, "http://y", "y" * 50_000)], pages.schema)
    warc.write_archive(segmented, f"{path}-2")
    files = (tmp_path / "archive-2").glob("part-*")
    found = [f for file in files for f, _ in warc.records(file.read_bytes())]
    parts = [f for f in found if f["warc-type"] == "continuation"]
    assert len(parts) >= 3 and all(f["warc-target-uri"] == "http://y" for f in parts)
    assert warc.read_archive(spark, path).count() == 5
