import hashlib
import random

import zstandard

from cyclebook.llm import warc as W

LONG = "<p>" + "é" * 60 + "</p>"  # more than 100 bytes
PAGES = [(1, "http://a/1", LONG), (5, "http://a/5", LONG), (3, "http://a/\r\nX: y", LONG), (2, None, "short"),
         (4, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", "WARC/1.1\r\n\r\n" * 30), (9, "u", "x" * 99),
         (10, "u", "x" * 99), (11, "u", "x" * 100), (12, "u", "x" * 100), (13, "u", "z" * 700_000)]


def brute(pages):
    out = []
    for page, _, html in pages:
        payload = (html or "").encode()
        same = [p for p, _, h in pages if (h or "").encode() == payload and p is not None]
        first = min(same) if len(payload) >= 100 and same else page
        out.append((page, len(payload), hashlib.sha256(payload).hexdigest(),
                    "response" if first == page else "revisit", None if first == page else first))
    return out


def key(row):
    return tuple(str(x) for x in row)


def test_archives_read_back(spark):
    table = spark.createDataFrame([(*p, 0) for p in PAGES], "page_id long, url string, html string, digest int").repartition(3)
    got = W.read_archives(W.write_archives(table)).collect()
    assert sorted(map(key, got)) == sorted(map(key, brute(PAGES)))


def test_index_reaches_single_records(spark):
    table = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    index = {r.page_id: r for r in W.write_archives(table).collect()}
    html = {p: (h or "").encode() for p, _, h in PAGES}
    for page in (1, 8, 9, 13):
        row = index[page]
        headers, payload = W.read_record(row.file, row.frame, row.offset)
        assert payload == html[page] and headers["WARC-Record-ID"] == f"<{row.record_id}>"
    headers, payload = W.read_record(index[5].file, index[5].frame, index[5].offset)
    assert payload == b"" and headers["WARC-Type"] == "revisit"
    assert headers["WARC-Refers-To"] == f"<{index[1].record_id}>"
    headers, _ = W.read_record(index[3].file, index[3].frame, index[3].offset)
    assert headers["WARC-Target-URI"] == "http://a/%0D%0AX: y"


def test_frames_are_independent_and_the_table_seeks(tmp_path):
    bundle, rng = W.Bundle(), random.Random(2)
    records = [W.record(i, "u", rng.randbytes(90_000), "0" * 64) for i in range(9)]
    places = [bundle.add(r) for r in records]
    path = str(tmp_path / "b.warc.zst")
    data = b"".join(bundle.finish())
    open(path, "wb").write(data)
    reader = W.BundleReader(path)
    assert len({f for f, _ in places}) > 3
    for (frame, offset), r in zip(places, records):
        assert reader.frame(frame)[offset:offset + len(r)] == r
    # Any Zstandard reader gets the same records and skips the table.
    assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == b"".join(records)


def test_null_and_repeated_pages(spark):
    rows = [(None, "u", LONG), (4, "u", LONG), (2, "u", LONG), (2, "u", LONG), (None, "u", "y" * 200), (None, None, None)]
    got = W.read_archives(W.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes) for r in got)
    n = len(LONG.encode())
    assert kinds == [(0, "response", 0, 0), (0, "response", 0, 200), (0, "revisit", 2, n),
                     (2, "response", 0, n), (2, "response", 0, n), (4, "revisit", 2, n)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.read_archives(W.write_archives(empty)).collect() == []
