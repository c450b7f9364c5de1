import base64
import gzip
import hashlib
import os
from collections import defaultdict

from conftest import SF001

from affinity.llm import warc


def check(rows, got):
    def digest(h):
        return base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    assert sorted(map(str, ((r[0], len((r[2] or "").encode()), digest(r[2])) for r in rows))) == sorted(
        map(str, ((g.page_id, g.payload_bytes, g.payload_digest) for g in got)))
    groups = defaultdict(list)
    for r in rows:
        groups[digest(r[2])].append(r[0])
    for d, ids in groups.items():
        mine = [g for g in got if g.payload_digest == d]
        top = max((i for i in ids if i is not None), default=None)
        assert [g.page_id for g in mine if g.record_type == "response"] == [top]
        assert all(g.refers_to is None if g.record_type == "response" else g.refers_to == top for g in mine)


def test_whole_table(spark):
    p = spark.read.parquet(f"{SF001}/pages.parquet")
    check([tuple(r) for r in p.select("page_id", "url", "html").collect()], warc.round_trip(p).collect())


def test_copies_nulls_and_repeats(spark):
    rows = [(1, "http://a/ b\r\nX: y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", ""), (4, "u", None), (5, "u", "x" * 200000),
            (5, "u", "x" * 200000), (None, None, None), (None, "v", "only"), (7, "w", "\r\n\r\nWARC/1.1")]
    p = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS row", "2 AS payload", "3 AS sha1")
    check(rows, warc.round_trip(p).collect())
    assert warc.round_trip(p.limit(0)).count() == 0


def test_selected_records_are_read_by_ranges(spark, scratch):
    p = spark.read.parquet(f"{SF001}/pages.parquet")
    index = warc.write(p, f"file://{scratch}/a", archive_bytes=20_000)
    names = [n for n in os.listdir(f"{scratch}/a") if n.endswith(".warc.gz")]
    assert set(names) == {r.archive for r in index.select("archive").distinct().collect()} and len(names) > 1
    some = index.filter("page_id % 7 = 0")
    got = {r.page_id: r for r in warc.read(some, f"file://{scratch}/a").collect()}
    html = {r.page_id: r for r in p.filter("page_id % 7 = 0").collect()}
    assert set(got) == set(html)
    for i, r in got.items():
        if r.record_type == "response":
            assert bytes(r.payload).decode() == html[i].html and r.url == html[i].url
    # an archive is plain gzip of WARC records
    with gzip.open(f"{scratch}/a/{names[0]}") as f:
        assert f.readline() == b"WARC/1.1\r\n"


def test_small_payloads_are_no_revisits(spark, scratch):
    rows = [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "y" * 50), (4, "u", "y" * 50)]
    p = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.write(p, f"file://{scratch}/b", min_bytes=10)
    assert {r.page_id: r.record_type for r in index.collect()} == {1: "response", 2: "response", 3: "revisit", 4: "response"}
