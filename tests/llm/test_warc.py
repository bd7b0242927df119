import base64
import gzip
import hashlib

from lakeshore.llm import warc

from tests.llm.skew import splits

SCHEMA = "page_id long, url string, html string, offset string"
ROWS = [
    (5, "http://a/x y\r\n", "<p>é</p>", "x"),
    (3, "http://b/", "<p>é</p>", "x"),
    (9, None, "<p>é</p>\r\n\r\nWARC/1.1", None),
    (4, "http://c/", None, "x"),
    (2, "http://c/", "", "x"),
    (3, "http://b/", "<p>é</p>", "x"),
    (None, "http://d/", "", "x"),
    (None, "http://e/", "only here", "x"),
    (11, "http://f/", "long " * 100000, "x"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted(map(tuple, warc.round_trip(pages).collect()), key=repr)
    refers = {5: 3, 4: 2}
    want = []
    for page_id, _, html, _ in ROWS:
        to = 2 if page_id is None and not html else refers.get(page_id)
        want.append((page_id, len((html or "").encode()), digest(html), "revisit" if to else "response", to))
    assert got == sorted(want, key=repr)


def test_least_bytes(spark):
    pages = spark.createDataFrame([(1, "u", "ab", None), (2, "u", "ab", None), (3, "u", "abc", None), (4, "u", "abc", None)], SCHEMA)
    got = {r.page_id: r.refers_to for r in warc.round_trip(pages, least_bytes=3).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_archives_and_selected_records(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"page {i % 40}", None) for i in range(100)], SCHEMA).coalesce(2)
    index = warc.write(pages, str(tmp_path / "w"))
    for r in index.collect():
        with open(r.file.removeprefix("file://"), "rb") as f:
            f.seek(r.offset)
            assert f"<urn:page:{r.page_id}>".encode() in gzip.decompress(f.read(r.length)).split(b"\r\n\r\n")[0]
    for r in index.select("file").distinct().collect():
        whole = gzip.open(r.file.removeprefix("file://")).read()
        assert whole.startswith(b"WARC/1.1\r\n") and whole.endswith(b"\r\n\r\n")
    got = warc.read(index.where("page_id % 3 = 0")).collect()
    assert sorted((r.page_id, r.payload) for r in got if r.record_type == "response") == [(i, f"page {i}".encode()) for i in range(0, 40, 3)]
    assert all(r.payload is None and r.refers_to == r.page_id % 40 for r in got if r.record_type == "revisit")


def test_ranges():
    assert warc.ranges([(0, 10), (10, 5), (16, 4), (200, 1)], gap=2, most=100) == [(0, 20, 3), (200, 201, 1)]
    assert warc.ranges([(0, 60), (60, 60)], gap=2, most=100) == [(0, 60, 1), (60, 120, 1)]


def test_pages_without_ids_refer_to_none(spark):
    pages = spark.createDataFrame([(None, "http://a/", "same", "x"), (None, "http://b/", "same", "x")], SCHEMA)
    want = (None, 4, digest("same"), "response", None)
    assert [tuple(r) for r in warc.round_trip(pages).collect()] == [want, want]


def test_a_payload_of_many_pages_is_split(spark):
    pages = spark.range(30000).selectExpr("id AS page_id", "'http://a/' AS url", "if(id % 3 = 0, concat('own ', id), 'shared by most') AS html")
    assert splits(spark, lambda: warc.with_roles(pages))
