import base64
import gzip
import hashlib
import os

from tests.llm.brute import SF_DIR
from tidegate.llm import warc_shards as ws


def expected(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            data = (html or "").encode()
            first[data] = min(page_id, first.get(data, page_id))
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        of = first.get(data) if page_id is not None else None
        revisit = of is not None and of < page_id
        out.append((page_id, len(data), digest, "revisit" if revisit else "response", of if revisit else None))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


ROWS = [
    (1, "http://a/ b\r\nX: y", "<p>é</p>"),
    (2, None, "<p>é</p>"),
    (3, "http://c", None),
    (4, "http://d", ""),
    (None, "http://e", "<p>é</p>"),
    (5, "http://f", "x" * 300_000),
    (5, "http://f", "x" * 300_000),
    (6, "http://g", "x" * 300_000),
    (7, "http://h", "a\r\n\r\nb\r\n\r\n"),
    (7, "http://h", "<p>é</p>"),
]
SCHEMA = "page_id bigint, url string, html string"


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    assert found(ws.round_trip(pages)) == expected([tuple(r) for r in pages.select("page_id", "url", "html").collect()])


def test_awkward_rows(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 AS shard", "'x' AS HTML", "2 AS part")
    assert found(ws.round_trip(pages)) == expected(ROWS)
    assert found(ws.round_trip(spark.createDataFrame([], SCHEMA))) == []


def test_payloads_come_back_whole(spark):
    back = ws.round_trip(spark.createDataFrame(ROWS, SCHEMA), payloads=True).collect()
    assert {bytes(r.payload) for r in back if r.record_type == "response"} == {
        (html or "").encode() for _, _, html in ROWS
    }


def test_short_payloads_are_all_responses(spark):
    back = ws.round_trip(spark.createDataFrame(ROWS, SCHEMA), min_bytes=10).collect()
    assert [r.page_id for r in back if r.record_type == "revisit"] == [6]


def test_files_roll_and_are_the_same_each_time(spark, tmp_path):
    pages = spark.createDataFrame(
        [(i, f"http://x/{i}", hashlib.sha256(str(i).encode()).hexdigest() * 50) for i in range(300)], SCHEMA
    )
    manifests = []
    for name in ("one", "two"):
        manifest = ws.write(pages, f"file://{tmp_path}/{name}", roll_bytes=4_000)
        manifests.append(sorted(map(tuple, manifest.collect())))
    assert manifests[0] == manifests[1] and len(manifests[0]) > 20
    assert sum(m[1] for m in manifests[0]) == 300
    names = os.listdir(f"{tmp_path}/one/records")
    assert not [n for n in names if n.endswith(".tmp")]
    assert sorted(n for n in names if n.endswith(".gz")) == [m[0] for m in manifests[0]]
    ranges = sorted((m[3], m[4]) for m in manifests[0])
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    text = gzip.open(f"{tmp_path}/one/records/{manifests[0][0][0]}").read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")


def test_left_over_files_are_not_read(spark, tmp_path):
    folder = f"file://{tmp_path}/three"
    manifest = ws.write(spark.createDataFrame(ROWS, SCHEMA), folder)
    with open(f"{tmp_path}/three/records/shard-999999-00000.warc.gz", "wb") as stray:
        stray.write(b"not an archive")
    assert found(ws.read(manifest, folder)) == expected(ROWS)


def test_files_are_read_by_a_task_each(spark, tmp_path, monkeypatch):
    pages = spark.range(400).selectExpr("id AS page_id", "'http://a' AS url", "repeat(sha2(string(id), 512), 40) AS html")
    manifest = ws.write(pages, str(tmp_path), roll_bytes=20_000)
    files = manifest.count()
    assert files > 8

    def tasks():
        return len([n for n in ws.read(manifest, str(tmp_path)).rdd.glom().map(len).collect() if n])

    assert tasks() == files
    monkeypatch.setattr(ws, "READERS", 5)
    assert tasks() == 5
    assert ws.read(manifest, str(tmp_path)).count() == 400
