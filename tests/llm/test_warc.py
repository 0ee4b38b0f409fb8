import base64
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF, rows
from voxloom.llm import catalog, warc
from voxloom.sources.corpus import open_files


def plain(pages):
    """Figures of (id, payload) rows with distinct ids."""
    first = {}
    for i, p in sorted(pages):
        first.setdefault(p, i)
    return {
        (i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
         "response" if first[p] == i else "revisit", None if first[p] == i else first[p])
        for i, p in pages
    }


def test_query_equals_brute_force(spark):
    pages = [(r.page_id, (r.html or "").encode()) for r in catalog.table(spark, SF, "pages").collect()]
    assert {tuple(r) for r in catalog.op2_warc(spark, SF).collect()} == plain(pages)


def test_round_trip(spark, tmp_path):
    pages = [(1, "u v\r\n", ""), (2, None, None), (3, "u", "x" * 3_000_000), (4, "u", "é"), (5, "w", "é"), (6, "u", "x" * 3_000_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("key", F.lit("extra"))
    manifest = warc.write_archives(df, str(tmp_path), archive_bytes=4000)
    records = warc.read_archives(manifest)
    got = {tuple(r) for r in warc.digests(records, "page_id", "long").collect()}
    assert got == plain([(i, (h or "").encode()) for i, _, h in pages])
    payloads = {r.key: r.payload for r in records.collect() if r.record_type == "response"}
    assert payloads == {"1": b"", "3": b"x" * 3_000_000, "4": "é".encode()}
    assert manifest.agg(F.sum("records")).first()[0] == len(pages)
    large = warc.write_archives(df, str(tmp_path), min_revisit_bytes=10)
    assert warc.read_archives(large).where("record_type = 'revisit'").count() == 1


def test_edges(spark, tmp_path):
    data = [(None, None, "p"), (7, None, "p"), (7, None, "p"), (None, None, "q")]
    df = spark.createDataFrame(data, "page_id long, url string, html string")
    got = warc.read_archives(warc.write_archives(df, str(tmp_path))).select("key", "record_type", "refers_to")
    assert rows(got) == {(None, "revisit", "7"): 1, ("7", "response", None): 2, (None, "response", None): 1}
    manifest = warc.write_archives(df.limit(0), str(tmp_path))
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0


def archive(tmp_path, records):
    writer = warc._Writer(str(tmp_path), open_files, 1 << 30)
    for r in records:
        writer.add(r)
    writer.close()
    return writer.closed[0]["path"]


def test_one_frame_per_record_after_the_dictionary(tmp_path):
    records = [warc.record(str(k), "u", b"payload %d" % k, None) for k in range(500)]
    data = open(archive(tmp_path, records), "rb").read()
    assert data[:4] == bytes.fromhex("5d2a4d18")
    assert [d for _, d in warc.frames(io.BytesIO(data))] == records


def test_damage_is_found(spark, tmp_path):
    good = warc.record("1", "u", b"abc", None)
    for bad in (
        good.replace(b"abc", b"abd"), good[:-1], good.replace(b"WARC/1.1", b"WARC/2.0"),
        good.replace(b"WARC-Date", b"Warc-Day"), good.replace(b"Content-Length: ", b"Content-Length: 1", 1),
        warc.record("2", "u", b"abc", "1").replace(b"WARC-Refers-To", b"X-Refers-To"),
    ):
        with pytest.raises(warc.ArchiveError):
            warc.parsed(bad)
    assert warc.parsed(good)["payload"] == b"abc"
    data = open(archive(tmp_path, [good] * 3), "rb").read()
    for bad in (data[:-3], data[8:], data[:6], data[:-40] + b"?" * 40):
        with pytest.raises(warc.ArchiveError):
            list(map(warc.parsed, (d for _, d in warc.frames(io.BytesIO(bad)))))
    (tmp_path / "cut.warc.zst").write_bytes(data[:-3])
    cut = spark.createDataFrame([(str(tmp_path / "cut.warc.zst"),)], "path string")
    with pytest.raises(Exception, match="cut off"):
        warc.read_archives(cut).collect()


def test_folders_with_odd_names(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    manifest = warc.write_archives(df, f"file://{tmp_path}/a b %20+")
    assert warc.read_archives(manifest).count() == 1
