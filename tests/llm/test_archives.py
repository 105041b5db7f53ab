"""WARC round trips."""

import gzip
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F
from tables import CLASHES, prose, rows_of, saved

from starloom.llm import queries, warc_chunks
from starloom.session import work_path

PAGES = "page_id bigint, url string, html string"
BODY = "<html>" + prose(1, 60) + "</html>"


def odd_pages():
    return [
        (5, "http://a/5", BODY), (3, "http://a/3", BODY), (9, None, BODY), (None, "http://a/n", BODY),
        (1, "http://a/1", None), (2, "http://a/2", ""), (4, "http://a/4", "tiny"), (6, "http://a/6", "tiny"),
        (7, "http://é/ü\r\nX: y", "é" * 200), (8, "u", "WARC/1.1\r\n\r\n" * 20), (10, "u", "x" * 1_000_000),
        (11, "u", "x" * 1_000_000), (12, "u", "y" * 99), (13, "u", "y" * 99), (14, "u", "z" * 100), (15, "u", "z" * 100),
        (20, "u", "q" * 150), (20, "u", "q" * 150), (21, "u", "q" * 150), (None, "u", "n" * 120), (None, "u", "n" * 120),
    ]


def pages(spark, rows=None, clash=False):
    frame = spark.createDataFrame(odd_pages() if rows is None else rows, PAGES)
    return frame.withColumns({c: F.lit(c) for c in CLASHES}) if clash else frame


def plain(rows):
    first = {}
    for id_, _, html in rows:
        if id_ is not None and len((html or "").encode()) >= 100:
            first[html] = min(id_, first.get(html, id_))
    for id_, _, html in rows:
        data = (html or "").encode()
        revisit = html in first and first[html] != id_
        yield (id_, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first[html] if revisit else None)


@pytest.mark.parametrize("clash", [False, True])
def test_op3(spark, tmp_path, clash):
    got = queries.op3_warc_chunks(spark, saved(tmp_path, pages=pages(spark, clash=clash)))
    assert got.filter("not intact").count() == 0
    assert rows_of(got.drop("intact")) == sorted(plain(odd_pages()), key=repr)
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    columns = "page_id, payload_bytes, payload_digest, record_type, refers_to"
    assert sorted(con.execute(f"select {columns} from ({warc_chunks.sql()})").fetchall(), key=repr) == rows_of(got.drop("intact"))


def test_op3_without_pages(spark, tmp_path):
    assert rows_of(queries.op3_warc_chunks(spark, saved(tmp_path, pages=pages(spark, [])))) == []


def archive(spark, rows):
    folder = work_path(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return warc_chunks.write(pages(spark, rows), folder)


def test_chunks_give_back_every_payload_and_url(spark):
    rows = [(i, f"http://x/{i}?q=a bé%20c%25", prose(i, n)) for i, n in enumerate((0, 1, 50, 20_000, 60_000))]
    read = warc_chunks.chunks(archive(spark, rows)).collect()
    for id_, url, html in rows:
        mine = sorted((r for r in read if r.page_id == id_), key=lambda r: r.chunk)
        assert b"".join(bytes(r.data) for r in mine).decode() == html
        assert [r.chunk for r in mine] == list(range(len(mine))) and [r.last for r in mine] == [False] * (len(mine) - 1) + [True]
        assert all(len(r.data) <= 2 * warc_chunks.CHUNK for r in mine) and mine[0].url == url
        size = 0
        for r in mine:
            size += len(r.data)
            assert r.bytes == size and r.digest == hashlib.sha256(html.encode()[:size]).hexdigest()


def test_files_are_gzip_members_of_whole_records(spark):
    manifest = archive(spark, odd_pages()).collect()
    assert sum(m.records for m in manifest) == len(odd_pages())
    text = b"".join(gzip.open(m.path).read() for m in manifest)
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(odd_pages()) and text.endswith(b"\r\n\r\n")
    assert b"\nX: y" not in text  # a URL cannot add header lines


def test_files_nobody_listed_are_not_read(spark):
    manifest = archive(spark, [(1, "u", "a" * 300)])
    folder = manifest.first().path.rsplit("/", 1)[0]
    with open(f"{folder}/lost-task.warc.gz", "wb") as file:
        file.write(b"half a file")
    assert [r.page_id for r in warc_chunks.chunks(manifest).collect()] == [1]


def test_a_cut_archive_is_an_error(spark):
    manifest = archive(spark, [(i, "u", prose(i, 400)) for i in range(5)]).coalesce(1)
    (row, *_) = sorted(manifest.collect(), key=lambda r: -r.records)
    data = open(row.path, "rb").read()
    ends = [i for i in range(len(data)) if data[i:i + 3] == b"\x1f\x8b\x08"] + [len(data)]  # members start here
    whole = warc_chunks.chunks(manifest.filter(F.col("path") == row.path))
    assert whole.filter("last").count() == row.records
    cuts = {ends[1] + 30, ends[-1] - 4, ends[-1] - 40, (ends[0] + ends[1]) // 2} | ({ends[-2]} if row.records > 1 else {0})
    for cut in cuts:
        with open(row.path, "wb") as file:
            file.write(data[:cut])
        if cut == len(data):
            continue
        print('cut', cut, len(data), ends)
        with pytest.raises(Exception, match="ends inside|manifest says"):
            whole.collect()
