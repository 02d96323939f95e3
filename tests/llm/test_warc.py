"""Archives written, normalised and read back by offset, on ordinary and awkward pages."""

import glob
import gzip
import hashlib
import json
import zlib

import pytest

from panelspark.llm import warc
from panelspark.llm.queries import QUERIES, SQL
from tests.compare import connect, difference, spark_table, sql_table

SMALL = "/root/testdata/sf0.001"
DATE = "2024-01-01T00:00:00Z"
SCHEMA = "page_id long, url string, html string, record string, first long, digest string, block int"
LONG = "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 5


def round_trip(spark, tmp_path, pages, payloads=True):
    raw, done = str(tmp_path / "raw"), str(tmp_path / "done")
    warc.write_archives(warc.record_texts(pages, "page_id", "url", "html", DATE), raw)
    made = warc.normalise(spark, raw, done).collect()
    return raw, done, made, warc.read_records(warc.read_index(spark, done), payloads)


def awkward():
    texts = [None, "", "a", "\n", "\r\n", "\r\n\r\n", "\r", "é\U0001f600" * 40, LONG, LONG + "\r", LONG + "\n", "é" * 49 + "z", "é" * 50, "\x00﻿"]
    rows = [(i, f"http://a/{i}", t) for i, t in enumerate(texts)]
    rows += [(100 + i, None, t) for i, t in enumerate(texts)]
    rows += [(200, "http://b/\r\nWARC-Type: x", LONG), (200, "http://c/", LONG), (8, "http://d", LONG), (None, "u", LONG), (None, None, "z" * 200)]
    rows += [(1000 + i, "hot", "h" * 150) for i in range(300)]
    return rows


def test_awkward_pages(spark, tmp_path):
    rows = awkward()
    pages = spark.createDataFrame([(*r, "r", 1, "d", 2) for r in rows], SCHEMA).repartition(3)
    raw, done, made, back = round_trip(spark, tmp_path, pages)
    got = back.collect()
    assert len(got) == len(rows) == sum(r["records"] for r in made)

    first = {}
    for i, _, t in rows:
        if i is not None and len((t or "").encode()) >= warc.REVISIT_BYTES:
            first[t] = min(i, first.get(t, i))
    want = []
    for i, u, t in rows:
        data = (t or "").encode()
        low = first.get(t) if len(data) >= warc.REVISIT_BYTES else None
        again = low is not None and i != low
        name = f"urn:page:{'' if i is None else i}"
        u = u and u.replace("\r", "%0D").replace("\n", "%0A")
        kind = ("revisit", u, f"urn:page:{low}") if again else ("response", u, None)
        want.append((name, *kind, len(data), hashlib.sha256(data).hexdigest(), None if again else data))
    key = lambda r: tuple(map(repr, r))
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_every_record_is_a_member_of_its_own(spark, tmp_path):
    pages = spark.createDataFrame([(*r, "r", 1, "d", 2) for r in awkward()], SCHEMA).coalesce(1)
    raw, done, made, _ = round_trip(spark, tmp_path, pages)
    (archive,) = glob.glob(f"{done}/*.warc.gz")
    (source,) = glob.glob(f"{raw}/*.gz")
    whole = gzip.open(source).read()
    # the source is one stream: its first member is everything
    one = zlib.decompressobj(wbits=31)
    assert one.decompress(open(source, "rb").read()) == whole and one.unused_data == b""
    assert gzip.open(archive).read() == whole
    data, at = open(archive, "rb").read(), 0
    for line in open(archive + ".idx", encoding="utf-8"):
        row = json.loads(line)
        assert row["offset"] == at
        member = zlib.decompressobj(wbits=31)
        text = member.decompress(data[at : at + row["length"]])
        assert member.eof and not member.unused_data and text.startswith(b"WARC/1.1\r\n")
        at += row["length"]
    assert at == len(data) == made[0]["bytes"]
    assert not [f for f in glob.glob(f"{done}/*") if not f.endswith((".warc.gz", ".idx"))]


def test_a_filtered_index_reads_only_its_records(spark, tmp_path):
    rows = [(i, None, f"page {i} " * 30) for i in range(50)]
    pages = spark.createDataFrame([(*r, "r", 1, "d", 2) for r in rows], SCHEMA)
    _, done, _, _ = round_trip(spark, tmp_path, pages)
    index = warc.read_index(spark, done).filter("record_id = 'urn:page:17'")
    (one,) = warc.read_records(index).collect()
    assert bytes(one["payload"]).decode() == rows[17][2]


def test_empty_table_and_archives_of_others(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert round_trip(spark, tmp_path, none)[3].collect() == []
    # bare line feeds, a warcinfo record, members already apart, and an empty archive
    info = b"WARC/1.0\nWARC-Type: warcinfo\nWARC-Record-ID: <urn:a>\nContent-Length: 2\n\nhi\n\n"
    page = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:b>\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    source = tmp_path / "others"
    source.mkdir()
    (source / "a.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(page * 2))
    (source / "b.warc.gz").write_bytes(gzip.compress(b""))
    done = str(tmp_path / "others-done")
    assert {r["records"] for r in warc.normalise(spark, str(source), done).collect()} == {3}
    kinds = warc.read_index(spark, done).orderBy("offset").collect()
    assert [r["record_type"] for r in kinds] == ["warcinfo", "resource", "resource"]


@pytest.mark.parametrize("bad", [b"junk\r\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort"])
def test_damaged_archives_are_refused(spark, tmp_path, bad):
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(bad))
    with pytest.raises(Exception, match="no record begins|cut short"):
        warc.normalise(spark, str(tmp_path), str(tmp_path / "done"))


def test_query_equals_sql(spark):
    got = spark_table(QUERIES["op12_warc"](spark, SMALL))
    assert difference(got, sql_table(connect(SMALL), SQL["op12_warc"])) is None
