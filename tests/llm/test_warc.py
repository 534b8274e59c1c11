import gzip
import io
import zlib

import pytest
from helpers import DATA, same_as_sql

from docketflow.llm.warc import OP5_SQL, member, members, op5_warc, parse, read_archives, record, write_archives
from docketflow.session import new_work_dir


def test_query_matches_sql(spark):
    same_as_sql(op5_warc(spark, f"{DATA}/sf0.01"), OP5_SQL, f"{DATA}/sf0.01")


def test_round_trip_with_edges(spark):
    big, wide = "é" * 600, "x" * 999
    data = [(1, "http://a/ b\r\n", big), (2, None, big), (3, "u", wide), (4, "u", wide), (5, None, None), (6, "", ""), (7, "u", "z" * 400_000), (None, "u", big), (2, "u", big), (8, "u", "WARC/1.1\r\n\r\n" * 200)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    manifest = write_archives(pages, new_work_dir(spark, "warc-test"), "page_id", "url", "html", roll=2000)
    got = sorted((r.page or "", r.payload_bytes, r.record_type, r.refers_to or "") for r in read_archives(manifest).collect())
    assert got == sorted([("1", 1200, "revisit", "2"), ("2", 1200, "response", ""), ("2", 1200, "response", ""), ("", 1200, "revisit", "2"), ("3", 999, "response", ""), ("4", 999, "response", ""), ("5", 0, "response", ""), ("6", 0, "response", ""), ("7", 400_000, "response", ""), ("8", 2400, "response", "")])
    assert all(r.verified for r in read_archives(manifest).collect())
    names = [r.path.removeprefix("file://") for r in manifest.collect()]
    assert sum(gzip.open(n).read().count(b"WARC-Record-ID") for n in names) == len(data)
    assert read_archives(write_archives(pages.where("false"), new_work_dir(spark, "warc-test"), "page_id", "url", "html")).count() == 0


def test_reader_sees_damage():
    data = member(record(1, "u", b"payload" * 50, None)) + member(record(2, "u", b"", None))
    assert [parse(p)["page"] for p in members(io.BytesIO(data), 7)] == ["1", "2"]
    plain = zlib.decompress(member(record(1, "u", b"payload" * 50, None)), 31)
    assert parse(iter([plain.replace(b"payloadpay", b"PAYLOADpay")]))["verified"] is False
    with pytest.raises(ValueError):
        parse(iter([plain[:-10]]))
    with pytest.raises(EOFError):
        [parse(p) for p in members(io.BytesIO(data[:-5]), 7)]
