"""Broken pages in time that grows with them; archives of other writers."""

from __future__ import annotations

import hashlib
import time

import pytest
from pyspark.sql import functions as F

from docspark.llm import htmltext, warc

TEXT = " ".join(["Some words of an article that goes on for quite a while."] * 6)


@pytest.mark.parametrize("unit", ["<a ", "<a'>'", "<a '>", "<div>some text ", "<li>x ", "<button>x", "<svg><button>", "</p><div>", "<!-- ",
                                  "<script", "<div></p>x", "<p><b></div>"])
def test_long_broken_pages(unit):
    def seconds(n):
        began = time.process_time()
        htmltext.main_text(unit * (n // len(unit)))
        return time.process_time() - began

    seconds(20_000)
    assert seconds(400_000) < 10  # quadratic time would be minutes
    page = f"<article><p>{TEXT}</p></article>" + unit * 2000
    assert TEXT in htmltext.main_text(page)


def test_tags_of_a_page():
    found = [t[2:] for t in htmltext.tags("<p a='x>y'><!-- <b> --><script>if (a<b) {}</script><svg/><br/></P ><b x='>t<i>")]
    assert found == [("p", False, " a='x>y'"), ("", False, ""), ("", False, ""), ("svg", False, "/"), ("br", False, "/"),
                     ("p", True, " "), ("b", False, " x='"), ("i", False, "")]


def foreign(kind, name, block, content="text/plain", extra=()):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"warc-record-id:{name}", f"Content-Type: {content}", *extra, f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def stored(spark, folder, data):
    (folder / "a.warc.gz").write_bytes(data)
    return spark.createDataFrame([(f"file://{folder}/a.warc.gz", len(data))], "path string, size long")


def test_records_of_other_writers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\nbody"
    made = [foreign("warcinfo", "<urn:uuid:1>", b"software: x\r\n", "application/warc-fields"),
            foreign("request", "<urn:uuid:2>", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "application/http; msgtype=request"),
            foreign("response", "<urn:uuid:3>", http, "application/http; msgtype=response", ["WARC-Target-URI: http://a/"]),
            foreign("metadata", "<urn:uuid:4>", b"fetchTimeMs: 5"), foreign("resource", "<urn:uuid:5>", b"")]
    fake = [b"WARC/ is a nice format", b"WARC/1.0\r\nWARC-Type: x\r\n\r\nno length", b"WARC/1.0", b"WARC/1.0\r\nContent-Length: 1\r\n\r\nx"]
    data = b"".join(warc.gzipped(m) + warc.gzipped(f) for m, f in zip(made, [*fake, b"other"]))
    for split in (8 << 20, 61):
        out = warc.records(stored(spark, tmp_path, data), split=split)
        got = sorted((r["record_id"], r["type"], r["id"], r["length"], bytes(r["payload"]), r["uri"]) for r in out.collect())
        assert got == [("<urn:uuid:1>", "warcinfo", None, 13, b"software: x\r\n", None), ("<urn:uuid:2>", "request", None, 0, b"", None),
                       ("<urn:uuid:3>", "response", None, 4, b"body", "http://a/"), ("<urn:uuid:4>", "metadata", None, 14, b"fetchTimeMs: 5", None),
                       ("<urn:uuid:5>", "resource", None, 0, b"", None)]
    assert out.where("type = 'response'").first()["digest"] == hashlib.sha1(b"body").hexdigest()


def test_ranges_are_read_by_many_tasks(spark, tmp_path):
    data = b"".join(warc.gzipped(warc.record(i, "u", "response", "d", bytes([i % 250]) * 900, 900, None)) for i in range(300))
    out = warc.records(stored(spark, tmp_path, data), split=len(data) // 12)
    tasks = out.select("id", F.spark_partition_id().alias("task"))
    assert sorted(r[0] for r in tasks.collect()) == list(range(300))
    assert tasks.select("task").distinct().count() >= 6 and out.rdd.getNumPartitions() >= 12


def test_a_cut_off_record_is_not_lost_silently(spark, tmp_path):
    whole = warc.gzipped(warc.record(1, "u", "response", "d", b"x" * 5000, 5000, None), 0)
    with pytest.raises(Exception, match="ends inside the record"):
        warc.records(stored(spark, tmp_path, whole + whole[:-900])).collect()
