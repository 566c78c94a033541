import hashlib

from pyspark.sql import functions as F

from quadra.llm import op1, warc
from quadra.llm.warc import END, MAGIC, read_warc, write_warc
from tests.llm.oracle import same


def test_query_against_sql(spark, sf):
    same(op1.op1_warc(spark, sf), op1.SQL["op1_warc"], sf)


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, file string")


NESTED = MAGIC + "WARC-Type: response\r\nContent-Length: 5" + END + "hello" + END


def test_round_trip_with_magic_in_payloads(spark, tmp_path):
    big = "x" * 150
    rows = [
        (1, "http://a/1", big, "x", "y"),
        (2, "http://a/2", big, "x", "y"),
        (3, "http://a/3", None, None, None),
        (4, None, "", "", ""),
        (5, "u", "a" + NESTED + NESTED + "tail é", "", ""),
        (6, "u", MAGIC + MAGIC, "", ""),
        (7, "u", "short", "", ""),
        (8, "u", "short", "", ""),
        (9, "u\r\nContent-Length: 3", "z" * 3000, "", ""),
        (1, "http://a/1", big, "x", "y"),
    ]
    for compression in ("gzip", None):
        path = str(tmp_path / f"w-{compression}")
        write_warc(_pages(spark, rows), path, compression=compression, files=1)
        got = read_warc(spark, path).select("record_id", "record_type", "refers_to", "payload", "payload_length").collect()
        assert len(got) == len(rows)
        by = {}
        for r in got:
            by.setdefault(int(r.record_id.split(":")[-1]), []).append(r)
        for i, _, html, _, _ in rows:
            for r in by[i]:
                if i == 2:
                    assert (r.record_type, r.refers_to, bytes(r.payload)) == ("revisit", "urn:page:1", b"")
                else:
                    assert r.record_type == "response" and bytes(r.payload) == (html or "").encode()
                assert r.payload_length == len((html or "").encode())


def test_chain_over_many_blocks(spark, tmp_path):
    """A plain file cut into small blocks: the chain crosses them, and magics in payloads lie at block borders."""
    rows = [(i, "u", (NESTED + str(i)) * (i % 7) + "p" * (i % 50), "", "") for i in range(400)]
    path = str(tmp_path / "plain")
    write_warc(_pages(spark, rows), path, compression=None, files=1)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = read_warc(spark, path, {"sha": F.sha2("payload", 256)}).select("record_id", "sha", "payload_length", "digest").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {i: hashlib.sha256(h.encode()).hexdigest() for i, _, h, _, _ in rows}
    seen = {int(r.record_id.split(":")[-1]): r for r in got}
    assert len(got) == 400
    for i, digest in want.items():
        assert seen[i].digest == digest
        # equal payloads of 100 bytes or more are revisits, whose own payload is empty
        assert seen[i].sha in (digest, hashlib.sha256(b"").hexdigest())


def test_blocks_inside_one_compressed_file(spark, tmp_path, monkeypatch):
    """A gzip file is one read, but the chain goes from block to block; records lie over several blocks."""
    monkeypatch.setattr(warc, "BLOCK_BYTES", 1000)
    rows = [(i, "u", (NESTED + str(i)) * (i % 40) + "p" * (i % 50), "", "") for i in range(300)]
    path = str(tmp_path / "zip")
    write_warc(_pages(spark, rows), path, files=1)
    got = {int(r.record_id.split(":")[-1]): (r.record_type, bytes(r.payload)) for r in read_warc(spark, path).collect()}
    first = {}
    for i, _, h, _, _ in rows:
        first.setdefault(h, i)
    assert got == {i: ("response", h.encode()) if len(h) < 100 or first[h] == i else ("revisit", b"") for i, _, h, _, _ in rows}


def test_files_are_rolled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    path = str(tmp_path / "rolled")
    write_warc(_pages(spark, [(i, "u", f"{i} " * 500, "", "") for i in range(200)]), path)
    assert len(list((tmp_path / "rolled").glob("part-*"))) >= 15
    assert read_warc(spark, path).count() == 200


def test_empty_table_and_null_ids(spark, tmp_path):
    path = str(tmp_path / "none")
    write_warc(_pages(spark, []), path)
    assert read_warc(spark, path).count() == 0
    path = str(tmp_path / "nulls")
    write_warc(_pages(spark, [(None, None, "q" * 200, None, None), (4, None, "q" * 200, None, None)]), path)
    got = {r.record_id: r.record_type for r in read_warc(spark, path).collect()}
    assert got == {"urn:page:": "revisit", "urn:page:4": "response"}
