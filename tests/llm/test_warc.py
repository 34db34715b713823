import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from checks.compare import oracle_connection
from stayscope.llm import warc_archive as W
from stayscope.llm.queries import ORACLES, op12_warc
from stayscope.session import shared_folder

SCHEMA = "page_id bigint, url string, html string"
LONG, OTHER = "é" * 500, "x" * 1000
ROWS = [
    (1, "http://a/1", LONG), (7, "http://a/7", LONG), (3, "http://a/3", LONG), (4, "http://a/4", "short"),
    (5, None, "short"), (6, "", None), (8, "http://a/8", ""), (None, "http://n", LONG), (None, "http://n", "n" * 2000),
    (None, "http://o", "n" * 2000), (2, "bad\r\nWARC-Type: fake", OTHER), (2, "bad\r\nWARC-Type: fake", OTHER),
    (9, "http://a/9", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "b" * 999), (10, "ünï", "z" * 999), (11, "ünï", "z" * 999),
    (12, "http://big", "w" * 3_000_000), (0, "zero", "w" * 3_000_000),
]


def brute(rows, least=1000):
    groups = {}
    for place, (page, url, html) in enumerate(rows):
        groups.setdefault((html or "").encode(), []).append((page is not None, page or 0, url is not None, url or "", place))
    out = []
    for place, (page, _, html) in enumerate(rows):
        raw = (html or "").encode()
        top = max(groups[raw])
        same = len(raw) < least or top[-1] == place
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "response" if same else "revisit",
                    None if same or not top[0] else top[1]))
    return sorted(out, key=str)


def archived(spark, pages, **more):
    folder = shared_folder(spark)
    W.write_archive(W.page_records(pages, **more), folder)
    return folder


def facts(spark, folder):
    rows = W.page_facts(W.read_archive(spark, folder)).collect()
    return sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in rows), key=str)


@pytest.mark.parametrize("sent", [W.SENT_ROWS, 0])
def test_odd_rows_against_brute_force(spark, monkeypatch, sent):
    monkeypatch.setattr(W, "SENT_ROWS", sent)
    folder = archived(spark, spark.createDataFrame(ROWS, SCHEMA).repartition(5))
    assert facts(spark, folder) == brute(ROWS)
    stored = spark.read.parquet(f"{folder}/payloads").collect()
    assert sorted(bytes(r.payload) for r in stored) == sorted({(h or "").encode() for _, _, h in ROWS})
    assert all(hashlib.sha256(r.payload).hexdigest() == r.digest for r in stored)


def test_records_as_files_and_back(spark):
    folder = archived(spark, spark.createDataFrame(ROWS, SCHEMA))
    found = W.read_archive(spark, folder)
    records = [bytes(r.record) for r in W.record_bytes(found).collect()]
    assert len(records) == len(ROWS) and all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
    W.export_files(found, f"{folder}/files", records_per_file=3)
    back = W.read_files(spark, f"{folder}/files").collect()
    assert sorted(bytes(r.header + r.http + r.body) + b"\r\n\r\n" for r in back) == sorted(records)
    bodies = sorted(bytes(r.body) for r in back if b"WARC-Type: response" in r.header)
    assert len(bodies) == sum(x[3] == "response" for x in brute(ROWS))
    assert len(list(W.split_records(b"".join(records)))) == len(records)
    assert not any(r.body for r in back if b"WARC-Type: revisit" in r.header)
    assert all(b"msgtype=response" in r.header and r.http.endswith(b"\r\n\r\n") for r in back)


@pytest.mark.parametrize("content", [b"junk", b"WARC/1.1\r\nX: 1\r\n\r\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"])
def test_broken_files_are_refused(content):
    with pytest.raises(ValueError):
        list(W.split_records(content))


def test_a_changed_or_missing_payload_is_noticed(spark):
    folder = archived(spark, spark.createDataFrame(ROWS[:4], SCHEMA))
    stored = spark.read.parquet(f"{folder}/payloads")
    changed = shared_folder(spark)
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{changed}/headers")
    stored.withColumn("payload", F.concat("payload", F.lit(b"!"))).write.parquet(f"{changed}/payloads")
    with pytest.raises(Exception, match="not that of its address"):
        facts(spark, changed)
    missing = shared_folder(spark)
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{missing}/headers")
    stored.filter(F.length("payload") < 10).write.parquet(f"{missing}/payloads")
    with pytest.raises(Exception, match="a payload is missing"):
        facts(spark, missing)


def test_empty_table_and_clashing_columns(spark):
    assert facts(spark, archived(spark, spark.createDataFrame([], SCHEMA))) == []
    odd = spark.createDataFrame(ROWS, "id bigint, link string, page string").withColumns(
        {"page_id": F.lit("x"), "digest": F.lit(1), "payload": F.lit(2), "url": F.lit(3), "html": F.lit("h"), "place": F.lit(0)})
    assert facts(spark, archived(spark, odd, id_col="id", url_col="link", html_col="page")) == brute(ROWS)


def test_query_against_sql(spark):
    con = oracle_connection("/root/testdata/sf0.001")
    names = "page_id, payload_bytes, payload_digest, record_type, refers_to"
    want = con.sql(ORACLES["op12_warc"]).select(names).fetchall()
    rows = op12_warc(spark, "/root/testdata/sf0.001").select(*names.split(", ")).collect()
    assert sorted(map(tuple, rows)) == sorted(want) and len(want) == 50
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar, html varchar)")
    unique = [r for i, r in enumerate(ROWS) if r[0] is not None and r not in ROWS[:i]]
    con.executemany("insert into pages values (?, ?, ?)", unique)
    assert sorted(con.sql(ORACLES["op12_warc"]).select(names).fetchall(), key=str) == brute(unique)
