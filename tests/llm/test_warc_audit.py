from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from tillstream.llm.warc_audit import audit, page_records, parents, range_hashes, record_bytes

FIELDS = "file long, offset long, length long, record long, digest string, status string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], FIELDS)


def records(count, files=3, length=300):
    return [(f, i * length, length, f * 1000 + i, hashlib.sha256(b"%d-%d" % (f, i)).hexdigest()) for f in range(files) for i in range(count)]


def brute(one, two):
    a, b = ({r[:2]: (r[2], r[4]) for r in x} for x in (one, two))
    names = {r[:2]: r[3] for r in [*two, *one]}
    status = lambda k: "missing" if k not in b else "extra" if k not in a else "corrupt"
    return sorted((*k, names[k], status(k)) for k in a.keys() | b.keys() if a.get(k) != b.get(k))


def result(df):
    return sorted(tuple(r) for r in df.select("file", "offset", "record", "status").collect())


def test_faults_are_located(spark):
    one = records(200)
    two = [r for r in one if r[3] not in (7, 1199)]
    two = [(*r[:4], "bad") if r[3] in (0, 50, 2100) else r for r in two]
    two = [(r[0], r[1], 299, *r[3:]) if r[3] == 60 else r for r in two]
    two += [(1, 10**9, 300, 5000, "far"), (9, 0, 10, 9000, "own file"), (0, 60_000, 300, 8000, None)]
    for width, fanout in ((1000, 2), (1000, 16), (1 << 30, 16)):
        got = audit(frame(spark, one), frame(spark, two), width, fanout)
        assert result(got) == brute(one, two)


def test_equal_and_empty_replicas(spark):
    one = records(20)
    assert result(audit(frame(spark, one), frame(spark, list(reversed(one))))) == []
    assert result(audit(frame(spark, []), frame(spark, []))) == []
    assert result(audit(frame(spark, one[:3]), frame(spark, []))) == brute(one[:3], [])


def test_a_node_tells_order_and_place(spark):
    a = frame(spark, [(0, 0, 5, 1, "x"), (0, 5, 5, 2, "y")])
    b = frame(spark, [(0, 0, 5, 1, "y"), (0, 5, 5, 2, "x")])
    hashes = [range_hashes(x, 100).first()["hash"] for x in (a, b)]
    assert hashes[0] != hashes[1]
    up = [parents(range_hashes(x, 5), 2).first()["hash"] for x in (a, b)]
    assert up[0] != up[1] and range_hashes(a, 5).count() == 2


def test_records_are_warc(spark):
    row = spark.createDataFrame([("http://x/", "é<p>")], "u string, h string")
    text = row.select(record_bytes(F.col("u"), F.col("h"), F.lit("n")).alias("r")).first()["r"]
    head, body = text.split("\r\n\r\n", 1)
    assert head.startswith("WARC/1.1\r\nWARC-Type: resource\r\n") and "Content-Length: 5" in head
    assert body == "é<p>\r\n\r\n"


def test_odd_pages(spark):
    rows = [(1, "u", "a"), (1, "u", "a"), (1, "v", None), (2, None, ""), (None, "u", "x" * 100_000), (None, None, None)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, offset long")
    got = page_records(pages).orderBy("file", "offset").collect()
    assert len(got) == len(rows) and {r.file for r in got} == {0, -1}
    for file in (0, -1):
        own = [r for r in got if r.file == file]
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
    assert result(audit(page_records(pages), page_records(pages))) == []
