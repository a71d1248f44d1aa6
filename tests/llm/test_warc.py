from __future__ import annotations

import glob
import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tradewind.llm import warc

PAGES = "page_id long, url string, html string"
BIG = "é<p>" + "x" * 1200


def brute(rows):
    best = {}
    for page, _, html in rows:
        best[html or ""] = max(best.get(html or "", -1), -1 if page is None else page)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        again = len(body) >= 1000 and (-1 if page is None else page) < best[html]
        out.append((page, len(body), hashlib.sha1(body).hexdigest(),
                    "revisit" if again else "response", best[html] if again else None))
    return sorted(map(str, out))


ROWS = [
    (1, "http://a", BIG), (2, None, BIG), (3, "http://c\r\nX: y", BIG + "!"), (4, "d", None),
    (5, "e", ""), (6, "f", "y" * 999), (7, "g", "y" * 999), (8, "h", "y" * 1000), (9, "i", "y" * 1000),
    (10, "j", "a\r\n\r\nb" * 400), (11, "k", "WARC/1.1\r\nContent-Length: 5\r\n\r\n" * 50),
    (12, "l", "z" * 3_000_000), (None, "m", BIG), (13, "n", "\x00\U0001f600"),
]


def test_round_trip(spark, tables):
    rows = warc.op1_warc_normalise(spark, tables(pages=(PAGES, ROWS))).collect()
    assert sorted(map(str, map(tuple, rows))) == brute(ROWS)


def test_hot_payload_and_repeated_rows(spark, tables):
    rows = [(i, "u", BIG) for i in range(300)] + [(7, "u", BIG), (299, "u", BIG)]
    got = warc.op1_warc_normalise(spark, tables(pages=(PAGES, rows))).collect()
    assert [r["page_id"] for r in got if r["record_type"] == "response"] == [299]
    assert len(got) == 302 and {r["refers_to"] for r in got} == {None, 299}


def test_archives_are_split_and_every_member_stands_alone(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"{i}" * 3000) for i in range(40)], PAGES).coalesce(1)
    root = str(tmp_path / "w")
    crawl = warc.write_monolithic(pages, "html", root, archive_bytes=50_000)
    warc.normalise(warc.revisits(crawl), root)
    files = sorted(glob.glob(f"{root}/normal/*.gz"))
    assert len(files) > 1 and not glob.glob(f"{root}/*/*.draft")
    seen = 0
    for f in files:
        with open(f, "rb") as data:
            for line in open(f + ".idx.json"):
                x = json.loads(line)
                data.seek(x["offset"])
                raw = gzip.decompress(data.read(x["length"]))
                assert raw.startswith(b"WARC/1.1\r\nWARC-Type: " + x["type"].encode())
                seen += 1
        # A monolithic archive is one stream, the normalised one has the same records.
        whole = gzip.open(f.replace("/normal/", "/monolithic/")).read()
        assert whole == gzip.open(f).read()
    assert seen == 40 and len(warc.read_archives(spark, root).collect()) == 40


def test_damaged_archive_is_named():
    whole = gzip.compress(warc.response("a", 0, 1, "u", b"x" * 500))
    assert len(list(warc.records(iter([whole[:9], whole[9:], whole]), "a"))) == 2
    with pytest.raises(ValueError, match="a.warc"):
        list(warc.records(iter([whole[:-20]]), "a.warc"))


def test_empty_table(spark, tables):
    assert warc.op1_warc_normalise(spark, tables(pages=(PAGES, []))).count() == 0


def test_archives_are_rewritten_by_many_tasks(spark, tmp_path):
    df = spark.range(400).selectExpr("id AS page_id", "'u' AS url", "repeat(uuid(), 200) AS html").repartition(4)
    crawl = warc.write_monolithic(df, "html", str(tmp_path), archive_bytes=200_000)
    n_archives = crawl.select("archive").distinct().count()
    assert n_archives >= 12
    tasks = []
    plain = warc.stored

    def spied(frame, label):
        if label == "warc-archives":
            tasks.append(frame.withColumn("task", F.spark_partition_id()).select("task").distinct().count())
        return plain(frame, label)

    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(warc, "stored", spied)
        warc.normalise(warc.stored(warc.revisits(crawl), "warc-decisions"), str(tmp_path))
    assert tasks[0] >= n_archives // 2
