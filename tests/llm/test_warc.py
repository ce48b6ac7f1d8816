import hashlib
import random

import pytest

from millrace.llm import warc as m

TRAP = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n\r\n\r\nWARC/1.1\r\n" * 20


def rows():
    big, r = "é<p>" * 400, random.Random(0)
    out = [(1, "http://www.A.example.com:80/x?Q=1#f", big), (2, "https://a.example.com/x?q=1", big), (3, "bad url\r\nX: y", big), (3, "http://b.org", big),
           (4, None, None), (5, "http://b.org/", "small"), (6, "http://b.org/", "small"), (7, "http://[broken", TRAP), (8, "ftp://ü.de/%20 +", TRAP), (None, "http://n.org", "z" * 2000), (None, None, "")]
    return out + [(100 + i, f"http://h{r.randint(0, 3)}.net/{r.randint(0, 2)}", "body" * r.randint(1, 600)) for i in range(80)]


@pytest.mark.parametrize("archive_bytes", [1, 20_000, 16 << 20])
def test_round_trip(spark, tmp_path, monkeypatch, archive_bytes):
    monkeypatch.setattr(m, "RANGE_ROWS", 9)
    data = rows()
    pages = spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "1 AS size", "2 AS digest", "3 AS owner")
    path = str(tmp_path / "w")
    got = [tuple(r) for r in m.archive_pages(pages, path, archive_bytes=archive_bytes).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    owner = {}
    for i, _, html in data:
        if len((html or "").encode()) >= 1000 and i is not None:
            owner[html] = max(owner.get(html, i), i)

    def want(i, html):
        text = (html or "").encode()
        revisit = html in owner and i != owner[html]
        return i, len(text), hashlib.sha1(text).hexdigest(), "revisit" if revisit else "response", owner[html] if revisit else None
    assert sorted(got, key=str) == sorted((want(i, h) for i, _, h in data), key=str)
    payloads = [(r["page_id"], r["payload"]) for r in m.read_payloads(spark, path).collect()]
    assert sorted(payloads, key=str) == sorted(((i, h or "") for i, _, h in data), key=str)


def test_global_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(m, "RANGE_ROWS", 9)
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string").repartition(6)
    found = m.archive_pages(pages, str(tmp_path / "w"), archive_bytes=5000).collect()
    ordered = sorted(found, key=lambda r: r["place"])
    assert [r["place"] for r in ordered] == list(range(len(rows())))
    keys = [(r["url_key"], r["captured_at"], -1 if r["page_id"] is None else r["page_id"]) for r in ordered]
    assert keys == sorted(keys)
    seen = {}
    for r in ordered:
        seen[r["url_key"]] = seen.get(r["url_key"], 0) + 1
        assert r["capture_no"] == seen[r["url_key"]]


def test_empty(spark, tmp_path):
    assert m.archive_pages(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w")).collect() == []


def test_loser_tree():
    r = random.Random(3)
    for k in range(0, 14):
        runs = [sorted(r.randint(0, 30) for _ in range(r.randint(0, 12))) for _ in range(k)]
        assert list(m.loser_tree_merge(runs, key=lambda x: x)) == sorted(x for run in runs for x in run)


def test_url_key():
    assert m.url_key("http://www.A.Example.com:80/X?Q#f") == "com,example,a)/x?q" and m.url_key("https://a.b") == "b,a)/"
