import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from ledgerline.llm import warc_zstd as q

LONG = "x" * 1500


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string, b int, path string") if len(rows[0]) == 6 \
        else spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_round_trip(ready):
    rows = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, None, "short"), (4, "http://a/\r\nX: y", "short"), (5, "u", None),
            (None, "n", LONG), (7, "é", "é" * 600), (7, "é", "é" * 600), (8, "b", "\r\n\r\nWARC/1.1\r\n\r\n")]
    pages = table(ready, rows)
    found = q.read_archives(q.write_archives(pages)).collect()
    assert len(found) == len(rows)
    for page_id, kind, refers_to, html in [(1, "revisit", 2, LONG), (2, "response", None, LONG), (3, "response", None, "short"),
                                           (4, "response", None, "short"), (5, "response", None, ""), (None, "revisit", 2, LONG),
                                           (7, "response", None, "é" * 600), (8, "response", None, "\r\n\r\nWARC/1.1\r\n\r\n")]:
        r = next(r for r in found if r["page_id"] == page_id)
        assert (r["record_type"], r["refers_to"], r["payload_bytes"]) == (kind, refers_to, len(html.encode()))
        assert r["payload_digest"] == hashlib.sha1(html.encode()).hexdigest()
        assert r["payload"] == (html.encode() if kind == "response" else None)
    assert next(r for r in found if r["page_id"] == 3)["url"] is None


def test_query(ready, sf):
    from ledgerline.llm.queries import REGISTRY

    pages = {r["page_id"]: (r["html"] or "").encode() for r in ready.read.parquet(f"{sf}/pages.parquet").collect()}
    top = {}
    for page_id, data in pages.items():
        if len(data) >= 1000:
            top[data] = max(page_id, top.get(data, page_id))
    rows = REGISTRY["op8_warc_zstd"](ready, sf).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        data = pages[r["page_id"]]
        keep = top.get(data, r["page_id"])
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if keep == r["page_id"] else ("revisit", keep))


def one(payload=b"hello", response=True):
    return q.record(5, "http://a", payload, hashlib.sha1(payload).digest(), response, None if response else 9)


def write(path, frames, dictionary=None):
    head = b"" if dictionary is None else struct.pack("<II", q.SKIPPABLE, len(dictionary)) + dictionary
    path.write_bytes(head + b"".join(frames))
    return str(path)


def test_dictionaries(tmp_path):
    samples = [(b"<html><body>common words %d" % i) * 9 for i in range(300)]
    made = zstandard.train_dictionary(4096, samples)
    frames = [zstandard.ZstdCompressor(dict_data=made).compress(one(s)) for s in samples[:50]]
    for number, stored in enumerate((made.as_bytes(), zstandard.ZstdCompressor().compress(made.as_bytes()))):
        rows = list(q.read_archive(write(tmp_path / f"{number}.warc.zst", frames, stored)))
        assert [r["payload"] for r in rows] == samples[:50]
    plain = [zstandard.compress(one())]
    assert next(q.read_archive(write(tmp_path / "p.warc.zst", plain)))["payload"] == b"hello"
    assert list(q.read_archive(write(tmp_path / "e.warc.zst", []))) == []
    big = [zstandard.compress(one(bytes(range(256)) * 20_000)), zstandard.compress(one())]
    assert [r["payload_bytes"] for r in q.read_archive(write(tmp_path / "b.warc.zst", big))] == [5_120_000, 5]


@pytest.mark.parametrize("broken", [
    lambda d: d.replace(b"WARC/1.1", b"WARC/9"), lambda d: d.replace(b"WARC-Date", b"X-Date"), lambda d: d[:-1],
    lambda d: d.replace(b"hello", b"hallo"), lambda d: d + one(), lambda d: d.replace(b"Content-Length: ", b"Content-Length: x"),
])
def test_bad_records(tmp_path, broken):
    with pytest.raises(q.BadArchive):
        list(q.read_archive(write(tmp_path / "a.warc.zst", [zstandard.compress(broken(one()))])))


def test_bad_frames(tmp_path):
    good = zstandard.compress(one())
    for number, frames in enumerate(([good[:-3]], [good, b"rubbish"], [good, good[:2]])):
        with pytest.raises(q.BadArchive):
            list(q.read_archive(write(tmp_path / f"{number}.warc.zst", frames)))


def test_empty_table(ready):
    pages = table(ready, [(1, "u", "x")]).limit(0)
    assert q.read_archives(q.write_archives(pages)).count() == 0


def test_equal_sha1_alone_is_no_revisit(ready, monkeypatch):
    """Different payloads whose SHA-1 collides keep their own; equal ones are revisits."""
    class Marked(Exception):
        pass

    def noted(df, fn, schema):
        raise Marked({r["page_id"]: r["refers_to"] for r in df.select("page_id", "refers_to").collect()})
    pages = ready.createDataFrame([(i, "http://a", c * 2000) for i, c in enumerate("abbcc")], "page_id bigint, url string, html string")
    monkeypatch.setattr(q.F, "sha1", lambda column: q.F.lit("00" * 20))
    monkeypatch.setattr(q, "map_batches", noted)
    with pytest.raises(Marked) as marked:
        q.write_archives(pages)
    assert marked.value.args[0] == {0: None, 1: 2, 2: None, 3: 4, 4: None}


def test_archives_are_read_by_several_tasks(ready):
    """As many tasks as there are archives, whatever the number of shuffle partitions is."""
    rows = [(n, "u", f"{n} " * 400) for n in range(400)]
    archives = q.write_archives(table(ready, rows).repartition(6), archive_bytes=2_000)
    n = archives.count()
    before = ready.conf.get("spark.sql.shuffle.partitions")
    for partitions in (str(n), "3"):
        ready.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            read = q.read_archives(archives, with_payload=False)
            tasks = read.select(F.spark_partition_id().alias("t"), "page_id").collect()
        finally:
            ready.conf.set("spark.sql.shuffle.partitions", before)
        assert len(tasks) == 400 and len({r.t for r in tasks}) > n // 3 > 1
