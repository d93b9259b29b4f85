import base64
import gzip
import hashlib
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loginwatch.llm import warc

from .cases import bag, table

PAGES = "page_id long, url string, html string"
ROWS = [
    (5, "http://a/5", "<p>same"), (3, "http://a/3 x", "<p>same"), (9, None, "<p>same"), (1, "", ""), (2, "u2", None),
    (4, "http://é/", "é" * 50_000), (None, "n1", "<p>same"), (None, "n2", "nobody"), (None, None, "nobody"),
    (7, "r", "twice"), (7, "r", "twice"), (7, "r", "other"), (8, "x\r\ny: z", "line\r\n\r\nline"), (1 << 60, "big", "big"),
]


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def slow(rows):
    """Response: the smallest page of a payload, one row of it; the others revisit it."""
    by = {}
    for page, _, html in rows:
        by.setdefault((html or "").encode(), []).append(page)
    out = []
    for data, pages in by.items():
        pages = sorted(pages, key=lambda p: (p is None, p or 0))
        for i, p in enumerate(pages):
            kind = ("response", None) if i == 0 else ("revisit", pages[0])
            out.append((p, len(data), b32(data), *kind))
    return sorted(out, key=repr)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def files(folder):
    return {p.name: p.read_bytes() for p in Path(folder).glob("*.warc.gz")}


@pytest.mark.parametrize("shard, file", [(1 << 25, 1 << 22), (1, 1), (100_000, 400)])
def test_archives_hold_every_page(spark, tmp_path, shard, file):
    pages = spark.createDataFrame(ROWS, PAGES).repartition(3).withColumn("extra", F.lit(1)).withColumn("sha1", F.lit("mine"))
    folder = f"file://{tmp_path}/w"
    manifest = warc.write(pages, folder, shard, file)
    back = warc.read(spark, folder)
    assert bag(back, *COLUMNS) == slow(ROWS)
    assert sum(r.records for r in manifest.collect()) == len(ROWS)
    got = {(r.page_id, r.url, bytes(r.payload).decode()) for r in back.where("payload IS NOT NULL").collect()}
    assert (4, "http://é/", "é" * 50_000) in got and (1, "", "") in got and (3, "http://a/3%20x", "<p>same") in got
    assert (8, "x%0D%0Ay:%20z", "line\r\n\r\nline") in got


def test_same_pages_give_the_same_bytes(spark, tmp_path):
    pages = table(spark, "pages")
    for name, frame in (("a", pages.coalesce(1)), ("b", pages.repartition(5))):
        warc.write(frame, f"file://{tmp_path}/{name}", 100_000, 20_000)
    one, two = files(tmp_path / "a"), files(tmp_path / "b")
    assert len(one) > 5 and one == two


def test_files_are_standard_and_rolled(spark, tmp_path):
    pages = table(spark, "pages")
    manifest = warc.write(pages, f"file://{tmp_path}/w", 1 << 20, 30_000).collect()
    found = files(tmp_path / "w")
    assert {r.file for r in manifest} == set(found)
    ids = []
    for r in manifest:
        assert r.bytes == len(found[r.file]) and r.sha256 == hashlib.sha256(found[r.file]).hexdigest()
        assert r.bytes <= 30_000 or r.records == 1
        plain = gzip.decompress(found[r.file])
        ids += re.findall(rb"X-Page: (\d+)\r\n", plain)
        while plain:
            head, _, rest = plain.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
            n = int(re.search(rb"\r\nContent-Length: (\d+)$", head)[1])
            assert rest[n:n + 4] == b"\r\n\r\n"
            plain = rest[n + 4:]
    order = [int(i) for i in ids]
    by_name = sorted(manifest, key=lambda r: r.file)
    assert sorted(order) == order or [r.file for r in manifest] != [r.file for r in by_name]
    assert bag(warc.read(spark, f"file://{tmp_path}/w"), *COLUMNS) == slow([tuple(r) for r in pages.collect()])


def test_damage_and_uncommitted_files(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    warc.write(spark.createDataFrame(ROWS, PAGES), folder)
    (tmp_path / "w/pages-999999-00000.warc.gz").write_bytes(b"not in the manifest")
    assert warc.read(spark, folder).count() == len(ROWS)
    victim = min((tmp_path / "w").glob("*.warc.gz"))
    victim.write_bytes(victim.read_bytes()[:-1] + b"x")
    with pytest.raises(Exception, match="not what was committed"):
        warc.read(spark, folder).collect()
    victim.unlink()
    with pytest.raises(Exception, match="is missing"):
        warc.read(spark, folder).count()


def test_revisits_name_their_response(spark, tmp_path):
    """By id, uri and date, as other readers resolve them."""
    warc.write(spark.createDataFrame(ROWS, PAGES).repartition(4), f"file://{tmp_path}/w", 1, 1)
    heads = []
    for data in files(tmp_path / "w").values():
        plain = gzip.decompress(data)
        while plain:
            head, _, rest = plain.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
            heads.append(fields)
            plain = rest[int(fields["Content-Length"]) + 4:]
    ids = {f["WARC-Record-ID"]: f for f in heads}
    assert len(ids) == len(ROWS)
    revisits = [f for f in heads if f["WARC-Type"] == "revisit"]
    assert len(revisits) == sum(r[3] == "revisit" for r in slow(ROWS)) > 4
    for f in revisits:
        response = ids[f["WARC-Refers-To"]]
        assert response["WARC-Type"] == "response" and response["WARC-Payload-Digest"] == f["WARC-Payload-Digest"]
        assert f["WARC-Refers-To-Target-URI"] == response["WARC-Target-URI"]
        assert f["WARC-Refers-To-Date"] == response["WARC-Date"]


def test_shards_of_a_large_table_are_larger(spark, tmp_path):
    pages = table(spark, "pages")
    manifest = warc.write(pages, f"file://{tmp_path}/w", 1, 1 << 20, 5)
    assert 2 <= manifest.select("shard").distinct().count() <= 6
    assert bag(warc.read(spark, f"file://{tmp_path}/w"), *COLUMNS) == slow([tuple(r) for r in pages.collect()])


def test_empty_table(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    assert warc.write(spark.createDataFrame([], PAGES), folder).count() == 0
    assert warc.read(spark, folder).count() == 0


def test_query(spark, tmp_path):
    pages = table(spark, "pages")
    twice = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 1000))
    got = warc.archived(twice, f"file://{tmp_path}/w")
    assert bag(got, *COLUMNS) == slow([tuple(r) for r in twice.collect()])
