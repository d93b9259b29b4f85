"""WARC archives of pages: a deterministic sharded writer and a reader."""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loginwatch.llm.common import numbered, split_join, stored

#: Payload bytes of a shard, and compressed bytes from which its file is rolled.
SHARD_BYTES = 32 << 20
FILE_BYTES = 4 << 20
#: Shards at most: beyond that they grow, so that their first keys stay a bounded list.
MAX_SHARDS = 100_000
LEVEL = 6
#: The date of every record: archives of the same pages are the same bytes.
DATE = "2024-01-01T00:00:00Z"
NO_URL = "urn:x-page:none"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6f1d3c1e-5d0a-5c57-9c0e-2c6f5a1b7d11")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page: str | None, url: str | None, payload_digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page} {copy} {payload_digest} {url}')}>"


def _uri(url: str) -> str:
    """Control characters and blanks escaped, so that a header stays one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(
    page: str | None, url: str | None, payload: bytes, sha1: str, original: tuple | None = None, copy: int = 0,
) -> bytes:
    """One record as its own gzip member; every header and digest is made anew.

    With an ``original``, the page and url of the response that has the payload, it is a
    revisit: it names that record by id, uri and date and holds the HTTP header alone, whose
    length field still tells the payload's size. Nothing in it depends on the clock, the
    task or the attempt.
    """
    revisit = original is not None
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": record_id(page, url, sha1, copy),
        "WARC-Date": DATE, "WARC-Target-URI": _uri(url or NO_URL),
        "WARC-Payload-Digest": f"sha1:{sha1}", "WARC-Block-Digest": f"sha1:{digest(block)}",
        "X-Page": page or "", "X-No-URL": "" if url else "null" if url is None else "empty",
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block)),
    }
    if revisit:
        refers, refers_url = original
        fields |= {
            "WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers, refers_url, sha1, 0),
            "WARC-Refers-To-Target-URI": _uri(refers_url or NO_URL), "WARC-Refers-To-Date": DATE,
            "X-Refers-To-Page": refers or "",
        }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", LEVEL, mtime=0)


class _Files:
    """The open file of a shard: bytes under a temporary name, then the final one.

    A name follows from shard and place, and contents from the records alone: a second
    attempt makes the same bytes, so a file that is there already is kept.
    """

    def __init__(self, folder: str, limit: int):
        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.limit, self.attempt = limit, uuid.uuid4().hex
        self.shard: int | None = None
        self.closed: list[tuple] = []

    def turn_to(self, shard: int) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.index = shard, 0
            self._open()

    def _open(self) -> None:
        self.name = f"pages-{self.shard:06d}-{self.index:05d}.warc.gz"
        self.temporary = f"{self.root}/_temporary/{self.name}.{self.attempt}"
        self.store.create_dir(f"{self.root}/_temporary", recursive=True)
        self.out = self.store.open_output_stream(self.temporary, compression=None)
        self.bytes = self.records = 0
        self.sha = hashlib.sha256()

    def write(self, data: bytes) -> None:
        if self.records and self.bytes + len(data) > self.limit:
            self.close()
            self.index += 1
            self._open()
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)
        self.records += 1

    def close(self) -> None:
        if self.shard is None:
            return
        self.out.close()
        final = f"{self.root}/{self.name}"
        if not self.records or self.store.get_file_info(final).type != fs.FileType.NotFound:
            self.store.delete_file(self.temporary)
        else:
            self.store.move(self.temporary, final)
        if self.records:
            self.closed.append((self.name, self.shard, self.records, self.bytes, self.sha.hexdigest()))

    def manifest(self) -> pd.DataFrame:
        rows, self.closed = self.closed, []
        return pd.DataFrame(rows, columns=["file", "shard", "records", "bytes", "sha256"])


MANIFEST = "file string, shard long, records long, bytes long, sha256 string"


def _save(folder: str, limit: int):
    """Writes sorted rows: decisions (kind 0) stand right before the rows they are about."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, last, decision, first, copy = _Files(folder, limit), None, None, None, 0
        for frame in batches:
            for shard, page, url, payload, sha1, kind, refers in frame.itertuples(index=False, name=None):
                key = (page, sha1)
                if kind == 0:
                    # The url of a decision is that of the response.
                    decision = (key, (refers, url))
                    continue
                files.turn_to(shard)
                copy = copy + 1 if key == last else 0
                if not copy:
                    first = (page, url)
                last = key
                original = decision[1] if decision and decision[0] == key else first
                payload = bytes(payload)
                revisit = copy > 0 or original[0] != page
                files.write(record(page, url, payload, digest(payload), original if revisit else None, copy))
            yield files.manifest()
        files.close()
        yield files.manifest()
    return run


def _bounds(index: DataFrame, shard_bytes: int, max_shards: int = MAX_SHARDS) -> list[tuple]:
    """The first key of every shard: running bytes within blocks of rows and over blocks.

    There are about ``max_shards`` at most, as shards of a larger table are larger.
    """
    total = index.agg(F.sum("size")).first()[0] or 0
    shard_bytes = max(shard_bytes, -(-total // max_shards))
    blocks = index.withColumn("block", F.expr("row div 4096"))
    sums = blocks.groupBy("block").agg(F.sum("size").alias("bytes"))
    before = F.sum("bytes").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    within = F.sum("size").over(Window.partitionBy("block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
    placed = blocks.withColumn("within", F.coalesce(within, F.lit(0))).join(
        sums.select("block", F.coalesce(before, F.lit(0)).alias("before")), "block"
    )
    shard = F.expr(f"(before + within) div {shard_bytes}").alias("shard")
    firsts = placed.groupBy(shard).agg(F.min(F.struct("page_id", "sha1")).alias("first")).orderBy("shard")
    return [_order(r["first"]["page_id"], r["first"]["sha1"]) for r in firsts.collect()]


def _order(page_id: int | None, sha1: str) -> tuple:
    return page_id is not None, page_id or 0, sha1


def write(
    pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, max_shards: int = MAX_SHARDS,
) -> DataFrame:
    """Writes ``page_id``, ``url``, ``html`` as archives below ``folder`` (a URI); returns
    the manifest, which is written last and names every file with its digest.

    Records are sorted by page, then payload digest, and cut into shards of about equal
    bytes at keys that depend on the data alone: a narrow table of pages is numbered in that
    order, and the first key of each shard, one per ``shard_bytes`` and ``MAX_SHARDS`` at
    most, goes to all tasks. Html is shuffled once, to its shard; rows of one page and
    payload are one shard. Of equal payloads the smallest page is the response; this is
    decided on digests, hot ones by broadcast, and reaches the writer as rows that sort in
    front of their page. Null pages come first and are a response only among themselves;
    a null url stays null; rows equal in all are separate records. An empty table gives
    an empty manifest. Only files that the manifest names count: a job that failed leaves
    none of them readable.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    index = numbered(
        rows.select("page_id", "sha1", "url", (F.octet_length("payload") + 600).cast("long").alias("size")),
        ["page_id", "sha1", "size"], "warc_index",
    )
    # The response of a payload is the row that is written first for its smallest page.
    first = F.min(F.struct(F.col("page_id").isNull(), F.col("page_id").alias("refers_to"), F.col("url").alias("refers_url")))
    copies = index.groupBy("sha1").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = copies.select("sha1", "first.refers_to", "first.refers_url", "n")
    decided = split_join(index.select("page_id", "sha1"), stored(copies, "warc_copies"), "sha1", index.count())
    decided = decided.where("n IS NOT NULL").groupBy("page_id", "sha1").agg(
        F.min(F.struct("refers_to", "refers_url")).alias("first")
    ).select("page_id", "sha1", "first.*")
    bounds = pages.sparkSession.sparkContext.broadcast(_bounds(index, shard_bytes, max_shards))

    @F.pandas_udf("long")
    def shard_of(page_ids: pd.Series, digests: pd.Series) -> pd.Series:
        keys = (_order(None if p is None else int(p), d) for p, d in zip(page_ids, digests))
        return pd.Series([max(0, bisect.bisect_right(bounds.value, k) - 1) for k in keys], dtype="int64")

    # Page numbers go to Python as text: a long with nulls would come as a float.
    both = rows.select("page_id", "url", "payload", "sha1", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("refers_to"))
    both = both.unionByName(decided.select(
        "page_id", F.col("refers_url").alias("url"), F.lit(None).cast("binary").alias("payload"), "sha1",
        F.lit(0).alias("kind"), "refers_to",
    )).withColumn("page", F.col("page_id").cast("string"))
    sorted_rows = (
        both.withColumn("shard", shard_of("page", "sha1"))
        .repartitionById(max(1, len(bounds.value)), F.col("shard").cast("int"))
        .sortWithinPartitions("shard", "page_id", "sha1", "kind", "url")
        .select("shard", "page", "url", "payload", "sha1", "kind", F.col("refers_to").cast("string").alias("refers"))
    )
    manifest = f"{folder}/_manifest"
    sorted_rows.mapInPandas(_save(folder, file_bytes), MANIFEST).write.parquet(manifest)
    return pages.sparkSession.read.schema(MANIFEST).parquet(manifest)


def _members(data: bytes) -> Iterator[bytes]:
    while data:
        member = zlib.decompressobj(31)
        yield member.decompress(data) + member.flush()
        data = member.unused_data


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:] if line)


def parse(data: bytes) -> dict:
    """The parts of one record; a block or payload that its digest belies is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["WARC-Type"]
    sha1 = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and sha1 != digest(payload):
        raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")
    return {
        "page": fields["X-Page"] or None,
        "url": {"null": None, "empty": ""}.get(fields["X-No-URL"], fields["WARC-Target-URI"]),
        "record_type": kind, "payload_digest": sha1, "payload_bytes": int(_fields(http)["Content-Length"]),
        "refers": fields.get("X-Refers-To-Page") or None, "payload": payload if kind == "response" else None,
    }


PARTS = ("page", "url", "record_type", "payload_digest", "payload_bytes", "refers", "payload")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the archives that the manifest names: ``page_id``, ``url``,
    ``record_type``, ``payload_digest``, ``payload_bytes``, ``refers_to`` and ``payload``
    (null for a revisit). Manifest rows are dealt to tasks, each of which opens the files
    it is given: one that is missing or that the manifest's digest belies is an error."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    schema = "page string, url string, record_type string, payload_digest string, payload_bytes long, refers string, payload binary"
    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    tasks = min(MAX_SHARDS, max(1, -(-total // SHARD_BYTES), spark.sparkContext.defaultParallelism))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        for frame in batches:
            for name, sha256 in frame.itertuples(index=False, name=None):
                if store.get_file_info(f"{root}/{name}").type == fs.FileType.NotFound:
                    raise ValueError(f"{name} is in the manifest but is missing")
                with store.open_input_stream(f"{root}/{name}", compression=None) as source:
                    content = source.read()
                if hashlib.sha256(content).hexdigest() != sha256:
                    raise ValueError(f"{name} is not what was committed")
                yield from _records(content)

    records = manifest.select("file", "sha256").repartition(tasks, "file").mapInPandas(run, schema)
    return records.select(
        F.col("page").cast("long").alias("page_id"), "url", "record_type", "payload_digest", "payload_bytes",
        F.col("refers").cast("long").alias("refers_to"), "payload",
    )


def _records(content: bytes, rows: int = 256) -> Iterator[pd.DataFrame]:
    out = []
    for data in _members(content):
        out.append(parse(data))
        if len(out) == rows:
            yield pd.DataFrame(out, columns=PARTS)
            out = []
    if out:
        yield pd.DataFrame(out, columns=PARTS)


def archived(pages: DataFrame, folder: str) -> DataFrame:
    """The result of the query: writes the archives and lists what they hold."""
    write(pages, folder)
    return read(pages.sparkSession, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
    )
