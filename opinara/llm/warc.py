"""WARC files: a deterministic sharded writer, and a reader.

Records are sorted by page and cut into shards, ranges of equal payload bytes found from
running totals, so they don't depend on a sample. Each shard is written in order as a
row of files: gzip members under a temporary name, closed at the record that reaches the roll
size, renamed when complete, and listed in the manifest, which is committed last. A
reader takes what the manifest lists. Attempts that were lost leave only temporary
files, which go at the end, or the same bytes under the same name.

The folder must be one that all machines reach, by a URI or path that pyarrow opens
(a mounted path, hdfs, s3, gs).
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_or_last, running_totals, salted_lookup, shuffle_partitions, stored

#: Compressed bytes after which a file is closed with the record at hand.
ROLL_BYTES = 1 << 26
#: Payload bytes of a shard, the work of one task; the driver holds one key for each.
SHARD_BYTES = 1 << 27
#: Compressed bytes of a block, the unit of reading; blocks begin with a record.
BLOCK_BYTES = 1 << 22
#: Payloads of fewer bytes are never revisits.
LEAST_REVISIT = 100
#: Written as the date of every record, as the pages state none.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of records handed on at once.
CHUNK = 1 << 23
#: Bytes counted for the headers of a record.
HEAD_BYTES = 512
SALTS = 64
#: What records are sorted by.
ORDER = ("_id", "_url", "digest")


def opened(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


def record_id(page: int | None, url: str, digest: str) -> str:
    name = hashlib.sha256(f"{page}\n{url}\n{digest}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name[:16], version=5)}>"


def target(url: str | None) -> str:
    """The address without characters that a header can't hold; a name of its own for none."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else "urn:absent"


def record(page: int | None, url: str | None, digest: str, size: int, payload: bytes | None, first: tuple[int, str | None] | None) -> bytes:
    """One record as a gzip member: a response, or with ``first`` a revisit of that page's."""
    address = target(url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"") if first is None else http
    head = {
        "WARC-Type": "response" if first is None else "revisit",
        "WARC-Record-ID": record_id(page, address, digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": address,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "WARC-Page-ID": "" if page is None else str(page),
    }
    if first is not None:
        head["WARC-Profile"] = PROFILE
        head["WARC-Refers-To"] = record_id(first[0], target(first[1]), digest)
        head["WARC-Refers-To-Target-URI"] = target(first[1])
        head["WARC-Refers-To-Page-ID"] = str(first[0])
    head["Content-Type"] = "application/http; msgtype=response"
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items())
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # no time, no name: the same bytes each time
    return packer.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n") + packer.flush()


def in_order(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """The columns that records are sorted by, without nulls, and whether there is an id."""
    return pages.withColumns(
        {"_id": id_or_last(id_col), "_there": F.col(id_col).isNotNull(), "_url": F.coalesce(F.col(url_col).cast("string"), F.lit(""))}
    )


def shard_plan(facts: DataFrame, shards: int, total: int) -> DataFrame:
    """Adds ``shard``: sorted by page, the shards are ranges of equal payload bytes, ``total`` in all."""
    sized = facts.withColumn("_all", F.lit(0)).withColumn("_bytes", F.col("size") + HEAD_BYTES)
    placed = running_totals(sized, ["_all"], list(ORDER), "_bytes", "_before")
    shard = F.floor(F.col("_before").cast("decimal(38,0)") * shards / F.lit(total)).cast("int")
    return placed.withColumn("shard", shard).drop("_all", "_bytes", "_before")


def revisits(facts: DataFrame) -> DataFrame:
    """The records that revisit another page, with ``first_id`` and ``first_url`` of that page."""
    large = facts.filter(F.col("size") >= LEAST_REVISIT)
    groups = large.groupBy("digest").agg(F.min(F.struct("_id", "_url")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    rows = large.withColumn("_salt", F.pmod(F.xxhash64("_id", "_url"), F.lit(SALTS)))
    rows = salted_lookup(rows, groups.select("digest", "first"), "digest", "_salt").filter(F.col("_id") > F.col("first._id"))
    return rows.select(*ORDER, "shard", F.col("first._id").alias("first_id"), F.col("first._url").alias("first_url")).distinct()


RECORDS = "_id long, _url string, digest string, size long, there boolean, shard int, member binary, first_id long, first_url string"
RECORDS_ARROW = pa.schema(
    [
        ("_id", pa.int64()), ("_url", pa.string()), ("digest", pa.string()), ("size", pa.int64()), ("there", pa.bool_()),
        ("shard", pa.int32()), ("member", pa.binary()), ("first_id", pa.int64()), ("first_url", pa.string()),
    ]
)


def responses(pages: DataFrame, html_col: str, bounds: list[tuple[tuple[int, str, str], int]]) -> DataFrame:
    """Every page as a response record, with its shard; ``bounds`` are the first keys of the shards, in order."""
    keys, numbers = [key for key, _ in bounds], [number for _, number in bounds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[dict] = []
            held = 0
            for page, there, url, html in zip(*(batch.column(i) for i in range(4)), strict=True):
                payload = (html.as_py() or "").encode()
                row = {"_id": page.as_py(), "_url": url.as_py(), "digest": hashlib.sha256(payload).hexdigest(), "size": len(payload), "there": there.as_py()}
                row["shard"] = numbers[max(bisect_right(keys, (row["_id"], row["_url"], row["digest"])) - 1, 0)]
                row["member"] = record(row["_id"] if row["there"] else None, row["_url"], row["digest"], len(payload), payload, None)
                rows.append(row)
                held += len(row["member"])
                if held >= CHUNK:
                    yield from pa.Table.from_pylist(rows, RECORDS_ARROW).to_batches()
                    rows, held = [], 0
            yield from pa.Table.from_pylist(rows, RECORDS_ARROW).to_batches()

    return pages.select("_id", "_there", "_url", F.col(html_col).alias("_html")).mapInArrow(run, RECORDS)


FILES = "name string, bytes long, sha256 string, records long, blocks array<struct<start: long, length: long, records: long>>"
MANIFEST = pa.schema(
    [
        ("name", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string()), ("records", pa.int64()),
        ("blocks", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("records", pa.int64())]))),
    ]
)


class Archive:
    """A file under way: written under a temporary name, renamed when it is complete."""

    def __init__(self, store: pyarrow.fs.FileSystem, base: str, drafts: str, name: str) -> None:
        self.store, self.path, self.draft, self.name = store, f"{base}/{name}", f"{drafts}/{name}-{uuid.uuid4().hex}", name
        self.out = store.open_output_stream(self.draft)
        self.digest, self.bytes, self.blocks = hashlib.sha256(), 0, []

    def write(self, member: bytes) -> None:
        if not self.blocks or self.blocks[-1]["length"] >= BLOCK_BYTES:
            self.blocks.append({"start": self.bytes, "length": 0, "records": 0})
        self.out.write(member)
        self.digest.update(member)
        self.bytes += len(member)
        self.blocks[-1]["length"] += len(member)
        self.blocks[-1]["records"] += 1

    def closed(self) -> pa.RecordBatch:
        """Puts the file in its place, over that of an earlier attempt with the same bytes; returns its row of the manifest."""
        self.out.close()
        if self.store.get_file_info(self.path).type != pyarrow.fs.FileType.NotFound:
            self.store.delete_file(self.path)
        self.store.move(self.draft, self.path)
        records = sum(b["records"] for b in self.blocks)
        row = {"name": self.name, "bytes": self.bytes, "sha256": self.digest.hexdigest(), "records": records, "blocks": self.blocks}
        return pa.RecordBatch.from_pylist([row], MANIFEST)


def written(rows: DataFrame, folder: str, drafts_folder: str, roll_bytes: int) -> DataFrame:
    """Writes sorted records shard by shard, closing a file when it has ``roll_bytes``; returns the manifest's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        drafts = opened(drafts_folder)[1]
        archive, shard, number, first = None, None, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["_id"], row["_url"], row["digest"])
                if row["member"] is None:  # comes right before the record that it is about
                    first = (key, (row["first_id"], row["first_url"]))
                    continue
                if archive is not None and (row["shard"] != shard or archive.bytes >= roll_bytes):
                    yield archive.closed()
                    archive = None
                if row["shard"] != shard:
                    shard, number = row["shard"], 0
                if archive is None:
                    archive = Archive(store, base, drafts, f"pages-{shard:06d}-{number:04d}.warc.gz")
                    number += 1
                member = row["member"]
                if first is not None and first[0] == key:
                    member = record(row["_id"] if row["there"] else None, row["_url"], row["digest"], row["size"], None, first[1])
                archive.write(member)
        if archive is not None:
            yield archive.closed()

    return rows.mapInArrow(run, FILES)


def write_warc(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    roll_bytes: int = ROLL_BYTES, shards: int | None = None,
) -> None:
    """Writes one record per row of ``pages`` and the manifest to ``folder``, which must be new.

    The payload is the html in UTF-8, empty for null. Of equal payloads of at least
    ``LEAST_REVISIT`` bytes the one of the smallest page id (null last, then the address) is a response;
    those of larger ids are revisits of it; smaller payloads are all responses. Rows that repeat
    are written each, with the same record id. An empty table gives a manifest
    without files. Other columns are left out. The same table and number of shards (unless stated, one for
    every ``SHARD_BYTES``) give the same files and digests.
    """
    spark = pages.sparkSession
    drafts_folder = f"{folder.rstrip('/')}/_temporary-{uuid.uuid4().hex}"
    store, drafts = opened(drafts_folder)
    store.create_dir(drafts)
    rows = in_order(pages, id_col, url_col)
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "utf-8")
    facts = rows.select("_id", "_url", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("size"))
    facts = stored(facts, "facts")
    total = facts.agg(F.sum(F.col("size") + HEAD_BYTES)).first()[0] or 1
    shards = shards or -(-total // SHARD_BYTES)
    facts = stored(shard_plan(facts, shards, total), "shards")
    first = facts.groupBy("shard").agg(F.min(F.struct(*ORDER)).alias("key")).orderBy("shard").collect()  # a row per shard
    bounds = [((r["key"]["_id"], r["key"]["_url"], r["key"]["digest"]), r["shard"]) for r in first] or [((0, "", ""), 0)]
    records = responses(rows, html_col, bounds)
    marks = revisits(facts).withColumns({c: F.lit(None).cast(records.schema[c].dataType) for c in ("size", "there", "member")})
    # A mark sorts before its record: its member is null.
    ordered = records.unionByName(marks).repartitionById(shards, "shard").sortWithinPartitions("shard", *ORDER, F.col("member").isNotNull())
    written(ordered, folder, drafts_folder, roll_bytes).write.parquet(f"{folder.rstrip('/')}/manifest")  # its marker comes last
    store.delete_dir(drafts)


def parsed(data: bytes) -> Iterator[dict]:
    """The records of a run of gzip members."""
    while data:
        unpack = zlib.decompressobj(31)
        raw = unpack.decompress(data) + unpack.flush()
        if not unpack.eof:
            raise ValueError("a record is cut off")
        data = unpack.unused_data
        head, _, rest = raw.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        fields = {name.lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}
        block = rest[: int(fields["content-length"])]
        if not version.startswith("WARC/") or len(block) != int(fields["content-length"]):
            raise ValueError("not a whole WARC record")
        http, _, payload = block.partition(b"\r\n\r\n")
        sizes = [x.partition(":")[2] for x in http.decode().split("\r\n") if x.lower().startswith("content-length:")]
        yield fields | {"payload": payload, "size": int(sizes[0])}


ARCHIVED = (
    "page_id long, url string, record_id string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary"
)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the files that the manifest of ``folder`` lists.

    ``payload`` is null for revisits. Digests of responses are computed anew and compared
    with the header's; a difference, or a record that is not whole, is an error.
    """
    blocks = spark.read.parquet(f"{folder.rstrip('/')}/manifest").select("name", F.inline("blocks"))
    blocks = blocks.repartition(shuffle_partitions(spark), "name", "start")

    def number(text: str | None) -> int | None:
        return int(text) if text else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        for batch in batches:
            for block in batch.to_pylist():
                with store.open_input_file(f"{base}/{block['name']}") as source:
                    source.seek(block["start"])
                    data = source.read(block["length"])
                rows, held, count = [], 0, 0
                for found in parsed(data):
                    count += 1
                    digest = found["warc-payload-digest"].removeprefix("sha256:")
                    whole = found["warc-type"] == "response"
                    if whole and (hashlib.sha256(found["payload"]).hexdigest() != digest or len(found["payload"]) != found["size"]):
                        raise ValueError(f"the payload of {found['warc-record-id']} is not what its header says")
                    rows.append(
                        {
                            "page_id": number(found["warc-page-id"]), "url": found["warc-target-uri"], "record_id": found["warc-record-id"],
                            "record_type": found["warc-type"], "refers_to": number(found.get("warc-refers-to-page-id")),
                            "payload_bytes": found["size"], "payload_digest": digest, "payload": found["payload"] if whole else None,
                        }
                    )
                    held += len(found["payload"])
                    if held >= CHUNK:
                        yield from pa.Table.from_pylist(rows, ARCHIVED_ARROW).to_batches()
                        rows, held = [], 0
                if count != block["records"]:
                    raise ValueError(f"{block['name']} has {count} records where the manifest says {block['records']}")
                yield from pa.Table.from_pylist(rows, ARCHIVED_ARROW).to_batches()

    return blocks.mapInArrow(run, ARCHIVED)


ARCHIVED_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ]
)
