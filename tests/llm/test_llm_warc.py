import gzip
import hashlib
import os

import pytest

from opinara.llm import warc

CLASH = "page_id long, url string, html string, digest string, member int, size string"


def pages(spark, parts=3):
    rows = [(i, f"http://h/{i}?q=é\r\nX: y", f"<p>{i}</p>" * (1 + i % 60)) for i in range(1, 200)]
    rows += [(i, f"http://copy/{i}", "<b>same</b>" * 20) for i in range(300, 340)]
    rows += [(i, None, None) for i in range(400, 403)] + [(500, "u", "short"), (501, "v", "short"), (502, "w", "é🙂" * 40_000)]
    rows += [(None, "n", "<b>same</b>" * 20), (None, "m", "no id"), (500, "u", "short")]
    return rows, spark.createDataFrame([(*r, "d", 1, "s") for r in rows], CLASH).repartition(parts)


def test_round_trip(spark, tmp_path):
    rows, frame = pages(spark)
    folder = str(tmp_path / "out")
    warc.write_warc(frame, folder, roll_bytes=4000)
    found = warc.read_warc(spark, folder).collect()
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in found], key=str) == sorted(
        [(i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in rows], key=str
    )
    revisits = {r["page_id"]: r["refers_to"] for r in found if r["record_type"] == "revisit"}
    assert revisits == {**{i: 300 for i in range(301, 340)}, None: 300}
    text = {i: (h or "").encode() for i, _, h in rows if i}
    assert all(bytes(r["payload"]) == text[r["page_id"]] for r in found if r["record_type"] == "response" and r["page_id"])
    first = next(r for r in found if r["page_id"] == 300)
    assert all(r["payload"] is None for r in found if r["record_type"] == "revisit") and first["record_type"] == "response"
    assert not [n for n in os.listdir(folder) if n.startswith("_temporary")]


def test_files_are_the_same_each_time_and_roll(spark, tmp_path):
    sums = []
    for parts, shuffle in ((3, "4"), (8, "7")):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        folder = tmp_path / f"out{parts}"
        warc.write_warc(pages(spark, parts)[1], str(folder), roll_bytes=4000, shards=3)
        spark.conf.set("spark.sql.shuffle.partitions", before)
        files = sorted(folder.glob("*.warc.gz"))
        sums.append({f.name: hashlib.sha256(f.read_bytes()).hexdigest() for f in files})
        manifest = spark.read.parquet(str(folder / "manifest")).collect()
        assert {r["name"]: r["sha256"] for r in manifest} == sums[-1]
        assert all(r["bytes"] == os.path.getsize(folder / r["name"]) for r in manifest)
        assert len(files) > 5 and sum(r["records"] for r in manifest) == 248
    assert sums[0] == sums[1]


def test_records_are_plain_warc(spark, tmp_path):
    folder = tmp_path / "out"
    warc.write_warc(pages(spark)[1].filter("page_id = 300 OR page_id = 301"), str(folder))
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in sorted(folder.glob("*.warc.gz")))
    assert raw.count(b"WARC/1.1\r\n") == 2 and raw.count(b"WARC-Type: revisit\r\n") == 1
    block = raw.split(b"\r\n\r\n", 1)[1].split(b"\r\n\r\nWARC/1.1")[0]
    assert f"sha256:{hashlib.sha256(block).hexdigest()}".encode() in raw


def test_damage_is_an_error(spark, tmp_path):
    folder = tmp_path / "out"
    warc.write_warc(pages(spark)[1], str(folder))
    name = next(folder.glob("*.warc.gz"))
    data = bytearray(name.read_bytes())
    data[len(data) // 2] ^= 255
    name.write_bytes(bytes(data))
    with pytest.raises(Exception):
        warc.read_warc(spark, str(folder)).collect()


def test_no_rows(spark, tmp_path):
    folder = str(tmp_path / "out")
    warc.write_warc(pages(spark)[1].limit(0), folder)
    assert warc.read_warc(spark, folder).collect() == []
