"""CSV by byte ranges against Spark's own reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from opinara.sources import csv_ranges as C
from opinara.sources import files


def written(folder, name, rows, encoding="utf-8", end="\n", bom=b""):
    quote = lambda cell: '"' + cell.replace('"', '""') + '"' if any(c in cell for c in '",\r\n') or cell.startswith("#") else cell
    text = end.join(",".join(map(quote, row)) for row in rows) + end
    path = folder / f"{name}.csv"
    path.write_bytes(bom + text.encode(encoding))
    return path


def some_rows(number, seed, letters):
    pick = random.Random(seed)
    cell = lambda: "".join(pick.choices(letters, k=pick.randint(0, 30)))
    return [["content", "user name", "n"]] + [[cell(), cell() + "x", str(i)] for i in range(number)]


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def read(spark, paths):
    rows = C.read_sources(spark, {"s": [f"file:{p}" for p in paths]})["s"]
    return [tuple(r) for r in rows.orderBy("row_id").drop("row_id").collect()]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_in_many_tasks_equals_the_whole_file(spark, tmp_path, small_ranges, end):
    rows = some_rows(900, 1, list('ab"", \n') + ["é", "和"]) + [["long\n" * 3000 + '"', "x", "y"], ["", "", ""], ["last", "one", '""']]
    path = written(tmp_path, "s", rows, end=end, bom=b"\xef\xbb\xbf")
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 8
    whole = [tuple(r) for r in spark.read.csv(str(path), header=True, multiLine=True, escape='"', quote='"').collect()]
    assert read(spark, [path]) == whole and len(whole) > 900


def test_gbk_and_broken_files(spark, tmp_path, small_ranges):
    rows = some_rows(400, 2, list('ab," \n') + ["和", "平", "谈"])
    gbk, utf8 = written(tmp_path, "a", rows, "gbk"), written(tmp_path, "b", rows)
    broken = tmp_path / "c.csv"
    broken.write_bytes(b"content,user name,n\nx\xff\xff\xffy,u,1\n")
    back = read(spark, [utf8])
    assert read(spark, [gbk]) == back and len(back) >= 390
    assert read(spark, [broken, gbk, utf8]) == back + back
    assert C.read_sources(spark, {"s": [f"file:{broken}"], "t": []}) == {}
    assert spark.conf.get("spark.sql.legacy.javaCharsets", "false") == "false"


def test_quotes_inside_plain_cells_open_nothing(spark, tmp_path, small_ranges):
    path = tmp_path / "q.csv"
    path.write_text('content,user name,n\n5" disk,u,1\na"b"c,"x\ny",2\n"he said ""no""",v,3\n,"",4\n\n"open to the end,5\nmore')
    found = read(spark, [path])
    whole = [tuple(r) for r in spark.read.csv(str(path), header=True, multiLine=True, escape='"', quote='"').collect()]
    assert found[:4] == whole[:4] == [('5" disk', "u", "1"), ('a"b"c', "x\ny", "2"), ('he said "no"', "v", "3"), (None, whole[3][1], "4")]
    assert len(found) == 5


def test_both_cases_of_a_line():
    assert C.ends_inside(b'a,"b', False) and not C.ends_inside(b'a,"b"', False) and not C.ends_inside(b'a"b', False)
    assert C.ends_inside(b"plain", True) and not C.ends_inside(b'x",y', True) and C.ends_inside(b'x","y', True)
    assert C.ends_inside(b'x""y', True) and not C.ends_inside(b'x"",""",z', True) and not C.ends_inside(b'"",""', False)
    assert C.header_names('a,,A,"b ""c"""') == ["a0", "_c1", "A2", 'b "c"']


def test_landed_sources_use_the_ranges(spark, tmp_path, small_ranges):
    rows = some_rows(300, 3, list('ab," \n'))
    written(tmp_path, "weibo", rows, "gbk")
    landed = files.landed_comments(spark, f"file:{tmp_path}")
    assert landed.count() >= 295 and {r[0] for r in landed.select("platform").distinct().collect()} == {"weibo"}
    assert landed.where(F.col("content").contains("\n")).count() > 20
