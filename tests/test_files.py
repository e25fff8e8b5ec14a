"""Landed files, word lists, stored tables and sinks."""

import pytest
from pyspark.sql import functions as F

from opinara.operators.columns import first_available, rename_aliases, standardize, to_comment_columns
from opinara.plans.clean import clean_folder
from opinara.sources import files, payloads, sinks, tables, wordlists


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    write(folder / "bilibili_raw.csv", '﻿platform,content,publish_time,like_count\nx,"支持和平\n解决争端",2025-05-01,3\nx,"He said ""stop the war now""",,\nx,,2025-05-02,1\n', "utf-8")
    write(folder / "知乎_posts.csv", "text,time,like\n反战停火谈判吧,2025-05-03,2\n支持和平 解决争端,2025-05-04,5\n短,2025-05-04,0\n", "gbk")
    write(folder / "youtube_comments.csv", "video_title,video_id,comment\nT,v1,People desire peace instead\nT,v1,People desire peace instead\n")
    write(folder / "empty.csv", "content,time\n,\n")
    write(folder / "notes.txt", "not a table")
    return folder


def test_listing_and_encodings(spark, landing):
    (landing / "parts.csv").mkdir()
    write(landing / "parts.csv" / "part-0.csv", "content\n一二三四五六\n")
    write(landing / "parts.csv" / "part-1.csv", "content\n甲乙丙丁戊己\n", "gbk")
    sources = files.list_sources(spark, str(landing))
    assert list(sources) == ["bilibili_raw", "empty", "parts", "youtube_comments", "知乎_posts"]
    paths = [p for group in sources.values() for p in group]
    found = {p.rsplit("/", 1)[1]: e for p, e in files.file_encodings(spark, paths).items()}
    assert found == {
        "bilibili_raw.csv": "UTF-8", "empty.csv": "UTF-8", "youtube_comments.csv": "UTF-8", "知乎_posts.csv": "GBK",
        "part-0.csv": "UTF-8", "part-1.csv": "GBK",
    }
    assert files.file_encodings(spark, []) == {}
    rows = files.landed_comments(spark, str(landing)).where("platform = 'parts'").collect()
    assert {r["content"] for r in rows} == {"一二三四五六", "甲乙丙丁戊己"}


def test_rows_follow_the_names_of_part_files(spark, tmp_path):
    folder = tmp_path / "raw" / "weibo 1+2.csv"
    folder.mkdir(parents=True)
    write(folder / "part-0.csv", "content\nfirst of all\nsecond\n")
    write(folder / "part-1.csv", "content\n" + "\n".join(f"a much larger file row {i}" for i in range(500)) + "\n")
    write(folder / "part-2.csv", "content\n第三个文件\n", "gbk")
    (folder / "part-3.csv").write_bytes(b"content\n\xff\xff\xff neither\n")
    rows = files.landed_comments(spark, str(tmp_path / "raw")).orderBy("row_id").select("content").collect()
    texts = [r["content"] for r in rows]
    assert texts[:3] == ["first of all", "second", "a much larger file row 0"]
    assert texts[-2:] == ["a much larger file row 499", "第三个文件"] and len(texts) == 503


def test_landed_comments(spark, landing):
    rows = files.landed_comments(spark, str(landing)).select("platform", "content", "timestamp", "likes", "publish_time").collect()
    got = {(r["platform"], r["content"]) for r in rows}
    assert ("bilibili", "支持和平\n解决争端") in got and ("zhihu", "反战停火谈判吧") in got
    assert ("bilibili", 'He said "stop the war now"') in got
    assert {r["platform"] for r in rows} == {"bilibili", "zhihu", "youtube"}  # the empty source is left out
    zhihu = [r for r in rows if r["platform"] == "zhihu"][0]
    assert zhihu["timestamp"] == "2025-05-03" and zhihu["likes"] == "2" and zhihu["publish_time"] is None


def test_clean_folder(spark, landing, tmp_path):
    rows = clean_folder(spark, str(landing)).select("platform", "cleaned_text", "language", "tokens").collect()
    got = {r["cleaned_text"]: r for r in rows}
    assert set(got) == {"支持和平 解决争端", "He said stop the war now", "反战停火谈判吧", "People desire peace instead"}
    assert got["支持和平 解决争端"]["platform"] == "bilibili"  # first by platform
    assert got["People desire peace instead"]["tokens"] == ["desire", "peace", "instead"]
    assert got["反战停火谈判吧"]["tokens"] == ["反战", "停火"]
    empty = tmp_path / "none"
    empty.mkdir()
    assert clean_folder(spark, str(empty)) is None


@pytest.mark.parametrize("alias,target", [
    ("text", "content"), ("comment", "content"), ("body", "content"), ("message", "content"), ("time", "timestamp"),
    ("date", "timestamp"), ("created_at", "timestamp"), ("username", "user"), ("nick", "user"), ("author", "user"),
    ("like", "likes"), ("点赞", "likes"), ("fav", "likes"),
])
def test_aliases(spark, alias, target):
    assert rename_aliases(spark.createDataFrame([("v",)], [alias])).columns == [target]


def test_standardize(spark):
    both = spark.createDataFrame([("a", "b", "c")], ["content", "text", "comment"])
    out = standardize(both, F.lit(" weibo_raw "))
    row = out.first()
    assert row["content"] == "a" and row["text"] == "b" and row["timestamp"] == "" and row["language"] == "auto"
    assert row["platform"] == "weibo"
    bare = standardize(spark.createDataFrame([(1, "zh")], ["x", "language"]), F.lit("微博_raw")).first()
    assert bare["content"] == "" and bare["language"] == "zh" and bare["platform"] == "微博_raw"
    assert first_available(out, ("sentiment_label", "content")) == "content"
    assert first_available(out, ("nope",)) is None


def test_word_lists(spark, tmp_path):
    write(tmp_path / "a.txt", "The\n of \n\n和\nthe\n")
    write(tmp_path / "b.txt", "和\nvon\n")
    words = wordlists.word_list(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")])
    assert sorted(r["word"] for r in words.collect()) == ["of", "the", "von", "和"]
    assert wordlists.stop_words(spark).count() == 113 + 93
    merged = wordlists.stop_words(spark, str(tmp_path / "b.txt"))
    assert merged.where("word = 'von'").count() == 1
    assert wordlists.cloud_stop_words(spark).where("word in ('nuclear', 'drone')").count() == 2


def test_tables_in_order(spark, tmp_path):
    scored, cleaned = str(tmp_path / "scored"), str(tmp_path / "cleaned")
    assert tables.first_table(spark, [scored, cleaned]) is None
    sinks.overwrite_table(spark.createDataFrame([(1, ["a"])], "i int, tokens array<string>"), cleaned)
    assert tables.first_table(spark, [scored, cleaned]).columns == ["i", "tokens"]
    sinks.overwrite_table(spark.range(2), scored)
    assert tables.first_table(spark, [scored, cleaned]).count() == 2
    assert tables.read_table(spark, "no_such_table") is None


def test_a_lost_writer_leaves_the_old_rows(spark, tmp_path):
    path, plain = str(tmp_path / "t"), str(tmp_path / "c")
    sinks.overwrite_table(spark.range(3), path)
    sinks.overwrite_csv(spark.range(3), plain)
    broken = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    for write_again in (lambda: sinks.overwrite_table(broken, path), lambda: sinks.overwrite_csv(broken, plain)):
        with pytest.raises(Exception, match="lost"):
            write_again()
    assert tables.read_table(spark, path).count() == 3 and files.read_csv(spark, plain).count() == 3
    # a writer that was lost after its rows, before its manifest
    spark.range(7).write.mode("append").parquet(path)
    assert tables.read_table(spark, path).count() == 3
    sinks.overwrite_table(tables.read_table(spark, path).where("id > 0"), path)  # a table from its own rows
    assert tables.read_table(spark, path).count() == spark.read.parquet(path).count() == 2
    sinks.overwrite_table(spark.range(0), path)
    assert tables.read_table(spark, path).count() == 0
    held = tables.children(spark, path)
    assert len([name for name in held if name.startswith(tables.MANIFEST)]) == 1 and len(tables.marks(held)) == 1
    sinks.overwrite_csv(spark.range(4), plain)
    assert files.read_csv(spark, plain).count() == 4


def test_rows_without_a_manifest_count_until_the_next_write(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.range(4).write.parquet(path)
    assert tables.read_table(spark, path).count() == 4
    lost = spark.range(9).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.overwrite_table(lost, path)
    assert tables.read_table(spark, path).count() == 4
    sinks.overwrite_table(spark.range(2), path)
    assert tables.read_table(spark, path).count() == 2


def test_append_new_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("", 3)], "comment_id string, v int")
    sinks.append_new(rows, path)
    sinks.append_new(rows.union(spark.createDataFrame([("c", 4)], rows.schema)), path)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 2, 4]
    assert files.known_ids(spark.read.parquet(path), spark).count() == 3


def test_csv_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("w", 'say "x",\ny', 3)], "platform string, content string, like_count int")
    path = str(tmp_path / "records")
    sinks.write_records(rows, path)
    text = "".join(p.read_text() for p in (tmp_path / "records").glob("*.csv"))
    assert text.startswith('"platform","keyword","comment_id"') and '"say ""x"",\ny"' in text
    back = files.read_csv(spark, path)
    assert back.first()["content"] == 'say "x",\ny' and back.columns == list(to_comment_columns(rows).columns)
    sinks.overwrite_csv(spark.createDataFrame([(1, ["a", "b"])], "i int, tokens array<string>"), str(tmp_path / "c"))
    assert files.read_csv(spark, str(tmp_path / "c")).first()["tokens"] == '["a","b"]'
    sinks.write_video_comments(spark.createDataFrame([("t", "v", "c", 1)], "video_title string, video_id string, comment string, x int"), str(tmp_path / "v"))
    assert files.read_csv(spark, str(tmp_path / "v")).columns == ["video_title", "video_id", "comment"]


def test_findings_file(spark, tmp_path):
    found = spark.createDataFrame([(2, "b", "second"), (1, "a", "first")], "no int, key string, text string")
    sinks.write_findings(found, str(tmp_path / "f"), "Title")
    lines = [l for p in sorted((tmp_path / "f").glob("*.txt")) for l in p.read_text().split("\n")]
    assert [l for l in lines if l] == ["Title", "=" * 40, "1. first", "2. second"]


def test_json_payloads(spark, tmp_path):
    write(tmp_path / "replies.json", '{"item_id":"BV1","page_no":1,"code":0,"data":{"replies":[{"rpid_str":"1","content":{"message":"hi"}}]}}\n{"item_id":"BV2","code":-1}\n')
    pages = payloads.reply_payloads(spark, str(tmp_path / "replies.json"))
    assert [r["item_id"] for r in pages.collect()] == ["BV1"]
    write(tmp_path / "threads.json", '{"video_title":"A &amp; B","video_id":"v","items":[{"snippet":{"topLevelComment":{"snippet":{"textDisplay":"it&#39;s"}}}},{"snippet":null}]}\n')
    rows = payloads.thread_comments(spark, str(tmp_path / "threads.json")).collect()
    assert [tuple(r) for r in rows] == [("A & B", "v", "it's")]


def test_long_threads_land_as_many_lines(spark, tmp_path, monkeypatch):
    from opinara.catalog import source_queries

    turn = F.when(F.col("id") % 2 == 0, F.col("id"))
    turns = spark.range(3000).select(F.lit(7).alias("conv_id"), turn.alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("text "), "id").alias("text"))
    turns.write.parquet(str(tmp_path / "conversations.parquet"))
    landed = []
    explode = payloads.thread_comments
    monkeypatch.setattr(source_queries.payloads, "thread_comments", lambda spark, path: landed.append(path) or explode(spark, path))
    found = source_queries.thread_payloads(spark, str(tmp_path))
    assert found.distinct().count() == found.count() == 3000
    lines = spark.read.json(landed[0]).select(F.size("items").alias("n")).collect()
    assert sum(r["n"] for r in lines) == 3000 and max(r["n"] for r in lines) <= 128
