import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from opinara.operators.aggregates import daily_mean
from opinara.streaming import caps as C
from opinara.streaming import incremental as I
from opinara.streaming import trend as T


def test_incremental_append(spark, tmp_path):
    folder, table = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "comment_id string, content string, crawl_time string"

    def land(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)
        I.append_stream(I.comment_stream(spark, folder, schema), table, str(tmp_path / "state")).awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(table).select("comment_id", "cleaned_text", "language").collect())

    first = land([("a", "支持[x]和平", "1"), ("b", "peace talks now", "1"), ("b", "later copy", "2"), ("", "no id", "1")])
    assert first == [("a", "支持和平", "zh"), ("b", "peace talks now", "en")]
    second = land([("a", "again", "3"), ("c", "ok", "3")])
    assert second == [*first, ("c", "ok", "other")]
    I.append_stream(I.comment_stream(spark, folder, schema), table, str(tmp_path / "other")).awaitTermination()
    assert spark.read.parquet(table).count() == 3  # a replay of everything adds nothing


def events(spark, tmp_path):
    rows = spark.range(200).select(
        F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2025-05-01").cast("timestamp_ntz")).alias("at"),
        (F.col("id") % 10 / 10).alias("score"),
    )
    path = str(tmp_path / "events")
    rows.write.parquet(path)
    return rows, spark.readStream.schema(rows.schema).parquet(path)


def test_trend_equals_batch(spark, tmp_path):
    batch, stream = events(spark, tmp_path)
    out = str(tmp_path / "open")
    T.write_open_trend(T.daily_trend(stream, "at", "score"), out, str(tmp_path / "s1")).awaitTermination()
    got = {r["date"]: (round(r["avg_score"], 9), r["n"]) for r in spark.read.parquet(out).collect()}
    want = {r["date"]: (round(r["avg_score"], 9), r["n"]) for r in daily_mean(batch, "at", "score").collect()}
    assert got == want and len(got) == 9


def test_finished_days_are_appended(spark, tmp_path):
    batch, stream = events(spark, tmp_path)
    out = str(tmp_path / "done")
    T.write_trend(T.daily_trend(stream, "at", "score", "1 hour"), out, str(tmp_path / "s2")).awaitTermination()
    got = {r["date"]: r["n"] for r in spark.read.parquet(out).collect()}
    want = {r["date"]: r["n"] for r in daily_mean(batch, "at", "score").collect()}
    assert got and all(want[d] == n for d, n in got.items()) and len(got) < len(want)


def test_recent_distinct(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2025-05-01 10:00:00"), ("a", "2025-05-01 10:01:00"), ("b", "2025-05-01 10:00:00")], "comment_id string, at string")
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows.select("comment_id", F.col("at").cast("timestamp").alias("at")).write.parquet(path)
    stream = spark.readStream.schema("comment_id string, at timestamp").parquet(path)
    query = I.recent_distinct(stream, "at", "1 hour").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "s"))
    query.trigger(availableNow=True).start(out).awaitTermination()
    assert sorted(r["comment_id"] for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_caps_hold_over_batches_and_replays(spark, tmp_path):
    folder, table, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    schema = "comment_id string, item string, at string, n int"

    def land(rows, fail=None):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        C.capped_stream(stream, table, state, "item", ["n"], "at", limit=3, total=7, expiry="1 day").awaitTermination()
        return sorted(r["comment_id"] for r in spark.read.parquet(table).collect())

    day = "2025-05-0{} 10:00:00".format
    assert land([("a1", "a", day(1), 1), ("a2", "a", day(1), 2), ("a1", "a", day(1), 3), ("b1", "b", day(1), 4), (None, "b", day(1), 5), ("x", None, day(1), 6)]) == ["a1", "a2", "b1"]
    # one of three is left of a; a repeated key doesn't count again
    assert land([("a2", "a", day(1), 1), ("a3", "a", day(1), 2), ("a4", "a", day(1), 3)]) == ["a1", "a2", "a3", "b1"]
    # two days on the counts of a have expired, those of the run have not
    assert land([("c1", "c", day(4), 1), ("c2", "c", day(4), 2)]) == ["a1", "a2", "a3", "b1", "c1", "c2"]
    assert land([("a5", "a", day(4), 1), ("a6", "a", day(4), 2)]) == ["a1", "a2", "a3", "a5", "b1", "c1", "c2"]
    assert land([("d1", "d", day(4), 1)]) == ["a1", "a2", "a3", "a5", "b1", "c1", "c2"]
    held = sorted(p.name for p in (tmp_path / "state-caps").iterdir())
    assert held == ["kept-3", "kept-4", "rows-3", "rows-4"]


def test_a_batch_lost_after_its_choice_is_finished_as_chosen(spark, tmp_path, monkeypatch):
    folder, table, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    schema = "comment_id string, item string, at string, n int"
    spark.createDataFrame([(f"a{i}", "a", "2025-05-01", i) for i in range(5)], schema).write.parquet(folder)

    def run():
        C.capped_stream(spark.readStream.schema(schema).parquet(folder), table, state, "item", ["n"], "at", limit=2).awaitTermination()

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(C, "append_new", lost)
    with pytest.raises(StreamingQueryException):
        run()
    monkeypatch.undo()
    run()
    run()
    assert sorted(r["comment_id"] for r in spark.read.parquet(table).collect()) == ["a0", "a1"]
    assert [tuple(r)[:2] for r in spark.read.parquet(f"{state}-caps/kept-0").orderBy("item").collect()] == [(None, 2), ("a", 2)]
