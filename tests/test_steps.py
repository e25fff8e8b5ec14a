"""A whole run over landed files, step by step."""

import pytest
from pyspark.sql import functions as F

from opinara.operators.columns import handle_missing, split_rows, with_date
from opinara.operators.keywords import largest_residual, neighbour_pairs, neighbour_shares, text_rank
from opinara.plans import steps


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")
    zh = ["支持和平解决争端", "反战停火谈判吧大家", "谴责侵略和霸权行为", "油价又涨了生活难", "医院里都是难民和儿童"]
    en = ["peace talks bring hope again", "this war is a terrible crisis", "oil prices hurt people everywhere", "stop bombing civilians right now"]
    rows = [f"{t}第{i}条,2025-05-{i % 9 + 1:02d} 10:00:00" for i in range(6) for t in zh]
    (raw / "weibo_raw.csv").write_text("content,publish_time\n" + "\n".join(rows) + "\n", encoding="utf-8-sig")
    rows = [f"T,v{i},{t} number {w}" for i, w in enumerate(["alpha", "beta", "gamma"]) for t in en]
    (raw / "youtube_comments.csv").write_text("video_title,video_id,comment\n" + "\n".join(rows) + "\n", encoding="utf-8")
    return str(raw), str(tmp_path_factory.mktemp("tables"))


def test_run(spark, folders):
    raw, tables = folders
    assert steps.score(spark, tables) is None and steps.report(spark, tables) is None
    out = steps.run(spark, raw, tables, {"hope": 0.9, "terrible": -0.8})
    assert set(out) == {"headline", "sentiment", "platforms", "trend", "topic_counts", "words", "findings"}
    head = out["headline"].first()
    assert head["total"] == 42 and head["platforms"] == 2
    assert sum(r["count"] for r in out["sentiment"].collect()) == 42
    assert out["trend"].count() == 6
    assert out["findings"].count() == 7
    assert spark.read.parquet(f"{tables}/topic_cluster_sizes").agg(F.sum("size")).first()[0] == 42
    assert spark.read.parquet(f"{tables}/keywords").where("keyword = '反战'").first()["weight"] == 6.0
    assert spark.read.parquet(f"{tables}/topic_shares").count() > 3
    words = {r["word"]: r["freq"] for r in out["words"].collect()}
    assert words["peace"] == 3 and "war" not in words
    text = spark.read.text(f"{tables}/report_findings_text").collect()
    assert any(r["value"].startswith("1. ") for r in text)


def test_trained_base_score(spark, folders):
    _, tables = folders
    labelled = spark.createDataFrame([("peace hope", 1), ("war crisis", 0)], "text string, label int")
    rows = steps.score(spark, tables, {"hope": 0.9, "terrible": -0.8}, labelled)
    assert {"base_score", "sentiment_score", "sentiment"} <= set(rows.columns)
    assert rows.where("sentiment_score not between 0 and 1").count() == 0
    best = rows.where("cleaned_text like 'peace talks%'").first()
    assert best["sentiment_score"] == 1.0 and best["sentiment"] == "正面"


def test_scores_need_a_base(spark, folders):
    with pytest.raises(ValueError):
        steps.score(spark, folders[1])


def test_missing_columns_are_made(spark, folders, tmp_path):
    """Tables without language and tokens, as another tool may leave them."""
    _, tables = folders
    bare = str(tmp_path)
    spark.read.parquet(f"{tables}/cleaned").drop("language", "tokens").write.parquet(f"{bare}/cleaned")
    polarity = {"hope": 0.9, "terrible": -0.8}
    scored = steps.score(spark, bare, polarity).select("comment_key", "sentiment_score")
    whole = steps.score(spark, tables, polarity).select("comment_key", "sentiment_score")
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, whole.collect()))
    assert steps.topics(spark, bare)["cluster_sizes"].agg(F.sum("size")).first()[0] == 42
    words = {r["word"]: r["freq"] for r in steps.report(spark, bare)["words"].collect()}
    assert words["peace"] == 3


def test_long_stop_word_lists(spark, folders, tmp_path):
    raw, _ = folders
    (tmp_path / "words.txt").write_text("\n".join([*(f"word{i}" for i in range(30_000)), "peace"]))
    rows = steps.clean(spark, raw, str(tmp_path / "tables"), [str(tmp_path / "words.txt")])
    tokens = {t for r in rows.select("tokens").collect() for t in r["tokens"]}
    assert "peace" not in tokens and "talks" in tokens and rows.count() == 42


def test_missing_dates_and_split(spark):
    rows = spark.createDataFrame([("a", " ", "2025/5/1"), ("", "x", "2025-05-02"), (None, "y", "z"), ("b", None, None)], "t string, u string, d string")
    kept = handle_missing(rows, ["t"], {"u": "none"}).collect()
    assert [(r["t"], r["u"]) for r in kept] == [("a", "none"), ("b", "none")]
    assert [str(r["date"]) for r in with_date(rows, "d").collect()] == ["2025-05-01", "2025-05-02", "None", "None"]
    train, test = split_rows(spark.range(2000), "id", 0.75)
    assert train.count() + test.count() == 2000 and 1400 < train.count() < 1600
    assert train.join(test, "id").count() == 0


def test_text_rank(spark):
    rows = spark.createDataFrame([(["a", "b", "c"],), (["a", "d"],), (["a", "a"],), ([],)], "tokens array<string>")
    pairs = neighbour_pairs(rows, 2)
    assert {(r["one"], r["two"]): r["weight"] for r in pairs.collect()} == {("a", "b"): 1, ("b", "c"): 1, ("a", "d"): 1}
    ranks = {r["word"]: r["rank"] for r in text_rank(pairs).collect()}
    assert sum(ranks.values()) == pytest.approx(4.0, abs=1e-7)
    # a - d and b - c hang on the ends of a - b, so the ranks have a closed form
    outer = (0.15 + 0.15 * 0.425) / (1 - 0.425 * 0.85 - 0.425)
    assert ranks["a"] == pytest.approx(ranks["b"], abs=1e-8) and ranks["c"] == pytest.approx(0.15 + 0.425 * ranks["a"], abs=1e-8)
    assert ranks["a"] == pytest.approx(0.15 + 0.85 * ranks["d"] + 0.425 * ranks["b"], abs=1e-8) and outer > 0
    assert min(ranks["a"], ranks["b"]) > max(ranks["c"], ranks["d"])


def test_text_rank_settles_on_every_kind_of_graph(spark):
    star = [("hub", f"w{i}", 1 + i % 3) for i in range(30)]
    line = [(f"a{i:02}", f"a{i + 1:02}", 1) for i in range(40)]
    apart = [("x", "y", 5)]
    pairs = spark.createDataFrame(star + line + apart, "one string, two string, weight long")
    ranks = text_rank(pairs)
    shares = neighbour_shares(pairs)
    assert largest_residual(shares, ranks) < 1e-8
    wrong = ranks.withColumn("rank", F.when(F.col("word") == "a07", F.col("rank") * 1.001).otherwise(F.col("rank")))
    assert largest_residual(shares, wrong) > 1e-5
    assert {r["word"]: round(r["rank"], 7) for r in ranks.where("word IN ('x', 'y')").collect()} == {"x": 1.0, "y": 1.0}
    assert text_rank(pairs.limit(0)).count() == 0 and largest_residual(shares.limit(0), ranks.limit(0)) == 0
    with pytest.raises(ValueError):
        text_rank(pairs, damping=1.0)
