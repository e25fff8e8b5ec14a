import math

import pytest
from pyspark.sql import functions as F

from opinara.operators import models as M
from opinara.plans.reports import topic_report


def docs(spark):
    words = {"a": ["peace", "talks", "hope"], "b": ["oil", "price", "market"], "c": ["war", "bomb", "front"]}
    rows = [(i, [words["abc"[i % 3]][j % 3] for j in range(i % 4 + 2)], "abc"[i % 3]) for i in range(45)]
    return spark.createDataFrame(rows, "row_id int, tokens array<string>, kind string")


def test_tfidf_rows(spark):
    rows = spark.createDataFrame([(1, ["x", "x", "y"]), (2, ["y", "don't"]), (3, [])], "k int, tokens array<string>")
    got = {(r["k"], r["term"]): (r["tf"], r["tfidf"]) for r in M.tfidf_rows(rows, "k").collect()}
    assert set(got) == {(1, "x"), (1, "y"), (2, "y"), (2, "don"), (2, "t")}
    wx, wy = 2 * (math.log(4 / 2) + 1), math.log(4 / 3) + 1
    assert got[(1, "x")] == (2, pytest.approx(wx / math.hypot(wx, wy)))
    limited = M.tfidf_rows(rows, "k", size=1).collect()
    assert {r["term"] for r in limited} == {"x"} and limited[0]["tfidf"] == pytest.approx(1.0)


def test_vectors_equal_rows(spark):
    source = docs(spark)
    vectors, names = M.tfidf_vectors(source)
    rows = {(r["row_id"], r["term"]): r["tfidf"] for r in M.tfidf_rows(source, "row_id").collect()}
    for r in vectors.select("row_id", "features").collect():
        for i, value in zip(r["features"].indices, r["features"].values):
            assert rows[(r["row_id"], names[i])] == pytest.approx(value)


def test_clusters(spark):
    source = docs(spark)
    clustered, model, names = M.cluster(source, k=3, starts=3)
    sizes = M.cluster_sizes(clustered, 3).collect()
    assert sum(r["size"] for r in sizes) == 45 and len(sizes) == 3
    kinds = clustered.groupBy("kind").agg(F.countDistinct("cluster").alias("n")).collect()
    assert all(r["n"] == 1 for r in kinds)
    terms = M.cluster_terms(source, model, names, 3).collect()
    assert len(terms) == 9 and {r["rank"] for r in terms} == {1, 2, 3}
    empty = M.cluster_sizes(clustered.where("cluster = 0"), 3).orderBy("cluster").collect()
    assert [r["size"] for r in empty][1:] == [0, 0]


def test_topic_report_with_clusters(spark):
    rows = docs(spark).withColumn("cleaned_text", F.array_join("tokens", " "))
    out = topic_report(rows, None, "row_id")
    assert {"topics", "sizes", "cluster_sizes", "cluster_terms"} == set(out)
    assert "cluster" in out["topics"].columns and out["cluster_sizes"].agg(F.sum("size")).first()[0] == 45


def test_classifiers(spark):
    rows = spark.createDataFrame(
        [("good great day", 1), ("great hope", 1), ("bad evil day", 0), ("evil crisis", 0)], "text string, label int"
    )
    model = M.train_sentiment(rows)
    out = {r["text"]: r["base_score"] for r in M.positive_probability(model, rows.select("text"), key="text").collect()}
    assert out["great hope"] > 0.5 > out["evil crisis"] and all(0 <= v <= 1 for v in out.values())
    for kind in ("nb", "svm"):
        topics = M.predicted_topics(M.train_topics(rows, "text", "label", kind), rows.select("text"), "text", "text").collect()
        assert {r["text"]: r["topic_label"] for r in topics}["good great day"] == 1
        assert all((r["topic_confidence"] is not None) == (kind == "nb") for r in topics)


def test_bayes_as_by_hand(spark):
    rows = spark.createDataFrame([("a a b", 1), ("b c", 0), ("c", 0)], "text string, label int")
    seen = spark.createDataFrame([(1, "a"), (2, "c c zz"), (3, "zz"), (4, None)], "row_id int, text string")
    got = {r["row_id"]: r["base_score"] for r in M.positive_probability(M.train_sentiment(rows), seen).collect()}
    prior = (2 / 5, 3 / 5)
    one = {"a": 3 / 6, "b": 2 / 6, "c": 1 / 6}
    nil = {"a": 1 / 6, "b": 2 / 6, "c": 3 / 6}
    share = lambda words: (p := prior[0] * math.prod(one[w] for w in words)) / (p + prior[1] * math.prod(nil[w] for w in words))
    assert got == {1: pytest.approx(share("a")), 2: pytest.approx(share("cc")), 3: pytest.approx(0.4), 4: pytest.approx(0.4)}


def test_words_beyond_the_vector_vocabulary_count(spark):
    rows = spark.createDataFrame([(" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(6000)), 1), ("rare", 0)], "text string, label int")
    assert M.train_sentiment(rows).weights.count() == 6001


def test_certificate_of_clusters(spark):
    source = docs(spark)
    clustered, model, names = M.cluster(source, k=3, starts=3)
    weights, centers = M.tfidf_rows(source, "row_id"), M.center_rows(spark, model, names)
    named = M.cluster_terms(clustered, model, names, 3)
    found = M.cluster_certificate(weights, clustered.select("row_id", "cluster"), centers, named, "row_id").collect()
    assert len(found) == 3 and all(r["nearest"] and r["rests"] and r["strongest"] for r in found)
    assert sum(r["cost"] for r in found) == pytest.approx(model.summary.trainingCost, abs=1e-6)
    other = source.select("row_id", (F.col("row_id") % 2).alias("cluster"))
    wrong = M.cluster_certificate(weights, other, centers, named, "row_id").collect()
    assert not all(r["nearest"] for r in wrong) and not any(r["rests"] for r in wrong)
    moved = centers.withColumn("weight", F.col("weight") + 0.01)
    assert not any(r["rests"] for r in M.cluster_certificate(weights, clustered.select("row_id", "cluster"), moved, named, "row_id").collect())
    weak = centers.orderBy("weight").limit(3).select("cluster", F.lit(1).alias("rank"), "term")
    assert not all(r["strongest"] for r in M.cluster_certificate(weights, clustered.select("row_id", "cluster"), centers, weak, "row_id").collect())


def test_terms_are_counted_and_weighted_in_their_row(spark):
    rows = M.tfidf_rows(docs(spark), "row_id")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_rows_of_a_repeated_key_count_as_one(spark):
    kind = "k int, tokens array<string>"
    apart = spark.createDataFrame([(1, ["x", "y"]), (1, ["x"]), (None, ["y"]), (None, ["z", "y"]), (2, None), (3, ["x"])], kind)
    got = {(r["k"], r["term"]): (r["tf"], r["tfidf"]) for r in M.tfidf_rows(apart, "k").collect()}
    weight = {"x": math.log(7 / 3) + 1, "y": math.log(7 / 3) + 1, "z": math.log(7 / 2) + 1}
    counts = {1: {"x": 2, "y": 1}, None: {"y": 2, "z": 1}, 3: {"x": 1}}
    length = {k: math.sqrt(sum((n * weight[t]) ** 2 for t, n in row.items())) for k, row in counts.items()}
    assert got == {(k, t): (n, pytest.approx(n * weight[t] / length[k])) for k, row in counts.items() for t, n in row.items()}


def test_top_terms_tie_by_term(spark):
    rows = spark.createDataFrame([(1, ["b", "a", "c", "c"]), (2, ["a"]), (3, [])], "k int, tokens array<string>")
    top = M.top_terms_per_row(M.weighted_terms(rows, "k"), "k", 2).collect()
    assert sorted((r["k"], r["rank"], r["term"]) for r in top) == [(1, 1, "c"), (1, 2, "b"), (2, 1, "a")]
    even = spark.createDataFrame([(1, ["c", "b", "a"])], "k int, tokens array<string>")
    assert [r["term"] for r in M.top_terms_per_row(M.weighted_terms(even, "k"), "k", 2).orderBy("rank").collect()] == ["a", "b"]


def test_starts_go_over_vectors_that_the_algorithm_keeps(spark, monkeypatch):
    seen, fit = [], M.KMeans.fit

    def noted(self, rows):
        seen.append((rows.columns, rows.storageLevel.useMemory))
        return fit(self, rows)

    monkeypatch.setattr(M.KMeans, "fit", noted)
    vectors, _ = M.tfidf_vectors(docs(spark))
    models = M.started(vectors, 3, 2, 42, 20)
    assert seen == [(["features"], False)] * 2 and [m.getSeed() for m in models] == [42, 43]


def test_bayes_with_more_words_than_are_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([("a a b", 1), ("b c", 0), ("c a", 0)], "text string, label int")
    seen = spark.createDataFrame([(1, "a a b"), (2, "c c zz"), (3, "zz"), (4, None), (None, "b b a"), (5, "c")], "row_id int, text string")
    model = M.train_sentiment(rows)
    scores = lambda: {r["row_id"]: r["_scores"] for r in model.log_scores(seen, "row_id", "text").collect()}
    whole = scores()
    monkeypatch.setattr(M, "fits_broadcast", lambda kept: False)
    monkeypatch.setattr(M, "FREQUENT_WORDS", 1)
    assert set(whole) == {1, 2, None, 5} and scores() == {k: pytest.approx(v) for k, v in whole.items()}
    plan = model.log_scores(seen, "row_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan  # no occurrence of a word meets the weights of the rare ones


def test_svm_learns_from_hashed_texts_made_once(spark, monkeypatch):
    seen, fit = [], M.OneVsRest.fit
    monkeypatch.setattr(M.OneVsRest, "fit", lambda self, rows: seen.append((rows.columns, rows.storageLevel.useMemory)) or fit(self, rows))
    rows = spark.createDataFrame([("good great day", 1), ("great hope", 1), ("bad evil day", 0), ("evil crisis", 0)], "text string, label int")
    M.train_topics(rows, "text", "label", "svm")
    assert seen == [(["label", "features"], True)]
