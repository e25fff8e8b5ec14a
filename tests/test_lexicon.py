"""Word tables inside texts: containment and segmentation against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from opinara.functions import segment as G
from opinara.operators import lexicon as X
from opinara.operators.topics import with_rule_topic, with_rule_topic_by_table
from opinara.plans.clean import clean_corpus

CJK = [chr(c) for c in range(0x4E00, 0x4E00 + 600)]


def word_table(spark, pairs):
    return spark.createDataFrame(sorted(pairs), "word string, tag string")


def many_words(pick, number, letters, longest):
    words = set()
    while len(words) < number:
        words.add("".join(pick.choices(letters, k=pick.randint(1 if len(words) < 40 else 2, longest))))
    return words


def test_containment_with_a_hundred_thousand_words(spark):
    pick = random.Random(1)
    words = many_words(pick, 100_000, CJK + list("abcé 0"), 8)
    texts = ["".join(pick.choices(CJK + list("abcé 0xyz"), k=pick.randint(0, 300))) for _ in range(120)] + ["", None, "x", "zz"]
    listed = spark.createDataFrame([(w, f"l{len(w)}") for w in sorted(words)] + [("", "empty"), (None, "null")], "word string, label string")
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(4)
    found = {r["k"]: r["labels"] for r in X.labels_in(rows, "k", "t", listed).collect()}
    inside = lambda t: {t[i : i + n] for n in range(1, 9) for i in range(len(t) - n + 1)} & words
    wanted = {k: sorted({f"l{len(w)}" for w in inside(t)}) for k, t in enumerate(texts) if t and inside(t)}
    assert found == wanted
    assert {r["k"] for r in X.texts_with_any(rows, "k", "t", listed).collect()} == set(wanted)


def test_broadcast_and_shuffle_find_the_same(spark, monkeypatch):
    listed = spark.createDataFrame([("b", "1"), ("longer word", "2"), ("good", "3"), ("goods", "3"), ("\U0001f600x", "4")], "word string, label string")
    texts = ["b", "a longer word", "the goods", "goo d", "\U0001f600x", "\U0001f600 x", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    small = sorted(map(str, X.labels_in(rows, "k", "t", listed).collect()))
    monkeypatch.setattr(X, "hinted", lambda table: table)
    assert sorted(map(str, X.labels_in(rows, "k", "t", listed).collect())) == small
    assert [r["labels"] for r in X.with_labels(rows, "k", "t", listed, "labels").orderBy("k").collect()] == [["1"], ["2"], ["3"], [], ["4"], [], []]
    assert X.labels_in(rows, "k", "t", listed.limit(0)).count() == 0 and X.labels_in(rows.limit(0), "k", "t", listed).count() == 0


def plain_segments(text, lexicon):
    """One token after the other, the longest word that starts there."""
    longest = max(map(len, lexicon), default=0)
    out, at = [], 0
    while at < len(text):
        run = re.match("[A-Za-z0-9]+", text[at:])
        size = len(run[0]) if run else 1
        for n in range(min(longest, len(text) - at), 0, -1):
            word = text[at : at + n]
            if word in lexicon and (not re.fullmatch("[A-Za-z0-9]+", word) or n == size):
                size = n
                break
        word = text[at : at + size]
        kind = "m" if re.fullmatch("[0-9]+", word) else "eng" if re.fullmatch("[A-Za-z0-9]+", word) else "x"
        out.append((word, lexicon.get(word, kind)))
        at += size
    return out


def segments(spark, texts, lexicon):
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(4)
    found = X.segmented(rows, "k", "t", word_table(spark, lexicon.items())).orderBy("k").collect()
    return [None if r["pairs"] is None else [tuple(p) for p in r["pairs"]] for r in found]


def test_segments_with_a_hundred_thousand_words(spark):
    pick = random.Random(2)
    lexicon = {w: pick.choice(["n", "v", "ns", "x"]) for w in many_words(pick, 100_000, CJK + list("ab1"), 6)}
    texts = ["".join(pick.choices(CJK + list("ab1 。\n"), k=pick.randint(0, 400))) for _ in range(60)] + ["", None, "ab1ab1", "\U0001f600ab"]
    assert segments(spark, texts, lexicon) == [None if t is None else plain_segments(t, lexicon) for t in texts]


def test_segments_are_those_of_the_list_form(spark):
    lexicon = {"best": "a", "be": "v", "que les": "n", "c罗": "nr", "罗纳": "n", "罗纳尔多": "nr", "12": "t", "é": "n"}
    texts = ["bests best be", "xque les12", "c罗纳尔多 c罗罗纳尔", "12 123 é12", "x" * 3000 + "罗纳" * 3000]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    listed = [[tuple(p) for p in r[0]] for r in rows.select(G.segment(F.col("t"), lexicon)).collect()]
    assert segments(spark, texts, lexicon) == listed == [plain_segments(t, lexicon) for t in texts]
    assert segments(spark, texts, {}) == [plain_segments(t, {}) for t in texts]
    plan = X.segmented(rows, "k", "t", word_table(spark, lexicon.items()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_tokens_of_a_corpus_by_table(spark):
    lexicon = {"停火": "v", "和平": "n", "和平谈判": "n", "谈判": "v"}
    texts = ["呼吁停火和平谈判现在开始", "the best peace talks are now", "呼吁停火和平谈判现在开始", "没有听说过的词语"]
    rows = spark.createDataFrame([(i, "p", t) for i, t in enumerate(texts)], "row_id int, platform string, content string")
    by_list = clean_corpus(rows, lexicon=lexicon).orderBy("row_id").collect()
    by_table = clean_corpus(rows, lexicon=word_table(spark, lexicon.items())).orderBy("row_id").collect()
    assert [r["tokens"] for r in by_table] == [r["tokens"] for r in by_list] and by_list[0]["tokens"] == ["停火", "和平谈判"]


@pytest.mark.parametrize("text", ["cleaned_text"])
def test_topics_by_table(spark, text):
    rules = (("b", ("油价", "oil")), ("a", ("和平", "peace", "us")))
    rows = spark.createDataFrame(list(enumerate(["PEACE oil", "because", "none", None, "", "和平"])), f"k int, {text} string")
    table = spark.createDataFrame([(i, n, w) for i, (n, ws) in enumerate(rules) for w in ws], "place int, topic string, word string")
    expected = {r["k"]: r["rule_topic"] for r in with_rule_topic(rows, rules, "other").collect()}
    assert {r["k"]: r["rule_topic"] for r in with_rule_topic_by_table(rows, "k", table, "other").collect()} == expected


def by_join(monkeypatch):
    """Every list counts as too long to be passed along."""
    whole = X.listed_rows
    monkeypatch.setattr(X, "listed_rows", lambda table: (whole(table)[0], None))


@pytest.mark.parametrize("slice_size", [7, 1 << 20])
def test_short_lists_are_searched_for_in_the_row(spark, monkeypatch, slice_size):
    pick = random.Random(3)
    letters = list("ab é0") + ["\U0001f600", "\0"]
    words = sorted(many_words(pick, 300, letters, 5)) + ["abab" * 5]
    listed = spark.createDataFrame([(w, f"l{i % 7}") for i, w in enumerate(words)] + [("a", "also"), ("b", None), (None, "n"), ("", "e")], "word string, label string")
    texts = ["".join(pick.choices(letters + ["x"], k=pick.randint(0, 60))) for _ in range(50)] + [None, "", "abab" * 9, "\0", "xx"]
    rows = spark.createDataFrame([*enumerate(texts), (None, "a")], "k int, t string").repartition(3)
    wanted = {k: sorted({f"l{i % 7}" for i, w in enumerate(words) if w in t} | ({"also"} if "a" in t else set())) for k, t in enumerate(texts) if t}
    built, sizes = X.X.build(words), [len(w) for w in words]
    monkeypatch.setattr(X.X, "SLICE", slice_size)
    for table in (1, 1 << 23):
        monkeypatch.setattr(X.X, "TABLE", table)
        places = {(i, at, words[w]) for text, place, word in X.X.Finder(built).hits([t or "" for t in texts]) for i, at, w in zip(text, place, word)}
        assert places == {(i, at, w) for i, t in enumerate(texts) for w in words for at in range(len(t or "") - len(w) + 1) if t[at:].startswith(w)}
        assert max(sizes) == 20
    found = X.with_labels(rows, "k", "t", listed, "labels")
    assert {r["k"]: r["labels"] for r in found.collect()} == {**dict.fromkeys([*range(len(texts)), None], []), **wanted}
    inside = X.labels_in(rows, "k", "t", listed)
    assert {r["k"]: r["labels"] for r in inside.collect()} == {k: v for k, v in wanted.items() if v}
    # One pass over the texts: neither a row for each gram nor a text moves.
    plan = inside._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    by_join(monkeypatch)
    assert {r["k"]: r["labels"] for r in X.labels_in(rows, "k", "t", listed).collect()} == {k: v for k, v in wanted.items() if v}


def test_segments_of_short_longer_and_long_lists(spark, monkeypatch):
    pick = random.Random(4)
    letters = list("ab1 é和平")
    texts = ["".join(pick.choices(letters, k=pick.randint(0, 80))) for _ in range(40)] + [None, "", "和", "ab1" * 30]
    for number in (60, 700):
        lexicon = {w: pick.choice(["n", "v", "x"]) for w in many_words(pick, number, letters, 4)}
        wanted = [None if t is None else plain_segments(t, lexicon) for t in texts]
        assert segments(spark, texts, lexicon) == wanted
        with monkeypatch.context() as patch:
            by_join(patch)
            assert segments(spark, texts, lexicon) == wanted
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    listed = spark.createDataFrame([("和平", None), ("ab1", "n"), ("ab1", "v"), ("", "n"), (None, "n"), ("12", None)], "word string, tag string")
    few = X.dictionary_tokens(rows, "k", "t", listed)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "posexplode" not in plan
    short = sorted((r["k"], r["tokens"]) for r in few.collect())
    by_join(monkeypatch)
    assert short == sorted((r["k"], r["tokens"]) for r in X.dictionary_tokens(rows, "k", "t", listed).collect())
