import random

import pytest
from pyspark.sql import functions as F

from opinara.llm import mixing

CLASH = "doc_id long, text string, source string, size string, target int, knots int"


def level_targets(sizes, weights, share, passes, least=0.0):
    """Targets by bisection of the common level."""
    total = share * sum(sizes)
    clamp = lambda x: [min(max(x * w, least * s), passes * s) for s, w in zip(sizes, weights, strict=True)]
    low, high = 0.0, 1e12
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(clamp(mid)) <= total else (low, mid)
    return clamp(low)


def table(spark, seed=3, number=400):
    pick = random.Random(seed)
    names = ["b", "a", "ä", "B", None, "", "hot"]
    rows = []
    for i in range(number):
        source = "hot" if i % 3 == 0 else pick.choice(names)
        text = pick.choice([None, "", " \t", "w " * pick.randint(1, 40), "x\ny z", "é\x0bé"])
        rows.append((i, text, source, "s", 1, 2))
    return rows, spark.createDataFrame(rows, CLASH).repartition(5)


@pytest.mark.parametrize(("share", "least"), [(1.5, 0.0), (0.4, 0.0), (1.9, 0.0), (1.5, 1.0)])
def test_targets_and_takes(spark, share, least):
    rows, docs = table(spark)
    found = mixing.mixed(docs, share=share, least=least).collect()
    assert len(found) == len(rows)
    words = lambda t: len([w for w in (t or "").translate({ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ") if w])
    size = {i: words(t) for i, t, *_ in rows}
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sums = [sum(size[r[0]] for r in rows if r[2] == n) for n in names]
    weights = [(5, 2, 1)[k % 3] for k in range(len(names))]
    want = dict(zip(names, level_targets(sums, weights, share, 2, least), strict=True))
    source = {r[0]: r[2] for r in rows}
    taken = dict.fromkeys(names, 0)
    for r in found:
        name = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sums[names.index(name)]
        assert r["target"] == pytest.approx(want[name], rel=1e-9, abs=1e-6)
        assert r["taken"] <= 2 * r["size"] and r["taken"] == len(r["positions"]) * r["size"]
        assert all(0 <= p <= 1 for p in r["positions"]) and r["positions"] == sorted(r["positions"])
        assert not least or r["positions"] or r["target"] == 0
        taken[name] += r["taken"]
    assert all(abs(taken[n] - want[n]) <= max(size.values()) for n in names)
    again = mixing.mixed(docs.repartition(3), share=share, least=least).collect()
    assert sorted(again, key=lambda r: r["doc_id"]) == sorted(found, key=lambda r: r["doc_id"])


def test_positions_follow_the_schedule(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one").alias("text"), F.when(F.col("id") % 2 == 0, "up").otherwise("late").alias("source"))
    schedules = {"up": [(0, 0), (1, 2)], "late": [(0, 0), (0.5, 0), (1, 4)]}
    found = mixing.mixed(docs, schedules=schedules, share=1.0, passes=1).collect()
    late = sorted(p for r in found if r["doc_id"] % 2 for p in r["positions"])
    up = sorted(p for r in found if r["doc_id"] % 2 == 0 for p in r["positions"])
    assert len(up) == len(late) == 2000
    assert all(abs(sum(p <= t for p in up) / 2000 - t * t) < 0.002 for t in (0.1, 0.5, 0.9))
    assert late[0] >= 0.5
    assert all(abs(sum(p <= t for p in late) / 2000 - 4 * (t - 0.5) ** 2) < 0.002 for t in (0.6, 0.75, 0.9))


def test_training_order(spark):
    rows, docs = table(spark, number=60)
    plan = mixing.mixed(docs, least=1.0)
    ordered = mixing.training_order(docs, plan)
    assert ordered.columns == docs.columns
    copies = {r["doc_id"]: len(r["positions"]) for r in plan.collect()}
    first = {r["doc_id"]: r["positions"] for r in plan.collect()}
    got = [r["doc_id"] for r in ordered.collect()]
    assert {i: got.count(i) for i in copies} == copies
    seen = {}
    places = []
    for i in got:
        places.append(first[i][seen.get(i, 0)])
        seen[i] = seen.get(i, 0) + 1
    assert places == sorted(places)


def test_no_words_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None, "a", "", 0, 0), (None, "", None, "", 0, 0)], CLASH)
    assert all(r["target"] == 0 and r["taken"] == 0 for r in mixing.mixed(docs).collect())
    assert mixing.mixed(docs.limit(0)).collect() == []


def test_a_source_without_words_stays_in_the_mix(spark):
    rows = [(1, None, "a", "", 0, 0), (2, " \n", "a", "", 0, 0), (3, "x y", "b", "", 0, 0), (4, "", None, "", 0, 0), (5, "z", "b", "", 0, 0)]
    docs = spark.createDataFrame(rows, CLASH)
    plan = mixing.mixed(docs, least=1.0)
    wordless = {r["doc_id"]: (r["taken"], r["positions"]) for r in plan.collect() if r["source_size"] == 0}
    assert wordless == {1: (0, [0.0]), 2: (0, [0.0]), 4: (0, [0.0])}
    got = [r["doc_id"] for r in mixing.training_order(docs, plan).collect()]
    assert set(got) == {1, 2, 3, 4, 5} and [got.count(i) for i in (1, 2, 4)] == [1, 1, 1]
