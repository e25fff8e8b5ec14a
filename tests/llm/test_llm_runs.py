"""Periodic runs against a search by every period, and their edge cases."""

import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opinara.llm import runs


def plain(words, exponent=4, length=6):
    """Runs by trying every period; of equal stretches the smallest period."""
    found = {}
    for period in range(1, len(words) // exponent + 1):
        start = 0
        while start + period < len(words):
            end = start
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            size = end - start + period
            if end > start and size >= max(length, exponent * period):
                found.setdefault((start, size), period)
            start = end + 1
    return sorted((s, n, p) for (s, n), p in found.items())


def shorter(words, rows):
    gone = {i for s, n, p in rows for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found(texts, **how):
    how = {"exponent": 4, "length": 6} | how
    numbers = runs.numbered([t.encode().split() for t in texts])
    rows = runs.runs_of(numbers, **how)
    ends = np.cumsum([0, *(len(t.split()) for t in texts)])
    return [[(int(s - a), int(n), int(p)) for s, n, p in rows if a <= s < b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab c d".split()), max_size=60), min_size=1, max_size=4))
def test_words_of_few_kinds(texts):
    texts = [" ".join(t) for t in texts]
    assert found(texts) == [plain(t.split()) for t in texts]
    assert found(texts, exponent=3, length=1) == [plain(t.split(), 3, 1) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=5), st.integers(1, 9)), max_size=12))
def test_repeated_pieces(pieces):
    text = " ".join(w for piece, times in pieces for w in piece * times)
    assert found([text]) == [plain(text.split())]
    assert found([text, text], exponent=3, length=9) == [plain(text.split(), 3, 9)] * 2


def test_a_run_that_ends_with_its_text_stays_apart_from_the_next():
    texts = ["x a a a", "a a a", "a a a a a a", "a b a b a b a b", "a b a b"]
    assert found(texts) == [[], [], [(0, 6, 1)], [(0, 8, 2)], []]


def test_rows_of_a_table(spark):
    texts = [None, "", " \t\n", "a", "b a a\ta  a a a b", "é é é é é é", "No no no no no no", "a b c a b c a b c a b c"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a a a a a a"), (4, "b a a\ta  a a a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS runs", "'x' AS id", "2 AS n_words")
    out = runs.periodic_runs(docs)
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out.collect()), key=str)
    words = [[w.decode() for w in (t or "").encode().split()] for _, t in rows]
    assert got == sorted(((i, len(w), plain(w), shorter(w, plain(w))) for (i, _), w in zip(rows, words, strict=True)), key=str)
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, exponent=2)


def test_very_long_texts_take_time_in_proportion():
    draw = random.Random(1)
    same = "a " * 300_000
    lines = " ".join(f"{draw.randrange(10**9)} all rights reserved by the owner of this" for _ in range(40_000))
    period = " ".join(f"w{i}" for i in range(1000)) + " "
    begun = time.time()
    assert found([same]) == [[(0, 300_000, 1)]]
    assert found([lines]) == [[]]
    assert found(["x " + period * 300]) == [[(1, 300_000, 1000)]]
    assert time.time() - begun < 60
