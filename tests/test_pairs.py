"""Neighbouring words counted and ranked as numbers, against plain counts and the forms for any number of words."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opinara.functions import pairs as B
from opinara.operators import keywords as K


def plain_pairs(texts, window):
    seen = Counter()
    for words in texts:
        for i, one in enumerate(words or []):
            for two in words[i + 1 : i + window]:
                if one is not None and two is not None and one != two:
                    seen[min(one, two), max(one, two)] += 1
    return seen


def test_pairs_of_long_short_and_null_texts(spark, monkeypatch):
    drawn = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)] + ["é", "z-z", ""]
    texts = [[words[i] for i in drawn.integers(0, len(words), n)] for n in (B.ROW_TOKENS * 2 + 3, B.ROW_TOKENS, B.ROW_TOKENS + 1, 7, 1, 0)]
    texts += [None, ["a", None, "b", "a"], [None], ["x", "x", "x"], texts[3]]
    rows = spark.createDataFrame([(t,) for t in texts], "tokens array<string>").repartition(3)
    for window in (2, 5):
        found = K.neighbour_pairs(rows, window)
        assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()  # no row for each pair
        assert {(r["one"], r["two"]): r["weight"] for r in found.collect()} == plain_pairs(texts, window)
    assert K.neighbour_pairs(rows.where("false")).count() == 0
    monkeypatch.setattr(K, "PASSED_WORDS", 10)
    assert {(r["one"], r["two"]): r["weight"] for r in K.neighbour_pairs(rows).collect()} == plain_pairs(texts, 5)


def test_counts_beyond_their_bits():
    packed = B.packed_counts(np.concatenate([np.full(2 * B.MOST + 5, 9, np.uint64), np.array([3, 3], np.uint64)]))
    keys, counts = packed >> np.uint64(B.COUNT_BITS), packed & np.uint64(B.MOST)
    assert keys.tolist() == [3, 9, 9, 9] and counts.tolist() == [2, B.MOST, B.MOST, 5]
    names = pa.array([f"n{i:02}" for i in range(16)])  # keys of four bits a word
    batch = pa.RecordBatch.from_arrays([pa.array([packed.tobytes()] * 2, pa.binary())], ["packed"])
    rows = pa.Table.from_batches(B.added(iter([batch]), names)).to_pylist()
    assert [(r["one"], r["two"], r["weight"]) for r in rows] == [("n00", "n03", 4), ("n00", "n09", 4 * B.MOST + 10)]


def test_blocks_of_many_words_and_any_weight():
    """Sources beyond two bytes, weights of every width, fractions, repeated rows and null words."""
    drawn = np.random.default_rng(6)
    names = pa.array([f"n{i}" for i in range(70_000)])
    one, two = drawn.integers(0, 70_000, 300_000), np.r_[drawn.integers(0, 50, 150_000), drawn.integers(0, 70_000, 150_000)]
    weight = np.r_[np.full(100_000, 1.0), drawn.integers(1, 70_000, 199_998), 0.5, 1e12]
    batch = pa.RecordBatch.from_arrays([names.take(pa.array(one)), names.take(pa.array(two)), pa.array(weight)], ["one", "two", "weight"])
    null = pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array(["n1"]), pa.array([1.0])], ["one", "two", "weight"])
    numbers = drawn.random(70_000)
    for parts in (1, 3):
        dealt = list(B.directed(B.split(iter([batch, null])), names, parts))
        rows = [row for part in range(parts) for b in dealt for row in [b.filter(pa.compute.equal(b["part"], part)).drop_columns("part")]]
        edges = list(B.laid_out(iter(rows)))
        assert {b["form"][0].as_py() for b in edges} == {"u2", "i4"} and {"u4", "f8"} <= {b["kind"][0].as_py() for b in edges}
        out = np.zeros(70_000)
        for b in B.summed(iter(edges), numbers):
            out[B.values_of(b["words"][0], "i4")] += B.values_of(b["sums"][0], "f8")
        plain = np.bincount(one, weight * numbers[two], 70_000) + np.bincount(two, weight * numbers[one], 70_000)
        assert np.allclose(out, plain, rtol=1e-12)


@pytest.fixture
def pairs(spark):
    drawn = np.random.default_rng(7)
    rows = {(f"w{min(a, b)}", f"w{max(a, b)}"): int(w) for a, b, w in zip(*(drawn.zipf(1.5, 4000) % 300 for _ in range(2)), drawn.integers(1, 9, 4000), strict=True) if a != b}
    rows |= {(f"l{i:02}", f"l{i + 1:02}"): 1 for i in range(30)}  # a line, which settles slowly
    return spark.createDataFrame([(a, b, w) for (a, b), w in rows.items()], "one string, two string, weight long").repartition(3).cache()


def test_ranks_settle_in_few_rounds(pairs, monkeypatch):
    rounds, given = [], K._given
    monkeypatch.setattr(K, "_given", lambda edges, ranks: rounds.append(1) or given(edges, ranks))
    ranks = K.text_rank(pairs, tolerance=1e-11)
    assert len(rounds) <= 45  # weights fixed by the damping took 52 on a text table
    assert K.largest_residual(K.neighbour_shares(pairs), ranks) < 1e-10


def test_shares_and_given_ranks_in_both_forms(pairs, monkeypatch):
    packed = K.packed_pairs(pairs)
    ranks, shares = K.text_rank(pairs, packed=packed), K.neighbour_shares(pairs, packed)
    given = K.given_ranks(shares, ranks)
    assert "Join" not in given._jdf.queryExecution().executedPlan().toString()
    rows, sums = ({(r["src"], r["word"]): r["share"] for r in shares.collect()}, {r["word"]: (r["neighbours"], r["given"]) for r in given.collect()})
    assert len(rows) == 2 * pairs.count() == sum(n for n, _ in sums.values())
    monkeypatch.setattr(K, "PASSED_WORDS", 10)
    assert K.packed_pairs(pairs).edges is None
    assert {(r["src"], r["word"]): r["share"] for r in K.neighbour_shares(pairs).collect()} == rows
    again = K.given_ranks(shares, ranks.where(F.lit(True)))
    assert {r["word"]: (r["neighbours"], pytest.approx(r["given"])) for r in again.collect()} == sums
