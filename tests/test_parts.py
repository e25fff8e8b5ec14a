"""Batches of long rows in parts, and text rank without tables of ranks."""

import pyarrow as pa
from pyspark.sql import functions as F

from opinara.functions import arrays
from opinara.functions import segment as G
from opinara.operators import keywords as K
from opinara.sources import csv_ranges


def test_parts_of_a_batch(monkeypatch):
    monkeypatch.setattr(arrays, "PART_BYTES", 100)
    texts = pa.array([None, "", "x" * 70, *["abc"] * 60])
    parts = list(arrays.few_at_a_time(texts))
    assert len(parts) > 3 and pa.concat_arrays(parts).equals(texts)
    batch = pa.RecordBatch.from_arrays([texts], ["t"])
    assert pa.Table.from_batches(arrays.few_at_a_time(batch)).equals(pa.Table.from_batches([batch]))
    assert [len(p) for p in arrays.few_at_a_time(pa.array([], pa.string()))] == [0]
    assert [len(p) for p in arrays.few_at_a_time(pa.array(["x" * 1000, "y" * 1000]))] == [1, 1]


def test_marks_of_lines_do_not_depend_on_the_parts(monkeypatch):
    """Parts of a few rows come out, whatever comes in, and the state of a range goes on from part to part."""
    lines = [b'a,"b', b"c", b'd"', b"", b"\xff"] * 40
    batch = pa.RecordBatch.from_arrays([pa.array(["f"] * 200), pa.array([0] * 200, pa.int64()), pa.array(lines, pa.binary())], ["file", "range", "value"])
    whole = pa.Table.from_batches(csv_ranges._marked(iter([batch])))
    monkeypatch.setattr(arrays, "PART_BYTES", 300)
    parts = list(csv_ranges._marked(iter([batch])))
    assert len(parts) > 4 and pa.Table.from_batches(parts).combine_chunks().equals(whole.combine_chunks())
    assert whole["line"].to_pylist() == list(range(200))


def test_long_lexicons_take_few_texts_at_a_time(spark):
    lexicon = {"和平": "n", "best": "a"}
    texts = ["和平x best", None, "", "bests 和平和平"] * 50 + ["和平 " * 200_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    both = [{r[0]: r[1] for r in rows.select("k", G.dictionary_tokens(F.col("t"), lexicon, (), in_jvm=jvm)).collect()} for jvm in (True, False)]
    assert both[0] == both[1] and len(both[1][200]) == 200_000
    plan = rows.select(G.segment(F.col("t"), lexicon, False))._jdf.queryExecution().toString()
    assert "ArrowEvalPython" in plan


def test_ranks_as_arrays_and_in_tables_are_equal(spark, monkeypatch):
    rows = [("a", "b", 3), ("a", "c", 1), ("b", "c", 2), ("d", "e", 1), ("c", "d", 5), ("a", "b", 1), ("b", "a", 2), *[("a", f"w{i}", 1 + i % 3) for i in range(300)]]
    pairs = spark.createDataFrame(rows, "one string, two string, weight long").repartition(5)
    passed = K.text_rank(pairs, tolerance=1e-11)
    words, count = K.numbered_words(pairs)
    assert count == 305 and sorted(r["word"] for r in words.collect()) == list(range(305))
    assert "Join" not in "".join(line for line in K.packed_edges(pairs, words)._jdf.queryExecution().toString())
    monkeypatch.setattr(K, "PASSED_WORDS", 10)
    tables = {r["word"]: r["rank"] for r in K.text_rank(pairs, tolerance=1e-11).collect()}
    found = {r["word"]: r["rank"] for r in passed.collect()}
    assert found.keys() == tables.keys() and all(abs(found[w] / tables[w] - 1) < 1e-9 for w in found)
