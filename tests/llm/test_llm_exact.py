import hashlib
import random

from opinara.llm import exact_dedup

CLASH = "doc_id long, text string, _sha string, keep_id int, kept string"


def brute(rows):
    groups = {}
    for i, text in rows:
        plain = "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
        groups.setdefault(plain, []).append((-len(text or ""), i is None, i))
    out = []
    for i, text in rows:
        plain = "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
        group = groups[plain]
        out.append((i, min(group)[2], len(group), hashlib.sha256(plain.encode()).hexdigest()))
    return sorted(out, key=str)


def found(frame):
    return sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in frame.collect()], key=str)


def test_against_brute_force_in_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "RUN_RECORDS", 4)  # three rounds for the rows below
    pick = random.Random(5)
    texts = [None, "", "  \t", "a b", "ab", "a\nb ", "äb c", "x" * 50_000, "x" * 49_999 + " x"]
    rows = [(i, pick.choice(texts)) for i in range(400)] + [(1000 + i, "hot text") for i in range(300)] + [(2000 + i, f"own {i}") for i in range(100)]
    assert exact_dedup.rounds_for(len(rows)) == 3
    docs = spark.createDataFrame([(i, t, "s", 1, "k") for i, t in rows], CLASH).repartition(7)
    result = exact_dedup.exact_duplicates(docs)
    assert found(result) == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in result.collect())


def test_ties_nulls_and_rows_that_repeat(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "ab"), (None, ""), (2, None), (3, "c"), (3, "d")]
    docs = spark.createDataFrame([(i, t, "s", 1, "k") for i, t in rows], CLASH)
    result = exact_dedup.exact_duplicates(docs).collect()
    kept = sorted((r["doc_id"], r["text_sha256"]) for r in result if r["kept"])
    assert [k[0] for k in kept] == [1, 2, 3, 3]
    left = exact_dedup.without_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == [(1, "a b"), (2, None), (3, "c"), (3, "d")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], CLASH)
    assert exact_dedup.exact_duplicates(docs).collect() == []
    assert exact_dedup.without_exact_copies(docs).collect() == []
