import random

import pytest

from opinara.llm import minhash
from opinara.llm.components import components

SPACE = " \t\n\x0b\x0c\r"
CLASH = "doc_id long, text string, node string, bits int, bands string"


def shingle_set(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = low.translate({ord(c): " " for c in SPACE}).split(" ")
    words = [w for w in words if w]
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width, percent):
    sets = [shingle_set(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common) and sets[j]:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        k = find(i)
        least[k] = min(least.get(k, (2, 0)), (key is None, key or 0))
    name = lambda i: None if least[find(i)][0] else least[find(i)][1]
    return sorted([(key, len(sets[i]), name(i)) for i, (key, _) in enumerate(rows)], key=str)


def family(pick, base, number, most):
    out = []
    for _ in range(number):
        words = base.split()
        for _ in range(pick.randint(0, most)):
            words[pick.randrange(len(words))] = f"w{pick.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_against_brute_force(spark, monkeypatch, width, percent):
    monkeypatch.setattr(minhash, "BLOCK", 8)  # buckets are compared as pairs of blocks
    pick = random.Random(7)
    word = lambda: "".join(pick.choices("abcdefgh", k=5))
    text = lambda n: " ".join(word() for _ in range(n))
    texts = [None, "", " \n\t", "one", "One", "one two", "one\ntwo", "ONE two three", "é É", "é é"]
    texts += family(pick, text(150), 60, 8) + family(pick, text(90), 30, 3) + family(pick, text(60), 12, 1)
    texts += [text(pick.randint(1, 80)) for _ in range(40)] + ["same text " * 30] * 40
    chain = text(120).split()
    for i in range(12):
        texts.append(" ".join(chain))
        chain[i * 9 % 120] = f"link{i}"
    rows = list(enumerate(texts, 100))
    pick.shuffle(rows)
    rows += [(None, texts[-1]), (100, texts[20]), (5, texts[20])]
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], CLASH).repartition(5)
    found = minhash.near_duplicates(docs, width=width, percent=percent).collect()
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found], key=str) == brute(rows, width, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    left = minhash.without_near_copies(docs, width=width, percent=percent)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in found if r["kept"]}


def test_one_row_of_each_component_stays(spark):
    t, u, other = "one two three four five six seven eight nine ten eleven twelve", "a b c d e f", "v w x y z"
    near = t + " thirteen"
    rows = [(1, t), (None, t), (None, near), (None, u), (None, u), (7, other), (7, near), (7, u + " "), (8, None), (8, None), (9, " "), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = sorted(map(tuple, minhash.without_near_copies(docs).collect()), key=str)
    assert left == sorted([(1, t), (7, u + " "), (7, other), (8, None), (8, None), (9, " "), (None, "")], key=str)


def test_texts_that_share_a_passage(spark):
    """Buckets of many members, none of them similar enough; some in groups of their own."""
    pick = random.Random(5)
    word = lambda: f"w{pick.randrange(10**6)}"
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(400):
        own = [word() for _ in range(25)]
        rows.append((i, " ".join(passage + own)))
        if i % 40 == 0:
            rows.append((1000 + i, " ".join(passage + own[:-1])))
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: i % 1000 for i, _ in rows}


def test_long_text_in_blocks_equals_whole(monkeypatch):
    import numpy as np

    from opinara.llm import text_hashes

    data = np.frombuffer(("some words and äöü " * 400 + "x" * 3000 + " end").encode(), np.uint8)
    whole = text_hashes.word_hashes(data, text_hashes.LOWER)
    monkeypatch.setattr(text_hashes, "BLOCK_BYTES", 64)
    assert (text_hashes.word_hashes(data, text_hashes.LOWER) == whole).all()


def test_estimate_is_near_the_similarity(spark):
    import numpy as np

    pick = np.random.default_rng(0)
    pool = pick.integers(0, 1 << 64, 3000, dtype=np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[400:2400])
    low = minhash.minima([a, b])
    bits = minhash.packed_bits(low)
    assert abs(minhash.estimates(bits[:1], bits[1])[0] - 1600 / 2400) < 0.15


def test_empty_table(spark):
    docs = spark.createDataFrame([], CLASH)
    assert minhash.near_duplicates(docs).collect() == []
    assert minhash.without_near_copies(docs).collect() == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 130)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (500, 400), (400, 500)], "u long, v long")
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 400: 400, 500: 400}
    assert components(links.limit(0)).collect() == []
