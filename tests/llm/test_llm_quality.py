import math
import random
import zlib
from collections import Counter

import numpy as np

from opinara.llm import quality

CLASH = "doc_id long, text string, quality int, label string, score string"


def corpus(number=300):
    pick = random.Random(3)
    word = lambda: "".join(pick.choices("abcdeinorst", k=pick.randint(2, 7)))
    rows, labels = [], {}
    for i in range(number):
        words = [word() for _ in range(pick.randint(5, 60))]
        bad = i % 4 == 0
        if bad:
            words = [w.upper() + "!!" for w in words] if i % 8 else [words[0]] * 40
        rows.append((i, " ".join(words)))
        labels[i] = int(not bad)
    return rows, labels


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, 1 - labels.get(i, 0), "x", "y") for i, t in rows], CLASH).repartition(3)
    return docs, spark.createDataFrame(list(labels.items()), "doc_id long, quality int")


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy_and_secrecy(spark):
    rows, labels = corpus()
    docs, known = frames(spark, rows, labels)
    found = {r["doc_id"]: r for r in quality.quality(docs, known).collect()}
    assert all(found[i]["held_out"] == is_held_out(i) for i in labels)
    held = [i for i in labels if is_held_out(i)]
    assert np.mean([found[i]["predicted"] == labels[i] for i in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found.values())
    turned = {i: 1 - q if is_held_out(i) else q for i, q in labels.items()}
    again = {r["doc_id"]: r["score"] for r in quality.quality(docs, frames(spark, rows, turned)[1]).collect()}
    assert again == {i: r["score"] for i, r in found.items()}


def test_rows(spark):
    rows, labels = corpus(80)
    rows += [(1000, None), (1001, ""), (None, "no id"), (1002, "word " * 300_000), (5, "twice"), (1003, " \n")]
    docs, known = frames(spark, rows, labels)
    known = known.union(spark.createDataFrame([(1, 7), (None, 1), (2, None), (3, 0), (3, 1)], "doc_id long, quality int"))
    found = quality.quality(docs, known).collect()
    assert len(found) == len(rows)
    empty = [r["score"] for r in found if r["doc_id"] in (1000, 1001)]
    assert empty[0] == empty[1]
    left = quality.good_documents(docs, known)
    assert left.columns == docs.columns
    good = sorted(str(r["doc_id"]) for r in found if r["predicted"])
    assert sorted(str(r["doc_id"]) for r in left.collect()) == good
    assert quality.quality(docs.limit(0), known).collect() == []
    assert {r["score"] for r in quality.quality(docs, known.limit(0)).collect()} == {0.5}


def test_features_in_blocks_are_those_of_words(monkeypatch):
    from opinara.llm import text_hashes

    data = np.frombuffer(("these are some words words words " * 20).encode(), np.uint8)
    whole = np.sort(np.concatenate(list(quality.features(data))))
    monkeypatch.setattr(text_hashes, "BLOCK_BYTES", 50)
    parts = np.sort(np.concatenate(list(quality.features(data))))
    # only character n-grams over a block's border may be missing
    assert len(whole) - len(parts) <= 5 * 14 and set(parts) <= set(whole)


MASK = (1 << 64) - 1


def plain_mixed(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def plain_features(text):
    """Buckets of a text, one feature at a time."""
    from opinara.llm import text_hashes

    factors = [int(f) for f in text_hashes.FACTORS]
    data = (text or "").encode()
    hashes = []
    for word in data.split():
        total = sum(int(text_hashes.BYTE_CODES[b]) * pow(int(text_hashes.STEP), k + 1, 1 << 64) for k, b in enumerate(word))
        hashes.append(plain_mixed((total + len(word) * factors[0]) & MASK))
    found = [plain_mixed(h) >> 48 for h in hashes]
    for a, b in zip(hashes, hashes[1:], strict=False):
        found.append(plain_mixed(factors[3] if a == b else (a * factors[1] + b * factors[2]) & MASK) >> 48)
    spaced = bytes(0x20 if b in b" \t\n\x0b\x0c\r" else b for b in data)
    for n in (3, 4):
        for i in range(len(spaced) - n + 1):
            code = int.from_bytes(n.to_bytes(8, "big") + spaced[i : i + n], "big") & MASK
            found.append((code * factors[4] & MASK) >> 48)
    return found


def plain_scores(train, texts):
    """Vectors, weights and scores in plain sums; the order and the start are those of the seed."""
    rng = np.random.default_rng(quality.SEED)
    start = rng.uniform(-1 / quality.DIM, 1 / quality.DIM, (quality.BUCKETS, quality.DIM))
    vectors = {}
    of = lambda b: vectors.setdefault(b, list(start[b]))
    weights, bias = [[0.0, 0.0] for _ in range(quality.DIM)], [0.0, 0.0]
    steps, step = quality.EPOCHS * len(train), 0

    def averaged(found):
        return [sum(of(b)[d] for b in found) / max(len(found), 1) for d in range(quality.DIM)]

    def softmax(mean):
        logits = [sum(m * w[c] for m, w in zip(mean, weights, strict=True)) + bias[c] for c in (0, 1)]
        powers = [math.exp(x - max(logits)) for x in logits]
        return [p / sum(powers) for p in powers]

    for _ in range(quality.EPOCHS):
        for i in rng.permutation(len(train)):
            found, label = train[i]
            rate = quality.RATE * (1 - step / steps)
            step += 1
            mean = averaged(found)
            gradient = softmax(mean)
            gradient[label] -= 1
            back = [w[0] * gradient[0] + w[1] * gradient[1] for w in weights]
            for b, n in Counter(found).items():
                for d in range(quality.DIM):
                    of(b)[d] -= rate * n / len(found) * back[d]
            for c in (0, 1):
                for d in range(quality.DIM):
                    weights[d][c] -= rate * mean[d] * gradient[c]
                bias[c] -= 0.1 * rate * gradient[c]
    return [softmax(averaged(plain_features(t)))[1] for t in texts]


def test_training_and_scores_as_plain_sums(spark):
    rows, labels = corpus(60)
    rows += [(100, "é  ünï çödé\tx x x x"), (101, ""), (102, None)]
    docs, known = frames(spark, rows, labels)
    train = [(plain_features(t), labels[i]) for i, t in rows if i in labels and not is_held_out(i)]
    found = {r["doc_id"]: r["score"] for r in quality.quality(docs, known).collect()}
    for (i, _), score in zip(rows, plain_scores(train, [t for _, t in rows]), strict=True):
        assert abs(found[i] - score) < 1e-4


def test_one_row_of_each_sampled_id(spark):
    rows, labels = corpus(40)
    docs, known = frames(spark, rows + [(1, "another text of an id")] * 50, labels)
    taken = quality.training_rows(docs, known)
    assert len(taken) == sum(not is_held_out(i) for i in labels)
    found, counts = quality.unpacked(quality.packed(np.array([5, 5, 0, quality.BUCKETS - 1])))
    assert (found.tolist(), counts.tolist()) == ([0, 5, quality.BUCKETS - 1], [1, 2, 1])
    assert len(quality.unpacked(quality.packed(np.empty(0, np.int64)))[0]) == 0
