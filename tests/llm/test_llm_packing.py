import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from opinara.llm import packing

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
CLASH = "doc_id long, text string, id string, file int, pieces string"


def test_best_fit_as_a_search_over_all_rows():
    rng = np.random.default_rng(0)
    for _ in range(200):
        row = int(rng.choice([1, 2, 7, 16, 100]))
        lengths = rng.integers(1, row + 1, rng.integers(1, 60))
        rows, starts, number = packing.best_fit(lengths, row)
        rooms: list[int] = []
        for length in sorted(lengths.tolist(), reverse=True):
            fit = [r for r in rooms if r >= length]
            if fit:
                rooms.remove(min(fit))
            rooms.append((min(fit) if fit else row) - length)
        assert number == len(rooms)
        used = np.zeros((number, row), int)
        for r, s, n in zip(rows, starts, lengths, strict=True):
            used[r, s : s + n] += 1
        assert used.max() == 1 and used.sum() == lengths.sum()


@pytest.mark.parametrize("group", [200, 1 << 20])
def test_round_trip(spark, tmp_path, group):
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    coder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [None, "", "one", "a few words " * 3, "long text, é " * 500, *(f"document {i} " * (i % 23) for i in range(80))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, "one"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], CLASH).repartition(3)
    folder = str(tmp_path / "out")
    packing.write_packed(docs, folder, RANKS, PATTERN, row_length=32, group_tokens=group, padding=9)
    found = packing.read_packed(spark, folder, row_length=32).collect()
    want = sorted([(i, coder.encode_ordinary(t or "")) for i, t in rows], key=str)
    assert sorted([(r["doc_id"], r["ids"]) for r in found], key=str) == want
    assert all(r["n_pieces"] == -(-r["n_tokens"] // 32) and r["n_tokens"] == len(r["ids"]) for r in found)
    for name in (tmp_path / "out").glob("*.ids.npy"):
        matrix = np.load(name)
        cumulative, resets = (np.load(str(name).replace(".ids.", f".{x}.")) for x in ("cu", "resets"))
        assert matrix.shape[1] == 32 and matrix.dtype == np.uint16
        at = packing.positions(resets, len(matrix), 32)
        assert (at[:, 0] == 0).all() and cumulative[0] == 0 and cumulative[-1] == matrix.size
        assert (np.flatnonzero(at.ravel() == 0) == cumulative[:-1]).all()


def test_no_rows(spark, tmp_path):
    docs = spark.createDataFrame([], CLASH)
    packing.write_packed(docs, str(tmp_path / "out"), RANKS, PATTERN)
    assert packing.read_packed(spark, str(tmp_path / "out")).collect() == []
