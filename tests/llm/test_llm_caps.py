import numpy as np
import pytest

from opinara.llm import caps

CLASH = "vec_id long, embedding array<double>, node string, key int, n_links string"


def brute(rows, cosine=0.95):
    usable = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {i: set() for i in range(len(rows))}
    for dim in {len(rows[i][1]) for i in usable}:
        own = [i for i in usable if len(rows[i][1]) == dim]
        unit = np.array([rows[i][1] for i in own], float)
        unit /= np.abs(unit).max(axis=1, keepdims=True)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        for a, b in np.argwhere(unit @ unit.T >= cosine):
            if a != b:
                links[own[a]].add(own[b])
    out = []
    for i, (key, _) in enumerate(rows):
        seen, front = {i}, [i]
        while front:
            front = [y for x in front for y in links[x] if y not in seen and not seen.add(y)]
        out.append((key, len(links[i]), min((rows[x][0] for x in seen if rows[x][0] is not None), default=None)))
    return sorted(out, key=str)


def clusters(rng, dim, number, size, spread):
    out = []
    for _ in range(number):
        centre = rng.normal(size=dim)
        out += [(centre + spread * rng.normal(size=dim)).tolist() for _ in range(size)]
    return out


@pytest.mark.parametrize("block", [1024, 16])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(caps, "BLOCK", block)
    rng = np.random.default_rng(2)
    vectors = clusters(rng, 24, 6, 25, 0.2) + clusters(rng, 24, 2, 40, 0.1) + rng.normal(size=(300, 24)).tolist()
    vectors += [vectors[0]] * 30 + [(3 * np.array(vectors[1])).tolist()] * 3 + clusters(rng, 5, 1, 10, 0.1)
    vectors += [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [1e300] * 24, [1e-300] * 24]
    rows = [(i if i % 50 else None, v) for i, v in enumerate(vectors, 1)] + [(7, vectors[20])]
    frame = spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], CLASH).repartition(5)
    found = caps.near_vectors(frame).collect()
    assert sorted([(r["vec_id"], r["n_links"], r["component_id"]) for r in found], key=str) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def test_recall_at_the_threshold():
    """Pairs of cosine 0.95 share a filter, also where the table is large."""
    rng = np.random.default_rng(4)
    for count in (10_000, 10_000_000):
        code = caps.code_for(count, 64)
        met = 0
        for _ in range(400):
            x = rng.normal(size=64)
            x /= np.linalg.norm(x)
            y = rng.normal(size=64)
            y -= x * (x @ y)
            y = 0.95 * x + np.sqrt(1 - 0.95**2) * y / np.linalg.norm(y)
            met += bool(np.intersect1d(caps.exceeded(x, code), caps.exceeded(y, code)).size)
        assert met >= 396


def test_decoding_finds_all_exceeded_directions():
    code = caps.Code(12, 3, 6, 0.3)
    turn, tables = caps.code_vectors(code)
    rng = np.random.default_rng(1)
    for _ in range(20):
        x = rng.normal(size=12)
        x /= np.linalg.norm(x)
        found = caps.exceeded(x, code)
        cuts = np.cumsum([0, *(t.shape[1] for t in tables)])
        scores = [t @ (turn @ x)[a:b] for t, a, b in zip(tables, cuts, cuts[1:], strict=False)]
        every = (scores[0][:, None, None] + scores[1][None, :, None] + scores[2][None, None, :]).ravel()
        above = np.flatnonzero(every >= code.height)
        if len(above) >= caps.LEAST_FILTERS:
            assert (found == above).all()
        else:
            assert set(found) == set(np.argsort(-every)[: caps.LEAST_FILTERS])


def test_floats_and_no_rows(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.01]), (3, [-1.0, 2.0])], "vec_id long, embedding array<float>")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in caps.near_vectors(frame).collect()}
    assert found == {1: (1, 1), 2: (1, 1), 3: (0, 3)}
    assert caps.near_vectors(frame.limit(0)).collect() == []
