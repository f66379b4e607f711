"""Operators on vectors against plain numpy over the same rows."""

import math

import numpy as np
import pytest

from kithscope.llm import queries
from kithscope.llm.op11_whitening import covariance, whiten
from kithscope.llm.op12_hard_negatives import mine_hard_negatives
from kithscope.llm.op13_embedding_duplicates import Side, encode, join_roots, linked_pairs, near_embeddings
from tests.conftest import MEDIUM

SCHEMA = "vec_id long, embedding array<float>, label int, row string, size int, node long, n long"
"""Extra columns whose names operators use themselves."""


def clean(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def odd_rows(d=6):
    """Random vectors with near copies, exact copies, repeated rows, ties and every unusable kind."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        v = rng.normal(size=d)
        rows.append([i, v, i % 3])
        if i % 10 == 0:
            rows.append([1000 + i, v + rng.normal(size=d) * 0.05, i % 3])
            rows.append([2000 + i, v, i % 3])
    hot = rng.normal(size=d)
    rows += [[3000 + i, hot + rng.normal(size=d) * 0.15, 1] for i in range(60)]
    rows += [[4000 + i, hot * (1 if i % 2 else 2), 2] for i in range(30)]
    out = [(i, [float(np.float32(c)) for c in v], k) for i, v, k in rows]
    out += [out[0], out[5], (100, out[7][1], 0), (None, out[3][1], 0), (5000, out[3][1], None)]
    out += [(5001, None, 1), (5002, [], 1), (5003, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (5004, [float("nan")] * d, 1), (5005, [float("inf")] + [0.0] * (d - 1), 1)]
    out += [(5006, [0.0] * d, 1), (5007, [0.0] * d, 1), (5008, [1.0, 2.0], 1), (5009, [1.0, 2.0], 1), (5100, [3.0, 1.0], 1), (5200, [float(np.float32(1e30))] + [0.0] * (d - 1), 1)]
    return [(i, v, k, "r", 1, 2, 3) for i, v, k in out]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3) if rows else spark.createDataFrame([], SCHEMA)


def given(spark):
    return [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]


# op11


def whiten_plain(rows, scale=64):
    """By numpy's own covariance of the distinct rows."""
    usable = [(i, [math.floor(max(min(scale * c, 2.0**53), -(2.0**53))) + 1_000_000 for c in v]) for i, v in rows if clean(v)]
    sizes = [len(x) for x in {tuple(x) for _, x in usable}]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s))
    usable = [(i, x) for i, x in usable if len(x) == d]
    fit = sorted({tuple(x) for _, x in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    deviation = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums))) for i, x in usable]
    return n, deviation, np.cov(np.array(fit, dtype=float).T, bias=True), np.array(fit, dtype=float), usable


def check_whitened(rows, got):
    n, deviation, cov, fit, usable = whiten_plain([(i, v) for i, v, *_ in rows])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    assert sorted((r.vec_id if r.vec_id is not None else -1, int(r.deviation)) for r in got) == sorted((i if i is not None else -1, v) for i, v in deviation)
    k = len(got[0].whitened)
    want = {tuple(x): (np.array(x) - fit.mean(axis=0)) @ axes[:, :k] / np.sqrt(values[:k]) for _, x in usable}
    by_id = {}
    for i, x in usable:
        by_id.setdefault(i, []).append(want[tuple(x)])
    signs = None
    for r in sorted(got, key=lambda r: -max(map(abs, r.whitened))):
        options = by_id[r.vec_id]
        if signs is None:
            signs = np.sign(np.array(options[0])) * np.sign(r.whitened)
        assert any(np.allclose(np.array(o) * signs, r.whitened, atol=1e-6) for o in options)
        assert np.allclose(r.explained, values[:k] / values.sum(), rtol=1e-6) and r.n == n and r.identity_error < 1e-4


def test_whitening_equals_numpy(spark):
    rows = given(spark)
    got = whiten(spark.read.parquet(f"{MEDIUM}/embeddings.parquet")).collect()
    assert len(got) == 500 and all(len(r.whitened) == 16 for r in got)
    check_whitened(rows, got)


def test_whitening_of_awkward_rows(spark):
    rows = [r for r in odd_rows() if r[0] != 5200]
    got = whiten(frame(spark, rows), carry=True).collect()
    check_whitened(rows, got)
    assert all(r.row.vec_id == r.vec_id and r.row.n == 3 for r in got)


def test_whitening_of_nothing_and_of_one_vector(spark):
    one = [(i, [1.0, 2.0], 0, "r", 1, 2, 3) for i in range(3)]
    for rows in ([], one, [(1, None, 0, "r", 1, 2, 3)]):
        df = whiten(frame(spark, rows))
        assert df.columns[-1] == "identity_error" and df.count() == 0


def test_flat_dimensions_have_no_component_and_huge_entries_do_not_fail(spark):
    flat = [(i, [float(i), 5.0, float(2 * i)], 0, "r", 1, 2, 3) for i in range(9)]
    assert {len(r.whitened) for r in whiten(frame(spark, flat)).collect()} == {1}
    assert whiten(frame(spark, odd_rows()), components=3).count() > 0


def test_covariances_follow_from_variances_exactly():
    x = [(3, 1), (5, 2), (4, 9), (8, 0)]
    n, sums = len(x), [20, 12]
    squares = [sum(a * a for a, _ in x), sum(b * b for _, b in x), sum((a + b) ** 2 for a, b in x)]
    assert np.allclose(covariance(n, sums, squares), np.cov(np.array(x, dtype=float).T, bias=True), atol=1e-15)


def test_whitening_query(spark):
    rows = queries.op11_whitening(spark, MEDIUM).collect()
    assert len(rows) == 500 * 16 and {r.component for r in rows} == set(range(1, 17)) and len({r.identity_error for r in rows}) == 1


# op12


def mine_plain(rows, is_anchor, n_positives=5, n_negatives=10, scale=256):
    use = sorted({(i, k, tuple(math.floor(max(min(scale * c, 2.0**53), -(2.0**53))) for c in v)) for i, v, k in rows if i is not None and k is not None and clean(v)})
    out = []
    for i, k, x in use:
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(x, y)), j, q) for j, q, y in use if len(y) == len(x)]
        for s, p, _ in sorted(r for r in scored if r[2] == k and r[1] != i)[:n_positives]:
            fit = sorted(r for r in scored if r[2] != k and 30 * -s <= 100 * -r[0] <= 90 * -s)[:n_negatives]
            out += [(i, p, rank + 1, r[1], -s, -r[0]) for rank, r in enumerate(fit)]
    return sorted(out)


NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mined(df):
    return sorted(tuple(r[n] for n in NAMES) for r in df.collect())


def test_hard_negatives_query_equals_brute_force(spark):
    rows = [(i, v, (k + 1) % 10 if i % 7 == 0 else k) for i, v, k in given(spark)]
    got = mined(queries.op12_hard_negatives(spark, MEDIUM))
    assert got == mine_plain(rows, lambda i: i % 100 == 0) and len(got) > 100


@pytest.mark.parametrize("chunk, block", [(2048, 1024), (17, 3)])
def test_hard_negatives_of_awkward_rows(spark, chunk, block):
    rows = odd_rows()
    got = mined(mine_hard_negatives(frame(spark, rows), lambda c: c % 20 == 0, n_positives=4, n_negatives=3, chunk_rows=chunk, block_rows=block))
    assert got == mine_plain([r[:3] for r in rows], lambda i: i % 20 == 0, 4, 3) and len(got) > 50


def test_hard_negatives_with_ties_and_without_anchors(spark):
    rows = [(i, [1.0, 0.0], 0, "r", 1, 2, 3) for i in range(8)] + [(60, [2.0**60, 2.0**60], 2, "r", 1, 2, 3), (61, [2.0**60, 0.0], 2, "r", 1, 2, 3)] + [(50 + i, [0.5, 0.5], 1, "r", 1, 2, 3) for i in range(30)]
    got = mined(mine_hard_negatives(frame(spark, rows), lambda c: c == 0))
    assert got == mine_plain([r[:3] for r in rows], lambda i: i == 0) and len(got) == 50
    # Scores of two huge vectors end at 64 bits.
    assert mine_hard_negatives(frame(spark, rows), lambda c: c == 60).count() == 0
    assert mined(mine_hard_negatives(frame(spark, rows), lambda c: c == 999)) == []
    assert mined(mine_hard_negatives(frame(spark, []), lambda c: c == 0)) == []


# op13


def near_plain(rows, threshold=0.93):
    def usable(i, v, k):
        return i is not None and k is not None and clean(v) and any(v)

    n = len(rows)
    links, parent = [0] * n, list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    units = [np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max()) if usable(i, v, k) else None for i, v, k in rows]
    for a in range(n):
        for b in range(a):
            if units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = {}
    for a in range(n):
        if units[a] is not None:
            least[find(a)] = min(least.get(find(a), rows[a][0]), rows[a][0])
    out = []
    for a, (i, _, _) in enumerate(rows):
        component = least[find(a)] if units[a] is not None else i
        out.append((i, links[a], component, i is not None and i == component))
    return sorted(out, key=repr)


def near(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block", [4096, 16])
def test_near_embeddings_equal_brute_force(spark, block):
    rows = odd_rows()
    got = near(near_embeddings(frame(spark, rows), block_rows=block))
    assert got == near_plain([r[:3] for r in rows])
    assert len({c for _, n, c, _ in got if n}) > 5


def test_near_embeddings_carry_rows_and_take_nothing(spark):
    got = near_embeddings(frame(spark, odd_rows()), carry=True).collect()
    assert len(got) == len(odd_rows()) and all(r.row.vec_id == r.vec_id and r.row.node == 2 for r in got)
    assert near_embeddings(frame(spark, [])).count() == 0


def test_near_embeddings_query(spark):
    assert near(queries.op13_embedding_duplicates(spark, MEDIUM)) == near_plain(given(spark))


def side(vectors, sure):
    import pyarrow as pa

    codes, factors = encode(vectors, 7)
    n, d = vectors.shape
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * d, pa.int32()), pa.array(vectors.ravel()))
    return Side(pa.table({"vector": lists, "code": [c.tobytes() for c in codes], "factor": factors, "copies": np.ones(n, dtype=np.int64)}), 7, 0.93, sure)


def test_estimates_are_unbiased_and_bounds_hold_at_the_threshold():
    """Twenty thousand pairs exactly at cosine 0.931: no link is lost, and few others need an exact product."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    e = rng.normal(size=x.shape)
    e -= (e * x).sum(axis=1, keepdims=True) * x
    y = 0.931 * x + math.sqrt(1 - 0.931**2) * e / np.linalg.norm(e, axis=1, keepdims=True)
    a, b = side(x, 6.0), side(y, 6.0)
    products = (a.turned * b.signs).sum(axis=1)
    _, factors = encode(y, 7)
    assert (products >= b.least).all()
    assert abs((products / (factors * 8)).mean() - 0.931) < 0.002
    others = a.turned[:2000] @ b.signs[2000:4000].T >= b.least[2000:4000]
    assert others.mean() < 0.01


def test_links_around_the_threshold_are_all_found_and_nothing_below():
    """A dense group whose cosines lie on both sides of the threshold, against all exact cosines."""
    rng = np.random.default_rng(12)
    base = rng.normal(size=64)
    x = base + rng.normal(size=(1500, 64)) * 0.27
    one = side(x, 6.0)
    got = np.concatenate([np.stack(p, axis=1) for p in linked_pairs(one, one, True, 0.93)])
    cosines = one.unit @ one.unit.T
    want = np.argwhere(np.triu(cosines >= 0.93, 1))
    assert 0.2 < len(want) / (1500 * 1499 / 2) < 0.8
    assert set(map(tuple, got)) == set(map(tuple, want))


def test_roots_of_a_path():
    order = np.random.default_rng(5).permutation(200)
    roots = join_roots(np.arange(201), order[:100], order[:100] + 1)
    roots = join_roots(roots, order[100:], order[100:] + 1)
    assert not roots.any()
