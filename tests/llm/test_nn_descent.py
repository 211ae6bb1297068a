import numpy as np
import pytest

from ledgerline.llm import nn_descent as nn

from . import brute

SCHEMA = "vec_id long, embedding array<float>, label int, node string, size string"


def rows(seed=1):
    r = np.random.default_rng(seed)
    near = lambda c, n, e: [(c + e * r.standard_normal(24)).tolist() for _ in range(n)]
    out = [(v, int(r.integers(3))) for v in r.standard_normal((500, 24)).tolist()]
    for n in (2, 3, 40, 90):
        out += [(v, 1) for v in near(r.standard_normal(24), n, 0.08)]
    chain = r.standard_normal(24)
    for _ in range(12):
        out.append((chain.tolist(), 2))
        chain = chain + 0.3 * r.standard_normal(24)
    out += [out[3], out[3], (out[3][0], None), (None, 1), ([0.0] * 24, 1), ([float("nan")] * 24, 1), ([float("inf")] * 24, 1), ([None] + [1.0] * 23, 1), ([], 1), ([1.0] * 5, 1), ([2.0] * 5, 1), ([-0.0] + [1.0] * 4, 1), ([0.0] + [1.0] * 4, 1)]
    order = r.permutation(len(out))
    return [(int(i) * 2, *out[k], "x", "y") for i, k in enumerate(order)]


def plain(data, threshold=0.93):
    ok = [k for k, r in enumerate(data) if r[1] and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    x = {k: np.array(data[k][1], np.float32).astype(np.float64) for k in ok}
    pairs = [(a, b) for i, a in enumerate(ok) for b in ok[i + 1 :] if data[a][2] == data[b][2] and len(x[a]) == len(x[b]) and x[a] @ x[b] / np.sqrt((x[a] @ x[a]) * (x[b] @ x[b])) >= threshold]
    root, n = brute.roots(len(data), pairs), np.zeros(len(data), int)
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    least = {g: min(data[k][0] for k in range(len(data)) if root[k] == g) for g in set(root)}
    return sorted((r[0], int(n[k]), least[root[k]], r[0] == least[root[k]]) for k, r in enumerate(data))


@pytest.mark.parametrize("block", [1024, 7])
def test_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(nn.link_counts, "__defaults__", (block,))
    data = rows()
    out = nn.near_duplicates(spark.createDataFrame(data, SCHEMA).repartition(3))
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in out.collect())
    want = plain(data)
    assert got == want


def test_audit_sees_missing_links(spark):
    frame = spark.createDataFrame(rows(), SCHEMA)
    vectors, _, kind = nn.nodes(frame)
    empty = spark.createDataFrame([], "node long, n long")
    assert nn.measured_recall(vectors, empty, kind, 0.93) == 0.0


def test_null_ids_and_empty(spark):
    same = [1.0, 2.0, 3.0]
    frame = spark.createDataFrame([(None, same, 1, "", ""), (5, same, 1, "", ""), (5, same, 1, "", ""), (None, None, 1, "", "")], SCHEMA)
    out = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in nn.near_duplicates(frame).collect()), key=str)
    assert out == [(5, 2, 5, True), (5, 2, 5, True), (None, 0, None, True), (None, 2, 5, True)]
    assert nn.near_duplicates(frame.limit(0)).count() == 0


def test_tight_group_beyond_one_cell(spark):
    """A group of 1000 distinct, nearly equal vectors is one component by the first cells alone."""
    r = np.random.default_rng(5)
    centre = r.standard_normal(64)
    made = [*r.standard_normal((1000, 64)), *(centre + 1e-4 * r.standard_normal((1000, 64)))]
    frame = spark.createDataFrame([(i, v.tolist(), 1, "", "") for i, v in enumerate(made)], SCHEMA)
    vectors, _, kind = nn.nodes(frame)
    found = nn.cells(vectors, range(nn.TABLES), nn.NEIGHBOURS, kind, 0.93).where("s >= 0.93").select("a", "b").collect()
    least = {r.node: r.least for r in vectors.select("node", "least").collect()}
    root = brute.roots(2000, [(least[x.a], least[x.b]) for x in found])
    assert len({root[k] for k in range(1000, 2000)}) == 1


def test_audit_meets_rare_links(spark):
    """Two linked nodes of 1500, the last in the order of the sample, are not taken for full recall."""
    order = [r.node for r in spark.range(1500).withColumnRenamed("id", "node").orderBy(nn.F.xxhash64("node")).collect()]
    made = np.random.default_rng(3).standard_normal((1500, 64)).astype("<f4")
    made[order[-1]] = made[order[-2]] * 1.5
    rows = [(k, 1, 1, k, bytearray(v.tobytes())) for k, v in enumerate(made)]
    vectors = spark.createDataFrame(rows, "node long, space long, size long, least long, vector binary")
    empty = spark.createDataFrame([], "node long, n long")
    assert nn.measured_recall(vectors, empty, "<f4", 0.93) == 0.0


def test_low_recall_raises(spark, monkeypatch):
    monkeypatch.setattr(nn, "RETRIES", 0)
    monkeypatch.setattr(nn, "audit", lambda *a: (0.5, True), raising=False)
    monkeypatch.setattr(nn, "measured_recall", lambda *a: 0.5)
    frame = spark.createDataFrame([(k, [1.0, k / 10], 1, "", "") for k in range(4)], SCHEMA)
    with pytest.raises(RuntimeError, match="recall 0.5"):
        nn.near_duplicates(frame)


def test_sets_of_cells_grow_with_their_hyperplanes():
    assert nn.tables_for(0, 0.93) == 1 and nn.tables_for(15, 0.93) >= 24
