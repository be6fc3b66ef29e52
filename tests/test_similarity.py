import numpy as np
import pytest

from colsieve.functions import normal
from colsieve.functions.hashing import projections, rng, seeds
from colsieve.operators import gram, graph, profile, similarity, vif


@pytest.fixture(scope="module")
def planted(spark):
    """Chain a-b-c (a,c below the threshold), a mirrored copy, an affine copy, a sum, a square."""
    g = np.random.default_rng(11)
    n = 4000
    a = g.normal(size=n)
    b = a + 0.24 * g.normal(size=n)
    c = b + 0.24 * g.normal(size=n)
    x, y = g.normal(size=n), g.normal(size=n)
    data = {"a": a, "b": b, "c": c, "neg": -x, "x": x, "aff": 3 * x + 2, "y": y, "sum": x + y + 0.01 * g.normal(size=n), "sq": y * y}
    names = list(data)
    rows = [tuple(float(data[k][i]) for k in names) for i in range(n)]
    return spark.createDataFrame(rows, names).repartition(5), names, data


def as_matrix(pairs, p):
    out = np.zeros((p, p))
    for r in pairs.collect():
        out[r["i"], r["j"]] = r["s"]
    return out


def test_phi_inv_against_the_standard_library():
    from statistics import NormalDist

    u = np.array([1e-12, 1e-6, 0.02, 0.074, 0.5, 0.8, 0.93, 1 - 1e-9])
    assert normal.phi_inv(u) == pytest.approx([NormalDist().inv_cdf(v) for v in u], rel=1e-13)


def test_scores_of_missing_and_outer_values():
    knots = np.array([0.0, 1.0, 1.0, 2.0])
    z = normal.normal_scores(np.array([np.nan, -5.0, 9.0, 1.0]), knots)
    assert z[0] == 0.0
    assert z[1] == pytest.approx(normal.phi_inv(np.array([1e-12]))[0])
    assert z[2] == pytest.approx(-z[1], rel=1e-4)
    assert z[3] == pytest.approx(normal.phi_inv(np.array([2 / 3]))[0])  # last of equal knots


def test_normal_scores_correlation_does_not_depend_on_partitions(planted):
    df, names, _ = planted
    knots = similarity.collect_cdfs(profile.cdf_tables(df, names, 200), names)
    one = as_matrix(similarity.normal_scores_correlation(df.coalesce(1), names, knots), len(names))
    many = as_matrix(similarity.normal_scores_correlation(df.repartition(16), names, knots), len(names))
    assert one == pytest.approx(many, abs=1e-12)
    assert np.allclose(one, one.T) and np.allclose(np.diag(one), 1)
    i = {n: k for k, n in enumerate(names)}
    assert one[i["x"], i["aff"]] == pytest.approx(1.0, abs=1e-9)
    assert one[i["x"], i["neg"]] == pytest.approx(-1.0, abs=1e-6)
    assert abs(one[i["y"], i["sq"]]) < 0.1  # even dependence stays unseen


def test_matrix_panels_give_the_same_result(planted, monkeypatch):
    df, names, data = planted
    whole = as_matrix(similarity.correlation_pairs(gram.cross_products(df, names)), len(names))
    monkeypatch.setattr(gram, "STATE_BYTES", 8 * (len(names) + 1) * 3)
    assert len(gram.panels(len(names) + 1)) == 4
    parts = as_matrix(similarity.correlation_pairs(gram.cross_products(df, names)), len(names))
    assert parts == pytest.approx(whole, abs=1e-12)
    assert whole == pytest.approx(np.corrcoef([data[n] for n in names]), abs=1e-9)


def test_pairwise_pearson_with_gaps(spark):
    g = np.random.default_rng(5)
    x = g.normal(size=(500, 3)) + 1000.0
    x[:, 2] += x[:, 0]
    x[g.random((500, 3)) < 0.3] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = as_matrix(similarity.pearson_pairwise(df, ["a", "b", "c"]), 3)
    for i in range(3):
        for j in range(3):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert got[i, j] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


def test_sine_dependence_blocks_over_several_scans(planted, monkeypatch):
    df, _, data = planted
    names = ["a", "x", "sum"]
    w = projections(42, "hsic", 3, 3, 4)
    got = {(r["block"], r["i"], r["j"]): r["s"] for r in similarity.sine_dependence(df, names, None, w).collect()}
    monkeypatch.setattr(similarity, "STATE_BYTES", 8 * 9)  # one block per scan
    again = {(r["block"], r["i"], r["j"]): r["s"] for r in similarity.sine_dependence(df, names, None, w).collect()}
    assert got == pytest.approx(again, abs=1e-12)
    z = np.sin(np.array([data[n] for n in names])[:, :, None] * w[1][:, None, :])
    z = (z - z.mean(axis=1, keepdims=True)) / z.std(axis=1, ddof=1, keepdims=True)
    flat = z.reshape(3, -1)
    want = flat @ flat.T / flat.shape[1]
    assert got[1, 0, 2] == pytest.approx(want[0, 2], abs=1e-10)


def test_lower_median_takes_the_fourth_of_eight(spark):
    df = spark.createDataFrame([(b, 0, 1, float(b)) for b in range(1, 9)], "block int, i int, j int, s double")
    assert similarity.lower_median(df).first()["s"] == 4.0


def test_transitive_component_and_sign(planted, spark):
    df, names, _ = planted
    pairs = similarity.pearson_pairwise(df, names)
    i = {n: k for k, n in enumerate(names)}
    s = as_matrix(pairs, len(names))
    assert abs(s[i["a"], i["c"]]) < 0.96 <= abs(s[i["a"], i["b"]])
    nodes = spark.createDataFrame([(k,) for k in range(len(names))], "i int")
    found = {r["i"]: r["component"] for r in graph.components(nodes, graph.threshold_edges(pairs, 0.96)).collect()}
    assert found[i["a"]] == found[i["b"]] == found[i["c"]] == i["a"]
    assert found[i["x"]] == found[i["neg"]] == found[i["aff"]] == i["neg"]
    assert found[i["sq"]] == i["sq"]


@pytest.mark.parametrize("shape", ["path", "random", "hub", "none"])
def test_components_against_union_find(spark, shape):
    g = np.random.default_rng(2)
    n = 300
    if shape == "path":
        order = g.permutation(n)
        edges = list(zip(order[:-1], order[1:]))
    elif shape == "random":
        edges = [tuple(g.integers(0, n, 2)) for _ in range(170)]
    elif shape == "hub":
        edges = [(150, k) for k in range(0, 280, 2)]
    else:
        edges = []
    parent = list(range(n))

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    want = {v: find(v) for v in range(n)}
    frame = spark.createDataFrame([(int(a), int(b)) for a, b in edges], "i int, j int")
    nodes = spark.createDataFrame([(v,) for v in range(n)], "i int")
    got = {r["i"]: r["component"] for r in graph.components(nodes, frame).collect()}
    assert got == want


def test_election_prefers_the_lower_position_on_ties(spark):
    profiled = spark.createDataFrame(
        [(0, "p", 0.0, 2.0), (1, "q", 0.0, 2.0), (2, "r", 0.5, 4.0)],
        "pos int, col string, missing_ratio double, variance double",
    )
    labels = spark.createDataFrame([(0, 0), (1, 0), (2, 2)], "i int, component int")
    rows = {r["col"]: r for r in graph.elect_by_quality(profiled, labels).collect()}
    assert rows["p"]["is_representative"] and not rows["q"]["is_representative"]
    assert rows["r"]["is_representative"]


def test_vif_identity_and_exact_collinearity(planted):
    _, names, data = planted
    x = np.array([data[n] for n in ("a", "b", "y", "sum", "x")])
    corr = np.corrcoef(x)
    for j, got in enumerate(vif.direct_vif(corr)):
        other = np.delete(x, j, axis=0)
        design = np.column_stack([np.ones(x.shape[1]), other.T])
        res = x[j] - design @ np.linalg.lstsq(design, x[j], rcond=None)[0]
        assert got == pytest.approx(x[j].var() / res.var(), rel=1e-6)
    solved = vif.vif_from_correlation(corr)
    for j in range(len(corr)):
        rest = np.delete(np.arange(len(corr)), j)
        r = corr[j, rest]
        r2 = r @ np.linalg.solve(corr[np.ix_(rest, rest)] + vif.RIDGE * np.eye(len(rest)), r)
        assert solved[j] == pytest.approx(1 / (1 - min(max(r2, 0), vif.R2_CAP)), rel=1e-6)
    exact = np.corrcoef([data["x"], data["y"], data["x"] + data["y"], data["a"]])
    assert np.isinf(vif.direct_vif(exact)[:3]).all() and np.isfinite(vif.direct_vif(exact)[3])


def test_linear_sum_loses_one_column_and_the_heir_inherits(planted):
    _, _, data = planted
    names = ["x", "y", "sum", "a"]
    corr = np.corrcoef([data[n] for n in names])
    kept, removed = vif.eliminate_by_correlation(corr, names, 10.0, {"sum": ["old"], "x": ["ox"], "y": ["oy"]})
    assert len(removed) == 1 and len(kept) == 3
    gone = removed[0]
    assert gone.survivor in kept and gone.survivor_r2_drop > 0
    assert gone.earlier_members and gone.column in gone.members


def test_direct_elimination_follows_complete_rows(spark):
    """Cross products stay exact while columns with gaps are dropped."""
    g = np.random.default_rng(9)
    n = 600
    x = g.normal(size=(n, 4))
    x[:, 3] = x[:, 0] + 0.05 * g.normal(size=n)
    x[g.random(n) < 0.3, 3] = np.nan
    x[g.random(n) < 0.2, 1] = np.nan
    names = ["p", "q", "r", "s"]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ",".join(f"{c} double" for c in names))
    missing = {c: int(np.isnan(x[:, k]).sum()) for k, c in enumerate(names)}
    rows = vif.CompleteRows(df, names, missing, np.zeros(4), np.ones(4))
    assert rows.count == int((~np.isnan(x).any(axis=1)).sum())
    rows.drop("s")
    left = x[:, :3]
    whole = left[~np.isnan(left).any(axis=1)]
    assert rows.count == len(whole)
    assert rows.correlation() == pytest.approx(np.corrcoef(whole.T), abs=1e-9)
    corr = np.corrcoef(x[~np.isnan(x).any(axis=1)].T)
    fresh = vif.CompleteRows(df, names, missing, np.zeros(4), np.ones(4))
    kept, removed = vif.eliminate_directly(fresh, corr)
    assert len(removed) == 1 and {removed[0].column, removed[0].survivor} == {"p", "s"}
    assert len(kept) == 3


def test_random_tracks_are_stateless():
    assert rng(42, "hsic", 3).random() == rng(42, "hsic", 3).random()
    assert rng(42, "hsic", 3).random() != rng(42, "rdc", 3).random()
    assert seeds(1, "spearman", 3) == seeds(1, "spearman", 3)
    with pytest.raises(ValueError):
        rng(1, "other", 0)


def test_shared_scans_give_both_dependences(planted):
    df, _, _ = planted
    names = ["a", "x", "sum"]
    knots = similarity.collect_cdfs(profile.cdf_tables(df, names, 100), names)
    h, r = similarity.both_dependences(df, names, knots, 42, 4, 6, 3, 2)
    assert as_matrix(h, 3) == pytest.approx(as_matrix(similarity.hsic_like(df, names, knots, 42, 6, 4), 3), abs=1e-12)
    assert as_matrix(r, 3) == pytest.approx(as_matrix(similarity.rdc_like(df, names, knots, 42, 3, 4, 2), 3), abs=1e-12)


def test_features_from_basis_functions_equal_features_from_rows(spark, monkeypatch):
    """One scan of polynomials gives the sums that two scans over the sines give."""
    g = np.random.default_rng(8)
    a = g.normal(size=3000)
    x = np.column_stack([a, a + g.normal(size=3000) * 0.3, np.where(g.random(3000) < 0.3, np.nan, a * a), g.integers(0, 4, 3000), np.full(3000, 2.5)])
    names = [f"c{k}" for k in range(5)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{c} double" for c in names))
    knots = similarity.collect_cdfs(profile.cdf_tables(df, names, 100), names)
    weights = [3 * g.normal(size=(5, 7)), g.normal(size=(5, 4)), np.full((5, 1), 1e-3)]
    assert np.abs(similarity.sine_coefficients(weights[0]) @ similarity._basis(np.linspace(-7, 7, 201)[:, None], similarity.sine_coefficients(weights[0]).shape[2])[1:]
                  - np.sin(weights[0][:, :, None] * np.linspace(-7, 7, 201))).max() < 1e-13
    got = {}
    for room in (similarity.BASIS_BYTES, 0):
        monkeypatch.setattr(similarity, "BASIS_BYTES", room)
        found = similarity.sine_dependence(df, names, knots, weights)
        got[room] = {(r["block"], r["i"], r["j"]): r["s"] for r in found.collect()}
    fast, slow = got.values()
    assert fast.keys() == slow.keys() and len(fast) == 75
    constant = [k for k in fast if 4 in k[1:]]
    assert max(abs(fast[k] - slow[k]) for k in fast.keys() - set(constant)) < 1e-10
    assert all(abs(fast[k]) < 1e-6 for k in constant)
