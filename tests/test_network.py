"""Networks against brute force, with hot copies and many blocks."""

import math
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellsurvey.operators import network


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 6))
    x[20:40] = x[20]  # a third of the cells are copies of one
    return x


@pytest.fixture(scope="module")
def vectors(spark, points):
    return spark.createDataFrame([("P", i, [float(v) for v in p]) for i, p in enumerate(points)], "proj_id string, cell_id long, features array<double>")


def brute(points):
    return np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))


@pytest.mark.parametrize("block", [7, 2048])
def test_nearest_neighbours(vectors, points, block):
    d = brute(points)
    got = network.nearest_neighbours(vectors, k=5, block=block).toPandas()
    assert len(got) == 60 * 5
    for i in range(60):
        order = sorted((d[i, j], j) for j in range(60) if j != i)[:5]
        mine = got[got.cell_id == i].sort_values("rank")
        assert mine["neighbour"].tolist() == [j for _, j in order]
        assert np.allclose(mine["distance"], [x for x, _ in order])


def test_fewer_cells_than_k(spark):
    v = spark.createDataFrame([("P", i, [float(i)]) for i in range(3)], "proj_id string, cell_id long, features array<double>")
    assert network.nearest_neighbours(v, k=15).count() == 6


def voting(w, marks):
    """Dense neighbour voting by the definition."""
    n, terms = marks.shape
    x, y = np.nonzero(marks)
    fold = np.full(marks.shape, -1)
    fold[x, y] = np.arange(len(x)) % 3
    degree = w.sum(0)
    out = []
    for t in range(terms):
        aucs, zs = [], []
        for f in range(3):
            train = (marks[:, t] == 1) & (fold[:, t] != f)
            score = np.round((w[train].sum(0)) / degree, 10)
            cand = (marks[:, t] == 0) | (fold[:, t] == f)
            r = pd.Series(score[cand]).rank().to_numpy()
            pos = marks[cand, t] == 1
            p, q = pos.sum(), (~pos).sum()
            auc = (r[pos].sum() / p - (p + 1) / 2) / q
            aucs.append(auc)
            zs.append(abs(auc * p * q - p * q / 2) / np.sqrt(p * q * (p + q + 1) / 12))
        dr = pd.Series(np.round(degree, 10)).rank().to_numpy()
        m = marks[:, t] == 1
        null = (dr[m].sum() / m.sum() - (m.sum() + 1) / 2) / (n - m.sum())
        z = sum(zs) / math.sqrt(3)
        out.append((np.mean(aucs), degree[m].mean(), null, 0.5 * math.erfc(z / math.sqrt(2))))
    return np.array(out)


@pytest.fixture(scope="module")
def marks():
    rng = np.random.default_rng(6)
    m = (rng.random((60, 3)) < 0.4).astype(int)
    m[:30, 0], m[30:, 0] = 1, 0
    return m


@pytest.mark.parametrize("block", [9, 2048])
def test_dense_voting(spark, vectors, points, marks, block):
    d = brute(points)
    members = spark.createDataFrame([("P", int(i), f"t{j}") for i, j in zip(*np.nonzero(marks))], "proj_id string, node long, term string")
    got = network.neighbour_voting_dense(vectors, members, block=block).toPandas().sort_values("term")
    want = voting(1 - d / d.max(), marks)
    assert np.allclose(got[["auc", "avg_node_degree", "degree_null_auc", "p_value"]].to_numpy(dtype=float), want, atol=1e-8)


def test_distances_hold_two_arrays_of_all_pairs():
    a, b = np.random.default_rng(1).normal(size=(2, 600, 4))
    tracemalloc.start()
    got = network._distances(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.5 * got.nbytes and np.allclose(got, np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1)))


def test_dense_voting_does_not_depend_on_the_rows_at_once(spark, vectors, marks):
    members = spark.createDataFrame([("P", int(i), f"t{j}") for i, j in zip(*np.nonzero(marks))], "proj_id string, node long, term string")
    one, all_ = (network.neighbour_voting_dense(vectors, members, rows_at_once=r).toPandas().sort_values("term", ignore_index=True) for r in (7, 1000))
    pd.testing.assert_frame_equal(one, all_)


def test_sparse_voting(spark, vectors, points, marks):
    edges = network.symmetric_edges(network.nearest_neighbours(vectors, k=4))
    w = np.zeros((60, 60))
    for r in edges.collect():
        w[r.src, r.dst] = r.w
    assert np.allclose(w, w.T)
    np.fill_diagonal(w, 1.0)
    members = spark.createDataFrame([("P", int(i), f"t{j}") for i, j in zip(*np.nonzero(marks))], "proj_id string, node long, term string")
    nodes = vectors.select("proj_id", F.col("cell_id").alias("node"))
    got = network.neighbour_voting(edges, nodes, members).toPandas().sort_values("term")
    assert np.allclose(got[["auc", "avg_node_degree", "degree_null_auc", "p_value"]].to_numpy(dtype=float), voting(w, marks), atol=1e-8)


@pytest.mark.parametrize("block", [5, 512])
def test_correlation_extremes(spark, block):
    rng = np.random.default_rng(8)
    x = rng.poisson(0.5, (23, 40))
    x[3] = 1  # no variance
    x[5] = x[6]
    c, g = np.nonzero(x)
    counts = spark.createDataFrame(pd.DataFrame({"proj_id": "P", "cell_id": c, "gene_id": g, "n": x[c, g]}))
    genes = spark.createDataFrame(pd.DataFrame({"proj_id": "P", "gene_id": np.arange(40)}))
    got = network.correlation_extremes(counts, genes, block=block).toPandas().sort_values("cell_id").reset_index(drop=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        r = np.corrcoef(x)
    np.fill_diagonal(r, np.nan)
    ok = [i for i in range(23) if i != 3]
    assert np.allclose(got["min_corr"][ok], np.nanmin(r[ok], axis=1)) and np.allclose(got["max_corr"][ok], np.nanmax(r[ok], axis=1))
    assert got["min_corr"].isna()[3] and got["max_corr"].isna()[3]


def test_products_follow_common_genes(monkeypatch):
    """Long gene lists are not laid out densely: the largest array is a slab of popular genes, the product or a run of partners."""
    rng = np.random.default_rng(3)
    n, m, genes = 30, 20, 200_000
    side = lambda cells: (np.r_[rng.integers(0, genes, 40_000), np.tile(np.arange(3), cells)], np.r_[rng.integers(0, cells, 40_000), np.repeat(np.arange(cells), 3)])
    (ga, pa), (gb, pb) = side(n), side(m)
    xa, xb = rng.integers(1, 9, len(ga)).astype(float), rng.integers(1, 9, len(gb)).astype(float)
    a, b = np.zeros((n, genes)), np.zeros((m, genes))
    a[pa, ga], b[pb, gb] = xa, xb  # of an entry named twice the last one counts
    sizes = []
    real = np.zeros

    def zeros(shape, *args, **kw):
        sizes.append(int(np.prod(shape)))
        return real(shape, *args, **kw)

    monkeypatch.setattr(network.np, "zeros", zeros)
    got = [network._products((ga, pa, xa, n), (gb, pb, xb, m), most=most, width=2) for most in (1, 7, 1 << 21)]
    assert max(sizes) <= n * m
    assert all(np.array_equal(g, a @ b.T) for g in got)
    none = np.array([], dtype=int)
    assert not network._products((none, none, none.astype(float), 0), (gb, pb, xb, m)).size


def test_components(spark):
    rng = np.random.default_rng(9)
    x = rng.poisson(1.0, (50, 30)).astype(float) @ np.diag(np.linspace(3, 0.2, 30))
    y = rng.normal(size=(20, 12))
    rows = []
    for p, m in (("P", x), ("Q", y)):
        c, g = np.nonzero(m)
        rows += [(p, int(i), int(j), float(m[i, j])) for i, j in zip(c, g)]
    values = spark.createDataFrame(rows, "proj_id string, cell_id long, gene_id long, x double")
    scores, singular = network.components_with_basis(values, k=4)
    got = scores.toPandas()
    for p, m in (("P", x), ("Q", y)):
        u, s, _ = np.linalg.svd(m, full_matrices=False)
        mine = np.stack(got[got.proj_id == p].sort_values("cell_id")["pc"].to_numpy())
        assert np.allclose(np.abs(mine), np.abs(u[:, :4] * s[:4]), atol=1e-6)
        sv = singular.filter(F.col("proj_id") == p).select("s").first()[0]
        assert np.allclose(sv, s[:4], rtol=1e-9)


def test_registered_components_against_numpy(spark):
    """All singular values and scores of the query's own input."""
    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.001"
    got = entry.queries()["pca_svd"](spark, folder).toPandas()
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    for p in range(3):
        own = vectors[vectors.label % 3 == p].sort_values("vec_id")
        m = np.stack(own["embedding"].to_numpy()).astype(float)
        u, s, vt = np.linalg.svd(m, full_matrices=False)
        mine = got[got.proj_id == f"P{p}"].sort_values("cell_id")[[f"pc{j + 1}" for j in range(10)]].to_numpy()
        assert np.allclose(np.linalg.norm(mine, axis=0), s[:10], rtol=1e-6)
        signs = np.where(vt[:10].sum(axis=1) < 0, -1, 1)
        assert np.allclose(mine, u[:, :10] * s[:10] * signs, atol=1e-4)


def test_components_that_do_not_converge(spark):
    rng = np.random.default_rng(1)
    rows = [("P", i, j, float(rng.normal())) for i in range(40) for j in range(40)]
    with pytest.raises(ValueError):
        network.components(spark.createDataFrame(rows, "proj_id string, cell_id long, gene_id long, x double"), k=2, most_rounds=2)


def test_rank_standardise_edges(spark):
    df = spark.createDataFrame([("P", 1, 3.0), ("P", 2, 1.0), ("P", 3, 1.0), ("P", 4, None), ("P", 5, float("nan")), ("P", 6, float("inf"))], "proj_id string, e int, w double")
    got = {r.e: r.standardised for r in network.rank_standardise(df).collect()}
    assert got == {1: 1.0, 2: 0.25, 3: 0.25, 4: 0.5, 5: 0.5, 6: 0.5}


def test_term_limits_are_exclusive(spark):
    cells = spark.createDataFrame([("P", i, "a" if i < 5 else "b", "x") for i in range(11)], "proj_id string, cell_id long, t string, u string")
    kept = network.sized_terms(network.membership(cells, ["t", "u"]), cells, min_count=5, max_share=0.95)
    assert {r.term for r in kept.select("term").distinct().collect()} == {"t=b"}


def test_strips_bound_what_is_exchanged(spark, monkeypatch):
    """Partner blocks of a strip are summed in the task: rows are cells x codes x strips, and the result does not depend on the cut."""
    rng = np.random.default_rng(8)
    cells = [("P", i, rng.normal(size=4).tolist()) for i in range(120)]
    vectors = spark.createDataFrame(cells, "proj_id string, cell_id long, features array<double>")
    members = spark.createDataFrame([("P", i, f"t{i // 40}") for i in range(120)], "proj_id string, node long, term string")
    seen = []
    real = network._on_block_strips

    def spy(placed, fn, schema, strip):
        found = network.durable(real(placed, fn, schema, strip))
        seen.append(found.count())
        return found

    monkeypatch.setattr(network, "_on_block_strips", spy)
    results = [network.neighbour_voting_dense(vectors, members, block=10, strip=strip).toPandas().sort_values("term", ignore_index=True) for strip in (1, 4, 100)]
    for other in results[1:]:
        assert np.allclose(results[0].drop(columns=["proj_id", "term"]).astype(float), other.drop(columns=["proj_id", "term"]).astype(float))
    assert seen[2] == 120 * 10 and seen[1] <= 120 * 10 * 3 < seen[0]
