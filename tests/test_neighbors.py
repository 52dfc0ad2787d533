import numpy as np
import pytest

from docsieve.operators import blocks, neighbors


def frame(spark, vectors, ids=None, parts=4):
    ids = ids or list(range(len(vectors)))
    kind = "string" if isinstance(ids[0], str) else "long"
    rows = [(i, [float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, f"doc_id {kind}, features array<double>").repartition(parts)


def distances(vectors, metric):
    if metric == "euclidean":
        return np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(-1))
    lengths = np.linalg.norm(vectors, axis=1)
    units = vectors / np.where(lengths > 0, lengths, 1)[:, None]
    table = np.round(1 - units @ units.T, 12)
    return table


def brute(vectors, ids, k, metric):
    table = distances(vectors, metric)
    return {
        ids[i]: sorted((table[i, j], ids[j]) for j in range(len(ids)) if j != i)[:k] for i in range(len(ids))
    }


def check(spark, vectors, k, metric, ids=None, cell_rows=None, parts=4):
    ids = ids or list(range(len(vectors)))
    found = neighbors.nearest_neighbors(frame(spark, vectors, ids, parts), k, metric, cell_rows=cell_rows).collect()
    got = {}
    for row in sorted(found, key=lambda r: r["neighbor_rank"]):
        got.setdefault(row["doc_id"], []).append((row["distance"], row["neighbor_id"]))
    want = brute(vectors, ids, k, metric)
    assert got.keys() == want.keys()
    for key in want:
        assert [n for _, n in got[key]] == [n for _, n in want[key]], key
        assert [d for d, _ in got[key]] == pytest.approx([d for d, _ in want[key]], abs=1e-9)


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("cell_rows", [None, 20])
def test_small_grid_with_ties_copies_and_zero_vectors(spark, metric, cell_rows):
    vectors = np.random.default_rng(1).integers(-2, 3, (250, 3)).astype(float)
    check(spark, vectors, 7, metric, [f"D{i:03d}" for i in range(250)], cell_rows)


def test_a_third_of_the_rows_are_copies(spark):
    rng = np.random.default_rng(4)
    vectors = np.vstack([np.tile(rng.normal(size=5), (100, 1)), rng.normal(size=(200, 5))])
    check(spark, vectors, 6, "euclidean", cell_rows=25)
    check(spark, vectors, 6, "cosine", cell_rows=25)


def test_one_dense_region_is_cut_into_pieces(spark, monkeypatch):
    """Most rows crowd into one spot; small pieces must give the same answer."""
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 16)
    monkeypatch.setattr(blocks.block_join, "__defaults__", (16,))
    rng = np.random.default_rng(6)
    vectors = np.vstack([rng.normal(size=(150, 4)) * 1e-3, rng.normal(size=(60, 4))])
    for parts in (1, 7):
        check(spark, vectors, 5, "euclidean", cell_rows=70, parts=parts)


def test_only_copies_and_too_few_rows(spark):
    check(spark, np.ones((6, 2)), 3, "euclidean")
    check(spark, np.zeros((6, 2)), 3, "cosine")
    with pytest.raises(ValueError):
        neighbors.nearest_neighbors(frame(spark, np.ones((3, 2))), 3)
    with pytest.raises(ValueError):
        neighbors.nearest_neighbors(frame(spark, np.ones((3, 2))), 1, "manhattan")


def lof(vectors, k):
    table = distances(vectors, "euclidean")
    near = [[j for _, j in sorted((table[i, j], j) for j in range(len(vectors)) if j != i)[:k]] for i in range(len(vectors))]
    reach = [table[i, near[i][-1]] for i in range(len(vectors))]
    density = [1 / (np.mean([max(reach[j], table[i, j]) for j in near[i]]) + 1e-10) for i in range(len(vectors))]
    return [-np.mean([density[j] for j in near[i]]) / density[i] for i in range(len(vectors))]


def test_outlier_factor(spark):
    rng = np.random.default_rng(8)
    vectors = np.vstack([rng.normal(size=(80, 3)), [[9.0, 9, 9]]])
    got = {r["doc_id"]: r["score"] for r in neighbors.lof_scores(frame(spark, vectors), 10).collect()}
    assert [got[i] for i in range(81)] == pytest.approx(lof(vectors, 10))
    assert min(got, key=got.get) == 80
    few = {r["doc_id"]: r["score"] for r in neighbors.lof_scores(frame(spark, vectors[:6]), 20).collect()}
    assert [few[i] for i in range(6)] == pytest.approx(lof(vectors[:6], 5))


def test_distance_scores(spark):
    vectors = np.random.default_rng(9).normal(size=(40, 4))
    got = {r["doc_id"]: r["score"] for r in neighbors.knn_scores(frame(spark, vectors), 5).collect()}
    want = brute(vectors, list(range(40)), 5, "cosine")
    assert [got[i] for i in range(40)] == pytest.approx([-np.mean([d for d, _ in want[i]]) for i in range(40)])


def test_affinity_graph(spark):
    vectors = np.random.default_rng(10).normal(size=(30, 3))
    rows = neighbors.affinity_graph(frame(spark, vectors), 6).collect()
    connected = np.eye(30)
    for i, near in brute(vectors, list(range(30)), 5, "euclidean").items():
        connected[i, [j for _, j in near]] = 1
    got = np.zeros((30, 30))
    for row in rows:
        got[row["src"], row["dst"]] = row["weight"]
    assert (got == (connected + connected.T) / 2).all()


def test_a_query_goes_once_to_each_load(spark, monkeypatch):
    """Without structure no cell can be left out; the rows sent must follow the loads, not the cells."""
    sent, join = [], neighbors.block_join

    def counted(queries, *rest):
        sent.append(queries.count())
        return join(queries, *rest)

    monkeypatch.setattr(neighbors, "block_join", counted)
    vectors = np.random.default_rng(11).normal(size=(300, 12))
    check(spark, vectors, 5, "euclidean", cell_rows=4)
    assert max(sent) <= 300


def test_products_keep_the_digits_of_near_rows():
    rng = np.random.default_rng(12)
    left = 1e3 + rng.normal(size=(40, 6))
    right = np.vstack([left[:15], left[:15] + 1e-7, 1e3 + rng.normal(size=(30, 6))])
    exact = np.sqrt(((left[:, None] - right[None]) ** 2).sum(-1))
    member = rng.integers(0, 2, (60, 3)).astype(float)
    for columns in (7, 512):
        assert blocks.distance_sums(left, right, member, columns) == pytest.approx(exact @ member, rel=1e-9)
    alone = blocks.distance_sums(left, right, np.eye(60))
    assert alone == pytest.approx(exact, rel=1e-6, abs=1e-12)


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_many_loads_of_many_chunks(spark, monkeypatch, metric):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 160)
    monkeypatch.setattr(neighbors, "CELL_ROWS", 9)
    rng = np.random.default_rng(13)
    vectors = rng.integers(-2, 3, (200, 4)).astype(float) if metric == "euclidean" else rng.normal(size=(200, 4))
    check(spark, vectors, 6, metric, [f"D{i:03d}" for i in range(200)], cell_rows=3)
