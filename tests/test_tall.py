import numpy as np
import pytest
from pyspark.sql import functions as F

from docsieve.operators import clustering, lsa, spectral, tall
from test_clustering import frame, labels_of, same_split


def tall_of(spark, values):
    rows = [(b, bytearray(np.ascontiguousarray(values[b * tall.BLOCK : (b + 1) * tall.BLOCK]).tobytes())) for b in range(-(-len(values) // tall.BLOCK))]
    return tall.Tall(spark.createDataFrame(rows, tall.TALL), values.shape[1], len(values))


def whole(matrix):
    rows = matrix.table.orderBy("block").collect()
    return np.vstack([np.frombuffer(r["data"]).reshape(-1, matrix.width) for r in rows])


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    for module in (tall, lsa, spectral):
        monkeypatch.setattr(module, "BLOCK", 16)
    monkeypatch.setattr(tall, "FAN_IN", 3)


def test_triangle_and_sums_by_a_tree(spark):
    values = np.random.default_rng(1).normal(size=(205, 7))
    matrix = tall_of(spark, values)
    upper = matrix.triangle(lambda rows: rows, 7)
    assert np.abs(upper.T @ upper) == pytest.approx(np.abs(values.T @ values))
    assert matrix.summed(lambda rows: rows.T @ rows, 7) == pytest.approx(values.T @ values)
    assert whole(matrix.beside(matrix.mapped(lambda rows: 2 * rows, 7).table, 7)) == pytest.approx(np.hstack([values, 2 * values]))


@pytest.mark.parametrize("rank", [40, 9])
def test_leading_eigenvectors_of_a_known_matrix(spark, rank):
    draw = np.random.default_rng(2)
    factor, _ = np.linalg.qr(draw.normal(size=(100, rank)))
    spectrum = np.linspace(1, 10, rank)
    dense = (factor * spectrum) @ factor.T

    def operator(matrix):
        return tall_of(spark, dense @ whole(matrix)).table

    found = tall.leading_eigenvectors(operator, tall.random_tall(spark, 100, 8, 3), 6, 1e-9)
    assert found.values == pytest.approx(np.sort(spectrum)[::-1][:6], abs=1e-8)
    assert found.residuals.max() <= 1e-9
    vectors = whole(found.vectors)
    assert vectors.T @ vectors == pytest.approx(np.eye(6), abs=1e-9)
    assert dense @ vectors == pytest.approx(vectors * found.values, abs=1e-6)


def test_projection_equals_the_dense_decomposition(spark):
    draw = np.random.default_rng(4)
    dense = draw.normal(size=(70, 45)) * (draw.random((70, 45)) < 0.2)
    rows = [(int(i), int(j), float(dense[i, j])) for i, j in zip(*np.nonzero(dense), strict=True)]
    weights = spark.createDataFrame(rows, "doc_id long, term_id long, weight double")
    fitted = lsa.fit_projection(weights, 12, tolerance=1e-8, terms=45)
    _, values, turned = np.linalg.svd(dense)
    assert fitted.singular_values == pytest.approx(values[:12], rel=1e-6)
    assert np.linalg.svd(turned[:12] @ fitted.matrix(), compute_uv=False) == pytest.approx(np.ones(12), abs=1e-6)
    low = spark.createDataFrame([(i, j, float((i + 1) * (j + 1))) for i in range(9) for j in range(5)], "doc_id long, term_id long, weight double")
    assert lsa.fit_projection(low, 4).dimension <= 4 and lsa.fit_projection(low, 4).singular_values[0] == pytest.approx(np.sqrt(285 * 55))


def test_projection_of_documents_matches_a_dense_svd(spark, monkeypatch):
    from docsieve.plans import catalog

    weights = catalog.settle(catalog.topic_weights(spark, "/root/testdata/sf0.001")[0])
    for module in (tall, lsa):
        monkeypatch.setattr(module, "BLOCK", 1024)
    fitted = lsa.fit_projection(weights, 20, tolerance=1e-6)
    rows = weights.select("doc_id", "term_id", "weight").toPandas()
    place = {doc: at for at, doc in enumerate(rows["doc_id"].unique())}
    dense = np.zeros((len(place), rows["term_id"].max() + 1))
    dense[rows["doc_id"].map(place), rows["term_id"]] = rows["weight"]
    assert fitted.singular_values == pytest.approx(np.linalg.svd(dense, compute_uv=False)[:20], rel=1e-6)


def test_graph_eigenvectors_span_the_dense_ones(spark):
    draw = np.random.default_rng(6)
    table = np.triu((draw.random((60, 60)) < 0.1) * draw.random((60, 60)), 1)
    table[0] = 0
    table = table + table.T + np.eye(60)
    edges = spark.createDataFrame([(i, j, float(table[i, j])) for i, j in zip(*(x.tolist() for x in np.nonzero(table)), strict=True)], "src long, dst long, weight double")
    found, roots = spectral.graph_eigenvectors(edges, 60, 4, tolerance=1e-9)
    np.fill_diagonal(table, 0)
    root = np.sqrt(table.sum(1))
    scaled = table / np.where(root > 0, root, 1)[:, None] / np.where(root > 0, root, 1)[None]
    values, vectors = np.linalg.eigh(scaled)
    assert found.values == pytest.approx(values[::-1][:4], abs=1e-8)
    angles = np.linalg.svd(vectors[:, ::-1][:, :4].T @ whole(found.vectors), compute_uv=False)
    assert angles == pytest.approx(np.ones(4), abs=1e-6)
    assert {r["node"]: r["root"] for r in roots.collect()} == pytest.approx({i: x for i, x in enumerate(root) if x})


def test_two_rings_are_separated(spark):
    turn = np.linspace(0, 2 * np.pi, 60, endpoint=False)
    rings = np.vstack([r * np.column_stack([np.cos(turn), np.sin(turn)]) for r in (1.0, 3.0)])
    points = frame(spark, rings)
    found = labels_of(clustering.spectral(points, 2))
    assert same_split(found, [0] * 60 + [1] * 60)
    assert not same_split(labels_of(clustering.kmeans(points, 2)), [0] * 60 + [1] * 60)
    assert points.count() == spectral.spectral_embedding(points, 3).where(F.size("features") == 3).count()


def test_a_step_writes_the_basis_once(spark, monkeypatch):
    written, write = [], tall.stored
    monkeypatch.setattr(tall, "stored", lambda table: written.append(table) or write(table))
    dense = np.diag(np.linspace(1, 2, 60))

    def operator(matrix):
        return tall_of(spark, dense @ whole(matrix)).table

    found = tall.leading_eigenvectors(operator, tall.random_tall(spark, 60, 4, 3), 3, 1e-12, depth=3, restarts=1)
    vectors = whole(found.vectors)
    assert vectors.T @ vectors == pytest.approx(np.eye(3), abs=1e-9)
    # Two for the start, one for each step, one for the result.
    assert len(written) == 2 + 3 + 1


def test_parts_of_packed_counts_follow_the_matrix(spark):
    # 20,000 terms by 110 columns, and 30,000 by 266: parts of large tables stay near the size of what a task multiplies.
    assert lsa.part_bytes(8 * 20_000 * 110) < 64 << 20 < lsa.part_bytes(8 * 30_000 * 266) <= 192 << 20
    rows = spark.range(40).select(F.col("id").alias("doc_id"), F.lit(1).alias("n"), F.expr("cast(repeat('x', 4 << 20) as binary)").alias("data"))
    assert lsa._parted(rows, "doc_id", 40, 8 * 20_000 * 110)[1] == 4 and lsa._parted(rows, "doc_id", 40, 8 * 30_000 * 266)[1] == 3


def test_small_graphs_are_solved_in_one_task_and_large_ones_over_spark(spark, monkeypatch):
    draw = np.random.default_rng(11)
    pairs = {(int(a), int(b)) for a, b in draw.integers(0, 50, (160, 2)) if a != b}
    edges = [(a, b, 1.0 + (a + b) % 3) for a, b in sorted(pairs | {(b, a) for a, b in pairs})]
    table = spark.createDataFrame(edges, "src bigint, dst bigint, weight double")
    over_spark = spectral.random_tall
    monkeypatch.setattr(spectral, "random_tall", lambda *_: pytest.fail("a small graph over Spark"))
    # Two nodes without edges, and a graph without any.
    one, _ = spectral.graph_eigenvectors(table, 52, 4, tolerance=1e-9)
    none, _ = spectral.graph_eigenvectors(table.where("src < 0"), 5, 2)
    monkeypatch.setattr(spectral, "random_tall", over_spark)
    monkeypatch.setattr(spectral, "HELD_BYTES", 0)
    other, _ = spectral.graph_eigenvectors(table, 52, 4, tolerance=1e-9)

    def vectors(found):
        return np.vstack([np.frombuffer(r["data"]).reshape(-1, found.vectors.width) for r in found.vectors.table.orderBy("block").collect()])

    assert np.allclose(one.values, other.values, atol=1e-9) and vectors(one).shape == (52, 4)
    assert np.allclose(vectors(one), vectors(other), atol=1e-5)
    assert len(none.values) == 2 and np.allclose(none.values, 0.0) and vectors(none).shape == (5, 2)


def test_a_sweep_makes_its_neighbour_graph_once(spark, monkeypatch):
    from docsieve.plans import catalog

    calls, plain = [], spectral.affinity_graph
    monkeypatch.setattr(spectral, "affinity_graph", lambda *rest: calls.append(rest) or plain(*rest))
    monkeypatch.setattr(catalog, "SWEEP_COUNTS", (2, 3))
    draw = np.random.default_rng(12)
    rows = [(i, [float(x) for x in draw.normal(size=3) + 6 * (i % 2)]) for i in range(40)]
    points = spark.createDataFrame(rows, "vec_id bigint, features array<double>")
    monkeypatch.setattr(catalog, "embeddings", lambda *_: points)
    swept = catalog.method_sweep(spark, "").collect()
    assert len(swept) == 6 and all(r["error"] is None for r in swept)
    assert len(calls) == 1
