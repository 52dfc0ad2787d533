from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from docsieve.operators import blocks, clustering, evaluation, hierarchy
from docsieve.operators.silhouette import silhouette, silhouette_rows, silhouette_runs


def frame(spark, vectors, parts=3):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "doc_id long, features array<double>").repartition(parts)


def groups(seed=0, size=20, spread=0.3):
    rng = np.random.default_rng(seed)
    middles = np.array([[0, 0, 5], [5, 0, 0], [0, 5, 0]])
    return np.vstack([m + spread * rng.normal(size=(size, 3)) for m in middles]), np.repeat([0, 1, 2], size)


def plain_silhouette(vectors, labels):
    table = np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(-1))
    values = []
    for i in range(len(vectors)):
        own = labels == labels[i]
        if own.sum() == 1:
            values.append(0.0)
            continue
        a = table[i][own].sum() / (own.sum() - 1)
        b = min(table[i][labels == c].mean() for c in set(labels) if c != labels[i])
        values.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return np.mean(values)


def same_split(left, right):
    return len(set(zip(left, right, strict=True))) == len(set(left)) == len(set(right))


def labels_of(found):
    return [r["label"] for r in found.labels.orderBy("doc_id").collect()]


@pytest.mark.parametrize("sparse", [False, True])
def test_silhouette_matches_all_pairs(spark, sparse):
    rng = np.random.default_rng(1)
    vectors = np.vstack([rng.normal(size=(50, 4)), np.tile(rng.normal(size=4), (30, 1))])
    labels = np.concatenate([rng.integers(0, 4, 79), [9]])
    rows = [
        (i, Vectors.sparse(4, range(4), v.tolist()) if sparse else v.tolist(), int(c))
        for i, (v, c) in enumerate(zip(vectors, labels, strict=True))
    ]
    df = spark.createDataFrame(rows, ["doc_id", "features", "label"]).repartition(5)
    assert silhouette(df) == pytest.approx(plain_silhouette(vectors, labels), abs=1e-7)


def test_silhouette_in_small_pieces(spark, monkeypatch):
    import docsieve.operators.silhouette as module

    monkeypatch.setattr(module, "BLOCK_ROWS", 7)
    vectors, labels = groups(2)
    df = frame(spark, vectors).join(
        spark.createDataFrame([(i, int(c)) for i, c in enumerate(labels)], "doc_id long, label int"), "doc_id"
    )
    assert silhouette(df) == pytest.approx(plain_silhouette(vectors, labels))
    assert silhouette_rows(df).agg(F.sum("weight")).first()[0] == 60
    assert silhouette(df, metric="squared_euclidean") > silhouette(df)
    with pytest.raises(ValueError):
        silhouette(df, metric="manhattan")
    with pytest.raises(ValueError):
        silhouette(df.withColumn("label", F.lit(1)))
    assert blocks.BLOCK_ROWS == 4096


@pytest.mark.parametrize("sparse", [False, True])
@pytest.mark.parametrize("block_rows", [None, 16])
def test_silhouettes_of_many_runs_in_one_pass(spark, sparse, block_rows):
    vectors, labels = groups(3)
    vectors[5] = vectors[7]
    points = frame(spark, vectors)
    if sparse:
        rows = [(i, Vectors.sparse(3, [(j, float(x)) for j, x in enumerate(v) if x])) for i, v in enumerate(vectors)]
        points = spark.createDataFrame(rows, ["doc_id", "features"]).repartition(3)
    draw = np.random.default_rng(4)
    runs = {"true": labels, ("drawn", 4): draw.integers(0, 4, 60), "alone": np.where(np.arange(60) == 9, 7, 3)}
    flat = {"one": np.zeros(60, int), "each": np.arange(60)}
    tables = {k: spark.createDataFrame([(i, int(c)) for i, c in enumerate(v)], "doc_id long, label int") for k, v in {**runs, **flat}.items()}
    found = silhouette_runs(points, tables, block_rows=block_rows)
    assert list(found) == [*runs, *flat] and found["one"] is None and found["each"] is None
    for name, given in runs.items():
        assert found[name] == pytest.approx(plain_silhouette(vectors, given), abs=1e-7)


def test_kmeans_finds_groups_whatever_the_partitioning(spark):
    vectors, labels = groups()
    found = [labels_of(clustering.kmeans(frame(spark, vectors, p), 3)) for p in (1, 4, 16)]
    assert all(same_split(f, labels) for f in found)
    assert found[0] == found[1] == found[2]
    assert set(labels_of(clustering.kmeans(frame(spark, vectors), 1))) == {0}


def test_choice_of_the_count(spark):
    vectors, labels = groups()
    chosen = clustering.cluster_kmeans(frame(spark, vectors), None, candidates=(2, 3, 5))
    assert chosen.cluster_count == 3 and same_split(labels_of(chosen), labels)
    ward = clustering.cluster_agglomerative(frame(spark, vectors), None, candidates=(2, 3, 5))
    assert ward.cluster_count == 3 and same_split(labels_of(ward), labels)
    tiny = frame(spark, vectors[:3])
    assert clustering.cluster_kmeans(tiny, None).cluster_count == 2
    assert clustering.cluster_kmeans(frame(spark, vectors[:1]), None).cluster_count == 1


def plain_agglomerative(vectors, k, linkage):
    parts = [[i] for i in range(len(vectors))]
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]

    def cost(a, b):
        if linkage == "ward":
            gap = vectors[a].mean(0) - vectors[b].mean(0)
            return len(a) * len(b) / (len(a) + len(b)) * gap @ gap
        return np.mean([[1 - units[i] @ units[j] for j in b] for i in a])

    while len(parts) > k:
        _, i, j = min((cost(parts[i], parts[j]), i, j) for i in range(len(parts)) for j in range(i))
        parts[j] += parts.pop(i)
    labels = np.empty(len(vectors), int)
    for label, members in enumerate(parts):
        labels[members] = label
    return labels.tolist()


@pytest.mark.parametrize("linkage", ["ward", "average"])
def test_agglomerative_is_exact_on_small_tables(spark, linkage):
    vectors = np.random.default_rng(7).normal(size=(35, 3))
    tree = clustering.Agglomerative(frame(spark, vectors), linkage)
    for k in (2, 4, 9):
        assert same_split(labels_of(tree.cut(k)), plain_agglomerative(vectors, k, linkage))


@pytest.mark.parametrize("linkage", ["ward", "average"])
def test_agglomerative_in_distributed_rounds_is_the_same_tree(spark, monkeypatch, linkage):
    draw = np.random.default_rng(8)
    # Groups, scattered rows, copies, and ties on a grid.
    grid = np.array([(x, y, 1.0) for x in range(5) for y in range(5)]) * 3 + 20
    vectors = np.concatenate([draw.normal(size=(60, 3)), draw.normal(size=(60, 3)) * 0.2 + 4, np.repeat(draw.normal(size=(2, 3)), 15, axis=0)])
    monkeypatch.setattr(hierarchy, "CELL_ROWS", 6)
    tree = clustering.Agglomerative(frame(spark, vectors), linkage, finish=25)
    assert len(tree.tree.top) < 25 and tree.tree.merges.count() == len(np.unique(vectors, axis=0)) - 1
    several = tree.cuts((1, 2, 3, 9, 40))
    for k, cut in several.items():
        found = labels_of(cut)
        assert same_split(found, plain_agglomerative(vectors, k, linkage)) and len(set(found)) == k
    tied = clustering.Agglomerative(frame(spark, grid), linkage, finish=8)
    assert tied.tree.merges.count() == 24
    assert sorted(Counter(labels_of(tied.cut(25))).values()) == [1] * 25


@pytest.mark.parametrize("linkage", ["ward", "average"])
def test_rounds_in_a_task_give_the_tree_of_the_table_and_of_spark(spark, monkeypatch, linkage):
    draw = np.random.default_rng(9)
    vectors = np.concatenate([draw.normal(size=(400, 4)), draw.normal(size=(200, 4)) * 0.1 + 3, np.repeat(draw.normal(size=(2, 4)), 9, axis=0)])
    rounds, round_ = [], hierarchy.MergeTree._round
    monkeypatch.setattr(hierarchy.MergeTree, "_round", lambda tree, *rest: rounds.append(rest) or round_(tree, *rest))
    # More clusters than the table of costs may have are no reason for rounds over Spark.
    assert hierarchy.LAST > hierarchy.FINISH and clustering.Agglomerative(frame(spark, draw.normal(size=(hierarchy.FINISH + 60, 2)))).tree.merges.count() == hierarchy.FINISH + 59
    assert not rounds
    points = np.unique(vectors / (np.sqrt((vectors**2).sum(1))[:, None] if linkage == "average" else 1.0), axis=0)
    start = np.arange(len(points)), np.ones(len(points)), points, np.zeros(len(points))
    merges, (nodes, sizes, means, heights), after = hierarchy.near_merges(*start, linkage, 1, 100)
    assert len(nodes) <= 100 and sizes.sum() == len(points) and len(merges) == len(points) - len(nodes) and len(points) == 602
    merges += hierarchy.finish_merges(nodes, sizes, means * sizes[:, None], heights, linkage, after)
    whole = hierarchy.finish_merges(start[0], start[1], points.copy(), start[3], linkage, 1)
    for found, expected in zip(sorted(merges), sorted(whole), strict=True):
        assert found[:3] == expected[:3] and found[3] == pytest.approx(expected[3], rel=1e-9, abs=1e-12)


def test_agglomerative_equals_the_plain_tree_on_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id")
    points = table.select(F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>").alias("features"))
    vectors = np.array([r["features"] for r in points.collect()])
    assert len(vectors) == 2000
    tree = clustering.Agglomerative(points, "ward", finish=900)
    sizes, sums, owner = np.ones(len(vectors)), vectors.copy(), np.arange(len(vectors))
    gaps = ((vectors**2).sum(1)[:, None] + (vectors**2).sum(1)[None] - 2 * vectors @ vectors.T) / 2
    np.fill_diagonal(gaps, np.inf)
    expected = {}
    for left in range(len(vectors), 8, -1):
        i, j = sorted(divmod(int(gaps.argmin()), len(vectors)))
        sizes[i], sums[i] = sizes[i] + sizes[j], sums[i] + sums[j]
        owner[owner == j] = i
        cost = sizes * sizes[i] / (sizes + sizes[i]) * ((sums / sizes[:, None] - sums[i] / sizes[i]) ** 2).sum(1)
        cost[np.isinf(gaps[i]) & np.isinf(gaps[:, i])] = np.inf
        gaps[i], gaps[:, i] = cost, cost
        gaps[i, i] = np.inf
        gaps[j], gaps[:, j] = np.inf, np.inf
        expected[left - 1] = owner.copy()
    for k in (8, 50, 900):
        assert same_split(labels_of(tree.cut(k)), expected[k].tolist())


def test_agglomerative_edges(spark):
    one = frame(spark, np.ones((4, 2)))
    assert set(labels_of(clustering.Agglomerative(one).cut(3))) == {0}
    assert clustering.Agglomerative(one.limit(0)).cut(2).labels.count() == 0
    with pytest.raises(ValueError):
        clustering.Agglomerative(one, "single")


def test_spectral_covers_every_row(spark):
    vectors, _ = groups(spread=1.5)
    found = clustering.spectral(frame(spark, vectors), 3)
    assert found.labels.count() == 60 and found.labels.select("label").distinct().count() <= 3


def test_sweep_reports_failures_and_filters(spark):
    vectors, _ = groups()
    points = frame(spark, vectors)

    def broken(k):
        raise RuntimeError("graph fell apart")

    methods = {"kmeans": lambda k: clustering.kmeans(points, k), "broken": broken}
    rows, labels = evaluation.method_sweep(points, methods, (2, 3), max_size=40, tolerated=("broken",))
    table = {(r["method"], r["cluster_count"]): r for r in rows.collect()}
    assert table[("broken", 2)]["error"] == "graph fell apart" and table[("broken", 2)]["silhouette_score"] is None
    assert table[("kmeans", 3)]["max_cluster_size"] == 20 and table[("kmeans", 3)]["size_constraint_ok"]
    assert not table[("kmeans", 2)]["size_constraint_ok"]
    assert set(labels) == {("kmeans", 2), ("kmeans", 3)}
    with pytest.raises(RuntimeError):
        evaluation.method_sweep(points, methods, (2, 3), max_size=40)
    assert [r["cluster_count"] for r in evaluation.size_filter(rows, 40).collect()] == [3]
    assert evaluation.size_filter(rows, 40, inclusive=True).count() == 2
    assert [r["cluster_count"] for r in evaluation.violating_runs(rows, 40).collect()] == [2]
    wide = evaluation.wide_labels(points, {"kmeans_k3": labels[("kmeans", 3)]})
    assert wide.columns == ["doc_id", "kmeans_k3"] and wide.count() == 60
    compared = evaluation.approach_comparison(spark, {"a": rows, "b": rows}).collect()
    assert len(compared) == 8 and compared[0]["method"] == "kmeans" and compared[0]["cluster_count"] == 3


def test_terms_and_representatives(spark):
    weights = spark.createDataFrame(
        [(0, "aa", 1.0), (1, "aa", 0.6), (1, "bb", 0.8), (2, "cc", 1.0)], "doc_id long, term string, weight double"
    )
    labels = spark.createDataFrame([(0, 0), (1, 0), (2, 1), (3, 0)], "doc_id long, label int")
    rows = evaluation.cluster_top_terms(weights, labels, 2).where("label = 0").orderBy("term_rank").collect()
    assert [(r["term"], r["weight"]) for r in rows] == [("aa", pytest.approx(1.6 / 3)), ("bb", pytest.approx(0.8 / 3))]
    noise = spark.createDataFrame([("aa",)], "term string")
    topics = spark.createDataFrame([(0, "letters")], "label int, topic string")
    named = evaluation.cluster_top_terms(weights, labels, 2, noise, topics).where("label = 0").collect()
    assert [(r["topic"], r["term_rank"], r["term"]) for r in named] == [("letters", 1, "bb")]
    near = evaluation.sparse_representatives(weights, labels, top=1).where("label = 0").first()
    dense = spark.createDataFrame(
        [(0, [1.0, 0.0, 0.0]), (1, [0.6, 0.8, 0.0]), (2, [0.0, 0.0, 1.0]), (3, [0.0, 0.0, 0.0])],
        "doc_id long, features array<double>",
    )
    full = evaluation.representative_documents(dense, labels, top=1).where("label = 0").first()
    assert near["doc_id"] == full["doc_id"]
    assert near["distance_to_centroid"] == pytest.approx(full["distance_to_centroid"])
    sizes = {r["label"]: tuple(r)[1:] for r in evaluation.cluster_sizes(labels).collect()}
    assert sizes == {0: (3, 3), 1: (1, 3)}
    found = clustering.Clustering(labels, 1, [np.array([0.1, 0.7])])
    vocab = spark.createDataFrame([(0, "aa"), (1, "bb")], "term_id long, term string")
    assert evaluation.center_top_terms(spark, found, vocab, 1).first()["term"] == "bb"


def test_labels_do_not_depend_on_the_session_width(spark):
    draw = np.random.default_rng(9)
    points = frame(spark, draw.normal(size=(300, 6))).persist()
    found = []
    for width in ("2", "4", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        found.append(sorted(tuple(r) for r in clustering.kmeans(points, 5, max_iter=20).labels.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1] == found[2]


def test_small_pieces_travel_in_large_loads(spark, monkeypatch):
    import docsieve.operators.silhouette as module

    rows, join = [], module.block_join

    def noted(*given):
        rows.append(given[-1])
        return join(*given)

    monkeypatch.setattr(module, "block_join", noted)
    vectors, labels = groups(5)
    given = spark.createDataFrame([(i, int(c)) for i, c in enumerate(labels)], "doc_id long, label int")
    df = frame(spark, vectors).join(given, "doc_id")
    assert silhouette(df, block_rows=4) == pytest.approx(plain_silhouette(vectors, labels))
    assert silhouette_runs(frame(spark, vectors), {1: given}, block_rows=4)[1] == pytest.approx(plain_silhouette(vectors, labels))
    assert min(rows) >= 512


def test_sparse_products_of_frequent_and_rare_terms():
    rng = np.random.default_rng(6)
    table = rng.random((70, 200)) * (rng.random((70, 200)) < np.linspace(0.01, 0.5, 200))
    rows = pd.DataFrame({"ids": [np.nonzero(r)[0] for r in table], "v": [r[r != 0] for r in table]})
    exact = np.sqrt(((table[:30, None] - table[None, 30:]) ** 2).sum(-1))
    found = blocks.sparse_distance_sums(rows[:30].reset_index(drop=True), rows[30:].reset_index(drop=True), np.eye(40), 16)
    assert found == pytest.approx(exact)


@pytest.mark.parametrize("linkage", ["ward", "average"])
def test_cheapest_clusters_by_products(linkage):
    """Over rows far from the origin, with equal costs, the first leaf among the exactly cheapest is found."""
    rng = np.random.default_rng(8)
    means = rng.integers(0, 4, (60, 3)).astype(float) + (1e4 if linkage == "ward" else 1.0)
    if linkage == "average":
        means /= np.linalg.norm(means, axis=1)[:, None]
    data = pd.DataFrame({"node": np.arange(60), "n": rng.integers(1, 4, 60).astype(float), "mean": list(means), "chunk": np.arange(60) // 7})
    place, cost = hierarchy._least_costs(data, data, np.ones((60, 16), bool), linkage)
    i, j = np.divmod(np.arange(3600), 60)
    n = data["n"].to_numpy()
    exact = hierarchy._pair_costs(n[i], means[i], n[j], means[j], linkage).reshape(60, 60)
    assert (exact == exact.T).all()
    np.fill_diagonal(exact, np.inf)
    assert place.tolist() == exact.argmin(1).tolist() and cost.tolist() == exact.min(1).tolist()
