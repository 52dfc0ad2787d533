import csv
import glob

import pytest
from pyspark.sql import functions as F

from docsieve.operators.forest import fit_forest
from docsieve.operators.anomaly import structural_points
from docsieve.operators.vectorize import VectorizerSettings, fit
from docsieve.plans.jobs import CorpusJobs
from docsieve.plans.report import export_tables
from docsieve.sources import tables
from docsieve.sources.articles import as_articles, load_articles, pick_columns
from docsieve.sources.buckets import BucketCache
from docsieve.sources.cache import fingerprint, load_cache, save_cache
from docsieve.streaming.scoring import stream_scores, stream_views, stream_weights

SIX = [
    ("DOC_001", "Two goalkeepers saved every shot of the cup final."),
    ("DOC_002", "Our league table lists the scorers of each team."),
    ("DOC_003", "Convolution layers learn edges before they learn faces."),
    ("DOC_004", "Gradient steps of a network shrink as training settles."),
    ("DOC_005", "Fry the leeks slowly, then add cumin and lentils."),
    ("DOC_006", "Soak the beans overnight and salt the soup last."),
]


def write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows([header, *rows])
    return str(path)


def lines(folder, suffix="csv"):
    found = []
    for path in sorted(glob.glob(f"{folder}/part-*")):
        with open(path, encoding="utf-8", newline="") as part:
            found += part.read().splitlines()
    return found


def test_run_writes_both_outputs(spark, tmp_path):
    docs = load_articles(spark, write_csv(tmp_path / "articles.csv", ["doc_id", "text"], SIX), with_row_seq=True)
    jobs = CorpusJobs(docs, preferred_clusters=3, contamination=0.2)
    labels, ranked = jobs.run(clusters_path=str(tmp_path / "clusters"), anomalies_path=str(tmp_path / "anomalies"))
    assert labels.count() == 6 and set(labels.columns) == {"doc_id", "label"}
    assert [r["anomaly"] for r in ranked.orderBy("anomaly").collect()] == [1, 2, 3, 4, 5, 6]
    written = lines(tmp_path / "clusters")
    assert [line.split(",")[0] for line in written if not line.startswith("doc_id")] == [d for d, _ in SIX]
    assert spark.read.csv(str(tmp_path / "anomalies"), header=True).columns == ["anomaly", "doc_id"]


def test_other_methods(spark):
    docs = spark.createDataFrame(SIX, "doc_id string, text string")
    jobs = CorpusJobs(docs, preferred_clusters=2)
    assert jobs.cluster("agglomerative").count() == 6
    assert jobs.anomalies(use_ensemble=False).count() == 6
    with pytest.raises(ValueError):
        jobs.cluster("dbscan")
    embeddings = spark.createDataFrame(
        [(d, [float(i), float(i * i)]) for i, (d, _) in enumerate(SIX)], "doc_id string, features array<double>"
    )
    assert jobs.cluster("ignored", embeddings=embeddings).count() == 6


def test_column_detection(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", ["document_id", "content"], [("A", "Alpha beta"), ("B", "Gamma delta"), ("C", "Epsilon zeta")])
    docs = load_articles(spark, path, with_row_seq=True)
    assert [r["doc_id"] for r in docs.orderBy("row_seq").collect()] == ["A", "B", "C"]
    CorpusJobs(docs, preferred_clusters=2).cluster(path=str(tmp_path / "c"))
    assert [line.split(",")[0] for line in lines(tmp_path / "c")[1:] if not line.startswith("doc_id")] == ["A", "B", "C"]
    assert pick_columns(["X", "TEXT", "Doc_ID"]) == ("Doc_ID", "TEXT")
    assert pick_columns(["key", "value"]) == ("key", "value")
    assert pick_columns(["x", "doc_id"]) == ("doc_id", "x")
    assert pick_columns(["a", "b"], "b", "a") == ("b", "a")
    with pytest.raises(ValueError):
        pick_columns(["only"])
    with pytest.raises(FileNotFoundError):
        load_articles(spark, str(tmp_path / "none.csv"))


def test_article_values(spark, tmp_path):
    path = write_csv(tmp_path / "q.csv", ["doc_id", "text"], [("001", 'say "hi",\nthen go'), ("002", "")])
    rows = {r["doc_id"]: r["text"] for r in load_articles(spark, path).collect()}
    assert rows == {"001": 'say "hi",\nthen go', "002": ""}
    numbered = spark.createDataFrame([(7, None)], "doc_id long, text string")
    assert tuple(as_articles(numbered).first()) == ("7", "")


def test_bag_of_words_file(spark, tmp_path):
    rows = [("D1", "apple banana"), ("D2", "apple carrot"), ("D3", "apple"), ("D,4", "the of")]
    docs = load_articles(spark, write_csv(tmp_path / "a.csv", ["doc_id", "text"], rows), with_row_seq=True)
    meta = CorpusJobs(docs).export_bag_of_words(str(tmp_path / "bow")).first()
    assert (meta["document_count"], meta["term_count"]) == (4, 3)
    assert lines(tmp_path / "bow") == [
        "doc_id,apple,banana,carrot", "D1,1,1,0", "D2,1,0,1", "D3,1,0,0", '"D,4",0,0,0',
    ]


def test_cache_follows_text_and_settings(spark, tmp_path):
    docs = spark.createDataFrame(SIX, "doc_id string, text string")
    folder = str(tmp_path / "cache")
    first = CorpusJobs(docs, cache_folder=folder)
    assert not first.load_features()
    first.prepare()
    again = CorpusJobs(docs.repartition(3), cache_folder=folder)
    assert again.load_features() and again.features("weights").count() == first.features("weights").count()
    edited = docs.withColumn("text", F.concat("text", F.lit(" more")))
    assert not CorpusJobs(edited, cache_folder=folder).load_features()
    assert not CorpusJobs(docs, cache_folder=folder, settings=VectorizerSettings()).load_features()
    assert load_cache(spark, None, ("views",), docs) is None
    assert fingerprint(docs) == fingerprint(docs.repartition(5)) != fingerprint(docs.limit(5))


def test_one_edited_document_computes_one_bucket(spark, tmp_path):
    docs = spark.createDataFrame([(f"D{i}", f"text number {i}") for i in range(200)], "doc_id string, text string")
    seen = []

    def upper(part):
        seen.append(part.count())
        return part.select("doc_id", F.upper("text").alias("loud"))

    def rows(table, settings=""):
        return {r["doc_id"]: r["loud"] for r in cache.rows("loud", table, upper, settings).collect()}

    cache = BucketCache(str(tmp_path), buckets=16)
    everything = {f"D{i}": f"TEXT NUMBER {i}" for i in range(200)}
    assert rows(docs) == everything and len(cache.computed["loud"]) == 16
    assert rows(docs.repartition(3)) == everything and cache.computed["loud"] == [] and seen == [200]
    edited = docs.withColumn("text", F.when(F.col("doc_id") == "D7", "other").otherwise(F.col("text")))
    assert rows(edited) == everything | {"D7": "OTHER"} and len(cache.computed["loud"]) == 1 and seen[-1] < 40
    without = edited.where("doc_id <> 'D9'")
    assert rows(without) == {k: v for k, v in (everything | {"D7": "OTHER"}).items() if k != "D9"}
    assert len(cache.computed["loud"]) == 1
    assert rows(docs, "other settings") == everything and len(cache.computed["loud"]) == 16
    # Another number of buckets takes nothing from the manifest; an empty table has no rows.
    cache = BucketCache(str(tmp_path), buckets=4)
    assert rows(docs) == everything and cache.computed["loud"] == [0, 1, 2, 3]
    assert rows(docs.limit(0)) == {}


def test_a_killed_save_leaves_the_one_before(spark, tmp_path):
    docs = spark.createDataFrame([(f"D{i}", f"text {i}") for i in range(30)], "doc_id string, text string")
    cache = BucketCache(str(tmp_path), buckets=4)
    same = lambda part: part.select("doc_id", "text")
    cache.rows("same", docs, same)

    def killed(part):
        return part.select("doc_id", F.raise_error("killed").cast("string").alias("text"))

    edited = docs.withColumn("text", F.concat("text", F.lit("!")))
    with pytest.raises(Exception, match="killed"):
        cache.rows("same", edited, killed)
    # A manifest without its mark of success does not count.
    (tmp_path / "same" / "manifest" / "2").mkdir()
    assert {r["text"] for r in cache.rows("same", docs, killed).collect()} == {f"text {i}" for i in range(30)}
    folder = str(tmp_path / "tables")
    save_cache(folder, {"a": docs, "b": docs}, docs)
    assert load_cache(spark, folder, ("a", "b"), docs) is not None
    with pytest.raises(Exception, match="killed"):
        save_cache(folder, {"a": edited, "b": killed(docs)}, edited)
    assert load_cache(spark, folder, ("a", "b"), docs) is None and load_cache(spark, folder, ("a", "b"), edited) is None


def test_feature_tables_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([("a", "Cats!"), ("b", "")], "doc_id string, text string")
    jobs = CorpusJobs(docs)
    tables.write_text_views(jobs.features("views"), f"{tmp_path}/views")
    assert {tuple(r) for r in tables.read_text_views(spark, f"{tmp_path}/views").collect()} == {
        ("a", "cat", "cats !"), ("b", "", ""),
    }
    tables.write_sparse_features(jobs.features("weights"), f"{tmp_path}/sparse")
    assert tables.read_features(spark, f"{tmp_path}/sparse").columns == ["doc_id", "term_id", "weight"]
    dense = spark.createDataFrame([("a", [1.0, 2.0])], "doc_id string, features array<double>")
    tables.write_dense_features(dense, f"{tmp_path}/dense")
    assert tables.load_embeddings(spark, f"{tmp_path}/dense", vector_col="features").first()["features"] == [1.0, 2.0]
    with pytest.raises(FileNotFoundError):
        tables.load_embeddings(spark, f"{tmp_path}/missing")
    tables.export_views(jobs.features("views"), f"{tmp_path}/export")
    tables.check_header(spark, f"{tmp_path}/export", ["doc_id", "text", "clustering_view", "anomaly_view"])
    with pytest.raises(ValueError):
        tables.check_header(spark, f"{tmp_path}/export", ["doc_id"])
    paths = export_tables({"dense": (dense.select("doc_id"), ["doc_id"])}, f"{tmp_path}/report")
    assert spark.read.csv(paths[0], header=True).first()[0] == "a"


def test_stream_gives_the_batch_result(spark, tmp_path):
    docs = spark.createDataFrame(SIX, "doc_id string, text string")
    docs.repartition(3).write.parquet(f"{tmp_path}/in")
    forest = fit_forest(structural_points(docs))
    model = fit(docs, VectorizerSettings(max_df=1.0))

    def arriving():
        return spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")

    def drain(df, name):
        query = (
            df.writeStream.format("parquet")
            .option("path", f"{tmp_path}/{name}")
            .option("checkpointLocation", f"{tmp_path}/{name}_state")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return spark.read.parquet(f"{tmp_path}/{name}")

    assert drain(stream_views(arriving()), "views").count() == 6
    from docsieve.operators.forest import forest_scores

    want = {r["doc_id"]: r["score"] for r in forest_scores(structural_points(docs), forest).collect()}
    got = {r["doc_id"]: r["score"] for r in drain(stream_scores(arriving(), forest), "scores").collect()}
    assert got == pytest.approx(want)

    def write(table, number):
        table.write.mode("overwrite").parquet(f"{tmp_path}/weights/batch={number}")

    query = stream_weights(arriving(), model, write, f"{tmp_path}/weights_state")
    query.processAllAvailable()
    query.stop()
    streamed = {(r["doc_id"], r["term"]): r["weight"] for r in spark.read.parquet(f"{tmp_path}/weights").collect()}
    assert streamed == pytest.approx({(r["doc_id"], r["term"]): r["weight"] for r in model.transform(docs).collect()})
