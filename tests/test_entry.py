import duckdb
import pytest

import __spark_entry__ as spec

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_entry_has_fifty_ranked_rows(spark):
    rows = spec.entry(spark).collect()
    assert [r["anomaly_rank"] for r in rows] == list(range(1, 51))


def test_every_check_belongs_to_a_query():
    assert set(spec.oracle_sql()) <= set(spec.queries())


@pytest.mark.parametrize(
    "name",
    ["corpus_summary", "clustering_view", "structural_features_pages", "bag_of_words", "tfidf", "anomaly_top_k", "lof_score"],
)
def test_query_equals_its_sql(spark, name):
    result = spec.queries()[name](spark, FOLDER)
    twin = duckdb.connect()
    for table in TABLES:
        twin.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    columns = sorted(result.columns)
    other = twin.sql(spec.oracle_sql()[name])
    assert sorted(other.columns) == columns
    left = sorted(tuple(r[c] for c in columns) for r in result.collect())
    order = [other.columns.index(c) for c in columns]
    right = sorted(tuple(r[i] for i in order) for r in other.fetchall())
    assert len(left) == len(right)
    for a, b in zip(left, right, strict=True):
        assert list(a) == [pytest.approx(v, abs=1e-9) if isinstance(v, float) else v for v in b]
