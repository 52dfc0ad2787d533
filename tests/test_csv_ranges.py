import random

import pytest

from docsieve.sources import articles, csvranges


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "96")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def field(value, draw):
    if draw.random() < 0.5 or any(c in value for c in ',"\n\r'):
        return '"' + value.replace('"', '""') + '"'
    return value


def write(path, rows, seed, end="\n", last=True):
    draw = random.Random(seed)
    lines = [",".join(field(v, draw) for v in row) for row in [("doc_id", "title", "text"), *rows]]
    path.write_bytes((end.join(lines) + (end if last else "")).encode())
    return str(path)


def odd_rows(seed, count=60):
    draw = random.Random(seed)
    parts = ["plain words", "a, comma", 'a "quoted" word', '""', "\n", "\r\n", "line\nbreak", "é日本", " ", '"', "x" * 150, "\n\n\n", "end\r\n"]
    return [(f"{i:03d}", draw.choice(parts).strip() or "t", "".join(draw.choices(parts, k=draw.randrange(1, 6)))) for i in range(count)]


def one_task(spark, path):
    table = spark.read.csv(path, header=True, multiLine=True, escape='"', quote='"')
    return [tuple(r) for r in table.collect()]


@pytest.mark.parametrize("end,last", [("\n", True), ("\r\n", True), ("\n", False)])
def test_ranges_give_the_records_of_the_whole_file(spark, tmp_path, small_ranges, end, last):
    path = write(tmp_path / "a.csv", odd_rows(1), 2, end, last)
    lines = spark.read.option("lineSep", "\n").text(path)
    assert lines.rdd.getNumPartitions() > 20
    table = csvranges.read_csv_ranges(spark, path, with_row_seq=True)
    assert table.columns == ["doc_id", "title", "text", "row_seq"]
    found = [tuple(r) for r in table.orderBy("row_seq").drop("row_seq").collect()]
    assert found == one_task(spark, path)
    assert [r[0] for r in found] == [f"{i:03d}" for i in range(60)]


def test_a_record_over_many_ranges_and_blank_lines(spark, tmp_path, small_ranges):
    long = "\n".join(f"line {i}, with words" for i in range(200))
    path = write(tmp_path / "b.csv", [("1", "t", long), ("2", "t", "short"), ("3", "t", long + '"')], 3)
    with open(path, "ab") as file:
        file.write(b"\n\n4,u\n\n")
    found = sorted(tuple(r) for r in csvranges.read_csv_ranges(spark, path).collect())
    assert found == sorted(one_task(spark, path))
    assert found[0][2] == long and found[-1] == ("4", "u", None)


def test_many_files_have_a_header_each(spark, tmp_path, small_ranges):
    folder = tmp_path / "many.csv"
    folder.mkdir()
    for i in range(3):
        rows = [(f"{i}{row[0]}", *row[1:]) for row in odd_rows(10 + i, 20)]
        write(folder / f"part{i}.csv", rows, i)
    table = csvranges.read_csv_ranges(spark, str(folder), with_row_seq=True)
    rows = table.orderBy("row_seq").collect()
    assert [r["doc_id"] for r in rows] == [f"{i}{k:03d}" for i in range(3) for k in range(20)]
    assert sorted(tuple(r)[:3] for r in rows) == sorted(one_task(spark, str(folder)))


def test_stray_quotes_go_to_the_one_task_reader(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('doc_id,text\n1,a 5" disk\n2,"fine"\n3,another 3" one\n')
    assert csvranges.read_csv_ranges(spark, str(path)) is None
    found = {r["doc_id"]: r["text"] for r in articles.load_articles(spark, str(path)).collect()}
    assert found == {"1": 'a 5" disk', "2": "fine", "3": 'another 3" one'}


def test_an_empty_file_and_a_header_alone(spark, tmp_path):
    (tmp_path / "d.csv").write_text("doc_id,text\n")
    assert articles.load_articles(spark, str(tmp_path / "d.csv")).count() == 0
    (tmp_path / "e.csv").write_text("")
    assert csvranges.read_csv_ranges(spark, str(tmp_path / "e.csv")) is None
