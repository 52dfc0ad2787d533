"""WARC archives, mixing, sharding: round trips and brute force."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from docsieve.llm import mixing, warc
from docsieve.llm.kdshards import kd_shards
from docsieve.session import ship_package

PAGE_SCHEMA = "page_id bigint, url string, html string, digest string, refers_to string"
DOC_SCHEMA = "doc_id bigint, text string, source string, size string, shard string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def sha1(payload):
    return base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()


def test_archives_give_every_record_back(spark, tmp_path):
    rows = [(i, f"http://x.org/{i}", f"<p>text {i % 7} é {'long ' * (i % 5)}</p>", "z", "z") for i in range(60)]
    rows += [(100, None, None, None, None), (101, "http://x.org/\r\n1", "", "z", None), (102, "u", "w" * 300_000, "z", "z")]
    rows += [(None, "u", "null id", None, None), (102, "u", "w" * 300_000, "z", "z")]
    path = str(tmp_path / "archives")
    warc.write_warc(spark.createDataFrame(rows, PAGE_SCHEMA), path)
    found = warc.read_warc(spark, path).collect()
    latest = {}
    for page, _, html, *_ in rows:
        if page is not None:
            latest[html or ""] = max(latest.get(html or "", -1), page)
    expected = Counter()
    for page, url, html, *_ in rows:
        html = html or ""
        refers = latest.get(html) if page is not None and latest[html] != page else None
        target = url and url.replace("\r", "%0D").replace("\n", "%0A")
        kind = "response" if refers is None else "revisit"
        payload = html.encode() if refers is None else None
        expected[(kind, page, target, len(html.encode()), sha1(html), refers, payload)] += 1
    assert Counter((r[0], r[1], r[2], r[3], r[4], r[5], r[6] and bytes(r[6]) if r[6] is not None else None) for r in found) == expected


def test_archives_are_plain_zstandard_with_a_dictionary_in_front(spark, tmp_path):
    import zstandard

    path = tmp_path / "archives"
    rows = [(i, "u", f"<html><body><p>page number {i} of many alike</p></body></html>" * 5, "", "") for i in range(400)]
    warc.write_warc(spark.createDataFrame(rows, PAGE_SCHEMA).coalesce(1), str(path))
    parts = list(path.glob("part-*"))
    total = 0
    for part in parts:
        content = part.read_bytes()
        assert content[:4] == warc.DICTIONARY_FRAME
        size = int.from_bytes(content[4:8], "little")
        dictionary = zstandard.ZstdCompressionDict(content[8 : 8 + size])
        assert content[8:12] == warc.DICTIONARY_MAGIC
        reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(content[8 + size :], read_across_frames=True)
        total += reader.read().count(b"WARC-Type: response")
    assert total == 400


def test_small_payloads_are_not_compared(spark):
    rows = spark.createDataFrame([(1, "u", b"ab", "d"), (2, "u", b"ab", "d")], "id bigint, url string, payload binary, digest string")
    assert [r["refers_to"] for r in warc.with_revisits(rows, 3).collect()] == [None, None]
    assert sorted([r["refers_to"] for r in warc.with_revisits(rows, 2).collect()], key=str) == [2, None]


def test_no_pages_no_archive(spark, tmp_path):
    path = str(tmp_path / "archives")
    warc.write_warc(spark.createDataFrame([], PAGE_SCHEMA), path)
    assert not [p for p in (tmp_path / "archives").glob("part-*") if p.stat().st_size]


def mixed_rows():
    rows = [(i, " ".join(f"w{j}" for j in range(17 * i % 97)), "s%d" % (i % 3 if i % 4 else 9), "x", "x") for i in range(300)]
    return rows + [(900, "one two", None, None, None), (901, None, "s1", "x", "x"), (None, "a b c", "s1", "x", "x"), (902, "", "é", "x", "x")]


def targets_by_rounds(sizes, weights, share, most):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, fixed = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in fixed]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        above = [s for s in open_ if weight[s] * level >= most * sizes[s]]
        if not above:
            return fixed | {s: weight[s] * level for s in open_}
        for s in above:
            fixed[s] = most * sizes[s]
            left -= fixed[s]


def highest_quotients(targets, blocks, seats, most):
    order = sorted(targets, key=lambda s: (s is None, s or ""))
    quotients = [
        (-targets[s] / (2 * k + 1), i, k, s) for i, s in enumerate(order) for k in range(most * blocks[s])
    ]
    return [s for *_, s in sorted(quotients)[:seats]]


def test_mix_follows_targets_and_quotas(spark):
    rows = mixed_rows()
    sizes = defaultdict(int)
    for _, text, source, *_ in rows:
        sizes[source] += len(WORD.findall(text or ""))
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    found = mixing.mix_sources(docs, block_words=8, shards=5).collect()
    assert len(found) == len(rows)
    wanted = targets_by_rounds(sizes, (3.0, 1.0, 2.0), 1.5, 2.0)
    taken = defaultdict(int)
    for r in found:
        assert r["target"] == pytest.approx(wanted[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, size in taken.items():
        assert abs(size - wanted[source]) <= 17
    again = mixing.mix_sources(docs.repartition(7), block_words=8, shards=5).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))

    blocks = {s: math.ceil(n / 8) for s, n in sizes.items()}
    targets = spark.createDataFrame([(s, sizes[s], wanted[s]) for s in sizes], "source string, source_size bigint, target double")
    quotas = {(r["source"], r["shard"]): r["quota"] for r in mixing.apportion(targets, 8, 5).collect()}
    seats = min(round(sum(wanted.values()) / 8), 2 * sum(blocks.values()))
    won = highest_quotients(wanted, blocks, seats, 2)
    for shard in range(5):
        part = Counter(won[seats * shard // 5 : seats * (shard + 1) // 5])
        assert {s: quotas[(s, shard)] for s in sizes} == {s: part.get(s, 0) for s in sizes}


def test_mixed_documents_hold_the_words_taken(spark):
    docs = spark.createDataFrame(mixed_rows(), DOC_SCHEMA)
    runs = mixing.mix_sources(docs, block_words=8, shards=3)
    out = mixing.mixed_documents(docs, runs)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        assert r["text"] == (r["text"] or "").strip() and r["text"]
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert words == Counter({r["id"]: r["taken"] for r in runs.collect() if r["taken"]})


def test_cut_words_keeps_the_space_between(spark):
    df = spark.createDataFrame([("  a\n\nb  c\td ",)], "text string")
    cut = [df.select(mixing.cut_words(F.col("text"), F.lit(a), F.lit(n))).first()[0] for a, n in ((0, 4), (1, 2), (3, 1))]
    assert cut == ["a\n\nb  c\td", "b  c", "d"]


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], DOC_SCHEMA)
    assert mixing.mix_sources(docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a", None, None), (2, "", None, None, None)], DOC_SCHEMA)
    assert [r["taken"] for r in mixing.mix_sources(blank).collect()] == [0, 0]


def test_shards_are_even_gapless_and_keep_equal_texts(spark):
    rows = [(i, ("word%d " % (i * 7919 % 1000)) * (1 + i * 31 % 40), "s", "x", "x") for i in range(4000)]
    rows += [(5000 + i, "copy of one text", "s", "x", "x") for i in range(300)] + [(None, None, None, None, None), (1, "", "s", "x", "x")]
    found = kd_shards(spark.createDataFrame(rows, DOC_SCHEMA), shards=10).collect()
    assert len(found) == len(rows)
    sizes, slots, copies = Counter(), defaultdict(list), Counter()
    texts = {i: t for i, t, *_ in rows[:-1]}
    for r in found:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        if r["id"] is not None and r["id"] >= 5000:
            copies[r["shard"]] += 1
            assert r["text_crc32"] == zlib.crc32(texts[r["id"]].encode())
    mean = sum(sizes.values()) / 10
    assert sorted(sizes) == list(range(10))
    assert max(abs(v - mean) for v in sizes.values()) < 0.03 * mean
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert len(copies) <= 2


def test_hot_text_is_cut_by_id(spark):
    docs = spark.createDataFrame([(i, "the same text", "s", "x", "x") for i in range(1000)], DOC_SCHEMA)
    sizes = Counter(r["shard"] for r in kd_shards(docs, shards=8).collect())
    assert len(sizes) == 8 and max(sizes.values()) < 1.1 * min(sizes.values())


def test_target_bytes_set_the_shards_and_few_rows_leave_some_empty(spark):
    docs = spark.createDataFrame([(i, "x" * 84, "s", "x", "x") for i in range(100)], DOC_SCHEMA)
    assert len({r["shard"] for r in kd_shards(docs, target_bytes=2500).collect()}) == 4
    assert {r["slot"] for r in kd_shards(docs.limit(2), shards=40).collect()} == {0}
    assert kd_shards(docs.limit(0), shards=40).count() == 0


def test_small_sources_come_near_their_targets(spark):
    sizes = {"a": 5, "b": 10, "c": 20, "d": 50, "e": 20_000, "f": 333}
    rows = [(i * 100 + k, " ".join(f"w{j}" for j in range(min(40, n - 40 * k))), s, "x", "x") for i, (s, n) in enumerate(sizes.items()) for k in range(-(-n // 40))]
    found = mixing.mix_sources(spark.createDataFrame(rows, DOC_SCHEMA)).collect()
    taken, target = Counter(), {}
    for r in found:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 2 for s in sizes)


def test_mixed_rows_keep_columns_of_any_name(spark):
    names = ["__row", "__id", "__key", "__plan", "__run", "__text", "runs", "id", "size", "taken"]
    docs = spark.createDataFrame(mixed_rows(), DOC_SCHEMA)
    clashing = docs.withColumns({name: F.concat(F.lit(name), F.col("doc_id").cast("string")) for name in names})
    out = mixing.mixed_documents(clashing, mixing.mix_sources(clashing))
    plain = mixing.mixed_documents(docs, mixing.mix_sources(docs))
    assert out.columns == clashing.columns
    key = lambda r: (r["doc_id"], r["source"] or "", r["text"])
    assert sorted(map(key, out.collect())) == sorted(map(key, plain.collect()))
    assert out.where(F.col("__run") != F.concat(F.lit("__run"), F.col("doc_id").cast("string"))).count() == 0
