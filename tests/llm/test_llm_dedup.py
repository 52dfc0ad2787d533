"""Fingerprints, line windows, SimHash groups against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from docsieve.llm import iblt, linededup, simhash
from docsieve.llm.common import connected_components, running_total
from docsieve.session import ship_package

DOC_SCHEMA = "doc_id bigint, text string, fp string, first string, n string"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x", "x") for i, t in rows], DOC_SCHEMA)


def paragraphs(text):
    return {p.strip(" ") for p in text.split("\n")} - {""}


def test_sketch_likeness_is_that_of_the_paragraphs(spark):
    import hashlib

    draw = random.Random(3)
    rows = [(i, "\n".join(f"line {draw.randrange(60)}" for _ in range(draw.choice([0, 1, 4, 9, 40, 300])))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "same\ntext"), (103, "same\ntext"), (104, "\n".join(f"unique {i}" for i in range(900)))]
    draw.shuffle(rows)
    found = {r["id"]: r for r in iblt.compare_with_edits(docs_of(spark, rows)).collect()}
    assert len(found) == len(rows)
    ordered = sorted((i, t or "") for i, t in rows)
    for at, (i, text) in enumerate(ordered):
        other = ordered[(at + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert found[i]["n_chars"] == len(text)
        assert found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for name, second in (("near_edited", edited), ("near_next", other)):
            a, b = paragraphs(text), paragraphs(second)
            assert found[i][name] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert len(found[i]["edited_out"]) == len(paragraphs(text) - paragraphs(edited))
        assert len(found[i]["edited_in"]) == len(paragraphs(edited) - paragraphs(text))
    assert found[102]["fingerprint"] == found[103]["fingerprint"] != found[104]["fingerprint"]


def test_one_line_texts_stay_like_their_edited_form(spark):
    draw = random.Random(9)
    rows = [(i, " ".join(f"w{draw.randrange(10_000)}" for _ in range(300))) for i in range(30)]
    found = iblt.compare_with_edits(docs_of(spark, rows)).collect()
    # Half of the runs stay of each, so about a third of all.
    assert all(0.15 < r["near_edited"] < 0.5 and r["near_next"] < 0.1 for r in found)


def test_next_text_over_many_ranges_ties_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(iblt, "DOCS_PER_RANGE", 5)
    rows = [(i * i % 101, f"t{i}") for i in range(80)] + [(None, "last")]
    found = {(r["id"], r["text"]): r["next_text"] for r in iblt.with_next_text(docs_of(spark, rows)).collect()}
    assert len(found) == len(rows)
    following = defaultdict(set)
    for key, text in found.items():
        following[text].add(key)
    assert Counter(found.values()) == Counter(t for _, t in rows)
    ids = {t: i for i, t in rows}
    for (i, _), other in found.items():
        if i is not None and ids[other] is not None and i != max(x for x in ids.values() if x is not None):
            later = [x for x in ids.values() if x is not None and x > i]
            assert ids[other] in (i, min(later))
    assert ids[found[(None, "last")]] == min(x for x in ids.values() if x is not None)


def test_fingerprints_of_no_documents_and_of_one(spark):
    assert iblt.compare_with_edits(docs_of(spark, [])).count() == 0
    one = iblt.compare_with_edits(docs_of(spark, [(1, "a\nb")])).first()
    assert one["near_next"] == 1.0


def lines_by_hand(rows):
    windows = defaultdict(list)
    for i, text in rows:
        filled = [(at, line.strip(" ")) for at, line in enumerate((text or "").split("\n")) if line.strip(" ")]
        for k in range(len(filled) - 2):
            windows[tuple(line for _, line in filled[k : k + 3])].append((i, filled[k][0], filled[k + 2][0]))
    gone = defaultdict(set)
    for places in windows.values():
        places.sort()
        for i, first, last in places[1:]:
            gone[i] |= set(range(first, last + 1))
    return {
        i: text if i not in gone else "\n".join(line for at, line in enumerate(text.split("\n")) if at not in gone[i]) for i, text in rows
    }


def test_repeated_windows_go_but_for_the_first(spark):
    draw = random.Random(5)
    shared = [f"shared line {i}" for i in range(8)]
    rows = []
    for i in range(120):
        lines = [f"own {i} {k}" for k in range(draw.randrange(6))]
        at = draw.randrange(len(lines) + 1)
        lines[at:at] = draw.choice([[], shared[:2], shared[1:5], [shared[2], "", " " + shared[3], shared[4] + " "], shared])
        rows.append((i, "\n".join(lines)))
    rows += [(500, None), (501, ""), (502, "a\nb"), (503, "x\ny\nz\n" * 4), (504, "\n".join(f"l{i}" for i in range(3000)))]
    found = linededup.drop_repeated_lines(docs_of(spark, rows))
    assert {r["doc_id"]: r["text"] for r in found.collect()} == lines_by_hand(rows)
    assert found.columns == ["doc_id", "text", "fp", "first", "n", "removed_lines"]


def test_repeated_rows_are_one_document(spark):
    same = "a b\nc d\ne f"
    found = linededup.drop_repeated_lines(docs_of(spark, [(1, same), (1, same), (2, same), (None, same)])).collect()
    kept = {(r["doc_id"], r["text"]) for r in found}
    # A null id comes before all others.
    assert kept == {(None, same), (1, ""), (2, "")} and len(found) == 4
    assert linededup.drop_repeated_lines(docs_of(spark, [])).count() == 0


def simhash_by_hand(text, words=4):
    import xxhash

    found = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_equals_its_definition(spark):
    texts = [None, "", " \n", "One", "one two three", "One TWO three four", "É é a\tb\nc\x0bd\x1ce " * 9, "w " * 5000, " a b c d e"]
    for text in texts:
        assert simhash.fingerprint(text) % 2**64 == simhash_by_hand(text)
    assert spark.sql("select xxhash64('one two three four') x").first()["x"] == simhash.fingerprint("one two three four")


def test_groups_equal_all_pairs(spark):
    draw = random.Random(11)
    base = [" ".join(f"w{draw.randrange(400)}" for _ in range(200)) for _ in range(30)]
    rows = []
    for i in range(400):
        words = draw.choice(base).split() if i % 2 else [f"u{draw.randrange(10**6)}" for _ in range(draw.choice([0, 1, 3, 60]))]
        for _ in range(draw.randrange(4)):
            if words:
                words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(7, rows[7][1]), (1000, None)]
    found = simhash.simhash_groups(docs_of(spark, rows)).collect()
    assert len(found) == len(rows)
    fps = [(i, simhash_by_hand(t)) for i, t in rows]
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a][1] ^ fps[b][1]).count("1") <= 4:
                parent[root(a)] = root(b)
    least = defaultdict(lambda: 10**9)
    for k, (i, _) in enumerate(fps):
        least[root(k)] = min(least[root(k)], i)
    expected = Counter((i, fp, least[root(k)]) for k, (i, fp) in enumerate(fps))
    assert Counter((r["id"], r["fp"] % 2**64, r["component_id"]) for r in found) == expected
    stay = simhash.first_of_groups(docs_of(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in stay) == sorted(least.values())


def test_chains_of_close_fingerprints_are_one_group(spark):
    chain = [0]
    for k in range(40):
        chain.append(chain[-1] ^ sum(1 << ((5 * k + j * 13) % 64) for j in range(4)))
    df = spark.createDataFrame([(fp - 2**64 if fp >= 2**63 else fp,) for fp in chain], "fp bigint")
    assert simhash.linked_fingerprints(df, 4).select("group").distinct().count() == 1


def test_no_documents_and_null_ids(spark):
    assert simhash.simhash_groups(docs_of(spark, [])).count() == 0
    rows = [(None, "a b c d e"), (None, "a b c d e"), (None, "totally different words here now")]
    found = simhash.simhash_groups(docs_of(spark, rows)).collect()
    assert [r["component_id"] for r in found] == [None] * 3
    assert simhash.first_of_groups(docs_of(spark, rows)).count() == 2


def test_components_of_stars_chains_and_rings(spark):
    links = [(0, k) for k in range(1, 300)] + [(1000 + k, 1001 + k) for k in range(90)] + [(5000, 5001), (5001, 5002), (5002, 5000), (7, 7)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {found[k] for k in range(300)} == {0}
    assert {found[k] for k in range(1000, 1091)} == {1000}
    assert {found[k] for k in range(5000, 5003)} == {5000}


def test_running_total_by_group(spark):
    rows = [(None if i % 5 == 0 else i % 3, i, i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, k int, v int").withColumn("h", F.xxhash64("k"))
    found = running_total(df, ["g"], "h", ["k"], F.col("v"), "before", 4).collect()
    sums = defaultdict(int)
    for r in sorted(found, key=lambda r: r["h"] % 2**64):
        assert r["before"] == sums[r["g"]]
        sums[r["g"]] += r["v"]


def test_rows_keep_columns_of_any_name(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = ["__spans", "__span_id", "__row", "__id", "__key", "id", "key", "spans", "fp", "group"]
    clashing = docs.withColumns({name: F.concat(F.lit(name), F.col("doc_id").cast("string")) for name in names})
    for stage in (linededup.drop_repeated_lines, simhash.first_of_groups):
        found, plain = stage(clashing), stage(docs)
        assert [c for c in found.columns if c != "removed_lines"] == clashing.columns
        rows = {r["doc_id"]: r for r in found.collect()}
        assert {i: r["text"] for i, r in rows.items()} == {r["doc_id"]: r["text"] for r in plain.collect()}
        assert all(r[c] == f"{c}{i}" for i, r in rows.items() for c in names)


def test_many_spans_in_one_long_document(spark):
    draw = random.Random(4)
    lines = [f"line {i} of the long one" for i in range(4000)]
    repeated = [at for at in range(0, 4000, 8) if draw.random() < 0.5]
    rows = [(1, "\n".join(f"{lines[at + k]}" if k < 4 else f"other {at} {k}" for at in repeated for k in range(6))), (2, "\n".join(lines))]
    found = {r["doc_id"]: r for r in linededup.drop_repeated_lines(docs_of(spark, rows)).collect()}
    gone = {line for at in repeated for line in lines[at : at + 4]}
    assert found[2]["text"].split("\n") == [line for line in lines if line not in gone]
    assert found[2]["removed_lines"] == len(gone) and found[1]["removed_lines"] == 0


def test_sketches_without_digests_give_the_same_likeness(spark):
    draw = random.Random(5)
    rows = [(i, "\n".join(f"line {draw.randrange(90)}" for _ in range(draw.choice([0, 2, 30, 200])))) for i in range(40)]
    names = ("id", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    whole, counted = (iblt.compare_with_edits(docs_of(spark, rows), keep_digests=keep) for keep in (True, False))
    assert "edited_out" in whole.columns and "edited_out" not in counted.columns
    assert sorted(tuple(r[c] for c in names) for r in whole.collect()) == sorted(tuple(r[c] for c in names) for r in counted.collect())


def test_pairs_that_stay_stuck_are_tried_again(spark, monkeypatch):
    draw = random.Random(6)
    rows = [(i, 0, [draw.getrandbits(62) for _ in range(n)], [draw.getrandbits(62) for _ in range(n)]) for i, n in enumerate([1, 5, 40, 300])]
    common = [draw.getrandbits(62) for _ in range(50)]
    rows = [(i, p, left + common, common + right) for i, p, left, right in rows]
    pairs = spark.createDataFrame(rows, "row bigint, pair int, left array<bigint>, right array<bigint>")
    monkeypatch.setattr(iblt, "SWEEPS", 1)
    for levels in (iblt.LEVELS, 0):
        monkeypatch.setattr(iblt, "LEVELS", levels)
        found = {r["row"]: r for r in iblt.compare_pairs(pairs).collect()}
        assert all(set(found[i]["only_left"]) == set(a) - set(b) and set(found[i]["only_right"]) == set(b) - set(a) for i, _, a, b in rows)
        counts = {r["row"]: (r["only_left"], r["only_right"]) for r in iblt.compare_pairs(pairs, keep_digests=False).collect()}
        assert counts == {i: (len(set(a) - set(b)), len(set(b) - set(a))) for i, _, a, b in rows}
