"""Token alignment, spelling variants and the n-gram join against brute force."""

import importlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from docsieve.llm import crosstokens, ngramjoin, queries, spelling
from docsieve.session import ship_package, stored

CLASHING = "doc_id bigint, text string, id string, n bigint, key string, row bigint, k string, word string, digest string"
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "x", 1, "x", "x", "x") for i, t in rows], CLASHING)


# --- op11 ---------------------------------------------------------------------------------------------------------


def encoders():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=queries.tokenizer_file("piece_bpe_32k.model"))


def plain_alignment(rows):
    """Groups and links of every row by comparing all byte ranges, and the counts of its links."""
    a, b = encoders()
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in printable]
    shown = {chr(x): x for x in printable} | {chr(256 + i): x for i, x in enumerate(rest)}

    def of_b(i):
        hexed = re.fullmatch("<0x(..)>", b.id_to_piece(i))
        return bytes([int(hexed[1], 16)]) if hexed else b.id_to_piece(i).replace("▁", " ").encode()

    found, counts = [], Counter()
    for text in rows:
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        tokens = [bytes(shown[c] for c in a.id_to_token(i)) for i in ids[0]], [of_b(i) for i in ids[1]]
        if not text or any(b"".join(t) != (" " + text).encode() for t in tokens):
            found.append(None)
            continue
        spans = []
        for side in tokens:
            ends = [sum(map(len, side[: i + 1])) for i in range(len(side))]
            spans.append([(e - len(t), e) for e, t in zip(ends, side, strict=True)])
        links = [
            (x, y)
            for x, (low, high) in zip(ids[0], spans[0], strict=True)
            for y, (begin, end) in zip(ids[1], spans[1], strict=True)
            if max(low, begin) < min(high, end)
        ]
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, before = [], 0
        for cut in cuts:
            sides = [",".join(str(i) for i, s in zip(ids[k], spans[k], strict=True) if before < s[1] <= cut) for k in (0, 1)]
            groups.append("|".join(sides))
            before = cut
        counts.update(links)
        found.append((len(ids[0]), len(ids[1]), len(cuts), links, ";".join(groups)))
    highest = defaultdict(int)
    for (_, y), c in counts.items():
        highest[y] = max(highest[y], c)
    return [
        (0, 0, 0, 0, "", 0, 0)
        if x is None
        else (*x[:3], len(x[3]), x[4], sum(counts[p] == highest[p[1]] for p in x[3]), sum(counts[p] for p in x[3]))
        for x in found
    ]


def odd_texts(count=120):
    draw = random.Random(5)
    parts = ["the", "naïve", "Straße", "don't", " ", "  ", "\n\n", "\t", "x" * 30, "日本語", "😀", "<|endoftext|>", "<s>", "3.14", "été", "\x00"]
    texts = [" ".join(draw.choices(parts, k=draw.randrange(1, 25))) for _ in range(count)]
    return [None, "", " ", "▁", "a▁b", *texts, *texts[:7], "word " * 3000]


@pytest.mark.parametrize("share", [1, crosstokens.FREQUENT])
def test_alignment_equals_all_overlaps(spark, monkeypatch, share):
    # With a share of 1 hardly any pair is frequent, so that nearly all links take the shuffled way.
    monkeypatch.setattr(crosstokens, "FREQUENT", share)
    texts = odd_texts()
    expected = plain_alignment([t if t is None or len(t) < 10_000 else None for t in texts[:-1]])
    pattern = importlib.import_module("public_tokenizers").PATTERN
    paths = queries.tokenizer_file("byte_bpe_50k.json"), pattern, queries.tokenizer_file("piece_bpe_32k.model")
    aligned = crosstokens.aligned_tokens(docs_of(spark, list(enumerate(texts[:-1]))).repartition(3), *paths)
    scored = crosstokens.scored_links(stored(aligned)).orderBy("id").collect()
    names = ("n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")
    assert [tuple(r[c] for c in names) for r in scored] == expected


def test_windows_give_the_alignment_of_the_whole(monkeypatch):
    import numpy as np

    pattern = importlib.import_module("public_tokenizers").PATTERN
    first = crosstokens.byte_level(queries.tokenizer_file("byte_bpe_50k.json"), pattern)
    second = crosstokens.pieces(queries.tokenizer_file("piece_bpe_32k.model"))
    texts = [t for t in odd_texts() if t and "▁" not in t]
    aligner = crosstokens.Aligner(first, second)
    whole = []
    for text in texts:
        ids = [np.array(side[0]([text])[0], np.uint32) for side in (first, second)]
        groups, links, _ = aligner.windows(ids, [np.array([len(x)]) for x in ids])
        whole.append((groups[0], Counter(links.tolist())))
    for hashes in (crosstokens._hashes, lambda ids, cuts: np.zeros(len(cuts) - 1, np.uint64)):
        # With one hash for all, windows are told apart by their ids alone.
        monkeypatch.setattr(crosstokens, "_hashes", hashes)
        for step in (1, 7, len(texts)):
            found = [x for at in range(0, len(texts), step) for x in aligner.align(texts[at : at + step])]
            assert [x[4] for x in found] == [groups for groups, _ in whole]
            times = (1 << crosstokens.TIMES_BITS) - 1
            assert [{e >> crosstokens.TIMES_BITS: e & times for e in x[5].tolist()} for x in found] == [links for _, links in whole]


def test_a_link_counted_over_the_limit_of_an_entry(monkeypatch):
    monkeypatch.setattr(crosstokens, "TIMES_BITS", 4)
    pattern = importlib.import_module("public_tokenizers").PATTERN
    aligner = crosstokens.Aligner(
        crosstokens.byte_level(queries.tokenizer_file("byte_bpe_50k.json"), pattern),
        crosstokens.pieces(queries.tokenizer_file("piece_bpe_32k.model")),
    )
    links = aligner.align(["the " * 100])[0][5]
    times = Counter()
    for entry in links.tolist():
        times[entry >> 4] += entry & 15
    assert max(times.values()) == 100 and len(links) > len(times)


def test_byte_level_encoder_equals_the_tokenizer_file():
    a, _ = encoders()
    pattern = importlib.import_module("public_tokenizers").PATTERN
    encode, _ = crosstokens.byte_level(queries.tokenizer_file("byte_bpe_50k.json"), pattern)
    points = [chr(c) for c in [*range(0x3000), *range(0xA000, 0xB000), *range(0x1F300, 0x1F700)] if not 0xD800 <= c < 0xE000]
    texts = [f"{c}a{c}1{c}! {c}{c}  {c}\n" for c in points]
    assert [x.tolist() for x in encode(texts)] == [a.encode(" " + t, add_special_tokens=False).ids for t in texts]


# --- op12 ---------------------------------------------------------------------------------------------------------


def plain_variants(words):
    letters = sorted({c for w in words for c in w})
    near = defaultdict(set)
    for w in words:
        for i in range(len(w) + 1):
            for c in letters:
                near[w] |= {w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]} if i < len(w) else {w + c}
            if i < len(w):
                near[w].add(w[:i] + w[i + 1 :])
        near[w] = {v for v in near[w] if v in words and v != w}
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda v: (-words[v], v))
            if words[best] >= 2 * n:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, n, len(near[w]), form.get(w), words[form[w]] if w in form else None, root(w)) for w, n in words.items()}


NAMES = ("word", "n", "n_near", "form", "form_n", "root")


def test_variants_equal_all_comparisons(spark):
    draw = random.Random(7)
    words = {"": 3, "a": 5, "aa": 10, "aaa": 21, "aaaa": 50, "aaaaa": 101, "zz" * 40: 9, "zz" * 40 + "z": 20, "é": 1}
    while len(words) < 400:
        words["".join(draw.choices("abé", k=draw.randrange(1, 9)))] = draw.choice([1, 2, 4, 4, 9, 20, 50])
    words["a"] = 5
    chain = "qwertyuiop"
    for step in range(9):
        words[chain[: 10 - step]] = 2**step
    rows = [(w, n, 1, "x") for w, n in words.items()] + [(None, 3, 1, "x")]
    # One word in two rows: its counts are added up.
    rows = [("a", 2, 0, "y"), *[(w, n - 2 if w == "a" else n, k, x) for w, n, k, x in rows]]
    table = spark.createDataFrame(rows, "word string, n bigint, k bigint, root string")
    found = spelling.spelling_variants(table).collect()
    assert len(found) == len(words)
    assert {tuple(r[c] for c in NAMES) for r in found} == plain_variants(words)


def test_affixes_by_digest_are_the_same_nodes(spark, monkeypatch):
    draw = random.Random(3)
    words = {"".join(draw.choices("ab", k=draw.randrange(1, 9))): draw.randrange(1, 40) for _ in range(150)}
    monkeypatch.setattr(spelling, "PLAIN_AFFIX", 2)
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert {tuple(r[c] for c in NAMES) for r in spelling.spelling_variants(table).collect()} == plain_variants(words)


def test_noisy_words_count_every_run(spark):
    draw = random.Random(2)
    vocabulary = ["Hello", "straße", "ÉCOLE", "école", "abc", "planet", "x×y÷z", "one2three", "Planet"]
    rows = [(i, " ".join(draw.choices(vocabulary, k=60))) for i in range(300)] + [(300, None), (301, ""), (None, "planet planet")]
    expected, slips = Counter(), 0
    lower = str.maketrans(spelling.UPPER, spelling.LOWER)
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            mark = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and mark % 97 == 0:
                at = mark % len(run)
                run = run[:at] + run[at + 1 :]
                slips += 1
            expected[run] += 1
    found = {r["word"]: r["n"] for r in spelling.noisy_words(docs_of(spark, rows)).collect()}
    assert slips and found == {w: n for w, n in expected.items() if len(w) >= 5 and n >= 3}


def test_no_words_give_no_variants(spark):
    empty = spark.createDataFrame([], "word string, n bigint")
    assert spelling.spelling_variants(empty).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(empty, times=1)


def test_words_and_their_affixes_are_not_broadcast(spark):
    words = [("house", 9), ("mouse", 3), ("houses", 2)]
    numbered = spark.createDataFrame([(k, *row) for k, row in enumerate(words)], "k bigint, word string, n bigint")
    for found in (spelling.near_words(numbered), spelling.spelling_variants(spark.createDataFrame(words, "word string, n bigint"))):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


# --- op13 ---------------------------------------------------------------------------------------------------------


def plain_groups(rows, words=3, percent=90):
    sets = {}
    for i, text in rows:
        found = (text or "").encode().lower().split()
        last = max(1, len(found) - words + 1)
        sets[i] = {tuple(found[k : k + words]) for k in range(last)} if found else set()
    reach = {i: i for i in sets}

    def top(i):
        while reach[i] != i:
            i = reach[i]
        return i

    names = sorted(sets)
    for at, a in enumerate(names):
        for b in names[:at]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                reach[high] = low
    return {(i, len(sets[i]), top(i)) for i in sets}


def near_copies(seed=11):
    """Groups of near copies around the limit, common passages, chains that grow by a few words, short and odd texts."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = " ".join(draw.choices(words, k=60))
    rows = []
    for size in (4, 12, 40, 130, 300):
        base = draw.choices(words, k=size)
        for _ in range(25):
            copy = list(base)
            for _ in range(draw.randrange(0, 1 + size // 25)):
                copy[draw.randrange(size)] = draw.choice(words)
            rows.append(" ".join(copy))
    growing = draw.choices(words, k=100)
    for _ in range(12):
        rows.append(" ".join(growing))
        growing += draw.choices(words, k=draw.randrange(2, 14))
    rows += [passage + " " + " ".join(draw.choices(words, k=draw.choice([2, 6, 20, 80]))) for _ in range(40)]
    rows += [None, "", " \n\t", "one", "ONE", "one two", "one two", "ONE Two\x0bthree", "one two\nthree", "a b c a b c", "a b c", "é É", "é é"]
    rows += [" ".join(["same"] * k) for k in (3, 4, 50)] + [" ".join(draw.choices(words, k=5000))] * 2
    draw.shuffle(rows)
    return [(10 * i + 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("limits", [(100_000, 200, 8192), (900, 1, 16)])
def test_groups_equal_all_comparisons(spark, monkeypatch, limits):
    # Small limits cut every group into many blocks and every product into many slices.
    for name, value in zip(("BLOCK_GRAMS", "LEAST_WEIGHT", "COLUMNS"), limits, strict=True):
        monkeypatch.setattr(ngramjoin, name, value)
    rows = near_copies()
    expected = plain_groups(rows)
    assert 20 < len(rows) - len({c for _, _, c in expected})
    found = ngramjoin.ngram_groups(docs_of(spark, rows).repartition(5)).collect()
    assert len(found) == len(rows)
    assert {tuple(r) for r in found} == expected


@pytest.mark.parametrize("words,percent", [(1, 50), (2, 80), (5, 100)])
def test_groups_at_other_limits(spark, words, percent):
    rows = near_copies(seed=4)
    assert {tuple(r) for r in ngramjoin.ngram_groups(docs_of(spark, rows), words=words, percent=percent).collect()} == plain_groups(
        rows, words, percent
    )


def test_repeated_rows_and_missing_ids(spark):
    text = " ".join(f"t{i}" for i in range(50))
    rows = [(7, text), (7, text), (None, text), (None, text + " z"), (None, "lonely words in here"), (9, ""), (9, "")]
    found = Counter(tuple(r) for r in ngramjoin.ngram_groups(docs_of(spark, rows)).collect())
    assert found == Counter([(7, 48, 7)] * 2 + [(None, 48, 7), (None, 49, 7), (None, 2, None)] + [(9, 0, 9)] * 2)


def test_every_cut_of_hashes_is_a_range(spark):
    import numpy as np

    grams = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 4000, dtype=np.uint64))
    table = spark.createDataFrame([(int(g),) for g in grams.view(np.int64)], "gram bigint")
    for bits in (0, 1, 2):
        kept = table.where(ngramjoin._within(F.col("gram"), F.lit(bits))).count()
        assert kept == (np.searchsorted(grams, np.uint64(1 << (64 - bits))) if bits else len(grams))


@pytest.mark.parametrize("percent", [50, 90, 100])
def test_linked_sizes_share_a_cell(spark, percent):
    sizes = list(range(1, 1500))
    cells = {n: set(c) for n, c in spark.createDataFrame([(n,) for n in sizes], "n bigint").select("n", ngramjoin._cells(F.col("n"), percent)).collect()}
    assert all(1 <= len(c) <= 2 for c in cells.values())
    for n in sizes:
        for other in range(n, min(1499, 100 * n // percent) + 1):
            assert cells[n] & cells[other], (n, other)
