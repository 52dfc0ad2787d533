"""Packing, quality rules, token counts, main text."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsieve.llm import htmltext, packing, quality, tokencounts
from docsieve.session import ship_package

public_tokenizers = pytest.importorskip("public_tokenizers")
DOC_SCHEMA = "doc_id bigint, text string, lang string, length string, start string"
ODD = "Ünïcode ÀÉß x² İstanbul ΣΑΣ don't I'LL 12,345 á é 中文字  nbsp\x1c\x85 tab\there\n\nnew ½ <|endoftext|> '' --- ​zero"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def sample_texts():
    draw = random.Random(2)
    texts = [ODD, "", "x", "word " * 9000] + [" ".join(draw.choice(ODD.split()) for _ in range(draw.randrange(400))) for _ in range(80)]
    return [*texts, None, "x", texts[10]]


def test_ids_and_pieces_equal_the_tokenizer(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [(i if i != 5 else None, t, "en", "x", "x") for i, t in enumerate(sample_texts())] + [(0, ODD, "en", "x", "x")]
    found = packing.pack_sequences(spark.createDataFrame(rows, DOC_SCHEMA), path, window=512, per_group=20).collect()
    expected = Counter()
    for i, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        for start in range(0, len(ids), 512):
            part = np.array(ids[start : start + 512], "<u4").tobytes()
            expected[(i, start, len(part) // 4, zlib.crc32(part), len(ids))] += 1
    assert Counter((r["id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in found) == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 512


def best_fit_by_hand(lengths, window):
    bins = []
    for length in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] >= length]
        if fits:
            min(fits)[0] -= length
        else:
            bins.append([window - length])
    return sorted(b[0] for b in bins)


def test_segment_tree_packs_like_plain_best_fit():
    draw = random.Random(4)
    for window in (8, 100, 4096):
        for _ in range(6):
            lengths = [draw.randint(1, window) for _ in range(200)]
            sequence, offset = packing.best_fit(lengths, window)
            filled = Counter()
            for s, n in zip(sequence, lengths, strict=True):
                filled[s] += n
            assert sorted(window - n for n in filled.values()) == best_fit_by_hand(lengths, window)
            assert all(o + n <= window for o, n in zip(offset, lengths, strict=True))


def test_little_is_padded(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    draw = random.Random(8)
    rows = [(i, "a " * draw.randrange(1, 3000), "en", "x", "x") for i in range(400)]
    found = packing.pack_sequences(spark.createDataFrame(rows, DOC_SCHEMA), path).toPandas()
    full = found.groupby("sequence_id").length.sum()
    assert full.sum() / (4096 * len(full)) > 0.97
    assert packing.pack_sequences(spark.createDataFrame([], DOC_SCHEMA), path).count() == 0


def test_base_measures_by_definition():
    texts = ["", "a b c a b c", "x\n\nx\n x\ny # $a<", "a a a a a", "é é | b\x1cc", "one two three four one two three five six one two"]
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        expected = (
            len(words),
            sum(map(len, words)),
            sum(c in "#*$%&|<>" for c in text),
            sum(line in lines[:i] for i, line in enumerate(lines)),
            len(covered),
        )
        assert quality.base_measures(text) == expected


def clean_text(draw, n):
    common = ["the", "of", "and", "to", "in", "is"]
    return " ".join(draw.choice(common) if draw.random() < 0.5 else f"w{chr(97 + draw.randrange(26))}{chr(97 + draw.randrange(26))}ord" for _ in range(n)) + "."


def test_odd_histograms_are_rejected_and_clean_ones_kept(spark):
    draw = random.Random(1)
    rows = [(i, clean_text(draw, draw.choice([60, 120, 400])), "en", "x", "x") for i in range(200)]
    rows += [(1000, "### 123 $$$ 456 " * 40 + "".join(f"q{i}# " for i in range(800)), "en", "x", "x")]
    rows += [(1001, " ".join(f"ZQ{i}X" for i in range(600)), "en", "x", "x"), (1002, "too short", "en", "x", "x")]
    rows += [(1003, None, "en", None, None), (1004, "", None, None, None), (1005, "same words here " * 100, "en", "x", "x")]
    rows += [(1006, clean_text(draw, 200), None, "x", "x"), (1007, clean_text(draw, 200), "xx", "x", "x"), (None, clean_text(draw, 100), "en", "x", "x")]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    found = {r["id"]: r for r in quality.judged(docs).collect()}
    assert len(found) == len(rows)
    assert all(found[i]["kept"] for i in [*range(200), 1006, 1007, None])
    assert not any(found[i]["kept"] for i in range(1000, 1006))
    assert [found[i]["base_failed"] for i in range(1000, 1006)] == [False, False, True, True, True, True]
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in found.items() if r["kept"]}
    assert quality.judged(docs.limit(0)).count() == 0


def test_distance_is_jensen_shannon():
    assert quality.distance([1, 0], [0, 1]) == pytest.approx(1.0)
    assert quality.distance([0.5, 0.5], [0.5, 0.5]) == 0.0
    p, q = [0.7, 0.2, 0.1], [0.1, 0.4, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    kl = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m, strict=True))
    assert quality.distance(p, q) == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2))


def test_language_counts_cover_all_documents(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "The the. cat", "en", "", ""), (2, "the (Dog)", "en", "", ""), (3, "der", None, "", "")], DOC_SCHEMA)
    found = {(r["lang"], r["name"]): r["n"] for r in quality.language_counts(docs).collect() if r["kind"] == "word"}
    assert found == {("en", "the"): 3, ("en", "cat"): 1, ("en", "dog"): 1, (None, "der"): 1}


def test_sections_share_out_all_tokens(spark):
    encoding, lengths = tokencounts.byte_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = [t for t in sample_texts()] + ["a\n\n\nb\n", "\n", "  \n  x", "é\n中\n" * 30]
    rows = [(i, t, "en", "x", "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    for rule in tokencounts.RULES:
        args = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
        found = defaultdict(list)
        for r in tokencounts.section_tokens(docs, *args, rule=rule).collect():
            found[r["id"]].append(r)
        for i, text in enumerate(texts):
            text = text or ""
            sections = sorted(found[i], key=lambda r: r["section"])
            assert "".join(text[r["start"] : r["end"]] for r in sections) == text
            owners, at = Counter(), 0
            for token in encoding.encode_ordinary(text):
                begin, at = at, at + lengths[token]
                spans, end = [], 0
                for r in sections:
                    start, end = end, end + len(text[r["start"] : r["end"]].encode())
                    shared = min(end, at) - max(start, begin)
                    if shared > 0:
                        spans.append((r["section"], shared))
                owner = spans[0] if rule == "first" else spans[-1] if rule == "last" else max(spans, key=lambda s: (s[1], -s[0]))
                owners[owner[0]] += 1
            assert {r["section"]: r["tokens"] for r in sections} == {r["section"]: owners.get(r["section"], 0) for r in sections}
    with pytest.raises(ValueError, match="rule"):
        tokencounts.section_tokens(docs, "", "", rule="none")


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="ad">Buy this now, it is a long and wordy advert for things.</div><div id="cookie-notice">We use cookies &amp; more.</div>
<article><h1>The &eacute;vent</h1><p>First <b>bold</b>   paragraph with
 enough text to be the article.<p>Second paragraph, with a <a href="x">link</a> &lt;tag&gt; inside it, and more words.
<ul><li>point one is here</li><li>point two is here</li></ul><script>track()</script>
<form><input name="q"><button>Send</button></form><p>Short.</p></article>
<aside>Side text that is not wanted at all.</aside><section class="comments"><p>Reader comment one, quite long indeed.</p></section>
<footer>&copy; 2024</footer></body></html>"""


def test_main_text_of_a_page():
    assert htmltext.main_text(PAGE).split("\n") == [
        "The évent",
        "First bold paragraph with enough text to be the article.",
        "Second paragraph, with a link <tag> inside it, and more words.",
        "point one is here",
        "point two is here",
        "Short.",
    ]


def test_main_text_without_article_elements():
    page = "<body><div class=menu><a href=1>a b</a> <a href=2>c d</a></div><div><div><h2>Head line</h2>" + "".join(
        f"<p>Paragraph number {i} has some ordinary words in it.</p>" for i in range(5)
    )
    text = htmltext.main_text(page + "</div><div><a href=x>More</a> <a href=y>Links</a> <a href=z>Here</a></div></div></body>")
    assert text.split("\n")[0] == "Head line" and "number 4" in text and "More" not in text


def test_all_of_an_uneven_article_is_kept():
    def section(n, name, size):
        return f"<section><h2>{name}</h2>" + "".join(f"<p>{name}{i} {'x' * size}</p>" for i in range(n)) + "</section>"

    parts = section(8, "long", 300) + "".join(section(3, f"short{k}", 100) for k in range(4))
    inner = f"loose words <b>in bold</b>{parts}<ul><li>point</li></ul><p>End.</p>"
    for before, after in (("<article>", "</article>"), ("<main>", "</main>"), ("<div class=menu><a href=x>m</a></div><div>", "</div>")):
        lines = htmltext.main_text(f"<body><nav>menu</nav>{before}{inner}{after}<footer>foot</footer></body>").split("\n")
        assert lines[0] == "loose words in bold" and lines[-2:] == ["point", "End."]
        assert len(lines) == 1 + 9 + 4 * 4 + 2


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "related-work", "privacy", "with-comments", "page sidebar", "menu"])
def test_wrappers_of_the_article_are_not_dropped_by_name(name):
    body = "<h1>Head</h1>" + "".join(f"<p>Paragraph {i} has some ordinary words in it.</p>" for i in range(6))
    beside = "<div class='sidebar-right'><p>Side words.</p></div><div id=mainNav><p>Some menu</p></div><div class='comment-list'><p>Reader words</p></div>"
    for key in ("class", "id"):
        text = htmltext.main_text(f"<body><div {key}='{name}'><article>{body}</article></div>{beside}</body>")
        assert text.count("Paragraph") == 6 and not re.search("Side|menu|Reader", text)


def test_text_under_a_beside_name_is_kept_only_without_an_article_elsewhere():
    words = "Many words that fill a page and say a lot about it."
    assert htmltext.main_text(f"<body><div class=widget><p>{words}</p></div><p>Rest.</p></body>").startswith(words)
    assert htmltext.main_text(f"<body><div class=ad>{words}</div><article><h1>Short.</h1></article></body>") == "Short."


def test_parts_of_an_article_named_like_its_subject_are_kept():
    body = "".join(f"<p>Paragraph {i} has some ordinary words in it.</p>" for i in range(6))
    inside = "<section class='related-work'><p>Other people wrote about this too.</p></section><p class='privacy'>Their privacy is the subject here.</p>"
    inside += "<div class='share'><a href=x>One</a> <a href=y>Two</a></div><div class='ad'><p>Buy these things now, they are cheap.</p></div>"
    text = htmltext.main_text(f"<body><article><h1>Head</h1>{body}{inside}</article></body>")
    assert "Other people" in text and "Their privacy" in text and "One" not in text and "Buy" not in text


def test_broken_and_empty_pages(spark):
    pages = [None, "", "plain text only", "<p>open <b>never closed", "<!-- only", "<script>x", "<a href='", "&#0; &bogus; &amp", "<nav>menu</nav>"]
    texts = [htmltext.main_text(p) for p in pages]
    assert texts[:4] == ["", "", "plain text only", "open never closed"]
    assert texts[4] == texts[5] == texts[8] == ""
    rows = [(i, None if i == 1 else "u", p, "x") for i, p in enumerate(pages)] + [(0, "u", "<div>" * 5000 + "deep", "x"), (50, "u", "<p>a" * 50_000, "x")]
    found = htmltext.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    assert len(found) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in found)


def test_small_and_null_languages_keep_clean_texts(spark):
    draw = random.Random(6)

    def texts(letters, common, n):
        def word():
            return draw.choice(common) if draw.random() < 0.5 else "".join(draw.choice(letters) for _ in range(5))

        return [" ".join(word() for _ in range(150)) + "." for _ in range(n)]

    english = texts("abcdefghi", ["the", "of", "and", "to", "in", "is"], 300)
    small = texts("klmnopqrs", ["el", "los", "y", "por", "una", "con"], 12)
    rows = [(i, t, "en", "x", "x") for i, t in enumerate(english)] + [(1000 + i, t, "es", "x", "x") for i, t in enumerate(small[:8])]
    rows += [(2000 + i, t, None, "x", "x") for i, t in enumerate(small[8:] + english[:4])]
    rows += [(3000, " ".join(f"ZQ{i}X" for i in range(600)), None, "x", "x")]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    found = {r["id"]: r["kept"] for r in quality.judged(docs).collect()}
    assert {i for i, kept in found.items() if not kept} == {3000}
    assert {r["doc_id"] for r in quality.kept_documents(docs).collect()} == set(found) - {3000}
    near = quality.nearest_languages(docs.where("lang is null"), quality.language_references(docs, quality.QualitySettings()).where("lang is not null"))
    assert sorted(r["near_lang"] for r in near.collect())[-4:] == ["es"] * 4


PARAGRAPHS = "".join(f"<p>Paragraph {i} of the article says something about its subject.</p>" for i in range(6))
READERS = "".join(f"<p>Reader {i} writes a long and lively remark about what the article has said.</p>" for i in range(12))


@pytest.mark.parametrize("tag", ["article", "main"])
@pytest.mark.parametrize(
    "part",
    [
        "<div id='comments'>{}</div>", "<section class=comments>{}</section>", "<ol class=comment-list>{}</ol>", "<div class='comment-thread'>{}</div>",
        "<div class='post-commentsArea wide'>{}</div>", "<div id=comments><article class='comment depth-2'>{}</article></div>", "<article class=comment>{}</article>",
    ],
)
def test_comments_inside_an_article_go_however_long(tag, part):
    page = f"<body><nav>Menu</nav><{tag}><h1>Head</h1>{PARAGRAPHS}{part.format(READERS)}</{tag}><footer>Foot</footer></body>"
    assert htmltext.main_text(page).split("\n") == ["Head", *[f"Paragraph {i} of the article says something about its subject." for i in range(6)]]
    beside = f"<body><div class=post><h1>Head</h1>{PARAGRAPHS}</div>{part.format(READERS)}</body>"
    assert "Reader" not in htmltext.main_text(beside) and "Paragraph 5" in htmltext.main_text(beside)


@pytest.mark.parametrize("name", ["notice", "cookie-notice", "sponsored", "related", "related-links", "search", "recommended", "ad-slot", "newsletter", "privacy"])
def test_named_parts_inside_an_article_go_but_single_blocks_stay(name):
    part = f"<div class='{name}'><p>Quite ordinary words, as dense as any of the article, which say what nobody asked.</p></div>"
    text = htmltext.main_text(f"<body><article>{PARAGRAPHS}{part}<p>The end.</p></article></body>")
    assert "nobody" not in text and text.endswith("The end.") and text.count("Paragraph") == 6
    if name in htmltext.AMBIGUOUS_NAMES:
        assert "Its own" in htmltext.main_text(f"<body><article>{PARAGRAPHS}<p class='{name}'>Its own words.</p></article></body>")


@pytest.mark.parametrize("name", ["post comments-open", "has-comments", "entry comments-closed", "no-comments"])
def test_marks_of_state_name_no_comments(name):
    assert htmltext.main_text(f"<body><main><article class='{name}'>{PARAGRAPHS}</article></main></body>").count("Paragraph") == 6


def test_end_tags_without_a_start_cost_nothing():
    import time

    seconds = []
    for n in (4_000, 16_000):
        page = "<div>" * n + "deep" + "</b>" * n + "</span></i>" * n
        start = time.process_time()
        assert htmltext.main_text(page) == "deep"
        seconds.append(time.process_time() - start)
    # Four times the tags take about four times as long, and nowhere near sixteen times.
    assert seconds[1] < 9 * seconds[0] + 0.5


def plain_densities(page, kept, body):
    """Composite text density by its formula, every element's subtree looked through anew."""
    count = len(page.tags)

    def inside(node, top):
        while node not in (top, -1):
            node = page.parents[node]
        return node == top

    def in_link(node):
        while node > 0:
            if page.tags[node] == "a":
                return True
            node = page.parents[node]
        return False

    def measures(top):
        below = [n for n in range(1, count) if n != top and kept[n] and inside(n, top)]
        pieces = [("".join(p.split()), n) for n, p in page.pieces if p and kept[n] and (inside(n, top))]
        return sum(len(p) for p, _ in pieces), sum(len(p) for p, n in pieces if in_link(n)), len(below), sum(page.tags[n] == "a" for n in below)

    chars, link_chars, *_ = measures(body)
    shared = link_chars / max(1, chars)
    density = []
    for node in range(count):
        c, lc, t, lt = measures(node) if kept[node] else (0, 0, 0, 0)
        if not c:
            density.append(0.0)
            continue
        base = math.log(c / max(1, c - lc) * lc + shared * c + math.e)
        density.append(c / max(1, t) * max(0.0, math.log(max(1.0, c / max(1, lc) * max(1, t) / max(1, lt))) / base))
    return density, [sum(density[n] for n in range(1, count) if page.parents[n] == top) for top in range(count)]


def test_densities_follow_the_formula():
    draw = random.Random(8)
    for _ in range(25):
        parts = [draw.choice(["<div>", "</div>", "<p>words here", "</p>", "<a href=x>link", "</a>", "<ul><li>", "</ul>", "some text "]) for _ in range(60)]
        page = htmltext.Page("<body>" + "".join(parts))
        kept = [n == 0 or draw.random() > 0.1 for n in range(len(page.tags))]
        for node in range(1, len(kept)):
            kept[node] = kept[node] and kept[page.parents[node]]
        found = htmltext.densities(page, kept, 1)
        expected = plain_densities(page, kept, 1)
        assert found[0] == pytest.approx(expected[0]) and found[1] == pytest.approx(expected[1])


def test_pages_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert htmltext.extract_main_text(empty).count() == 0


def test_without_any_language_the_base_rules_decide(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    rows = quality.judged(docs).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in rows)
    assert quality.kept_documents(docs).count() == sum(r["kept"] for r in rows)


CLASHES = ["key", "near_lang", "__lang", "__reference", "__row", "id", "lines"]


def test_quality_rules_keep_columns_of_any_name(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang")))
    plain = {r["doc_id"] for r in quality.kept_documents(docs).collect()}
    clashing = docs.withColumns({name: F.concat(F.lit(name), F.col("doc_id").cast("string")) for name in CLASHES})
    kept = quality.kept_documents(clashing)
    assert kept.columns == clashing.columns
    rows = kept.collect()
    assert {r["doc_id"] for r in rows} == plain and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in CLASHES)
    assert quality.judged(clashing).count() == docs.count()
