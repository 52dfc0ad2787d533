"""The operators of this subpackage as named queries over the test tables, with their SQL twins."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsieve.llm.crosstokens import aligned_tokens, scored_links
from docsieve.llm.htmltext import extract_main_text
from docsieve.llm.iblt import compare_with_edits
from docsieve.llm.kdshards import kd_shards
from docsieve.llm.linededup import drop_repeated_lines
from docsieve.llm.mixing import mix_sources
from docsieve.llm.ngramjoin import ngram_groups
from docsieve.llm.packing import pack_sequences
from docsieve.llm.quality import judged
from docsieve.llm.simhash import simhash_groups
from docsieve.llm.spelling import noisy_words, spelling_variants
from docsieve.llm.tokencounts import section_tokens
from docsieve.llm.warc import archive_folder, read_warc, write_warc
from docsieve.session import stored


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file, the same on every machine that has them installed."""
    return importlib.import_module("public_tokenizers").path(name)


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to WARC archives with their own dictionaries, and read back."""
    path = archive_folder(spark)
    write_warc(table(spark, folder, "pages"), path)
    records = read_warc(spark, path, with_payload=False)
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The words that a mix of 150 % takes of every document."""
    mixed = mix_sources(table(spark, folder, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches of every text and its edited version, and how alike they are."""
    found = compare_with_edits(table(spark, folder, "documents"), keep_digests=False)
    return found.withColumnRenamed("id", "doc_id")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the three-line windows that earlier ones hold."""
    left = drop_repeated_lines(table(spark, folder, "documents"))
    return left.select("doc_id", "text", F.col("removed_lines").cast("long").alias("removed_lines"))


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Forty shards of near equal bytes."""
    placed = kd_shards(table(spark, folder, "documents"))
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose fingerprints of four-word shingles are linked at four bits or fewer."""
    groups = simhash_groups(table(spark, folder, "documents"), words=4, most_bits=4)
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select(F.col("id").alias("doc_id"), shown.alias("fingerprint"), "component_id")


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 4,096 tokens."""
    packed = pack_sequences(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"), window=4096, end_id=2)
    return packed.withColumnRenamed("id", "doc_id")


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Base measures and divergence from the language of every document."""
    return judged(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every line of every document."""
    pattern = importlib.import_module("public_tokenizers").PATTERN
    counts = section_tokens(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"), pattern)
    return counts.withColumnRenamed("id", "doc_id")


def op10_html(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return extract_main_text(table(spark, folder, "pages")).withColumnRenamed("id", "page_id")


def op11_cross_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Two tokenizations of every document aligned, with the corpus-wide counts of its links."""
    pattern = importlib.import_module("public_tokenizers").PATTERN
    documents = table(spark, folder, "documents")
    aligned = aligned_tokens(documents, tokenizer_file("byte_bpe_50k.json"), pattern, tokenizer_file("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    scored = scored_links(stored(aligned.withColumn("groups_sha256", digest).drop("groups")))
    return scored.withColumnRenamed("id", "doc_id")


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """The words of all documents, slips included, with the words that they are variants of."""
    return spelling_variants(noisy_words(table(spark, folder, "documents")))


def op13_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of three-word shingles share 90 % of their union."""
    groups = ngram_groups(table(spark, folder, "documents"), words=3, percent=90)
    return groups.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_mixing": op2_mixing,
    "op3_fingerprints": op3_fingerprints,
    "op4_line_dedup": op4_line_dedup,
    "op5_sharding": op5_sharding,
    "op6_simhash": op6_simhash,
    "op7_packing": op7_packing,
    "op8_quality": op8_quality,
    "op9_token_counts": op9_token_counts,
    "op10_html": op10_html,
    "op11_cross_tokens": op11_cross_tokens,
    "op12_spelling": op12_spelling,
    "op13_ngram_join": op13_ngram_join,
}

SQL: dict[str, str] = {
    "op1_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
latest AS (SELECT x, max(page_id) AS m FROM p GROUP BY x)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (((('0x' || substr(x, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::INT, 1)), '') AS payload_digest,
    CASE WHEN m = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN m <> page_id THEN m END AS refers_to
FROM p JOIN latest USING (x)""",
    "op4_line_dedup": """WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS l, unnest(range(len(ls))) AS line_no FROM d),
filled AS (SELECT doc_id, line_no, trim(l, ' ') AS t FROM lines WHERE trim(l, ' ') <> ''),
runs AS (SELECT doc_id, line_no AS low, lead(line_no, 2) OVER o AS high, t || chr(10) || lead(t) OVER o || chr(10) || lead(t, 2) OVER o AS run
    FROM filled WINDOW o AS (PARTITION BY doc_id ORDER BY line_no)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, low) AS n FROM runs WHERE high IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest(range(low, high + 1)) AS line_no FROM ranked WHERE n > 1),
kept AS (SELECT doc_id, string_agg(l, chr(10) ORDER BY line_no) AS left_text FROM lines ANTI JOIN gone USING (doc_id, line_no) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS c FROM gone GROUP BY doc_id)
SELECT doc_id, CASE WHEN c IS NULL THEN text ELSE coalesce(left_text, '') END AS text, coalesce(c, 0)::BIGINT AS removed_lines
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)""",
    "op12_spelling": r"""WITH RECURSIVE bits AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
pairs AS (SELECT doc_id, run, count(*) AS c, hex(encode(doc_id || ':' || run)) AS x FROM runs GROUP BY doc_id, run),
marked AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2),
    lambda i: ('0x' || substr(x, 2 * i::INT + 1, 2))::BIGINT)), lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])), 4294967295) AS h FROM pairs, bits),
w AS (SELECT word, sum(c)::BIGINT AS n FROM (SELECT c, CASE WHEN h % 97 = 0
    THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM marked)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
skipped AS (SELECT word, n, unnest(list_transform(range(length(word)), lambda i: substr(word, 1, i::INT) || chr(1) || substr(word, i::INT + 2))) AS k FROM w),
cut AS (SELECT DISTINCT word, n, unnest(list_transform(range(length(word)), lambda i: substr(word, 1, i::INT) || substr(word, i::INT + 2))) AS short FROM w),
one AS (SELECT a.word AS a, a.n AS na, b.word AS b, b.n AS nb FROM skipped a JOIN skipped b USING (k) WHERE a.word <> b.word
  UNION ALL SELECT cut.word, cut.n, w.word, w.n FROM cut JOIN w ON w.word = short
  UNION ALL SELECT w.word, w.n, cut.word, cut.n FROM cut JOIN w ON w.word = short),
best AS (SELECT a, na, count(*) AS n_near, max(nb) AS top, min(CASE WHEN nb = m THEN b END) AS b
  FROM (SELECT *, max(nb) OVER (PARTITION BY a) AS m FROM one) GROUP BY a, na),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * n THEN b END AS form, CASE WHEN top >= 2 * n THEN top END AS form_n
  FROM w LEFT JOIN best ON a = word),
walk AS (SELECT word, word AS at FROM forms UNION ALL SELECT walk.word, f.form FROM walk JOIN forms f ON f.word = walk.at WHERE f.form IS NOT NULL),
ends AS (SELECT walk.word, walk.at AS root FROM walk JOIN forms f ON f.word = walk.at WHERE f.form IS NULL)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM forms JOIN ends USING (word)""",
    "op13_ngram_join": r"""WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(len(ws) - 2), lambda i: ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3]) END) AS gram FROM d),
sizes AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM g x JOIN g y USING (gram) JOIN sizes sx ON sx.doc_id = x.doc_id JOIN sizes sy ON sy.doc_id = y.doc_id
  WHERE x.doc_id <> y.doc_id AND 10 * sx.n >= 9 * sy.n AND 10 * sy.n >= 9 * sx.n
  GROUP BY x.doc_id, y.doc_id, sx.n, sy.n HAVING 100 * count(*) >= 90 * (sx.n + sy.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = d.doc_id) AS component_id
FROM d LEFT JOIN sizes USING (doc_id)""",
}
