"""The same queries in plain SQL (DuckDB dialect), written independently of the operators."""

from __future__ import annotations

from dataclasses import replace

from docsieve.functions.cleaning import ANOMALY_SETTINGS, CLUSTERING_SETTINGS, CleaningSettings
from docsieve.functions.patterns import CONTRACTIONS
from docsieve.operators.structural import NATIVE_FEATURES

# Character classes as RE2 writes them.
W = r"\p{L}\p{N}_"
S = r"\t-\r\x1c-\x20\x85\p{Z}"
WORDS = f"[{W}]+"
TAG = "<[^>]+>"
LINK = f"https?://[^{S}]+|www\\.[^{S}]+"
MAIL = f"[{W}][{W}.+-]*@[{W}-]+\\.[{W}.-]*[{W}]"
NUMBERED = f"[{W}]*\\p{{Nd}}[{W}]*"
SYMBOL = f"[^{S}{W}]"
DIGITS = r"[\p{Nd}\x{B2}\x{B3}\x{B9}\x{2070}-\x{2079}\x{2080}-\x{2089}]"
PUNCT = f"[^\\p{{L}}\\p{{N}}{S}]"

FEATURE_LIST = ", ".join(NATIVE_FEATURES)


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def found(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, {quote(pattern)}))"


def view(text: str, settings: CleaningSettings) -> str:
    """The normalised text as one SQL expression."""
    value = f"lower(coalesce({text}, ''))"
    for short, long in CONTRACTIONS:
        value = f"replace({value}, {quote(short)}, {quote(long)})"
    removals = (
        (settings.remove_html_tags, TAG),
        (settings.remove_urls, LINK),
        (settings.remove_emails, MAIL),
        (settings.remove_digits, NUMBERED),
        (settings.remove_non_alphanumeric and not settings.preserve_structure_markers, f"[^a-z{S}]"),
    )
    for wanted, pattern in removals:
        if wanted:
            value = f"regexp_replace({value}, {quote(pattern)}, ' ', 'g')"
    tokens = f"regexp_extract_all({value}, {quote('[a-z' + chr(39) + ']+')})"
    if settings.preserve_structure_markers:
        tokens = f"list_concat({tokens}, regexp_extract_all({value}, {quote(SYMBOL)}))"
    stops = ", ".join(quote(word) for word in sorted({*settings.stop_words, *settings.extra_stop_words}))
    kept = f"list_filter({tokens}, lambda t: t NOT IN ({stops}))"
    if settings.use_lemmatization:
        kept = (
            f"list_transform({kept}, lambda t: CASE WHEN t LIKE '%ies' AND length(t) > 4 THEN t[:-4] || 'y' "
            "WHEN t LIKE '%s' AND t NOT LIKE '%ss' AND length(t) > 3 THEN t[:-2] ELSE t END)"
        )
    return f"coalesce(array_to_string(list_filter({kept}, lambda t: t <> ''), ' '), '')"


CLUSTER_VIEW = view("text", CLUSTERING_SETTINGS)
ANOMALY_VIEW = view("text", ANOMALY_SETTINGS)
PLAIN_VIEW = view("text", replace(CLUSTERING_SETTINGS, use_lemmatization=False))


def measures(table: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """CTEs ending in ``feat(id, ...)`` with the sixteen SQL-expressible measures."""
    return f"""
src AS (SELECT {key} AS id, coalesce({text}, '') AS text FROM {table}),
tok AS (SELECT id, text, regexp_extract_all(lower(text), {quote(WORDS)}) AS w FROM src),
tc AS (SELECT id, t, count(*) AS c FROM (SELECT id, unnest(w) AS t FROM tok) GROUP BY id, t),
per AS (SELECT id, sum(c) AS n, count(*) AS v, sum(CASE WHEN c > 1 THEN c ELSE 0 END) AS rep,
               sum(c * length(t)) AS letters FROM tc GROUP BY id),
ent AS (SELECT tc.id, -sum((c / n) * ln(c / n + 1e-9)) AS h FROM tc JOIN per USING (id) GROUP BY tc.id),
pos AS (SELECT id, unnest(w) AS t, unnest(range(len(w))) AS i FROM tok),
run AS (SELECT id, max(cnt) AS longest FROM (
          SELECT id, t, g, count(*) AS cnt FROM (
            SELECT id, t, i - row_number() OVER (PARTITION BY id, t ORDER BY i) AS g FROM pos)
          GROUP BY id, t, g) GROUP BY id),
feat AS (SELECT tok.id,
  greatest(length(text), 1)::DOUBLE AS char_count,
  greatest(len(w), 1)::DOUBLE AS token_count,
  coalesce(letters, 0) / greatest(len(w), 1) AS average_token_length,
  coalesce(v, 0) / greatest(len(w), 1) AS type_token_ratio,
  CASE WHEN len(w) = 0 THEN 0.0 ELSE rep / n END AS repeated_token_ratio,
  coalesce(longest, 0)::DOUBLE AS max_token_run,
  CASE WHEN len(w) = 0 OR ln(v + 1e-9) <= 0 THEN 0.0 ELSE h / ln(v + 1e-9) END AS lexical_entropy,
  {found('text', chr(92) + 'p{Lu}')} / greatest(length(text), 1) AS uppercase_ratio,
  {found('text', DIGITS)} / greatest(length(text), 1) AS digit_ratio,
  {found('text', PUNCT)} / greatest(length(text), 1) AS punctuation_ratio,
  {found('lower(text)', LINK)}::DOUBLE AS url_count,
  {found('text', MAIL)}::DOUBLE AS email_count,
  {found('text', TAG)}::DOUBLE AS html_tag_count,
  len(list_filter(regexp_extract_all(text, {quote(WORDS)}),
      lambda x: regexp_matches(x, '[a-zA-Z]') AND regexp_matches(x, '\\p{{Nd}}'))) / greatest(len(w), 1)
      AS mixed_alnum_token_ratio,
  {found('text', chr(92) + '{[^}]+' + chr(92) + '}')} / greatest(len(w), 1) AS placeholder_token_ratio,
  CASE WHEN len(w) < 2 THEN 1.0 ELSE len(list_distinct(list_transform(range(1, len(w)),
      lambda i: w[i] || ' ' || w[i + 1]))) / (len(w) - 1) END AS bigram_type_token_ratio
  FROM tok LEFT JOIN per USING (id) LEFT JOIN ent USING (id) LEFT JOIN run USING (id))"""


FEAT = measures()
LONG = f"long AS (UNPIVOT (SELECT id, {FEATURE_LIST} FROM feat) ON {FEATURE_LIST} INTO NAME feature VALUE value)"


def rounded_features(key: str) -> str:
    return f"SELECT id AS {key}, " + ", ".join(f"round({f}, 6) AS {f}" for f in NATIVE_FEATURES) + " FROM feat"


def score(name: str, alias: str = "s") -> str:
    return f"{alias} AS (SELECT id AS doc_id, round({name}, 9) AS score FROM feat)"


def ranked(source: str, alias: str, start: int = 1) -> str:
    shift = "" if start else " - 1"
    return f"{alias} AS (SELECT *, row_number() OVER (ORDER BY score, doc_id){shift} AS r FROM {source})"


def word_counts(source: str, key: str, text: str, sizes: str, alias: str = "counts") -> str:
    """``alias(key, term, tf)`` of word n-grams with the sizes listed."""
    parts = []
    for n in sizes.split(","):
        gram = " || ' ' || ".join(f"ws[i + {j}]" for j in range(int(n)))
        parts.append(
            f"SELECT {key}, unnest(list_transform(range(1, len(ws) - {int(n) - 2}), lambda i: {gram})) AS term FROM words_{alias}"
        )
    return f"""
words_{alias} AS (SELECT {key}, regexp_extract_all({text}, '[{W}]{{2,}}') AS ws FROM {source}),
{alias} AS (SELECT {key}, term, count(*) AS tf FROM ({' UNION ALL '.join(parts)}) GROUP BY {key}, term)"""


def vocabulary(cap: int, low: float, high: str, counts: str = "counts", alias: str = "vocab") -> str:
    return f"""
{alias} AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id, df, total_tf FROM (
  SELECT term, count(*) AS df, sum(tf)::BIGINT AS total_tf FROM {counts} GROUP BY term
  HAVING count(*) >= {low} AND count(*) <= {high} ORDER BY total_tf DESC, term LIMIT {cap}))"""


N = "(SELECT count(*) FROM documents)"
VIEWS = f"views AS (SELECT doc_id, lang, text, {CLUSTER_VIEW} AS view FROM documents)"
TOPIC = f"""{VIEWS},{word_counts('views', 'doc_id', 'view', '1,2')},
{vocabulary(20000, 1, f'0.92 * {N}')},
raw AS (SELECT doc_id, term, (1 + ln(tf)) * (ln((1.0 + {N}) / (1.0 + df)) + 1) AS w FROM counts JOIN vocab USING (term)),
tfidf AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""

EMB = """emb AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
dist AS (SELECT a.vec_id AS i, b.vec_id AS j, a.label AS li, b.label AS lj,
  list_distance(a.e, b.e) AS d, 1 - list_cosine_similarity(a.e, b.e) AS c FROM emb a, emb b WHERE a.vec_id <> b.vec_id)"""

KNN = """knn AS (SELECT i, j, c, row_number() OVER (PARTITION BY i ORDER BY c, j) AS r FROM dist)"""


def feature_pairs() -> str:
    """Distances between all documents on the sixteen measures."""
    vector = "[" + ", ".join(f"round({f}, 9)" for f in NATIVE_FEATURES) + "]"
    return f"""pts AS (SELECT id, {vector}::DOUBLE[] AS e FROM feat),
pair AS (SELECT a.id AS i, b.id AS j, list_distance(a.e, b.e) AS d,
  1 - list_cosine_similarity(a.e, b.e) AS c FROM pts a, pts b WHERE a.id <> b.id)"""


LOF = """near AS (SELECT i, j, d FROM pair QUALIFY row_number() OVER (PARTITION BY i ORDER BY d, j) <= 20),
kd AS (SELECT i, max(d) AS k FROM near GROUP BY i),
lrd AS (SELECT near.i, 1 / (avg(greatest(d, kd.k)) + 1e-10) AS l FROM near JOIN kd ON kd.i = near.j GROUP BY near.i),
lof AS (SELECT near.i AS doc_id, -avg(b.l) / any_value(a.l) AS score FROM near JOIN lrd b ON b.i = near.j
  JOIN lrd a ON a.i = near.i GROUP BY near.i)"""


def silhouette_rows(label_i: str, label_j: str, distance: str, source: str = "dist") -> str:
    """CTEs ending in ``sil(i, l, s)``."""
    return f"""
lab AS (SELECT i, j, {label_i} AS a, {label_j} AS b, {distance} AS x FROM {source}),
tot AS (SELECT i, a, b, sum(x) AS t, count(*) AS n FROM lab GROUP BY i, a, b),
ab AS (SELECT i, a AS l, max(CASE WHEN a = b THEN t / n END) AS inside, min(CASE WHEN a <> b THEN t / n END) AS outside
  FROM tot GROUP BY i, a),
sil AS (SELECT i, l, CASE WHEN inside IS NULL THEN 0 ELSE (outside - inside) / greatest(outside, inside) END AS s FROM ab)"""


def metric_table(counts: tuple[int, ...]) -> str:
    """CTEs ending in ``metrics(method, cluster_count, silhouette_score, max_cluster_size)``."""
    parts, ctes = [], []
    for method, column in (("by_id", "id"), ("by_label", "label")):
        for k in counts:
            li = f"i % {k}" if column == "id" else f"li % {k}"
            lj = f"j % {k}" if column == "id" else f"lj % {k}"
            own = f"vec_id % {k}" if column == "id" else f"label % {k}"
            tag = f"{method}{k}"
            body = silhouette_rows(li, lj, "d")
            for name in ("lab", "tot", "ab", "sil"):
                body = body.replace(f"{name} AS (", f"{name}_{tag} AS (").replace(f"FROM {name} ", f"FROM {name}_{tag} ")
            body = body.replace("FROM ab)", f"FROM ab_{tag})")
            ctes.append(body)
            parts.append(
                f"SELECT '{method}' AS method, {k}::INTEGER AS cluster_count, (SELECT round(avg(s), 6) FROM sil_{tag}) AS silhouette_score, "
                f"(SELECT max(n) FROM (SELECT count(*) AS n FROM emb GROUP BY {own})) AS max_cluster_size"
            )
    return f"{EMB},{','.join(ctes)},\nmetrics AS ({' UNION ALL '.join(parts)})"


def label_merges(linkage: str, rounds: int = 7) -> str:
    """The label means of the embeddings, the two nearest groups merged in each round."""
    if linkage == "ward":
        unit = "v"
        mean_a, mean_b = ("list_transform({0}.s, lambda x: x / {0}.n)".format(side) for side in "ab")
        cost = f"a.n * b.n / (a.n + b.n) * list_distance({mean_a}, {mean_b}) ** 2"
    else:
        unit = "list_transform(v, lambda x: x / sqrt(list_inner_product(v, v)))"
        cost = "1 - list_inner_product(a.s, b.s) / (a.n * b.n)"
    steps = []
    for r in range(rounds):
        steps.append(f"""
near{r} AS (SELECT a.slot AS i, b.slot AS j FROM g{r} a JOIN g{r} b ON a.slot < b.slot ORDER BY {cost}, i, j LIMIT 1),
g{r + 1} AS (SELECT slot, n, s, topics FROM g{r}, near{r} WHERE slot <> i AND slot <> j UNION ALL
  SELECT i, a.n + b.n, list_transform(list_zip(a.s, b.s), lambda z: z[1] + z[2]), list_concat(a.topics, b.topics)
  FROM near{r} JOIN g{r} a ON a.slot = i JOIN g{r} b ON b.slot = j)""")
    return f"""WITH u AS (SELECT label, unnest(embedding::DOUBLE[]) AS x, unnest(range(len(embedding))) AS p FROM embeddings),
m AS (SELECT label, list(x ORDER BY p) AS v FROM (SELECT label, p, round(avg(x), 6) AS x FROM u GROUP BY label, p) GROUP BY label),
g0 AS (SELECT label AS slot, 1::DOUBLE AS n, {unit} AS s, [label::BIGINT] AS topics FROM m),{",".join(steps)}
SELECT unnest(topics) AS topic, label FROM (SELECT topics, (row_number() OVER (ORDER BY slot) - 1)::INTEGER AS label FROM g{rounds})"""


def _snippet(text: str, length: int) -> str:
    return f"replace(substring({text}, 1, {length}), chr(10), ' ')"


def sql() -> dict[str, str]:
    f3 = f"""{FEAT}, {score('bigram_type_token_ratio', 's1')}, {score('lexical_entropy', 's2')},
{score('average_token_length', 's3')}, {ranked('s1', 'r1')}, {ranked('s2', 'r2')}, {ranked('s3', 'r3')}"""
    metrics = metric_table(tuple(range(2, 11)))
    describe = ", ".join(
        f"round(quantile_cont(value, {p}), 6) AS {name}"
        for p, name in ((0.05, "p5"), (0.25, "p25"), (0.5, "median"), (0.75, "p75"), (0.95, "p95"))
    )
    place = "CASE feature " + " ".join(f"WHEN '{f}' THEN {i}" for i, f in enumerate(NATIVE_FEATURES)) + " END"
    corr = f"""{FEAT}, {LONG}, spread AS (SELECT feature, min(value) = max(value) AS flat, {place} AS place FROM long GROUP BY feature),
pairs AS (SELECT a.feature AS feature_a, b.feature AS feature_b, corr(a.value, b.value) AS c FROM long a JOIN long b USING (id)
  GROUP BY a.feature, b.feature),
cm AS (SELECT feature_a, feature_b, CASE WHEN x.flat OR y.flat THEN NULL ELSE round(c, 6) END AS correlation, x.place AS pa, y.place AS pb
  FROM pairs JOIN spread x ON x.feature = feature_a JOIN spread y ON y.feature = feature_b)"""
    tails = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(quantile_cont({f}, 0.05), 6) AS lower_quantile, "
        f"count(*) FILTER ({f} <= (SELECT quantile_cont({f}, 0.05) FROM feat)) AS at_or_below_quantile, "
        f"0.5::DOUBLE AS threshold, count(*) FILTER ({f} < 0.5) AS below_threshold FROM feat"
        for f in ("bigram_type_token_ratio", "type_token_ratio", "lexical_entropy")
    )
    clipped = f"""{TOPIC},
sizes AS (SELECT lang AS label, count(*) AS n FROM documents GROUP BY lang),
means AS (SELECT lang AS label, term, sum(weight) / any_value(n) AS weight FROM tfidf JOIN documents USING (doc_id)
  JOIN sizes ON sizes.label = lang GROUP BY lang, term)"""
    overlaps = []
    for group in (("bigram", "entropy"), ("bigram", "length"), ("entropy", "length"), ("bigram", "entropy", "length")):
        overlaps.append(
            f"SELECT '{'&'.join(group)}' AS sets, count(*) FILTER ({' AND '.join(group)}) AS overlap, "
            f"count(*) FILTER ({' OR '.join(group)}) AS union_size FROM m"
        )
    result = {
        "load_articles": "SELECT doc_id::VARCHAR AS doc_id, coalesce(text, '') AS text FROM documents",
        "load_embedding_table": "SELECT vec_id, len(embedding)::INTEGER AS dimensions, round(list_sum(embedding::DOUBLE[]), 4) AS component_sum FROM embeddings",
        "clustering_view": f"SELECT doc_id, {CLUSTER_VIEW} AS clustering_text FROM documents",
        "anomaly_view": f"SELECT doc_id, {ANOMALY_VIEW} AS anomaly_text FROM documents",
        "strip_html_view": f"SELECT page_id, {view('html', CLUSTERING_SETTINGS)} AS clustering_text, {view('html', ANOMALY_SETTINGS)} AS anomaly_text FROM pages",
        "conversation_views": f"SELECT conv_id, turn, {CLUSTER_VIEW} AS clustering_text, {ANOMALY_VIEW} AS anomaly_text FROM conversations",
        "normalization_preview": f"SELECT doc_id, text, {CLUSTER_VIEW} AS clustering_text, {ANOMALY_VIEW} AS anomaly_text FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 5)",
        "normalization_compare": f"""WITH {VIEWS}, t AS (SELECT sum({found('lower(text)', WORDS)})::DOUBLE AS raw,
  sum({found('view', f'[^{S}]+')})::DOUBLE AS kept FROM views)
SELECT raw AS raw_token_count, kept AS normalized_token_count, round(1 - kept / raw, 6) AS token_reduction_ratio FROM t""",
        "structural_features_16": f"WITH {FEAT} {rounded_features('doc_id')}",
        "structural_features_pages": f"WITH {measures('pages', 'page_id', 'html')} {rounded_features('page_id')}",
        "feature_describe": f"""WITH {FEAT}, {LONG} SELECT feature, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
round(min(value), 6) AS min, {describe}, round(max(value), 6) AS max FROM long GROUP BY feature""",
        "feature_histogram": f"""WITH {FEAT}, x AS (SELECT type_token_ratio AS v FROM feat),
b AS (SELECT min(v) AS lo, (max(v) - min(v)) / 50 AS w FROM x),
h AS (SELECT least(floor((v - lo) / w), 49)::INTEGER AS bin, count(*) AS n FROM x, b GROUP BY 1)
SELECT g.i::INTEGER AS bin, round(lo + g.i * w, 6) AS bin_start, round(lo + (g.i + 1) * w, 6) AS bin_end, coalesce(n, 0) AS count
FROM range(50) g(i) CROSS JOIN b LEFT JOIN h ON h.bin = g.i""",
        "feature_tails": f"WITH {FEAT} {tails}",
        "feature_tail_rows": f"""WITH {FEAT} SELECT id AS doc_id, round(bigram_type_token_ratio, 6) AS bigram_type_token_ratio FROM feat
WHERE bigram_type_token_ratio <= (SELECT quantile_cont(bigram_type_token_ratio, 0.05) FROM feat)""",
        "feature_corr": f"WITH {corr} SELECT feature_a, feature_b, correlation FROM cm",
        "strong_pairs": f"WITH {corr} SELECT feature_a, feature_b, correlation FROM cm WHERE abs(correlation) > 0.8 AND pa > pb",
        "extreme_docs": f"""WITH {FEAT}, {LONG}, lowest AS (SELECT feature, id, value FROM long
  QUALIFY row_number() OVER (PARTITION BY feature ORDER BY round(value, 9), id) = 1)
SELECT feature, id AS doc_id, round(value, 6) AS value, {_snippet('text', 200)} AS snippet FROM lowest JOIN documents ON doc_id = id""",
        "lowest_5": f"""WITH {FEAT}, {score('type_token_ratio')} SELECT doc_id, round(score, 6) AS type_token_ratio, {_snippet('text', 400)} AS snippet
FROM (SELECT * FROM s ORDER BY score, doc_id LIMIT 5) JOIN documents USING (doc_id)""",
        "separation_table": f"""WITH {FEAT}, {LONG}, m AS (SELECT feature, avg(value) FILTER (toxic = 1) AS f, avg(value) FILTER (toxic = 0) AS n
  FROM long JOIN labels ON doc_id = id GROUP BY feature)
SELECT feature, round(f, 6) AS flagged_mean, round(n, 6) AS normal_mean, round(f / (n + 1e-9), 3) AS ratio FROM m""",
        "vocabulary": f"WITH {VIEWS},{word_counts('views', 'doc_id', 'view', '1,2')},{vocabulary(20000, 1, f'0.92 * {N}')} SELECT * FROM vocab",
        "bag_of_words": f"""WITH {VIEWS},{word_counts('views', 'doc_id', 'view', '1')},{vocabulary(20000, 1, N)}
SELECT doc_id, term, term_id, tf FROM counts JOIN vocab USING (term)""",
        "term_popularity": f"""WITH {VIEWS},{word_counts('views', 'doc_id', 'view', '1')}
SELECT term, sum(tf)::BIGINT AS total_tf, row_number() OVER (ORDER BY sum(tf) DESC, term) AS term_rank FROM counts GROUP BY term""",
        "bow_preview": f"""WITH {VIEWS},{word_counts('views', 'doc_id', 'view', '1')},{vocabulary(20000, 2, f'0.95 * {N}')},
top AS (SELECT term FROM vocab ORDER BY total_tf DESC, term LIMIT 20), first AS (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 12)
SELECT doc_id, term, coalesce(tf, 0) AS tf FROM first CROSS JOIN top LEFT JOIN counts USING (doc_id, term)""",
        "word_bigrams": f"""WITH {VIEWS},{word_counts('views', 'doc_id', 'view', '2')}
SELECT term, count(*) AS df, sum(tf)::BIGINT AS total_tf FROM counts GROUP BY term""",
        "char_wb_ngrams": f"""WITH views AS (SELECT doc_id, {ANOMALY_VIEW} AS view FROM documents),
wd AS (SELECT doc_id, ' ' || p || ' ' AS p, count(*) AS c FROM (SELECT doc_id, unnest(regexp_extract_all(view, '[^{S}]+')) AS p FROM views) GROUP BY ALL),
sized AS (SELECT doc_id, p, c, unnest([3, 4, 5]) AS n FROM wd),
gram AS (SELECT doc_id, c, unnest(list_transform(range(1, greatest(length(p) - n, 0) + 2), lambda i: substring(p, i, n))) AS term
  FROM sized WHERE n = 3 OR n <= length(p)),
counts AS (SELECT doc_id, term, sum(c) AS tf FROM gram GROUP BY doc_id, term),
{vocabulary(30000, 1, N)} SELECT * FROM vocab""",
        "feature_names": f"WITH {VIEWS},{word_counts('views', 'doc_id', 'view', '1,2')},{vocabulary(20000, 1, f'0.92 * {N}')} SELECT term_id, term FROM vocab",
        "lemma_view": f"""WITH lex AS (SELECT DISTINCT unnest(string_split({PLAIN_VIEW}, ' ')) AS token FROM benchmark),
tok AS (SELECT doc_id, unnest(ws) AS token, unnest(range(len(ws))) AS place FROM (SELECT doc_id, string_split({PLAIN_VIEW}, ' ') AS ws FROM documents))
SELECT doc_id, string_agg(CASE WHEN lex.token IS NULL THEN tok.token ELSE substring(tok.token, 1, 4) END, ' ' ORDER BY place) AS normalized_text
FROM tok LEFT JOIN lex USING (token) GROUP BY doc_id""",
        "random_baseline": "SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id::VARCHAR), doc_id LIMIT 50",
        "lof_detection": f"""WITH {FEAT}, {feature_pairs()}, {LOF}
SELECT doc_id, score < (SELECT quantile_cont(score, 0.02) FROM lof) AS is_anomaly FROM lof""",
        "knn_detection": f"""WITH {EMB}, {KNN}, s AS (SELECT i AS vec_id, avg(c) AS d FROM knn WHERE r <= 5 GROUP BY i)
SELECT vec_id, d >= (SELECT quantile_cont(d, 0.98) FROM s) AS is_anomaly FROM s""",
        "ward_label_means": label_merges("ward"),
        "average_label_means": label_merges("average"),
        "job_bag_of_words": f"""WITH {VIEWS},{word_counts('views', 'doc_id', 'view', '1')},{vocabulary(20000, 1, N)},
rk AS (SELECT term, row_number() OVER (ORDER BY total_tf DESC, term) AS r FROM vocab),
cell AS (SELECT doc_id, map(list(r), list(tf)) AS m FROM counts JOIN rk USING (term) GROUP BY doc_id)
SELECT 'doc_id,' || (SELECT string_agg(term, ',' ORDER BY r) FROM rk) AS line
UNION ALL SELECT d.doc_id::VARCHAR || ',' || array_to_string(list_transform(range(1, (SELECT count(*) FROM rk) + 1),
  lambda i: coalesce(m[i], 0)), ',') FROM documents d LEFT JOIN cell USING (doc_id)""",
        "tfidf": f"WITH {TOPIC} SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf",
        "tfidf_transform_new": f"""WITH {VIEWS},{word_counts('views', 'doc_id', 'view', '1,2')},{vocabulary(20000, 1, f'0.92 * {N}')},
fresh AS (SELECT item_id, {CLUSTER_VIEW} AS view FROM benchmark),{word_counts('fresh', 'item_id', 'view', '1,2', 'fc')},
raw AS (SELECT item_id, term, (1 + ln(tf)) * (ln((1.0 + {N}) / (1.0 + df)) + 1) AS w FROM fc JOIN vocab USING (term))
SELECT item_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY item_id)), 6) AS weight FROM raw""",
        "term_matrix_lines": f"""WITH {VIEWS},{word_counts('views', 'doc_id', 'view', '1')},{vocabulary(20000, 1, N)},
rk AS (SELECT term, row_number() OVER (ORDER BY total_tf DESC, term) AS r FROM vocab),
cell AS (SELECT doc_id, map(list(r), list(tf)) AS m FROM counts JOIN rk USING (term) GROUP BY doc_id)
SELECT d.doc_id, d.doc_id::VARCHAR || ',' || array_to_string(list_transform(range(1, (SELECT count(*) FROM rk) + 1),
  lambda i: coalesce(m[i], 0)), ',') AS line FROM documents d LEFT JOIN cell USING (doc_id)""",
        "concat_and_slice": """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), b AS (SELECT vec_id, list_concat(e, e[-8:]) AS e FROM v)
SELECT vec_id, len(e)::INTEGER AS dimensions, round(list_sum(e), 4) AS component_sum FROM b""",
        "knn_cosine": f"WITH {EMB}, {KNN} SELECT i AS vec_id, j AS neighbor_id, round(c, 6) AS distance, r::INTEGER AS neighbor_rank FROM knn WHERE r <= 5",
        "knn_euclidean": f"""WITH {FEAT}, {feature_pairs()} SELECT i AS doc_id, j AS neighbor_id, round(d, 6) AS distance,
row_number() OVER (PARTITION BY i ORDER BY d, j)::INTEGER AS neighbor_rank FROM pair QUALIFY neighbor_rank <= 5""",
        "knn_score": f"WITH {EMB}, {KNN} SELECT i AS vec_id, round(-avg(c), 6) AS score FROM knn WHERE r <= 5 GROUP BY i",
        "lof_score": f"WITH {FEAT}, {feature_pairs()}, {LOF} SELECT doc_id, round(score, 6) AS score FROM lof",
        "affinity_graph": f"""WITH {EMB}, near AS (SELECT i AS src, j AS dst FROM dist QUALIFY row_number() OVER (PARTITION BY i ORDER BY d, j) <= 5
  UNION ALL SELECT vec_id, vec_id FROM emb), edge AS (SELECT src, dst FROM near UNION ALL SELECT dst, src FROM near)
SELECT src, dst, (count(*) * 0.5)::DOUBLE AS weight FROM edge GROUP BY src, dst""",
        "upper_quantile_mask": f"""WITH {EMB}, {KNN}, s AS (SELECT i AS vec_id, round(-avg(c), 9) AS score FROM knn WHERE r <= 5 GROUP BY i)
SELECT vec_id, round(score, 6) AS score, -score >= (SELECT quantile_cont(-score, 0.95) FROM s) AS is_anomaly FROM s""",
        "rank_normalized": f"""WITH {FEAT}, {score('lexical_entropy')}, {ranked('s', 'r', 0)}
SELECT doc_id, round(r.r / greatest({N} - 1, 1), 6) AS rank_score FROM r""",
        "rank_average": f"""WITH {FEAT}, {feature_pairs()}, {LOF},
k1 AS (SELECT i AS doc_id, round(-avg(c), 9) AS score FROM (SELECT i, j, c FROM pair QUALIFY row_number() OVER (PARTITION BY i ORDER BY c, j) <= 5) GROUP BY i),
k2 AS (SELECT doc_id, round(score, 6) AS score FROM lof), {score('bigram_type_token_ratio', 'k3')},
{ranked('k1', 'q1', 0)}, {ranked('k2', 'q2', 0)}, {ranked('k3', 'q3', 0)}
SELECT doc_id, round((q1.r + q2.r + q3.r) / 3.0 / ({N} - 1), 6) AS score FROM q1 JOIN q2 USING (doc_id) JOIN q3 USING (doc_id)""",
        "contamination_mask": f"""WITH {FEAT}, {score('lexical_entropy')}
SELECT doc_id, round(score, 6) AS score, score < (SELECT quantile_cont(score, 0.02) FROM s) AS is_anomaly FROM s""",
        "ensemble_mask": f"""WITH {f3}, e AS (SELECT doc_id, round((r1.r + r2.r + r3.r - 3) / 3.0 / ({N} - 1), 9) AS score
  FROM r1 JOIN r2 USING (doc_id) JOIN r3 USING (doc_id))
SELECT doc_id, round(score, 6) AS score, score <= (SELECT quantile_cont(score, 0.02) FROM e) AS is_anomaly FROM e""",
        "threshold_score": f"""WITH {FEAT}, {score('bigram_type_token_ratio')}, {ranked('s', 'r', 0)}
SELECT round(score, 6) AS threshold FROM r WHERE r.r = floor({N} * 0.025)""",
        "anomaly_top_k": f"WITH {FEAT}, {score('bigram_type_token_ratio')}, {ranked('s', 'r')} SELECT r.r AS anomaly, doc_id FROM r WHERE r.r <= 50",
        "anomaly_by_mask": f"""WITH {FEAT}, {score('bigram_type_token_ratio')}, m AS (SELECT * FROM s WHERE score < (SELECT quantile_cont(score, 0.1) FROM s)),
{ranked('m', 'r')} SELECT r.r AS anomaly, doc_id FROM r""",
        "candidate_table": f"""WITH {FEAT}, {score('type_token_ratio')}, {ranked('s', 'r')}
SELECT doc_id, round(score, 6) AS score, score < (SELECT quantile_cont(score, 0.02) FROM s) AS predicted_anomaly, r.r AS anomaly_rank FROM r""",
        "top_k_snippets": f"""WITH {FEAT}, {score('type_token_ratio')}, {ranked('s', 'r')}
SELECT doc_id, round(score, 6) AS score, r.r AS anomaly_rank, {_snippet('text', 220)} AS snippet FROM r JOIN documents USING (doc_id) WHERE r.r <= 10""",
        "attach_texts": "SELECT labels.doc_id, quality, coalesce(text, '') AS text FROM labels LEFT JOIN documents USING (doc_id)",
        "side_by_side": f"""WITH {f3} SELECT r1.r AS rank, r1.doc_id AS left_doc_id, round(r1.score, 6) AS left_score, a.text AS left_text,
r2.doc_id AS right_doc_id, round(r2.score, 6) AS right_score, b.text AS right_text
FROM r1 JOIN r2 ON r1.r = r2.r JOIN documents a ON a.doc_id = r1.doc_id JOIN documents b ON b.doc_id = r2.doc_id WHERE r1.r <= 10""",
        "overlap_sets": f"""WITH {f3}, m AS (SELECT r1.r <= 50 AS bigram, r2.r <= 50 AS entropy, r3.r <= 50 AS length
  FROM r1 JOIN r2 USING (doc_id) JOIN r3 USING (doc_id)) {' UNION ALL '.join(overlaps)}""",
        "overlap_curve": f"""WITH {f3} SELECT k::INTEGER AS top_k, count(*) FILTER (greatest(r1.r, r2.r) <= k) AS overlap_count
FROM r1 JOIN r2 USING (doc_id), (SELECT unnest([10, 25, 50, 75, 100]) AS k) GROUP BY k""",
        "spearman": f"""WITH {f3}, a AS (SELECT doc_id, avg(r) OVER (PARTITION BY score) AS x FROM r1),
b AS (SELECT doc_id, avg(r) OVER (PARTITION BY score) AS y FROM r3)
SELECT round(corr(x, y), 6) AS spearman_score_correlation,
  (SELECT count(*) FROM s1 WHERE score < (SELECT quantile_cont(score, 0.02) FROM s1)) AS left_predicted_anomaly_count,
  (SELECT count(*) FROM s3 WHERE score < (SELECT quantile_cont(score, 0.02) FROM s3)) AS right_predicted_anomaly_count
FROM a JOIN b USING (doc_id)""",
        "detector_profile": f"""WITH {f3}, t AS (SELECT 'bigram' AS detector, doc_id FROM r1 WHERE r <= 50 UNION ALL
  SELECT 'entropy', doc_id FROM r2 WHERE r <= 50 UNION ALL SELECT 'length', doc_id FROM r3 WHERE r <= 50 UNION ALL SELECT 'baseline', id FROM feat)
SELECT detector, round(avg(bigram_type_token_ratio), 3) AS mean_bigram_type_token_ratio,
  round(avg(repeated_token_ratio), 3) AS mean_repeated_token_ratio FROM t JOIN feat ON id = doc_id GROUP BY detector""",
        "set_cosine_spread": f"""WITH {FEAT}, {feature_pairs()}, {score('bigram_type_token_ratio')}, {ranked('s', 'r')}
SELECT round(avg(c), 4) AS mean_internal_cosine_distance FROM pair JOIN r a ON a.doc_id = i JOIN r b ON b.doc_id = j WHERE a.r <= 50 AND b.r <= 50""",
        "silhouette_euclidean": f"WITH {EMB},{silhouette_rows('li', 'lj', 'd')} SELECT round(avg(s), 6) AS silhouette FROM sil",
        "silhouette_squared": f"WITH {EMB},{silhouette_rows('li', 'lj', 'd * d')} SELECT round(avg(s), 6) AS silhouette FROM sil",
        "silhouette_by_cluster": f"WITH {EMB},{silhouette_rows('li', 'lj', 'd')} SELECT l AS label, round(avg(s), 6) AS silhouette FROM sil GROUP BY l",
        "cluster_sizes": "SELECT label, count(*) AS size, max(count(*)) OVER () AS max_size FROM embeddings GROUP BY label",
        "metric_rows": f"WITH {metrics} SELECT *, max_cluster_size < 260 AS size_constraint_ok, NULL::VARCHAR AS error FROM metrics",
        "size_filter": f"WITH {metrics} SELECT method, cluster_count, max_cluster_size FROM metrics WHERE max_cluster_size < 240 AND silhouette_score IS NOT NULL",
        "violating_runs": f"WITH {metrics} SELECT method, cluster_count, max_cluster_size FROM metrics WHERE max_cluster_size >= 240",
        "best_per_group": f"""WITH {metrics} SELECT method, cluster_count, silhouette_score FROM metrics
QUALIFY row_number() OVER (PARTITION BY method ORDER BY silhouette_score DESC, cluster_count) = 1""",
        "global_best": f"""WITH {metrics} SELECT method, cluster_count, silhouette_score FROM metrics WHERE max_cluster_size < 1300
ORDER BY silhouette_score DESC, method, cluster_count LIMIT 1""",
        "wide_labels": "SELECT vec_id, (label % 2)::INTEGER AS by_label_k2, (label % 5)::INTEGER AS by_label_k5 FROM embeddings",
        "nearest_to_centroid": """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT vec_id, label, unnest(e) AS x, unnest(range(len(e))) AS p FROM e),
m AS (SELECT label, p, avg(x) AS m FROM u GROUP BY label, p),
d AS (SELECT vec_id, u.label, 1 - sum(x * m) / sqrt(sum(x * x)) / sqrt(sum(m * m)) AS c FROM u JOIN m USING (label, p) GROUP BY vec_id, u.label)
SELECT label, 1::INTEGER AS representative_rank, vec_id, round(c, 6) AS distance_to_centroid FROM d
QUALIFY row_number() OVER (PARTITION BY label ORDER BY round(c, 12), vec_id) = 1""",
        "cluster_top_terms": f"""WITH {clipped} SELECT label, row_number() OVER (PARTITION BY label ORDER BY round(weight, 12) DESC, term)::INTEGER AS term_rank,
term, round(weight, 6) AS weight FROM means QUALIFY term_rank <= 12""",
        "cluster_top_terms_no_noise": f"""WITH {clipped},
items AS (SELECT item_id, {CLUSTER_VIEW} AS view FROM benchmark),{word_counts('items', 'item_id', 'view', '1', 'ic')},
noise AS (SELECT term FROM ic GROUP BY term HAVING count(*) >= 0.2 * (SELECT count(*) FROM benchmark))
SELECT label, upper(label) AS topic, row_number() OVER (PARTITION BY label ORDER BY round(weight, 12) DESC, term)::INTEGER AS term_rank,
term, round(weight, 6) AS weight FROM means WHERE term NOT IN (SELECT term FROM noise) QUALIFY term_rank <= 8""",
        "representative_docs": f"""WITH {clipped}, len AS (SELECT label, sqrt(sum(weight * weight)) AS l FROM means GROUP BY label),
dot AS (SELECT t.doc_id, sum(t.weight * m.weight) AS x FROM tfidf t JOIN documents d USING (doc_id) JOIN means m ON m.label = d.lang AND m.term = t.term GROUP BY t.doc_id),
dd AS (SELECT d.doc_id, d.lang AS label, d.text, 1 - coalesce(x, 0) / l AS c FROM documents d JOIN len ON len.label = d.lang LEFT JOIN dot USING (doc_id))
SELECT label, row_number() OVER (PARTITION BY label ORDER BY round(c, 12), doc_id)::INTEGER AS representative_rank, doc_id,
round(c, 6) AS distance_to_centroid, {_snippet('text', 220)} AS snippet FROM dd QUALIFY representative_rank <= 5""",
    }
    # The same results whatever the size of cells and pieces.
    for name in ("knn_cosine", "knn_euclidean", "knn_score", "lof_score", "affinity_graph"):
        result[f"{name}_cells"] = result[name]
    result["silhouette_pieces"] = result["silhouette_euclidean"]
    for name, table_name, text in (("corpus_summary", "documents", "text"), ("corpus_summary_pages", "pages", "html")):
        result[name] = f"""SELECT count(*) AS document_count, round(avg(length({text})), 6) AS average_character_count,
round(avg({found(text, WORDS)}), 6) AS average_word_count, count(*) FILTER (regexp_matches({text}, {quote(TAG)})) AS html_like_document_count,
count(*) FILTER ({found(text, SYMBOL)} / greatest(length({text}), 1) > 0.15) AS symbol_heavy_document_count FROM {table_name}"""
    return result
