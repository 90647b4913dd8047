"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprints, licenses, line_dedup, media, minhash, mixing, packing, quality, search, spelling, token_counts, toxicity, url_filter
from .common import UPPER, WORD, read, text_key

#: The contract's rules: verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Sites whose pages, as far as the table has them, make up the list of blocked URLs.
LISTED_SITES = ["adult-x", "casino-win", "cheap-pills", "spam-farm"]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.label_chain(docs, read(spark, sf_dir, "labels"))
    toxic = F.col("p_toxic") >= model.thresholds[1]
    return toxicity.score(docs, model, keep_text=False).withColumns({"toxic": toxic, "kept": ~toxic})


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), token_counts.public_scores())


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), size=2).drop("text_key")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, quality.fit(docs, read(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("p_quality", 6).alias("p_quality"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"), licenses.known_digests(spark))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack(read(spark, sf_dir, "documents"), packing.public_encoder()))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    listed = pages.select("url").filter(F.arrays_overlap(F.split(url_filter.url_host(F.col("url")), r"\."), F.array(*map(F.lit, LISTED_SITES))))
    return url_filter.filter_urls(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    marked = line_dedup.beside_removed(docs.select("doc_id", text_key(F.col("text")).alias("text_key")), line_dedup.repeated_lines(docs))
    return marked.select("doc_id", F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"), F.array_join(F.coalesce("_gone", F.array().cast("array<int>")), ",").alias("removed_lines"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")).drop("n_chars")


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digests(media.document_media(read(spark, sf_dir, "documents")))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(read(spark, sf_dir, "documents"), written=spelling.with_lost_letters))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_token_counts": op2_token_counts,
    "op3_minhash": op3_minhash,
    "op4_quality": op4_quality,
    "op5_licenses": op5_licenses,
    "op6_packing": op6_packing,
    "op7_url_filter": op7_url_filter,
    "op8_line_dedup": op8_line_dedup,
    "op9_mixing": op9_mixing,
    "op10_media": op10_media,
    "op11_search": op11_search,
    "op12_spelling": op12_spelling,
    "op13_fingerprints": op13_fingerprints,
}

_OP7 = f"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(coalesce(rest, ''), '^[^?#]*\\?([^#]*)', 1) AS query
  FROM u
), k AS (
  SELECT *, regexp_replace(regexp_replace(query, '(^|&)utm_[^&]*', '', 'g'), '^&+', '') AS q FROM p
), c AS (
  SELECT *, regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '') || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS canonical FROM k
), listed AS (
  SELECT DISTINCT canonical FROM c WHERE canonical <> '' AND len(list_intersect(string_split(host, '.'), {LISTED_SITES!r})) > 0
), rules(verdict, rule_host, rule_path) AS (VALUES {", ".join(map(str, URL_RULES))}),
f AS (
  SELECT page_id, host, path, canonical, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(r.verdict, length(rule_host || rule_path)) AS verdict
  FROM c LEFT JOIN rules r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id, host, path, canonical
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END) AS verdict FROM f
"""

#: All pairs that share a shingle, and the smallest document that links reach.
_OP3 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) = 1 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN n x ON x.doc_id = a.doc_id JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id JOIN n y ON y.doc_id = b.doc_id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT doc_id AS root, doc_id AS node FROM documents UNION SELECT r.root, e.b FROM r JOIN e ON e.a = r.node
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT node AS doc_id, min(root) AS component_id FROM r GROUP BY node) LEFT JOIN n USING (doc_id)
"""

#: Every item's scores over all documents that hold one of its terms.
_OP11 = f"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents
), q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark
), stats AS (
  SELECT count(*) FILTER (len(ts) > 0) AS big_n, CAST(sum(len(ts)) AS BIGINT) AS big_l FROM t
), d AS (
  SELECT doc_id, 100 - 25 + (25 * len(ts) * big_n) // big_l AS m, ts FROM t, stats WHERE len(ts) > 0
), p AS (
  SELECT doc_id, m, term, count(*) AS tf FROM (SELECT doc_id, m, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY doc_id, m, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, stats GROUP BY term
), s AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score FROM q JOIN p USING (term) JOIN w USING (term) GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20
"""

ORACLE: dict[str, str] = {
    "op3_minhash": _OP3,
    "op5_licenses": licenses.oracle(),
    "op7_url_filter": _OP7,
    "op11_search": _OP11,
}
