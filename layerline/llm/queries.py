"""The operators over their whole tables, with production parameters, and what SQL can say of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerline.llm import (
    bpe,
    ctw,
    licenses,
    lines,
    neardup,
    packing,
    phrases,
    quality,
    ranked,
    tokenfiles,
    topk,
    toxicity,
    urls,
)
from layerline.llm.common import table
from layerline.operators.scale import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(table(spark, folder, "documents"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept")


@query
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return packing.pack(documents, tokenizer_path("word_bpe_49k.json"))


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.concat_ws(",", "sentence_ids").alias("sentence_ids"),
        F.concat_ws(",", "licences").alias("licences"),
    )


@query
def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(documents, path, split_pattern())


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxic_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.deduplicate(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", "text")


@query
def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return ctw.score(table(spark, folder, "documents"))


@query
def op8_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, folder, "documents"), words=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge(table(spark, folder, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op10_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


SQL["op10_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON b.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query
def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = scratch_dir(spark, "token-files")
    return tokenfiles.digests(table(spark, folder, "documents"), files, tokenizer_path("byte_bpe_50k.json"))


@query
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL["op12_ranked_search"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, whole GROUP BY term, docs),
norms AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM sizes, whole),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
wanted AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY item_id, term),
scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN norms USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
    doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""


@query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


SQL["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
sized AS (SELECT lang, ws, unnest([1, 2, 3, 4]) AS size FROM words),
grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2),
    lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS phrase FROM sized WHERE len(ws) >= size),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE size > 1 AND f >= 30),
places AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, ((2000000 * c.a::HUGEINT) // (x.f + y.f))::BIGINT AS score
  FROM places c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.k + 1:], ' ')),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_sizes AS (SELECT lang, ws, size, a, unnest(range(2, size)) AS part FROM candidates WHERE size > 2),
inner_phrases AS (
  SELECT lang, a, unnest(list_transform(range(1, size - part + 2),
    lambda i: array_to_string(ws[i:i + part - 1], ' '))) AS phrase FROM inner_sizes),
covers AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL),
ranked AS (
  SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, w.phrase) AS rank,
    w.phrase, w.a, w.l, w.r, t.n, w.score
  FROM lowest w JOIN totals t ON t.lang = w.lang
  LEFT JOIN covers c ON c.lang = w.lang AND c.phrase = w.phrase
  WHERE c.longer IS NULL OR 100 * c.longer < 80 * w.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""
