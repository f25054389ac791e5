"""One query per operator, over its whole table, and comparison SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import (
    exact_dedup, lexical, licenses, line_dedup, mixing, neighbours, packing, quality, simhash, substring_dedup, token_counts, token_store, whitening,
)

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
QUERIES = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_spans(table(spark, folder, "documents"))


@query
def op2_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), k=10, every=100)


@query
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), weights=(5, 2, 1), max_epochs=3).select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), limit=3, size=3)


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), BYTE_BPE, window=2048)


@query
def op6_token_store(spark: SparkSession, folder: str) -> DataFrame:
    return token_store.stored(table(spark, folder, "documents"), WORD_BPE)


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.scored(docs, quality.learn(docs, table(spark, folder, "labels")))


@query
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), BYTE_BPE, limit=1024)


@query
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    files = pages.select(F.col("page_id").alias("file_id"), licenses.web_path(F.col("url")).alias("path"), F.col("html").alias("text"))
    found = licenses.scan(files).withColumnRenamed("file_id", "page_id")
    return found.withColumn("score", F.round("score", 6))


@query
def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whitened(table(spark, folder, "embeddings"), components=8)
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@query
def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_counts(table(spark, folder, "documents"), least_docs=10, least_chars=1)


@query
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


SQL = {
    "op3_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('7:' || coalesce(doc_id::VARCHAR, '')) AS place FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::HUGEINT AS weight
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, sum(source_size) OVER () AS whole,
    coalesce(sum(source_size) OVER earlier, 0)::HUGEINT AS spent, sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS open,
    row_number() OVER (ORDER BY source_size::DOUBLE / weight, source) AS n
  FROM sources WINDOW earlier AS (ORDER BY source_size::DOUBLE / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first_free AS (
  SELECT n, whole - 3 * spent AS remaining, open FROM ranked WHERE weight * (whole - 3 * spent) <= 3 * source_size * open ORDER BY n LIMIT 1),
targets AS (
  SELECT source, source_size,
    CASE WHEN r.n < f.n THEN (3 * source_size)::DOUBLE ELSE weight::DOUBLE * (f.remaining::DOUBLE / f.open::DOUBLE) END AS target
  FROM ranked r, first_free f),
ordered AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM sized),
budgets AS (SELECT *, round(target)::BIGINT AS budget FROM targets)
SELECT o.doc_id, o.size, b.source_size, b.target,
  (CASE WHEN b.source_size = 0 THEN 0 ELSE (b.budget // b.source_size) * o.size + greatest(0, least(o.size, b.budget % b.source_size - o.before)) END)::BIGINT AS taken
FROM ordered o JOIN budgets b ON o.source IS NOT DISTINCT FROM b.source""",
    "op10_exact_dedup": r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER best = 1 AS kept, text_sha256
FROM n WINDOW best AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)""",
    "op12_line_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS nth FROM d),
k AS (SELECT r, nth, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE o.key IS NOT NULL) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (WHERE o.key IS NULL), '') AS text
  FROM k LEFT JOIN often o ON o.key = k.key GROUP BY r)
SELECT d.doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM d JOIN kept USING (r)""",
    "op13_lexical_search": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
whole AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS docs, sum(len(terms))::BIGINT AS all_terms FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, whole GROUP BY term, docs),
asked AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
sized AS (SELECT r, doc_id, 10 + (90 * len(terms)::BIGINT * docs) // all_terms AS m FROM d, whole WHERE len(terms) > 0),
scores AS (SELECT item_id, text, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN sized USING (r) GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
