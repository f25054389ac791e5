"""Token counts from a digest cache.

The cache is a table (content, tokenizer, n_tokens): digests of the normalised content and of the tokenizer file. A text
whose pair of digests is stored is not encoded again; of the others each distinct one is encoded once and appended.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import text_of
from reelhouse.llm.tokens import encoder, version
from reelhouse.session import shared_folder, written

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"


def content_digest(text: Column) -> Column:
    """Normalised means: a missing text is empty. Anything further could change the count."""
    return F.unhex(F.sha2(text, 256))


def cached(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """Stored counts of one tokenizer version; a cache that doesn't exist yet is empty. Repeats count once."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException:
        rows = spark.createDataFrame([], CACHE_SCHEMA)
    return rows.where(F.col("tokenizer") == version(tokenizer)).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_missing(docs: DataFrame, cache: str, tokenizer: str) -> None:
    """Encode each distinct text that the cache lacks once, and append its count.

    Copies collapse before the shuffle, so each distinct text travels once at most per task.
    """
    spark = docs.sparkSession
    texts = docs.select(text_of().alias("text")).select(content_digest(F.col("text")).alias("content"), "text")
    missing = texts.dropDuplicates(["content"]).join(cached(spark, cache, tokenizer), "content", "left_anti")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoder(tokenizer)
        for rows in batches:
            yield pd.DataFrame({"content": rows["content"], "n_tokens": [len(coder.ids(t)) // 4 for t in rows["text"]]})

    counted = missing.mapInPandas(count, "content binary, n_tokens long")
    counted.select("content", F.lit(version(tokenizer)).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, cache: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of `docs` (doc_id, text).

    A missing text counts as empty: no bytes, no tokens. Repeated rows come out as often as they stand in the table; an
    empty table gives none. Other columns are not looked at. `cache` is the folder of the cache, kept from run to run;
    without one a new folder beside the checkpoints is used.
    """
    import uuid

    spark = docs.sparkSession
    cache = cache or shared_folder(spark, f"token-counts-{uuid.uuid4().hex}")
    count_missing(docs, cache, tokenizer)
    text = text_of()
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), content_digest(text).alias("content"))
    counts = written(cached(spark, cache, tokenizer), "counts")  # so no sum stands above the join, and a hot text can be split
    counted = rows.join(counts, "content")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
