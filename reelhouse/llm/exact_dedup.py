"""Exact deduplication by a tree merge of sorted digest runs.

Every input partition yields a run: its digests in order, equal ones collapsed to one entry. Runs meet in binomial
rounds. In each round the runs whose numbers agree but for the next four bits go to the one of them whose bits are zero,
and are merged there many ways at once: a sort by (run, digest) and one collapse per digest, which Spark carries out
before the exchange and again behind it. So no digest, however hot, reaches a merging task more than once per run of the
round. An entry stands for a text only where SHA-256, byte length and a second hash agree, and keeps the smallest
identifier among the longest originals at every level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import WHITE, chosen_rows, row_key, text_of
from reelhouse.session import written

#: Runs are numbered in so many bits, and so many bits are merged away per round.
RUN_BITS, ROUND_BITS = 12, 4

_SAME = ("digest", "bytes", "second")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, length (code points of the original) and the digest of the text without white space, per row."""
    text = docs.select("doc_id", text_of().alias("text"))
    squeezed = text.select("doc_id", row_key().alias("row_key"), F.length("text").alias("length"), F.regexp_replace("text", f"{WHITE}+", "").alias("squeezed"))
    return squeezed.select(
        "doc_id",
        "row_key",
        "length",
        F.unhex(F.sha2("squeezed", 256)).alias("digest"),
        F.octet_length("squeezed").alias("bytes"),
        F.xxhash64("squeezed").alias("second"),
        F.pmod(F.spark_partition_id(), F.lit(1 << RUN_BITS)).alias("run"),
    )


def merged(found: DataFrame) -> DataFrame:
    """One entry per digest: best (the row that stays), group_size, and repeats (rows equal to it in all that ranks)."""
    rank = F.struct(
        (-F.col("length")).alias("shortness"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("row_key").alias("row_key")
    )
    level = found.select("run", *_SAME, rank.alias("best"), F.lit(1).cast("long").alias("members"))
    for done in range(ROUND_BITS, RUN_BITS + 1, ROUND_BITS):
        receiver = F.shiftleft(F.shiftright("run", done), done)
        level = level.groupBy(receiver.alias("run"), *_SAME).agg(F.min("best").alias("best"), F.sum("members").alias("members"))
    return level.select(*_SAME, "best", F.col("members").alias("group_size"))


def _resolved(docs: DataFrame) -> DataFrame:
    """Every row with its group. Only groups of two and more are joined back; a single row is its own group."""
    found = written(digests(docs), "digests")
    groups = merged(found).where("group_size > 1").withColumnRenamed("best", "kept_row")
    own = F.struct((-F.col("length")).alias("shortness"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("row_key").alias("row_key"))
    return found.join(groups, list(_SAME), "left").select(
        "doc_id",
        "row_key",
        F.coalesce("kept_row", own).alias("kept_row"),
        own.alias("own"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "run",
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of `docs` (doc_id, text).

    Texts are equal when they are identical without white space. The longest original stays, then the smallest doc_id; a
    missing doc_id comes after all others, a missing text counts as empty. Rows that repeat the row that stays in both
    doc_id and text are told apart by nothing, so exactly one of them is marked as kept. An empty table gives none.
    Other columns are not looked at.
    """
    rows = written(_resolved(docs), "groups")
    stays = F.col("own") == F.col("kept_row")
    losers = rows.where(~stays | (F.col("group_size") == 1)).withColumn("kept", F.col("group_size") == 1)
    winners = rows.where(stays & (F.col("group_size") > 1))
    tied = winners.groupBy("text_sha256", "kept_row").agg(F.first("doc_id").alias("doc_id"), F.first("group_size").alias("group_size"), F.count(F.lit(1)).cast("int").alias("n"))
    firsts = tied.select("doc_id", "kept_row", "group_size", "text_sha256", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("nth"))
    firsts = firsts.withColumn("kept", F.col("nth") == 1)
    columns = ("doc_id", F.col("kept_row.doc_id").alias("keep_id"), "group_size", "kept", "text_sha256")
    return losers.select(*columns).union(firsts.select(*columns))


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, whole and in its columns."""
    rows = _resolved(docs).where(F.col("own") == F.col("kept_row"))
    chosen = written(rows.groupBy("doc_id", "row_key").agg(F.count(F.lit(1)).alias("repeats")), "kept")
    return chosen_rows(docs, chosen)
