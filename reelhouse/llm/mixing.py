"""Mixing sources to target weights by capped water-filling.

Sources share a volume by weight. A source that would be read more often than the epoch limit is clamped there and the
excess goes to the others by weight, again and again until none is above. Each document is then taken in whole
repetitions, and a seeded order over the documents of a source decides which of them are taken once more: as many as
the fractional repetition holds, the last one in part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse.llm.common import WHITE, WORD, running_total, text_of
from reelhouse.session import written

#: Hex digits of the seeded order that number the parts of a source over which volume is summed, coarse and fine.
PART_DIGITS = (2, 5)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def seeded_order(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def source_targets(volumes: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """volumes (source, source_size) with target: each source's share of the whole volume.

    Weights repeat over the sources in the order of their code points, a missing source last.
    """
    ranked = running_total(volumes, [F.col("source").asc_nulls_last()], F.lit(1), "sources", "position")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    wide = "decimal(38,0)"
    level = ranked.select("source", "source_size", weight.cast("long").alias("weight"), F.lit(False).alias("clamped"))
    level = written(level, "sources")
    limit = F.col("source_size") * max_epochs
    while True:
        free = ~F.col("clamped")
        now = level.agg(
            F.sum("source_size").alias("whole"),
            F.sum(F.when(free, F.col("weight"))).alias("weight"),
            F.coalesce(F.sum(F.when(~free, limit)), F.lit(0)).alias("spent"),
            F.sum(F.col("clamped").cast("int")).alias("n"),
        ).first()
        if now["weight"] is None:
            break
        left = now["whole"] - now["spent"]
        above = free & (F.col("weight").cast(wide) * F.lit(left).cast(wide) > limit.cast(wide) * F.lit(now["weight"]).cast(wide))
        if level.where(above).isEmpty():
            target = F.when(free, F.col("weight") * F.lit(left / now["weight"])).otherwise(limit.cast("double"))
            return level.select("source", "source_size", target.alias("target"))
        level = written(level.withColumn("clamped", F.col("clamped") | above), "sources")
    return level.select("source", "source_size", limit.cast("double").alias("target"))


def _thresholds(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source: the place in the seeded order at which its fractional repetition is used up.

    Volume is summed over parts of the order, then over parts of the part in which the volume runs out, and last by place; so
    no source brings more rows to a window than there are parts.
    """
    left = sources.where("rest > 0").select(F.col("source").alias("of"), F.lit("").alias("within"), "rest")
    sized = sized.select("source", "place", F.col("size").alias("words"))
    for digits in (*PART_DIGITS, None):
        part = F.col("place") if digits is None else F.substring("place", 1, digits)
        inside = sized.join(left, sized["source"].eqNullSafe(left["of"]) & F.col("place").startswith(F.col("within")))
        parts = inside.groupBy("of", "rest", part.alias("part")).agg(F.sum("words").alias("size"))
        earlier = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        last = parts.where("before < rest and before + size >= rest")
        left = written(last.select("of", F.col("part").alias("within"), (F.col("rest") - F.col("before")).alias("rest"), "size"), "mixing-parts")
    return left.select("of", F.col("within").alias("last_place"), F.col("rest").alias("in_last"), F.col("size").alias("last_size"))


def source_plan(sized: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """One row per source: source_size, target, whole (repetitions of every document), and where the last one ends."""
    volumes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    budget = F.round("target").cast("long")
    sources = source_targets(volumes, weights, max_epochs).withColumns({
        "whole": F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0).cast("long"),
        "rest": F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(0).cast("long"),
    })
    sources = written(sources, "sources")
    ends = _thresholds(sized, sources)
    plan = sources.join(ends, sources["source"].eqNullSafe(F.col("of")), "left").drop("of")
    return written(plan.withColumnRenamed("source", "of"), "mixing-plan")


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: int = 7) -> DataFrame:
    """doc_id, size, source_size, target, taken, whole, part for every row of `docs` (doc_id, text, source).

    size counts words; a missing text has none. taken = whole * size + part: `whole` repetitions of the document and
    `part` words of one more. A missing source is one of its own, the last. Documents at the same place of the seeded
    order (the same doc_id, or none) share the words left at that place by size. Sources without words have target 0.
    An empty table gives an empty result. Other columns are not looked at.
    """
    sized = written(docs.select("doc_id", "source", word_count(text_of()).alias("size"), seeded_order(seed).alias("place")), "sizes")
    plan = source_plan(sized, weights, max_epochs)
    rows = sized.join(plan, sized["source"].eqNullSafe(plan["of"]))
    part = (
        F.when(F.col("last_place").isNull() | (F.col("place") > F.col("last_place")), F.lit(0))
        .when(F.col("place") < F.col("last_place"), F.col("size"))
        .otherwise(F.expr("(in_last * size) div last_size"))
        .cast("long")
    )
    rows = rows.withColumn("part", part)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).alias("taken"), "whole", "part")


def mixed(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: int = 7) -> DataFrame:
    """The mix itself, in the columns of `docs`: a row for each repetition; one taken in part has its first words.

    The whole decision for a row follows from its source's row of the plan, so documents are joined to one row per source.
    """
    names = docs.columns
    sized = written(docs.select("doc_id", "source", word_count(text_of()).alias("size"), seeded_order(seed).alias("place")), "sizes")
    plan = source_plan(sized, weights, max_epochs)
    plan = plan.select(*[F.col(c).alias(f"_llm_{c}") for c in ("of", "whole", "last_place", "in_last", "last_size")])
    place, whole = seeded_order(seed), F.col("_llm_whole")
    rows = docs.join(plan, docs["source"].eqNullSafe(F.col("_llm_of")))
    at_end = place == F.col("_llm_last_place")
    size = word_count(text_of())
    rows = rows.withColumn("_llm_size", F.when(at_end, size)).withColumn("_llm_part", F.expr("(_llm_in_last * _llm_size) div _llm_last_size").cast("int"))
    full = whole + F.coalesce((place < F.col("_llm_last_place")).cast("long"), F.lit(0))
    words = F.regexp_extract_all(text_of(), F.lit(f"{WHITE}*{WORD}"), F.lit(0))
    cut = F.array_join(F.slice(words, F.lit(1), F.col("_llm_part")), "")
    again = F.array_repeat(F.lit(False), full.cast("int"))
    partly = F.when(F.coalesce(F.col("_llm_part"), F.lit(0)) > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    rows = rows.withColumn("_llm_cut", F.explode(F.concat(again, partly)))
    return rows.withColumn("text", F.when(F.col("_llm_cut"), cut).otherwise(F.col("text"))).select(*names)
