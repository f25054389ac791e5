"""Titles of one group that can match, without pairing all of them.

Keys are made so that two titles that match share one: of a text that lies in another, the head of a fixed length is among
the pieces of that length of the other; titles with two words in common share the pair of these words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct titles of a group up to which every wanted title meets each of them.
FEW = 64
#: Lengths of pieces; a text is looked up by its head of the largest length that it has.
LENGTHS = (0, 1, 2, 4, 8, 16)


def _key(kind: str, size: int, piece: Column) -> Column:
    return F.concat(F.lit(f"{kind}{size}:"), piece)


def inside(kind: str, c: Column) -> Column:
    """Key by which a text is found among those that hold it."""
    key = _key(kind, 0, F.lit(""))
    for n in LENGTHS[1:]:
        key = F.when(F.length(c) >= n, _key(kind, n, F.left(c, F.lit(n)))).otherwise(key)
    return F.array(key)


def around(kind: str, c: Column) -> Column:
    """Keys of all texts that this one may hold."""
    def pieces(n: int) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1)))
        found = F.transform(at, lambda i: _key(kind, n, F.substr(c, i, F.lit(n))))
        return F.when(F.length(c) >= n, found).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(F.array(_key(kind, 0, F.lit(""))), *[pieces(n) for n in LENGTHS[1:]]))


def heads(kind: str, c: Column) -> Column:
    """Keys of all texts that this one may begin with."""
    return F.filter(
        F.array(_key(kind, 0, F.lit("")), *[F.when(F.length(c) >= n, _key(kind, n, F.left(c, F.lit(n)))) for n in LENGTHS[1:]]),
        lambda k: k.isNotNull(),
    )


def two_words(words: Column, offered: bool) -> Column:
    """Pairs of different words; an offered word that is repeated counts as a pair, and short titles have single words too."""
    each = F.array_sort(F.array_distinct(words))
    pairs = F.flatten(
        F.transform(each, lambda a: F.transform(F.filter(each, lambda b: b > a), lambda b: F.concat(F.lit("w:"), a, F.lit(" "), b)))
    )
    again = each if not offered else F.filter(each, lambda a: F.size(F.filter(words, lambda w: w == a)) > 1)
    twice = F.transform(again, lambda a: F.concat(F.lit("w:"), a, F.lit(" "), a))
    single = F.when(F.size(each) <= 2, F.transform(each, lambda a: F.concat(F.lit("s:"), a))).otherwise(F.array().cast("array<string>"))
    return F.concat(pairs, twice, single)


def crowding_words(offers: DataFrame, group: list[str], words: str, few: int = FEW) -> DataFrame:
    """`crowding`, the words that more than `few` offers of a group share: no use as keys, each being one hot key.

    There are at most as many as the group has words, divided by `few`.
    """
    counted = offers.select(*group, F.explode(words).alias("_word")).groupBy(*group, "_word").agg(F.count(F.lit(1)).alias("_n"))
    return counted.where(F.col("_n") > few).groupBy(*group).agg(F.collect_set("_word").alias("crowding"))


def parted_words(df: DataFrame, prefix: str) -> DataFrame:
    """Splits `<prefix>_long` by `crowding` into `<prefix>_rare`, which serve as keys, and `<prefix>_hot`, in order."""
    long_, crowding = F.col(f"{prefix}_long"), F.coalesce("crowding", F.array().cast("array<string>"))
    return df.withColumns({f"{prefix}_rare": F.array_except(long_, crowding), f"{prefix}_hot": F.array_sort(F.array_intersect(long_, crowding))}).drop("crowding")


def best_by_crowding_words(wants: DataFrame, offers: DataFrame, group: list[str]) -> DataFrame:
    """Wants with the first `entry` among those that share most of their crowding words, and that number as `score`.

    Wants and offers that hold the same crowding words are one row each before they meet, so pairs grow with the
    combinations of such words, not with titles. Offers that share other words too are found through those.
    """
    signed = offers.where(F.size("entry_hot") > 0).groupBy(*group, "entry_hot").agg(F.min("entry").alias("entry"))
    asked = wants.where(F.size("want_hot") > 0).select(*group, "want_hot").distinct()
    shared = F.size(F.array_intersect("want_hot", "entry_hot"))
    met = asked.join(signed, group).withColumn("_shared", shared).where(F.col("_shared") > 0)
    best = met.groupBy(*group, "want_hot").agg(F.min(F.struct((-F.col("_shared")).alias("minus"), "entry")).alias("_b"))
    return wants.join(best, [*group, "want_hot"]).withColumns({"entry": F.col("_b.entry"), "score": -F.col("_b.minus")})


def meeting(
    wants: DataFrame, offers: DataFrame, group: list[str], want_id: list[str], offer_id: str, want_keys: Column, offer_keys: Column, few: int = FEW
) -> DataFrame:
    """Pairs of wants (with `titles`, the number of offers of their group) and offers that may match, each once.

    Where a group offers few titles that is all of them, so pairs grow with the wants alone; else it is those that share
    a key. No match is lost either way; whether a pair does match is for the caller to say.

    Wants and offers meet sorted, never broadcast: the sizes that Catalyst goes by are those of compressed files, of titles a
    hundredth of their rows' and less, and don't count the keys that a title is exploded to.
    """
    direct = wants.where(F.col("titles") <= few).hint("merge").join(offers, group)
    many = wants.where(F.col("titles") > few)
    asked = many.withColumn("_key", F.explode(F.array_distinct(want_keys)))
    crowded = many.select(*group).distinct()
    listed = offers.join(crowded.hint("merge"), group, "left_semi").withColumn("_key", F.explode(F.array_distinct(offer_keys)))
    keyed = asked.hint("merge").join(listed, [*group, "_key"]).drop("_key").dropDuplicates([*group, *want_id, offer_id])
    return direct.unionByName(keyed)
