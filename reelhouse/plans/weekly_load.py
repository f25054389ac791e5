"""The weekly run: published figures, then estimates and ranks for this and the next weekend."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.operators import match_film, merge, publish
from reelhouse.operators.partition_merge import PartitionedTable
from reelhouse.plans.rank import rank_weekends
from reelhouse.plans.weekend_estimate import estimate_weekend
from reelhouse.session import written


def published_figures(local: DataFrame, abroad: DataFrame, results: DataFrame, year: int) -> DataFrame:
    """Box-office rows (weekend_id, title, ...) of the local section with the foreign figures of the
    same title, and the film each title is found as. Titles without a film are dropped; of two
    titles of one film the later row counts.
    """
    wants = local.select("title").distinct().select(
        "title", F.lit(year).alias("year_hint"), F.array().cast("array<string>").alias("extra_queries")
    )
    films = match_film.search_films(wants, results, year_offsets=(0,), clean=False).select("title", "film_id")
    foreign = abroad.select(
        "weekend_id", "title", F.col("week_end").alias("revenue_us"), F.col("cumulative").alias("cumulatif_us_to_date")
    )
    rows = local.join(foreign, ["weekend_id", "title"], "left").join(films, "title")
    figures = F.struct(
        "pos", "title", "fr_title", "url",
        F.col("week_end").cast("bigint").alias("revenue_qc"), F.col("revenue_us").cast("bigint").alias("revenue_us"),
        F.col("cumulative").cast("bigint").alias("cumulatif_qc_to_date"), F.col("cumulatif_us_to_date").cast("bigint").alias("cumulatif_us_to_date"),
    )
    return (
        rows.groupBy("film_id", "weekend_id").agg(F.max(figures).alias("f"))
        .select("film_id", "weekend_id", "f.*", F.lit(None).cast("int").alias("rank"))
        .drop("pos")
    )


def load_published(revenues: DataFrame, figures: DataFrame, showings: DataFrame, screens: DataFrame) -> DataFrame:
    """Revenues with the figures merged in. The rows with their features are written once; the merge goes over them again."""
    return merge.merge_published(revenues, written(publish.published_rows(figures, showings, screens), "published-rows"))


def revenue_table(spark: SparkSession, path: str) -> PartitionedTable:
    """Revenues partitioned by weekend: a week's run reads and rewrites that week."""
    return PartitionedTable(spark, path, "weekend_id")


def load_published_into(table: PartitionedTable, figures: DataFrame, showings: DataFrame, screens: DataFrame) -> None:
    """The same into a stored table, of which only the weekends of the figures are read and rewritten."""
    source, rules = merge.published_merge(table.read(), publish.published_rows(figures, showings, screens))
    table.merge(source, merge.REVENUE_KEY, rules)


def load_estimates_into(table: PartitionedTable, estimates: DataFrame) -> None:
    """New estimates in, old ones refreshed, published rows untouched; only the estimates' weekends are rewritten."""
    table.merge(estimates, merge.REVENUE_KEY, merge.estimate_rules(table.read()), F.expr(merge.STILL_ESTIMATED))


def estimate_and_rank(
    revenues: DataFrame, showings: DataFrame, screens: DataFrame, weekends: DataFrame, movies: DataFrame,
    weekend_id: int, ticket_price: float, bias: float,
) -> DataFrame:
    """Revenues after refreshing one weekend's estimates and ranks.

    The estimates and the refreshed table are written once, since the merge and the ranking go
    over them again. The next weekend's estimate reads this result, so write that too.
    """
    estimates = written(
        estimate_weekend(showings, screens, revenues, weekends, movies, weekend_id, ticket_price, bias), "estimates"
    )
    refreshed = written(merge.merge_estimates(revenues, estimates), "refreshed-revenues")
    return merge.write_ranks(refreshed, rank_weekends(refreshed, showings, weekend_id))
