"""Previous figures, change and running totals along each film's weekends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from reelhouse.functions import money


def by_film() -> WindowSpec:
    """One row per film and weekend, so a film's window holds at most its weekends on screen."""
    return Window.partitionBy("film_id").orderBy("weekend_id")


def with_previous(revenues: DataFrame) -> DataFrame:
    """The latest earlier row of the same film, from any source; its figures may be NULL."""
    return revenues.withColumns(
        {
            "prev_weekend": F.lag("weekend_id").over(by_film()),
            "prev_rev": F.lag("revenue_qc").over(by_film()),
            "prev_cumul": F.lag("cumulatif_qc_to_date").over(by_film()),
        }
    )


def had_real_weekend(revenues: DataFrame, weekends: DataFrame, movies: DataFrame) -> DataFrame:
    """Whether an earlier weekend of the film ended on or after its release; unknown release: no."""
    ends = weekends.select(F.col("id").alias("weekend_id"), "end_date")
    released = movies.select(F.col("id").alias("film_id"), "release_date")
    earlier = by_film().rowsBetween(Window.unboundedPreceding, -1)
    return (
        revenues.join(ends, "weekend_id", "left").join(released, "film_id", "left")
        .withColumn(
            "had_real_weekend",
            F.coalesce(F.max("end_date").over(earlier) >= F.col("release_date"), F.lit(False)),
        )
        .drop("end_date", "release_date")
    )


def week_over_week(revenues: DataFrame, weekends: DataFrame, movies: DataFrame) -> DataFrame:
    """Change in percent against the previous figure; NULL on the first real weekend."""
    return had_real_weekend(with_previous(revenues), weekends, movies).withColumn(
        "change_qc", money.change_percent(F.col("revenue_qc"), F.col("prev_rev"), ~F.col("had_real_weekend"))
    )


def running_totals(revenues: DataFrame) -> DataFrame:
    """Cumulative revenue of a film up to and with each weekend; NULL counts as 0."""
    so_far = by_film().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return revenues.withColumn("running_qc", F.sum(F.coalesce("revenue_qc", F.lit(0))).over(so_far))
