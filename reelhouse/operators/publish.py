"""Published figures: films of a weekend with their occupancy and share, ready to merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse import fixed_values as fv
from reelhouse.operators.features import occupancy, show_counts, total_counts, ratio


def published_rows(figures: DataFrame, showings: DataFrame, screens: DataFrame) -> DataFrame:
    """Figures (film_id, weekend_id, revenue_qc, revenue_us, rank, cumulatives) with weekend features.

    A missing local revenue counts as 0, the other figures stay NULL. The share is 0 for a film
    without shows and NULL for a weekend without any.
    """
    key = ["film_id", "weekend_id"]
    return (
        figures.join(occupancy(showings, screens), key, "left")
        .join(show_counts(showings), key, "left")
        .join(total_counts(showings), "weekend_id", "left")
        .select(
            *key,
            F.coalesce("revenue_qc", F.lit(0)).cast("bigint").alias("revenue_qc"),
            "revenue_us",
            "rank",
            "cumulatif_qc_to_date",
            "cumulatif_us_to_date",
            F.lit(fv.PUBLISHED).alias("data_source"),
            "average_showing_occupancy",
            ratio(F.coalesce("film_cnt", F.lit(0)), F.col("total_cnt")).alias("showings_proportion"),
        )
    )
