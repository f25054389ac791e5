"""Box-office tables derived by Spark from the shared test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse import fixed_values as fv
from reelhouse.functions import time as tm


class SampleTables:
    """Lazy views; every attribute is a plan over the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def movies(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.raw("part").select(
            key.alias("id"),
            F.col("p_name").alias("title"),
            F.when(key % 4 != 0, F.concat(F.lit("Le "), "p_name")).alias("fr_title"),
            F.date_add(F.lit("2023-12-15").cast("date"), (key % 40).cast("int")).alias("release_date"),
            (80 + F.col("p_size")).cast("int").alias("runtime"),
            F.col("p_retailprice").cast("decimal(12,2)").cast("double").alias("popularity"),
            F.when(key % 3 == 1, 0).when(key % 3 == 2, key * 1000).cast("bigint").alias("budget"),
        )

    @property
    def theaters(self) -> DataFrame:
        key = F.col("n_nationkey")
        fixed = {
            1: "Cinéma Beaubien", 3: "Cinéma RGFM Beloeil", 5: "Cinéma Élysée (Granby)",
            7: "Cinémathèque québécoise", 9: "Cinéma Banque Scotia", 11: "CINEMA  MAGOG",
        }
        name = F.concat(F.when(key % 2 == 0, "Cineplex ").otherwise("Cinema "), "n_name")
        for nation, title in fixed.items():
            name = F.when(key == nation, title).otherwise(name)
        return self.raw("nation").select(
            key.cast("bigint").alias("id"),
            name.alias("name"),
            F.when(key % 3 != 0, F.concat(F.lit("Chain "), F.col("n_regionkey").cast("string"))).alias("company"),
            F.lit(None).cast("int").alias("screens"),
            F.when(key % 10 != 4, (1000 + key).cast("string")).alias("theater_api_id"),
            F.concat(F.lit("https://theatres.example/"), key.cast("string")).alias("showings_url"),
        )

    @property
    def screens(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("id"),
            F.col("s_nationkey").cast("bigint").alias("theater_id"),
            F.concat(F.lit("Salle "), F.col("s_suppkey").cast("string")).alias("name"),
            (80 + F.col("s_suppkey") % 11 * 20).cast("int").alias("seat_count"),
        )

    @property
    def showing_facts(self) -> DataFrame:
        suppliers = self.raw("supplier")
        n = suppliers.agg(F.count(F.lit(1))).scalar()
        e = self.raw("events").withColumn("s_suppkey", F.col("event_id") % n)
        seats = 80 + F.col("s_suppkey") % 11 * 20
        film = F.col("user_id")
        preview_hole = (
            (film % 11 == 7)
            & (F.col("ts") >= F.lit("2024-01-19 05:00:00").cast("timestamp_ntz"))
            & (F.col("ts") < F.lit("2024-01-22 05:00:00").cast("timestamp_ntz"))
        )
        unknown = (F.col("event_type") == "error") | (film % 13 == 5) | preview_hole
        return e.join(suppliers, "s_suppkey").select(
            F.col("event_id").alias("id"),
            film.alias("movie_id"),
            F.col("s_nationkey").cast("bigint").alias("theater_id"),
            F.col("s_suppkey").alias("true_screen"),
            seats.alias("true_seats"),
            F.when(F.col("event_id") % 7 != 0, F.col("s_suppkey")).alias("screen_id"),
            F.col("ts").alias("start_at"),
            tm.local_date(F.col("ts")).alias("date"),
            "value",
            F.when(~unknown, F.least(F.floor("value"), seats)).cast("int").alias("seats_sold"),
        )

    @property
    def showings(self) -> DataFrame:
        url = F.concat(F.lit("https://tickets.example/old?P3="), (50000 + F.col("id") % 500).cast("string"))
        return self.showing_facts.select(
            "id", "movie_id", "theater_id", "screen_id", "start_at", "date", "seats_sold",
            F.when(F.col("id") % 4 == 1, url).alias("purchase_url"),
        )

    @property
    def weekends(self) -> DataFrame:
        wid = tm.weekend_id(F.col("date"))
        return self.showings.select(wid.alias("id")).distinct().select(
            "id", tm.friday_of(F.col("id")).alias("start_date"), tm.sunday_of(F.col("id")).alias("end_date")
        )

    @property
    def revenues(self) -> DataFrame:
        day = tm.local_date(F.col("ts"))
        film = F.col("film_id")
        v = (
            self.raw("events")
            .where((F.weekday(day) >= 4) & (F.col("event_type") != "error"))
            .groupBy(F.col("user_id").alias("film_id"), tm.weekend_id(day).alias("weekend_id"))
            .agg(F.sum(F.col("value").cast("decimal(12,2)")).alias("v"))
            .where((film % 4 != 3) & ~((F.col("weekend_id") == 202403) & (film % 3 != 0) & (film % 5 != 0)))
        )
        amount = F.round(F.col("v") * F.when(film % 3 == 0, 5).otherwise(100)).cast("bigint")
        so_far = Window.partitionBy("film_id").orderBy("weekend_id").rowsBetween(Window.unboundedPreceding, 0)
        placed = Window.partitionBy("weekend_id", film % 3).orderBy(F.desc("v"), "film_id")
        return v.withColumn("revenue_qc", amount).select(
            "film_id",
            "weekend_id",
            "revenue_qc",
            F.when(film % 3 == 0, fv.PUBLISHED).otherwise(fv.ESTIMATE).alias("data_source"),
            F.sum("revenue_qc").over(so_far).alias("cumulatif_qc_to_date"),
            F.when(film % 3 == 0, F.row_number().over(placed)).alias("rank"),
        )

    @property
    def measurements(self) -> DataFrame:
        number = F.col("true_screen").cast("string")
        kind = F.col("id") % 6
        auditorium = (
            F.when(kind == 1, F.concat(F.lit("Salle "), number))
            .when(kind == 2, F.concat(F.lit("SALLE "), F.lpad(number, F.greatest(F.lit(3), F.length(number)), F.lit("0"))))
            .when(kind == 3, F.concat(F.lit("Auditorium #"), number, F.lit(" bis")))
            .when(kind == 4, "le")
            .when(kind == 5, F.concat(F.lit("Grande Salle "), (F.col("true_screen") % 10).cast("string")))
        )
        return self.showing_facts.select(
            F.col("id").alias("showing_id"),
            "movie_id",
            "theater_id",
            auditorium.alias("auditorium"),
            F.when(F.col("id") % 17 != 0, (F.col("true_seats") - F.floor("value")).cast("int")).alias("seats_remaining"),
            (F.col("true_seats") + F.floor(F.col("id") / 7) % 25 - 12).cast("int").alias("capacity"),
            F.when(F.col("id") % 4 == 0, "cineentreprise").otherwise("cineplex").alias("source"),
            (F.col("start_at") + F.expr("interval 13 minutes")).alias("measured_at"),
        )

    @property
    def block_showings(self) -> DataFrame:
        """Showings set to the last full four-hour block, so several share a theatre and a time."""
        wall = tm.to_local(F.col("f.start_at"))
        block = F.date_trunc("DAY", wall).cast("timestamp_ntz") + F.make_dt_interval(
            hours=(F.floor(F.hour(wall) / 4) * 4).cast("int")
        )
        return (
            self.showing_facts.alias("f")
            .join(self.movies.alias("m"), F.col("m.id") == F.col("f.movie_id"))
            .select(
                "f.id", "f.movie_id", "f.theater_id", "f.date", "f.screen_id", "f.true_screen", "f.true_seats",
                block.alias("local_start"),
                F.coalesce("m.fr_title", "m.title").alias("movie_title"),
                "m.runtime",
            )
        )

    @property
    def schedule_items(self) -> DataFrame:
        kind, title = F.col("id") % 5, F.col("movie_title")
        shown = (
            F.when(kind == 0, F.left(title, F.lit(8)))
            .when(kind == 1, F.concat(title, F.lit(" VF")))
            .when(kind == 2, F.concat(title, F.lit(" (VOSTFR) 3D")))
            .when(kind == 3, F.concat(F.lit("IMAX: "), title))
            .otherwise(title)
        )
        key = (100000 + F.col("id")).cast("string")
        return self.block_showings.select(
            "theater_id",
            "date",
            F.col("id").cast("int").alias("pos"),
            shown.alias("title"),
            tm.hhmm(F.col("local_start")).alias("time"),
            key.alias("key"),
            F.concat(F.lit("https://tickets.example/Film-achat.awp?P1=01&P2=01&P3="), key).alias("url"),
        )

    @property
    def probe_outcomes(self) -> DataFrame:
        counts = self.screens.select("theater_id", F.col("seat_count").alias("candidate")).distinct()
        return (
            self.showing_facts.where(F.col("screen_id").isNull())
            .join(counts, "theater_id")
            .select(F.col("id").alias("showing_id"), "candidate", (F.col("candidate") <= F.col("true_seats")).alias("ok"))
        )

    @property
    def wanted_shows(self) -> DataFrame:
        key = F.col("id")
        return self.block_showings.select(
            key.alias("showing_id"),
            "theater_id",
            "date",
            tm.hhmm(F.col("local_start")).alias("time"),
            F.col("movie_title").alias("title"),
            F.when(key % 8 != 0, F.col("runtime")).alias("runtime"),
            F.when(key % 3 == 0, "FR").when(key % 3 == 1, "EN").alias("language"),
        )

    @property
    def sessions(self) -> DataFrame:
        key, title = F.col("id"), F.col("movie_title")
        name = (
            F.when(key % 4 == 0, title)
            .when(key % 4 == 1, F.upper(title))
            .when(key % 4 == 2, F.concat(title, F.lit(" 3D")))
            .otherwise(F.left(title, F.lit(7)))
        )
        experience = F.when(key % 3 == 0, "Regular").when(key % 3 == 1, "D-BOX").otherwise("UltraAVX")
        area = F.when(key % 5 == 0, fv.GENERAL_AREA).when(key % 5 == 1, fv.MOTION_SEAT_AREA).otherwise("0000000002")
        return self.block_showings.select(
            "theater_id",
            key.alias("pos"),
            name.alias("movie_name"),
            F.concat(F.lit("/film/"), F.col("movie_id").cast("string")).alias("film_url"),
            F.when(key % 9 != 0, F.col("runtime") + key % 13 - 6).cast("int").alias("runtime_minutes"),
            F.when(key % 2 == 0, "FR").otherwise("EN").alias("language_code"),
            F.array(experience).alias("experience_types"),
            F.concat(F.lit(" Salle "), F.col("true_screen").cast("string"), F.lit(" ")).alias("auditorium"),
            F.date_format("local_start", "yyyy-MM-dd'T'HH:mm:ss").alias("start_local"),
            F.lit(None).cast("string").alias("start_utc"),
            F.when(key % 10 != 0, F.concat(F.lit("s"), F.floor(key / 2).cast("string"))).alias("session_id"),
            (F.col("true_seats") - key % 70).cast("int").alias("seats_remaining"),
            area.alias("area_code"),
            "date",
            tm.hhmm(F.col("local_start")).alias("time"),
            F.when(key % 6 == 0, F.date_add("date", 1)).otherwise(F.col("date")).alias("session_date"),
        )

    @property
    def search_wants(self) -> DataFrame:
        key, name = F.col("p_partkey"), F.col("p_name")
        title = (
            F.when(key % 5 == 0, F.concat(name, F.lit(" VF")))
            .when(key % 5 == 1, F.concat(F.lit("Le "), name))
            .when(key % 5 == 2, F.concat("p_brand", F.lit(" : "), name))
            .when(key % 5 == 3, F.concat(F.lit("Inconnu "), "p_brand"))
            .otherwise(name)
        )
        return self.raw("part").select(
            key.alias("want_id"),
            title.alias("title"),
            F.when(key % 11 != 0, 2021 + F.col("p_size") % 6).cast("int").alias("year_hint"),
            F.array(F.concat_ws(" ", "p_type", name)).alias("extra_queries"),
        )

    @property
    def search_results(self) -> DataFrame:
        key, name = F.col("p_partkey"), F.col("p_name")
        query = (
            F.when(key % 3 == 0, name)
            .when(key % 3 == 1, F.concat(F.lit("Le "), name))
            .otherwise(F.concat("p_brand", F.lit(" | "), name))
        )
        title = (
            F.when(key % 4 == 0, name).when(key % 4 == 1, F.upper(name))
            .when(key % 4 == 2, F.concat(name, F.lit(" deux"))).otherwise(F.col("p_brand"))
        )
        original = (
            F.when(key % 7 == 0, F.concat(F.lit("The "), name)).when(key % 7 == 1, name).otherwise(F.col("p_type"))
        )
        released = F.concat((2021 + key % 6).cast("string"), F.lit("-05-01"))
        return self.raw("part").select(
            query.alias("query"),
            (2022 + F.col("p_size") % 4).cast("int").alias("year"),
            key.cast("int").alias("pos"),
            (500000 + key).alias("id"),
            title.alias("title"),
            original.alias("original_title"),
            F.when(key % 13 == 0, "").otherwise(released).alias("release_date"),
            F.array(F.when(key % 4 == 1, fv.DOCUMENTARY_GENRE).otherwise(18)).alias("genre_ids"),
            (F.col("p_size") * 1.5).alias("popularity"),
        )
