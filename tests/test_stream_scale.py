"""What the measurement stream does once, however many partitions and batches there are."""

from reelhouse.catalog.queries_streaming import LANDED_FILES, landed
from reelhouse.operators.match_screen import auditorium_offers, screen_by_auditorium
from reelhouse.sources.sample import SampleTables


def test_files_landed_do_not_grow_with_the_partitions(spark, folder, tmp_path):
    """More files would mean more batches, each of which lays the updates over the whole state."""
    t, kept = SampleTables(spark, folder), {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        path = landed(spark, t, str(tmp_path))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    files = spark.read.parquet(path)
    assert len(files.inputFiles()) == LANDED_FILES
    assert files.exceptAll(t.measurements).isEmpty() and files.count() == t.measurements.count()


def test_offers_of_screens_serve_every_batch(spark):
    """Texts of two batches meet keys worked out once; the screens themselves aren't read again."""
    screens = spark.createDataFrame([(1, 1, "Salle 1", 80), (2, 1, "La très grande salle du rez-de-chaussée", 90), (3, 1, None, 100), (4, None, "Salle 4", 70)], "id bigint, theater_id bigint, name string, seat_count int")
    texts = [(1, "salle 1"), (1, "1"), (1, "grande salle du rez-de-chaussée"), (1, " "), (None, "Salle 4"), (1, None)]
    offers = tuple(d.localCheckpoint() for d in auditorium_offers(screens))
    for part in (texts[:2], texts[2:], texts):
        wanted = spark.createDataFrame(part, "theater_id bigint, auditorium string")
        found = screen_by_auditorium(wanted, None, offers).collect()
        assert sorted(map(tuple, found)) == sorted(map(tuple, screen_by_auditorium(wanted, screens).collect()))
        assert found
