"""Golden values of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reelhouse.functions import money
from reelhouse.functions import text as tx
from reelhouse.functions import time as tm
from reelhouse.operators import match_film, providers

D = dt.date


@pytest.mark.parametrize(
    "build, given, expected",
    [
        (tx.name_key, "  Cinéma   Élysée (Granby) ", "cinema elysee (granby)"),
        (tx.name_key, "Cinéma", "cinema"),
        (tx.title_key, "Le Comte de Monte-Cristo (VF)", "comte de monte cristo"),
        (tx.title_key, "(VF) Le film", "le film"),
        (tx.title_key, "L'été [3D] IMAX", "ete"),
        (tx.flat_title, "Le Comte de Monte-Cristo (VF)", "comtedemontecristo"),
        (tx.base_title, "Mission : Impossible…", "mission"),
        (tx.base_title, "It…", "it"),
        (tx.version_signature, "Dune VF 3D", "3D+VF"),
        (tx.version_signature, "Dune VOSTFR", "VOST"),
        (tx.version_signature, "Dune v.o.a. D-Box", "DBOX+VOA"),
        (tx.version_signature, "Dune", "default"),
        (tx.version_signature, "Vfamille Imaxx", "default"),
        (tx.auditorium_key, "Salle 07", "7"),
        (tx.auditorium_key, "Auditorium #10 VIP", "10"),
        (tx.digits, "Salle 07", "07"),
        (tx.digits, None, ""),
        (tx.identity_key, "L’Été  ﬁn​", "l'ete ﬁn"),
        (tx.without_version_markers, "Dune V.F. (version française)", "Dune ."),
        (tx.without_version_markers, "Dune vf", "Dune"),
        (tx.decode_entities, "a &amp; b &lt;&quot;&apos;", "a & b <\"'"),
        (tx.decode_entities, "&amp;quot;", "&quot;"),
        (tx.plain_text, "<p>a</p><script>x<y</script><style>z</style><b>b&amp;c</b>", "a b&c"),
        (tx.canonical_href, "/films/a-b/?x=1", "/films/a-b"),
        (tx.slug_title, "/films/le-grand-film/", "Le Grand Film"),
        (lambda c: tx.slug_title(c, True), "/films/le-grand-film-vfof", "Le Grand Film"),
        (lambda c: tx.base_film_url(c, "https://x.example"), "/films/a/horaires", "https://x.example/films/a"),
        (lambda c: tx.url_param(c, "P3"), "https://x.example/a?P1=1&P3=77", "77"),
        (lambda c: tx.url_param(c, "P3"), "https://x.example/a?P1=1", None),
        (lambda c: tx.with_url_param(c, "P3", F.lit("9")), "https://x.example/a?P3=77&b=1#c", "https://x.example/a?P3=9&b=1#c"),
        (lambda c: tx.with_url_param(c, "P3", F.lit("9")), "https://x.example/a", "https://x.example/a?P3=9"),
        (tx.title_candidate, "Théâtre Desjardins", None),
        (tx.title_candidate, "de  Foo Bar • 2 h", "Foo Bar"),
        (tx.title_candidate, "x", None),
        (tm.program_time, "18h45", "18:45"),
        (tm.program_time, "24:10", "00:10"),
        (tm.program_time, "25:10", None),
        (tm.schedule_time, "18 h 45", "18:45"),
        (tm.schedule_time, "18 h", "18:00"),
        (tm.schedule_time, "7:10 PM", "19:10"),
        (tm.schedule_time, "12:05 am", "00:05"),
        (tm.schedule_time, "complet", None),
        (tm.ticket_time, "séance 18", "18:00"),
        (tm.ticket_time, "à 9h05", "09:05"),
        (money.money_text, "1,23M$", 1230000),
        (money.money_text, "1 234 567 $", 1234567),
        (money.money_text, "1 234 567 $", 1234567),
        (money.money_text, "n/d", None),
        (money.plain_amount, "12 345,5 $", 12345.5),
        (lambda c: tm.french_date(c, "sortie"), "Sortie partout au Québec : 14 novembre 2025", D(2025, 11, 14)),
        (tm.french_date, "le 5 AOÛT 2024", D(2024, 8, 5)),
        (tm.french_date, "31 février 2024", None),
        (tm.lenient_iso_date, "2024/3/7 (jeu.)", D(2024, 3, 7)),
        (tm.lenient_iso_date, "mars 2024", None),
        (match_film.search_norm, "L'Été: 2", "l ete 2"),
        (match_film.release_year, "2024-01-05", 2024),
        (match_film.release_year, "", None),
        (providers.provider_of, "CINÉMA   Magog", "webdev"),
        (providers.provider_of, "Cinéma Banque Scotia", "cineplex"),
        (providers.provider_of, "Cinémathèque québécoise", "cinematheque"),
        (providers.provider_of, "Cinéma Triomphe", "cineentreprise"),
        (providers.provider_of, "Cineplex de demain", "cineplex"),
        (providers.provider_of, "Salle du village", None),
    ],
)
def test_text_and_time(one, build, given, expected):
    assert one(build, given) == expected


@pytest.mark.parametrize(
    "day, week, friday, sunday",
    [
        (D(2021, 1, 3), 202053, D(2021, 1, 1), D(2021, 1, 3)),
        (D(2025, 12, 28), 202552, D(2025, 12, 26), D(2025, 12, 28)),
        (D(2024, 1, 7), 202401, D(2024, 1, 5), D(2024, 1, 7)),
    ],
)
def test_weekends(one, day, week, friday, sunday):
    assert one(tm.weekend_id, day) == week
    assert one(tm.friday_of, week) == friday
    assert one(tm.sunday_of, week) == sunday
    assert tm.weekend_dates(week) == (friday, sunday)


@pytest.mark.parametrize("day, friday", [(D(2024, 1, 5), 5), (D(2024, 1, 6), 5), (D(2024, 1, 7), 5), (D(2024, 1, 11), 5)])
def test_last_friday(one, day, friday):
    assert one(tm.last_friday, day) == D(2024, 1, friday)


def test_january_seen_in_december(one):
    assert one(tm.french_day_month, "jeudi 1er janvier", D(2025, 12, 20)) == D(2026, 1, 1)
    assert one(tm.french_day_month, "jeudi 15 janvier", D(2026, 1, 3)) == D(2026, 1, 15)
    assert one(tm.french_day_month, "bientôt", D(2026, 1, 3)) is None


@pytest.mark.parametrize(
    "clock, band",
    [("13:59:00", "11-14"), ("13:59:30", None), ("10:59:00", None), ("11:00:00", "11-14"), ("20:30:00", "2030-24"), ("23:59:30", None)],
)
def test_bands(one, clock, band):
    at = dt.datetime.fromisoformat(f"2024-01-05 {clock}")
    assert one(lambda c: tm.band(tm.second_of_day(c.cast("timestamp_ntz"))), at.isoformat(" ")) == band


@pytest.mark.parametrize("clock, quiet", [("00:59", False), ("01:00", True), ("09:29", True), ("09:30", False)])
def test_quiet_hours(one, clock, quiet):
    utc = dt.datetime.fromisoformat(f"2024-01-05 {clock}") + dt.timedelta(hours=5)
    assert one(lambda c: tm.in_quiet_hours(c.cast("timestamp_ntz")), utc.isoformat(" ")) is quiet


def test_summer_time(one):
    assert one(lambda c: tm.hhmm(tm.to_local(c.cast("timestamp_ntz"))), "2025-07-01 23:30:00") == "19:30"
    assert one(lambda d, t: tm.local_start(d, t), D(2025, 7, 1), "9:05") == dt.datetime(2025, 7, 1, 13, 5)
    assert one(lambda d, t: tm.local_start(d, t), D(2025, 7, 1), "25:05") is None


def test_title_distance(one):
    for a, b, expected in (("Dune", "dune!", 0), ("Dune", "Dune deux", 1), ("", "Dune", 4), ("abc", "xyz", 3)):
        assert one(tx.title_distance, a, b) == expected


def test_word_similarity(one):
    assert one(tx.word_similarity, "Le grand bleu", "grand bleu profond mer") == 0.5
    assert one(tx.word_similarity, "", "grand") == 0.0


def test_separator_variants(one):
    assert one(tx.separator_variants, "A : B") == ["A : B", "A | B", "A - B", "A B"]


def test_seats(one):
    assert one(money.seats_sold_clamped, 120, 130) == 0
    assert one(money.seats_sold_clamped, 120, -5) == 120
    assert one(money.seats_sold, 120, -5) == 125


def test_change(one):
    change = lambda a, b, f: money.change_percent(a.cast("bigint"), b.cast("bigint"), f)
    assert float(one(change, 50, 100, False)) == -50.0
    assert one(change, 50, 0, False) is None
    assert one(change, 50, 100, True) is None
    assert float(one(change, 1_000_000, 1, False)) == 9999.99


def test_windows(one):
    for name, bounds in (("Cinéma Beaubien", (729, 900)), ("Cinéma Magog", (825, 1005)), ("Cinéma Triomphe", (-435, 0)), ("Ailleurs", (720, 1020))):
        first = one(lambda n: providers.measuring_window(providers.provider_of(n), n)[0], name)
        last = one(lambda n: providers.measuring_window(providers.provider_of(n), n)[1], name)
        assert (first, last) == bounds


def test_months(one):
    assert one(lambda d: tm.month_label(d, 1), D(2024, 1, 31)) == "2024-02"
    assert one(lambda d: tm.month_labels(d, 2, 4), D(2024, 11, 30)) == ["2025-01", "2025-02", "2025-03"]
