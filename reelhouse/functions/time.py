"""Dates, week ids, local time, bands and French date text as Column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelhouse import fixed_values as fv
from reelhouse.functions.text import SPACE, once, pattern, strip_marks, trim_space


# ---- weekends -----------------------------------------------------------------------------
def weekend_id(date: Column) -> Column:
    """ISO week of a date as YYYYWW."""
    return (F.extract(F.lit("YEAROFWEEK"), date) * 100 + F.weekofyear(date)).cast("int")


def monday_of(weekend: Column) -> Column:
    year, week = F.floor(weekend / 100).cast("int"), (weekend % 100).cast("int")
    jan4 = F.make_date(year, F.lit(1), F.lit(4))
    return F.date_add(jan4, (week - 1) * 7 - F.weekday(jan4))


def friday_of(weekend: Column) -> Column:
    return F.date_add(monday_of(weekend), 4)


def sunday_of(weekend: Column) -> Column:
    return F.date_add(monday_of(weekend), 6)


def weekend_dates(weekend: int) -> tuple[dt.date, dt.date]:
    """Friday and Sunday of a week id, for literal date bounds in a plan."""
    year, week = divmod(weekend, 100)
    return dt.date.fromisocalendar(year, week, 5), dt.date.fromisocalendar(year, week, 7)


def last_friday(date: Column) -> Column:
    """The Friday on or before a date."""
    return F.date_sub(F.next_day(date, "FRI"), 7)


def lenient_iso_date(c: Column) -> Column:
    """Date from 'YYYY-M-D' text with '/' or '-' and stray characters; NULL if not a date."""
    x = F.replace(F.regexp_replace(trim_space(c), "[^0-9/-]", ""), F.lit("/"), F.lit("-"))
    x = F.regexp_replace(x, "^(.*?)-([0-9]{2})[0-9](?![0-9])", "$1-$2")
    whole = F.regexp_extract(x, "^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})$", 1)
    return F.when(whole != "", F.try_to_date(whole, "yyyy-M-d"))


# ---- local wall clock ---------------------------------------------------------------------
def to_local(instant: Column, tz: str = fv.LOCAL_TZ) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), instant)


def to_utc(local: Column, tz: str = fv.LOCAL_TZ) -> Column:
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), local)


def local_date(instant: Column, tz: str = fv.LOCAL_TZ) -> Column:
    return to_local(instant, tz).cast("date")


def hhmm(wall_clock: Column) -> Column:
    return F.date_format(wall_clock, "HH:mm")


def second_of_day(wall_clock: Column) -> Column:
    """Second of the day, fraction kept."""
    return F.hour(wall_clock) * 3600 + F.minute(wall_clock) * 60 + F.extract(F.lit("SECOND"), wall_clock)


def local_start(date: Column, time: Column, tz: str = fv.LOCAL_TZ) -> Column:
    """UTC instant of a local date and an 'H:MM' text."""
    clock = F.lpad(time, 5, "0")  # built from its fields: no session zone has a say in it
    hour, minute = (F.regexp_extract(clock, r"^([0-9]{2}):([0-9]{2})$", i).try_cast("int") for i in (1, 2))
    wall = F.try_make_timestamp_ntz(F.year(date), F.month(date), F.day(date), hour, minute, F.lit(0))
    return to_utc(wall, tz)


def band(seconds: Column) -> Column:
    """Time-of-day band; NULL outside every band, also in the open last minute of one."""
    out = F.lit(None).cast("string")
    for label, first, last in reversed(fv.BANDS):
        out = F.when(seconds.between(first, last), label).otherwise(out)
    return out


def in_quiet_hours(instant: Column) -> Column:
    local = hhmm(to_local(instant))
    return (local >= fv.QUIET_START) & (local < fv.QUIET_END)


# ---- minutes ------------------------------------------------------------------------------
def minute_of_day(time: Column) -> Column:
    """Minutes since midnight of an 'HH:MM' text, NULL when it is none."""
    h = F.regexp_extract(time, "^([0-9]{1,2}):([0-9]{2})$", 1)
    m = F.regexp_extract(time, "^([0-9]{1,2}):([0-9]{2})$", 2)
    return F.when(h != "", h.try_cast("int") * 60 + m.try_cast("int"))


def minutes_apart(a: Column, b: Column) -> Column:
    """Absolute distance in minutes between two 'HH:MM' texts; NULL stands for 'infinitely far'."""
    return F.abs(minute_of_day(a) - minute_of_day(b))


# ---- French dates -------------------------------------------------------------------------
_MONTH_WORDS = "janvier|février|fevrier|mars|avril|mai|juin|juillet|août|aout|septembre|octobre|novembre|décembre|decembre"


def _month_number(word: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in fv.FRENCH_MONTHS.items() for x in pair])
    return F.try_element_at(table, strip_marks(F.lower(word)))


def french_date(text: Column, after: str = "") -> Column:
    """First 'day month year' in a text, optionally only after a given word; NULL for impossible days."""
    lead = f"{after}[^\\n\\r]*?" if after else ""
    p = f"(?iu){lead}([0-9]{{1,2}}){SPACE}+({_MONTH_WORDS}){SPACE}+([0-9]{{4}})"
    day, month, year = (F.regexp_extract(text, p, i) for i in (1, 2, 3))
    iso = F.concat_ws("-", year, F.lpad(_month_number(month).cast("string"), 2, "0"), F.lpad(day, 2, "0"))
    return F.when(day != "", F.try_to_date(iso, "yyyy-MM-dd"))


def french_day_month(label: Column, as_of: Column) -> Column:
    """Date from a label without year: the year of as_of, but January seen in December is next year's."""
    edge = f"(?:^|{SPACE})", f"(?={SPACE}|$)"

    def parts(low: Column) -> Column:
        day = F.regexp_extract(low, f"{edge[0]}([0-9]{{1,2}})(?:er)?{edge[1]}", 1)
        return F.struct(day.alias("day"), _month_number(F.regexp_extract(low, f"{edge[0]}({_MONTH_WORDS}){edge[1]}", 1)).alias("month"))

    def date(p: Column) -> Column:
        day, month = p["day"], p["month"]
        year = F.year(as_of) + F.when((month == 1) & (F.month(as_of) == 12), 1).otherwise(0)
        iso = F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day, 2, "0"))
        return F.when((day != "") & month.isNotNull(), F.try_to_date(iso, "yyyy-MM-dd"))

    return once(once(F.lower(label), parts), date)


# ---- time text ----------------------------------------------------------------------------
def program_time(text: Column) -> Column:
    """'18h45' or '18:45' as HH:MM; hour 24 reads as 00; anything else NULL."""
    x = F.regexp_replace(text, "[^0-9hH:]", "")

    def read(clock: Column) -> Column:
        hour = F.lpad(F.regexp_replace(clock, "[:hH].*$", ""), 2, "0")
        return F.when(clock != "", F.concat(once(hour, lambda h: F.when(h == "24", "00").otherwise(h)), F.lit(":"), F.right(clock, F.lit(2))))

    return once(F.regexp_extract(x, "^((?:[01]?[0-9]|2[0-4])[:hH][0-5][0-9])$", 1), read)


def schedule_time(text: Column) -> Column:
    """First clock time in a text: 12-hour with AM/PM, '18:45', '18 h 45' or '18 h'; NULL if none."""
    twelve = pattern(r"(?i){B}(1[0-2]|0?[0-9]):([0-5][0-9])\s*(AM|PM){B}")
    clock = pattern(r"(?i){B}(?:([01]?[0-9]|2[0-3]):([0-5][0-9])|([01]?[0-9]|2[0-3])\s*h\s*([0-5][0-9])?){B}")
    h12, m12, half = (F.regexp_extract(text, twelve, i) for i in (1, 2, 3))
    hour = h12.try_cast("int") % 12 + F.when(F.upper(half) == "PM", 12).otherwise(0)
    h = F.concat(F.regexp_extract(text, clock, 1), F.regexp_extract(text, clock, 3))
    m = F.concat(F.regexp_extract(text, clock, 2), F.regexp_extract(text, clock, 4))
    return F.when(h12 != "", F.concat_ws(":", F.lpad(hour.cast("string"), 2, "0"), m12)).when(
        h != "", F.concat_ws(":", F.lpad(h, 2, "0"), F.when(m == "", "00").otherwise(m))
    )


def ticket_time(text: Column) -> Column:
    """'18:45' or '18h45' anywhere in a text, else a bare one- or two-digit hour."""
    full = pattern(r"{B}([0-9]{1,2})[:hH]([0-9]{2}){B}")
    bare = pattern(r"{B}([0-9]{1,2}){B}")
    h, m, hour = F.regexp_extract(text, full, 1), F.regexp_extract(text, full, 2), F.regexp_extract(text, bare, 1)
    return F.when(h != "", F.concat_ws(":", F.lpad(h, 2, "0"), m)).when(
        hour != "", F.concat(F.lpad(hour, 2, "0"), F.lit(":00"))
    )


# ---- months -------------------------------------------------------------------------------
def month_label(date: Column, ahead: int = 0) -> Column:
    return F.date_format(F.add_months(F.trunc(date, "MM"), ahead), "yyyy-MM")


def month_labels(date: Column, first: int, last: int) -> Column:
    """Labels 'YYYY-MM' of the months first..last after the month of a date."""
    start = F.trunc(date, "MM")
    months = F.sequence(F.add_months(start, first), F.add_months(start, last), F.expr("interval 1 month"))
    return F.transform(months, lambda d: F.date_format(d, "yyyy-MM"))
