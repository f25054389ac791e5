"""Money text, seats and revenue arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelhouse import fixed_values as fv
from reelhouse.functions.text import SPACE

_NUMBER = r"^([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+))"


def _leading_number(c: Column) -> Column:
    return F.regexp_extract(c, _NUMBER, 1).try_cast("double")


def whole(c: Column) -> Column:
    """Half-up rounding to a whole number (a plain cast would cut); float noise is cleared first."""
    return F.round(F.round(c, 6)).cast("bigint")


def _bare_amount(text: Column, also: str) -> Column:
    x = F.regexp_replace(text, f"{SPACE}|{also}", "")
    return F.regexp_replace(x, "^([^,]*),", "$1.")


def money_text(text: Column) -> Column:
    """'1,23M$' or '1 234 567 $' to whole units; NULL when no number leads the text."""
    x = _bare_amount(text, r"&nbsp;|\$")
    millions = F.regexp_extract(x, "(?i)^([0-9.]+)M", 1)
    return F.when(millions != "", whole(_leading_number(millions) * 1_000_000)).otherwise(
        whole(_leading_number(x))
    )


def plain_amount(text: Column) -> Column:
    """Amount without unit letters, fraction kept."""
    return _leading_number(_bare_amount(text, r"\$"))


def seats_sold_clamped(capacity: Column, remaining: Column) -> Column:
    """Sold seats kept within 0..capacity."""
    cap = F.coalesce(capacity, F.lit(0))
    return F.greatest(F.lit(0), F.least(cap, cap - F.coalesce(remaining, F.lit(0)))).cast("int")


def seats_sold(capacity: Column, remaining: Column) -> Column:
    """Sold seats floored at 0, without upper bound."""
    return F.greatest(F.lit(0), F.coalesce(capacity, F.lit(0)) - remaining).cast("int")


def weekend_revenue(seats: Column, price: float, bias: float, floor: Column) -> Column:
    """Seats to money, at least 0 and below the published floor less 10 when there is one."""
    amount = seats * F.lit(price) * F.lit(bias)
    return F.when(seats.isNotNull(), whole(F.greatest(F.lit(0.0), F.least(amount, (floor - 10).cast("double")))))


def midweek_revenue(seats: Column, price: float, bias: float) -> Column:
    return F.when(seats.isNotNull(), whole(seats * F.lit(price) * F.lit(bias)))


def change_percent(current: Column, previous: Column, first: Column) -> Column:
    """Change against the previous figure in percent, two decimals, within +-9999.99."""
    change = F.round((current.cast("double") / previous.cast("double") - 1) * 100, 2)
    known = ~first & current.isNotNull() & previous.isNotNull() & (previous != 0)
    return F.when(
        known, F.least(F.lit(9999.99), F.greatest(F.lit(-9999.99), change))
    ).cast("decimal(6,2)")


def is_provisional(film_id: Column) -> Column:
    return film_id >= fv.PROVISIONAL_BASE


def budget_or_null(budget: Column) -> Column:
    return F.nullif(budget, F.lit(0))
