"""Calendar and timestamp helpers on naive (UTC) timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# French calendar names, in calendar order.
MONTH_NAMES = [
    "janvier", "février", "mars", "avril", "mai", "juin",
    "juillet", "août", "septembre", "octobre", "novembre", "décembre",
]
DAY_NAMES = ["lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche"]


def date_key(moment: Column) -> Column:
    """``YYYYMMDD`` as an integer, by arithmetic (no text formatting, no time zone)."""
    day = F.to_date(moment)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def iso_weekday(day: Column) -> Column:
    """Monday 1 … Sunday 7."""
    return F.weekday(day) + 1


def name_of(names: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), number)


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def micros(moment: Column) -> Column:
    """Microseconds since the epoch of a naive timestamp (session time zone is UTC)."""
    return F.unix_micros(moment.cast("timestamp"))


def rounded_seconds(micros_elapsed: Column) -> Column:
    """Whole seconds, half up; the elapsed time is never negative."""
    return F.call_function("div", micros_elapsed + F.lit(500_000), F.lit(1_000_000)).cast("int")


def iso_text(moment: Column) -> Column:
    """ISO-8601 text; the fraction appears only when there is one."""
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(moment, ".SSSSSS")
    return F.concat(whole, F.when(fraction == ".000000", "").otherwise(fraction))

