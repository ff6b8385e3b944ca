"""Dates of the registers as ISO strings; null where a text is none of the forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .chains import let, strip

ISO_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
# First year of each Japanese era less one.
ERAS = {"令和": 2018, "平成": 1988, "昭和": 1925, "大正": 1911}


def _parsed(text: Column, *formats: str) -> Column:
    return F.date_format(F.coalesce(*[F.expr("null").cast("date")], *[F.try_to_date(text, f) for f in formats]), "yyyy-MM-dd")


def eu_date(text: Column) -> Column:
    return _parsed(strip(text), "d/M/yyyy", "yyyy-M-d", "d.M.yyyy", "d-M-yyyy")


def uk_date(text: Column) -> Column:
    return _parsed(strip(text), "dd/MM/yyyy", "yyyy-MM-dd", "d MMM yyyy", "d MMMM yyyy")


def us_date(text: Column) -> Column:
    """M/D/YYYY rewritten as YYYY-MM-DD without a look at the calendar."""

    def turned(day: Column) -> Column:
        part = lambda i: F.regexp_extract(day, r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})\z", i)
        return F.when(part(3) != "", F.concat_ws("-", part(3), F.lpad(part(1), 2, "0"), F.lpad(part(2), 2, "0")))

    return let(strip(text), turned)


def iso_date(text: Column) -> Column:
    """The day of an ISO date or date and time."""
    day = F.substring(strip(text), 1, 10)
    return F.when(day.rlike(ISO_DAY) & F.try_to_date(day, "yyyy-MM-dd").isNotNull(), day)


def wareki_date(text: Column) -> Column:
    """Japanese era date, the first year of an era written as 1 or 元."""
    plain = F.translate(F.regexp_replace(text, r"(?U)\s+", ""), "０１２３４５６７８９", "0123456789")
    part = lambda i: F.regexp_extract(plain, r"(令和|平成|昭和|大正)(元|[0-9]{1,2})年([0-9]{1,2})月([0-9]{1,2})日", i)
    base = F.coalesce(*[F.when(part(1) == era, F.lit(year)) for era, year in ERAS.items()])
    year = base + F.when(part(2) == "元", 1).otherwise(F.expr("0") + F.try_to_number(F.nullif(part(2), F.lit("")), F.lit("99")).cast("int"))
    day = F.concat_ws("-", year.cast("string"), F.lpad(part(3), 2, "0"), F.lpad(part(4), 2, "0"))
    return F.when(base.isNotNull() & F.try_to_date(day, "yyyy-MM-dd").isNotNull(), day)


def any_date(text: Column) -> Column:
    """The first of the forms above that fits."""
    return F.coalesce(iso_date(text), eu_date(text), uk_date(text), us_date(text), wareki_date(text))


def link_day(link: Column) -> Column:
    """The day that an action page's link names as yyyymmdd, or null."""
    code = F.regexp_extract(F.substring_index(link, "/", -1), "[0-9]{8}", 0)
    return let(code, lambda c: F.when(c != "", F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))))


def action_day(link: Column, published: Column) -> Column:
    """Day of an action page: yyyymmdd in its link, else a written US date, else the page's own date."""
    return F.coalesce(link_day(link), let(published, lambda p: F.coalesce(us_date(p), _parsed(p, "MMMM d, yyyy"), iso_date(p))))
