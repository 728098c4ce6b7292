"""Dates as feeds and research providers write them: Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def published(c: Column) -> Column:
    """The moment of a published date: ISO (with Z, an offset or the date alone), RFC 822, ``8 January 2024``, ``January 8, 2024`` and short months. Without a zone it is UTC; what is none of these is null."""
    s = F.trim(c)
    iso = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(s, F.lit("T00:00:00Z"))).when(s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"), F.when(s.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), s).otherwise(F.concat(s, F.lit("Z"))))
    day = F.regexp_replace(s, r"^[A-Za-z]{3,9},\s*", "")  # a parser has no use for the day of the week
    zone = r"\s+(?:GMT|UT|UTC|Z)$"
    mail = F.regexp_replace(F.regexp_replace(day, zone, " +0000"), r"^(\d) ", "0$1 ")
    mail = F.when(mail.rlike(r"[+-]\d{4}$"), mail).otherwise(F.concat(mail, F.lit(" +0000")))
    words = F.regexp_replace(F.regexp_replace(s, r"^([A-Za-z]+)\.? (\d{1,2}), ?(\d{4})$", "$2 $1 $3"), r"^(\d) ", "0$1 ")
    short = F.regexp_replace(words, r"^(\d{2} [A-Za-z]{3})[a-z]* (\d{4})$", "$1 $2")
    return F.coalesce(
        F.try_to_timestamp(iso), F.try_to_timestamp(mail, F.lit("dd MMM yyyy HH:mm:ss xx")), F.try_to_timestamp(mail, F.lit("dd MMM yyyy HH:mm xx")),
        F.try_to_timestamp(F.concat(short, F.lit(" +0000")), F.lit("dd MMM yyyy xx")),
    )


def loose_date(c: Column) -> Column:
    """A research date of a year (2000 to 2099), with a month (number or name) and a day where there is one; impossible dates are null."""
    s = F.lower(c)
    part = lambda k: F.regexp_extract(s, r"(20\d{2})(?:[- /]?([01]?\d))?(?:[- /]?([0-3]?\d))?", k)
    name, named = F.lit(None).cast("int"), F.lit(None).cast("int")
    for k, month in enumerate(MONTHS, 1):
        name = F.coalesce(name, F.when(s.contains(month), k))
    named = F.regexp_extract(s, r"20\d{2}[- /]?[a-z]{3,9}[- /]?([0-3]?\d)", 1)
    month = F.coalesce(name, F.nullif(part(2), F.lit("")).cast("int"), F.lit(1))
    day = F.coalesce(F.when(name.isNotNull(), F.nullif(named, F.lit("")).cast("int")).otherwise(F.nullif(part(3), F.lit("")).cast("int")), F.lit(1))
    return F.when(part(1) != "", F.try_to_date(F.format_string("%s-%02d-%02d", part(1), month, day), "yyyy-MM-dd"))
