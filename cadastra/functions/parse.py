"""Dates, times and numbers as they stand in files: what can't be read is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def compact_date(c: Column | str) -> Column:
    """YYYYMMDD, exactly eight digits."""
    x = col(c)
    return F.when(x.rlike(r"\A[0-9]{8}\z") & (x != "00000000"), F.try_to_date(x, "yyyyMMdd"))


def any_date(c: Column | str) -> Column:
    """DD/MM/YYYY or YYYY-MM-DD, anything after it ignored, or just YYYYMMDD."""
    x = F.trim(F.coalesce(col(c), F.lit("")))
    return (
        F.when(x.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}"), F.try_to_date(F.left(x, F.lit(10)), "dd/MM/yyyy"))
        .when(x.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.try_to_date(F.left(x, F.lit(10)), "yyyy-MM-dd"))
        .otherwise(compact_date(x))
    )


def list_date(c: Column | str) -> Column:
    """As any_date, and YYYY (its first day), YYYYMM and YYYY-MM (the month's first day)."""
    x = F.trim(F.coalesce(col(c), F.lit("")))
    return (
        F.when(x.rlike(r"\A[0-9]{4}\z"), F.try_to_date(F.concat(x, F.lit("0101")), "yyyyMMdd"))
        .when(x.rlike(r"\A[0-9]{4}-?[0-9]{2}\z"), F.try_to_date(F.concat(F.replace(x, F.lit("-"), F.lit("")), F.lit("01")), "yyyyMMdd"))
        .otherwise(any_date(x))
    )


def amount(c: Column | str) -> Column:
    """A number with decimal comma and thousands points, with thousands points only, or plain; currency sign and blanks ignored."""
    x = F.regexp_replace(F.trim(F.coalesce(col(c), F.lit(""))), r"[R$\s]", "")
    plain = (
        F.when(x.rlike(r",[0-9]+$"), F.replace(F.replace(x, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(x.rlike(r"^-?[0-9]{1,3}(\.[0-9]{3})+$"), F.replace(x, F.lit("."), F.lit("")))
        .otherwise(x)
    )
    return F.nullif(plain, F.lit("")).try_cast("decimal(38,10)")


def hour(c: Column | str) -> Column:
    """Hour of hh:mm anywhere in the text, or of one or two bare digits; null outside 0 to 23."""
    x = F.coalesce(col(c), F.lit(""))
    h = F.coalesce(
        F.nullif(F.regexp_extract(x, r"([0-9]{1,2}):[0-9]{2}", 1), F.lit("")), F.nullif(F.regexp_extract(x, r"\A\s*([0-9]{1,2})\s*\z", 1), F.lit(""))
    ).cast("int")
    return F.when(h.between(0, 23), h)


def clock_seconds(c: Column | str) -> Column:
    """HH:MM:SS as seconds; hours may pass 24."""
    p = F.split(F.trim(col(c)), ":")
    ok = F.trim(col(c)).rlike(r"\A[0-9]{1,3}:[0-9]{2}:[0-9]{2}\z")
    part = lambda i: F.get(p, F.lit(i)).try_cast("int")
    return F.when(ok, part(0) * 3600 + part(1) * 60 + part(2))


def completed_years(start: Column | str, end: Column | str) -> Column:
    """Whole years between two dates, counted by calendar day."""
    a, b = col(start), col(end)
    before = F.struct(F.month(b), F.dayofmonth(b)) < F.struct(F.month(a), F.dayofmonth(a))
    return F.year(b) - F.year(a) - before.cast("int")
