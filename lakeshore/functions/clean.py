"""Column expressions for cleaning and classifying. All are null-safe and raise on no input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocabulary import AGING, DELETED, FLOW, INSERTED, STOCK, UPDATED


def squeezed(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), r"\s+", " ")


def keyword(text: Column) -> Column:
    """Search words in lower case with single spaces."""
    return squeezed(F.lower(text))


def full_name(last: Column, first: Column) -> Column:
    """Both names, in that order; without either an empty string."""
    return F.trim(F.regexp_replace(F.concat_ws(" ", last, first), r"\s+", " "))


def masked(phone: Column, shown: int = 3) -> Column:
    return F.concat(F.repeat(F.lit("x"), F.greatest(F.length(phone) - shown, F.lit(0))), F.right(phone, F.lit(shown)))


def city(address: Column) -> Column:
    """What follows the last comma."""
    return F.coalesce(F.trim(F.element_at(F.split(address, ","), -1)), F.lit("unknown"))


def gender(code: Column) -> Column:
    return F.when(code == 1, "M").when(code == 2, "F").otherwise("O")


def change_kind(deleted: Column, created_at: Column, day: str) -> Column:
    """Deleted, inserted on the given day (yyyyMMdd), or updated."""
    return F.when(deleted, DELETED).when(F.date_format(created_at, "yyyyMMdd") == day, INSERTED).otherwise(UPDATED)


def aging(days: Column) -> Column:
    out = None
    for most, sign, name in AGING:
        hit = days < most if sign == "<" else days <= most
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(">28")


def smart_key(*parts: Column) -> Column:
    """Parts joined by underscores; null parts are left out."""
    return F.concat_ws("_", *parts)


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """A rounded share as a double; null where the whole is 0."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)


def failed(is_success: Column, is_valid: Column) -> Column:
    """Either flag says no; a missing flag says nothing."""
    return F.coalesce(is_success == 0, F.lit(False)) | F.coalesce(is_valid == 0, F.lit(False))


def in_stock(status: Column) -> Column:
    return status.isin(*STOCK)


def in_flow(status: Column) -> Column:
    return status.isin(*FLOW)


def month_before(ym: Column, months: int = 1) -> Column:
    return F.date_format(F.add_months(F.to_date(F.concat(ym, F.lit("01")), "yyyyMMdd"), -months), "yyyyMM")


def month_number(ym: Column) -> Column:
    """A number of the month yyyyMM; that of the next month is one more. Null for anything else."""
    n = F.when(ym.rlike(r"^\d{6}$"), ym).cast("int")
    return F.floor(n / 100).cast("int") * 12 + n % 100


def epoch_seconds(at: Column) -> Column:
    """Seconds since 1970 of a wall-clock time, whatever the session's zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), at.cast("timestamp_ntz"))
