"""Date and time columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_TIME = "dd/MMM/yyyy:HH:mm:ss Z"
DATETIME = "yyyy-MM-dd HH:mm:ss"
# Sunday first. Fixed values.
WEEKDAYS = ["周日", "周一", "周二", "周三", "周四", "周五", "周六"]


def as_of_literal(as_of) -> Column:
    """The reference instant of a report, as a zone-free timestamp literal."""
    return F.lit(str(as_of)).cast("timestamp_ntz")


def before(as_of, length: str) -> Column:
    """`as_of` minus an interval such as "7 DAY"; folds to a literal, so scans can prune."""
    return as_of_literal(as_of) - F.expr(f"INTERVAL {length}")


def since(ts: Column, as_of, length: str) -> Column:
    return ts >= before(as_of, length)


def shifted_week(ts: Column, as_of) -> Column:
    """The seven days that end a week before `as_of`, both ends included."""
    return ts.between(before(as_of, "14 DAY"), before(as_of, "7 DAY"))


def log_time(text: Column) -> Column:
    """Access-log time to an instant; text that does not parse gives null."""
    return F.try_to_timestamp(text, F.lit(LOG_TIME))


def datetime_text(ts: Column) -> Column:
    return F.date_format(ts, DATETIME)


def millis_text(millis: Column) -> Column:
    """Epoch milliseconds, as number or text, to date-time text."""
    return F.date_format(F.timestamp_millis(millis.try_cast("bigint")), DATETIME)


def reformat(text: Column, source: str, target: str) -> Column:
    return F.date_format(F.try_to_timestamp(text, F.lit(source)), target)


def month_start(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def weekday_label(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in WEEKDAYS]), F.dayofweek(day))


def days_back(day: Column, n: int) -> Column:
    return F.date_format(F.date_sub(day, n), "yyyy-MM-dd")


def months_back(day: Column, n: int) -> Column:
    return F.date_format(F.add_months(day, -n), "yyyy-MM-dd")


def years_back(day: Column, n: int) -> Column:
    return F.date_format(F.add_months(day, -12 * n), "yyyy-MM-dd")


def day_key(ts: Column) -> Column:
    """Day as text, taken from the front of the timestamp's text."""
    return F.date_format(ts, "yyyy-MM-dd")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))
