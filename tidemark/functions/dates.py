"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the time format of the logs, e.g. 20230204T161026.000Z. The fraction
# may have one to six digits.
LOG_TIME_FORMAT = "yyyyMMdd'T'HHmmss.SSSSSS'Z'"

# What a text in that format looks like.
LOG_TIME_PATTERN = r"^\d{8}T\d{6}\.\d{1,6}Z$"

WEEKLY = "weekly"
MONTHLY = "monthly"


def parse_log_day(stamp, bad_time: str = "raise") -> Column:
    """Calendar day of a log time. A bad text raises, or is NULL with ``bad_time='null'``."""
    parse = F.try_to_date if bad_time == "null" else F.to_date
    return parse(stamp, LOG_TIME_FORMAT)


def log_time_text(stamp) -> Column:
    """Log time rewritten as ``yyyy-MM-dd HH:mm:ss`` text; other text is left as it is."""
    return F.regexp_replace(
        stamp,
        r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})\.\d+Z$",
        "$1-$2-$3 $4:$5:$6",
    )


def format_day(day) -> Column:
    """A date or time as ``yyyy-MM-dd`` text."""
    return F.date_format(day, "yyyy-MM-dd")


def text_to_day(text) -> Column:
    """``yyyy-MM-dd`` text as a date."""
    return F.to_date(text, "yyyy-MM-dd")


def week_start(day) -> Column:
    """The Monday on or before a day."""
    return F.trunc(day, "week")


def month_start(day) -> Column:
    """The first day of the month."""
    return F.trunc(day, "month")


def bucket_start(day, frequency: str | None) -> Column:
    """Start of the day's week or month; for any other frequency the day itself."""
    if frequency == WEEKLY:
        return week_start(day)
    if frequency == MONTHLY:
        return month_start(day)
    return F.col(day) if isinstance(day, str) else day


def days_between(later, earlier) -> Column:
    """Number of days from ``earlier`` to ``later``."""
    return F.datediff(later, earlier)


def days_before(day, n: int) -> Column:
    """The date ``n`` days earlier."""
    return F.date_sub(day, n)
