"""The business calendar: days and months of one time zone, and the ranges built on them."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.scalars import day_of

BUSINESS_TZ = "Asia/Tokyo"
BUSINESS_OFFSET = timedelta(hours=9)  # fixed value: no daylight saving

HISTORY_DAYS = 730
BACKFILL_MONTHS = 24
CHUNK_DAYS = 7
SEARCH_CAP = 15_000
DETAIL_BATCH = 100


# --- columns -------------------------------------------------------------------------------------
def business_date(instant: Column) -> Column:
    return day_of(instant, int(BUSINESS_OFFSET.total_seconds()))


def local_time(instant: Column) -> Column:
    """Business wall-clock time of an instant; the session has to run in UTC (``pin_utc``)."""
    return F.from_utc_timestamp(instant, BUSINESS_TZ).cast("timestamp_ntz")


def month_of(day: Column) -> Column:
    """First day of the month as DATE."""
    return F.trunc(day, "MM")


def business_month(instant: Column) -> Column:
    return month_of(business_date(instant))


def months_apart(later: Column, earlier: Column) -> Column:
    """Calendar months between two days, days of the month ignored."""
    whole = (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
    return whole.cast("bigint")


def iso_local(instant: Column, colon: bool = False) -> Column:
    """ISO text with the business offset, with or without the colon in it."""
    text = F.date_format(local_time(instant), "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(text, F.lit("+09:00" if colon else "+0900"))


def instant_literal(iso: str) -> Column:
    """An ISO text with offset as a constant, so that filters on it reach the scan."""
    return F.lit(iso).cast("timestamp")


# --- job parameters ------------------------------------------------------------------------------
def month_start(moment: datetime) -> datetime:
    return moment.replace(day=1, hour=0, minute=0, second=0, microsecond=0)


def shift_month(moment: datetime, months: int) -> datetime:
    start = month_start(moment)
    years, index = divmod(start.month - 1 + months, 12)
    return start.replace(year=start.year + years, month=index + 1)


def resolve_span(
    mode: str = "MONTHLY", start: str | None = None, end: str | None = None, now: datetime | None = None
) -> tuple[datetime, datetime]:
    """The half-open business-time span a run covers.

    MONTHLY is the month before ``now``, HISTORICAL the last 730 days, CUSTOM the days from ``start``
    to ``end`` with both included.
    """
    now = now or datetime.now(ZoneInfo(BUSINESS_TZ)).replace(tzinfo=None)
    mode = (mode or "MONTHLY").upper()
    if mode == "HISTORICAL":
        return now - timedelta(days=HISTORY_DAYS), now
    if mode == "CUSTOM":
        if not start or not end:
            raise ValueError("CUSTOM needs start and end as YYYY-MM-DD")
        return datetime.fromisoformat(start), datetime.fromisoformat(end) + timedelta(days=1)
    return shift_month(now, -1), month_start(now)


def backfill_span(
    start: str | None = None, end: str | None = None, now: datetime | None = None
) -> tuple[datetime, datetime]:
    """Span of a backfill: 24 months back to ``now`` unless given; the ``end`` day itself is left out."""
    now = now or datetime.now(ZoneInfo(BUSINESS_TZ)).replace(tzinfo=None)
    first = datetime.fromisoformat(start) if start else shift_month(now, -BACKFILL_MONTHS)
    last = datetime.fromisoformat(end) if end else now
    if first >= last:
        raise ValueError("the start must lie before the end")
    return first, last


def iso_instant(local: datetime) -> str:
    """Business wall-clock time as ISO text with offset."""
    return local.replace(tzinfo=ZoneInfo(BUSINESS_TZ)).isoformat()


def months_touched(start_iso: str, end_iso: str) -> tuple[list[date], list[date]]:
    """Business months that ``[start, end)`` covers in full, and those it covers in part."""
    zone = ZoneInfo(BUSINESS_TZ)
    start = datetime.fromisoformat(start_iso).astimezone(zone).replace(tzinfo=None)
    end = datetime.fromisoformat(end_iso).astimezone(zone).replace(tzinfo=None)
    full: list[date] = []
    partial: list[date] = []
    month = month_start(start)
    while month < end:
        following = shift_month(month, 1)
        (full if start <= month and following <= end else partial).append(month.date())
        month = following
    return full, partial
