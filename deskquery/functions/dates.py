"""Day serials, Unix seconds and strptime, all resolved while planning.

A date-time literal reaches Spark as text cast to TIMESTAMP_NTZ: a Python
datetime would become a zoned TIMESTAMP and shift with the session's zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import QuerySyntaxError, TypeMismatch

EPOCH = datetime(1899, 12, 30)
LARGEST_SERIAL = 1e6


def parse_with_format(text: str, fmt: str) -> datetime:
    try:
        return datetime.strptime(text, fmt)
    except ValueError as error:
        raise QuerySyntaxError(f"strptime: {error}") from None


def from_serial(days: float) -> datetime:
    """The wall-clock second of a day serial."""
    if not 0 <= days <= LARGEST_SERIAL:
        raise TypeMismatch(f"date serial {days} is out of range")
    return EPOCH + timedelta(seconds=round(days * 86400))


def to_serial(moment: datetime) -> float:
    return (moment - EPOCH) / timedelta(days=1)


def from_unix(seconds: int) -> datetime:
    try:
        return datetime.fromtimestamp(seconds, timezone.utc).replace(tzinfo=None)
    except (ValueError, OverflowError, OSError):
        raise TypeMismatch(f"Unix time {seconds} is out of range") from None


def timestamp_literal(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def serial_column(column: Column) -> Column:
    """A timestamp column as a day serial."""
    start = timestamp_literal(EPOCH)
    return F.expr("1").cast("double") * F.timestamp_diff("MICROSECOND", start, column) / 86_400_000_000
