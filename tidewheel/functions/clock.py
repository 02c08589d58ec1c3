"""Time expressions built on epoch seconds, so none depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

QUARTER_HOUR = 900
HOUR = 3_600
DAY = 86_400
_EPOCH_WEEKDAY = 3  # 1970-01-01 was a Thursday, and Monday counts as 0


def epoch_of_ntz(name: str) -> Column:
    """Epoch seconds of a TIMESTAMP_NTZ column that holds UTC wall-clock time."""
    return F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', {name})")


def floor_to(epoch: Column, seconds: int) -> Column:
    """Epoch seconds rounded down to a multiple of ``seconds``."""
    return epoch - F.pmod(epoch, F.lit(seconds))


def bucket_of(epoch: Column, seconds: int) -> Column:
    """Number of the ``seconds``-wide bucket that holds ``epoch`` (exact for negatives)."""
    return F.call_function("div", floor_to(epoch, seconds), F.lit(seconds))


def hour_utc(epoch: Column) -> Column:
    return F.call_function("div", F.pmod(epoch, F.lit(DAY)), F.lit(HOUR))


def weekday_utc(epoch: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.pmod(bucket_of(epoch, DAY) + F.lit(_EPOCH_WEEKDAY), F.lit(7)).cast("bigint")


def iso_date(epoch: Column) -> Column:
    """UTC calendar date as ``yyyy-MM-dd`` text."""
    return F.date_from_unix_date(bucket_of(epoch, DAY).cast("int")).cast("string")
