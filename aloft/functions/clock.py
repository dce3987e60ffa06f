"""Clock expressions (X1-X7), all on ``timestamp_ntz`` and independent of the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hhmm_to_ts(year: ColumnOrName, month: ColumnOrName, day: ColumnOrName, hhmm: ColumnOrName,
               rollover: str = "next_day") -> Column:
    """(year, month, day, hhmm) -> timestamp_ntz.

    ``2400`` means midnight at the end of the day: ``rollover="next_day"``
    gives 00:00 of the following day (the documented intent);
    ``"same_day"`` gives 00:00 of the same day (what the source code does).
    Impossible clocks (minute >= 60, hour > 24), text that is no number, and nulls give null.
    """
    if rollover not in ("next_day", "same_day"):
        raise ValueError("rollover must be 'next_day' or 'same_day'")
    v = _c(hhmm).try_cast("int")
    hour = F.floor(v / 100).cast("int")
    minute = (v - hour * 100).cast("int")
    is_2400 = hour == 24
    h = F.when(is_2400, F.lit(0)).otherwise(hour)
    ts = F.try_make_timestamp_ntz(_c(year).try_cast("int"), _c(month).try_cast("int"), _c(day).try_cast("int"),
                                  h, minute, F.lit(0))
    if rollover == "next_day":
        ts = F.when(is_2400, ts + F.expr("INTERVAL 1 DAY")).otherwise(ts)
    return ts


def shift(ts: ColumnOrName, interval: str) -> Column:
    """``ts + INTERVAL`` (X2), e.g. ``shift("ts", "2 hours")``, ``shift("ts", "-150 minutes")``."""
    return _c(ts) + F.expr(f"INTERVAL {interval}")


def epoch_micros(ts: ColumnOrName) -> Column:
    """Microseconds since 1970-01-01 00:00 of a timestamp_ntz wall clock, zone-free.

    Built from date parts, which are naive for timestamp_ntz.
    (``timestamp_diff``, ``date_trunc`` and ``date_format`` go through the
    session zone even for timestamp_ntz, so a wall clock inside a DST gap
    of that zone would move.)
    """
    t = _c(ts)
    return (F.unix_date(F.to_date(t)).cast("long") * F.lit(86_400_000_000)
            + F.hour(t).cast("long") * F.lit(3_600_000_000) + F.minute(t).cast("long") * F.lit(60_000_000)
            + (F.extract(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("long"))


def floor_div(x: Column, d: int) -> Column:
    """Exact floor division of a long column by a positive constant."""
    return ((x - F.pmod(x, F.lit(d))) / F.lit(d)).cast("long")


def trunc_div(x: Column, d: int) -> Column:
    """Exact division truncated toward zero."""
    return F.when(x >= 0, floor_div(x, d)).otherwise(-floor_div(-x, d))


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


# Microseconds per unit of the zone-free floor.
_FLOOR_US = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def floor_to(ts: ColumnOrName, unit: str) -> Column:
    """Floor a timestamp_ntz to ``unit`` (second/minute/hour/day), zone-free."""
    step = _FLOOR_US[unit]
    return F.timestamp_add("MICROSECOND", floor_div(epoch_micros(ts), step) * F.lit(step), _epoch())


def hour_start(ts: ColumnOrName) -> Column:
    """Start of the hour, timestamp_ntz (internal bucket key of X3)."""
    return floor_to(ts, "hour")


def date_label(ts: ColumnOrName) -> Column:
    """``yyyy-MM-dd`` of a wall clock, zone-free."""
    return F.to_date(_c(ts)).cast("string")


def hour_label(ts: ColumnOrName) -> Column:
    """Hour-bucket label ``yyyy-MM-dd HH`` (X3), zone-free."""
    t = _c(ts)
    return F.concat(date_label(t), F.lit(" "), F.lpad(F.hour(t).cast("string"), 2, "0"))


def minutes_between(a: ColumnOrName, b: ColumnOrName, wrap_day: bool = False) -> Column:
    """Whole minutes from ``b`` to ``a``.

    Signed and truncated toward zero by default.  ``wrap_day=True``
    reproduces the day-wrapping form (the difference taken modulo 24 h,
    then floored to minutes), so -2 h gives 1320.
    """
    us = epoch_micros(a) - epoch_micros(b)
    if not wrap_day:
        return trunc_div(us, 60_000_000).cast("int")
    return floor_div(F.pmod(us, F.lit(86_400_000_000)), 60_000_000).cast("int")


def to_utc(ts: ColumnOrName, tz: ColumnOrName) -> Column:
    """Local wall clock in zone ``tz`` (a column of IANA names) -> UTC wall clock.

    NTZ in, NTZ out; a null or unknown zone gives null rather than an error.
    """
    zone = _c(tz)
    known = F.concat(F.lit("2000-01-01 00:00:00 "), F.nullif(F.trim(zone), F.lit(""))).try_cast("timestamp").isNotNull()
    return F.when(known, F.convert_timezone(zone, F.lit("UTC"), _c(ts)))


# Six-hour block names used by the day-block label.
BLOCK_NAMES = ("early", "morning", "afternoon", "night")


def day_block(ts: ColumnOrName, offset: str = "-150 minutes") -> Column:
    """``yyyy-MM-dd <block>`` of ``ts + offset`` (X7); blocks are 0-6, 6-12, 12-18, 18-24 h."""
    t = shift(ts, offset) if offset else _c(ts)
    h = F.hour(t)
    block = (F.when(h < 6, BLOCK_NAMES[0]).when(h < 12, BLOCK_NAMES[1])
             .when(h < 18, BLOCK_NAMES[2]).otherwise(BLOCK_NAMES[3]))
    return F.when(t.isNotNull(), F.concat_ws(" ", date_label(t), block))
