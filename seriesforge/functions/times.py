"""Event-time column functions. Every engine computation uses UTC microseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from seriesforge.config import DISPLAY_ZONE, HOUR_US, MINUTE_US

_DAY_US = 24 * HOUR_US
# A clock time followed by an offset or zone.
_ZONED = r"[T ][0-9]{1,2}:.*([Zz]|[+-][0-9:]+|[A-Z]{3}.*|[A-Za-z]+/.*)$"


def micros(ts: str) -> Column:
    """Microseconds since the epoch of a timestamp_ntz column.

    Put together from calendar parts: a difference of timestamps would pass through the session
    zone and go wrong at its clock changes.
    """
    return micros_of(F.col(f"`{ts}`"))


def micros_of(ts: Column) -> Column:
    ts = ts.cast("timestamp_ntz")
    second = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return (F.unix_date(ts.cast("date")).cast("bigint") * F.lit(_DAY_US) + F.hour(ts).cast("bigint") * F.lit(HOUR_US)
            + F.minute(ts).cast("bigint") * F.lit(MINUTE_US) + second)


def from_micros(us: Column) -> Column:
    return (F.lit("1970-01-01").cast("timestamp_ntz")
            + F.make_dt_interval(secs=us.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(8,0)")))


def parse_utc(text: Column) -> Column:
    """ISO-8601 text to naive UTC; unreadable text becomes null, an offset is applied, none means UTC."""
    instant = from_micros(F.unix_micros(F.try_to_timestamp(text)))
    return F.when(text.rlike(_ZONED), instant).otherwise(text.try_cast("timestamp_ntz"))


def hour_floor(ts: Column) -> Column:
    return ts.cast("timestamp_ntz") - F.make_dt_interval(mins=F.minute(ts), secs=F.extract(F.lit("SECOND"), ts))


def day_floor(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def local_time(ts: Column, zone: str = DISPLAY_ZONE) -> Column:
    """Wall-clock time for display; features always stay in UTC."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def hours_between(later_us: Column, earlier_us: Column) -> Column:
    return (later_us - earlier_us) / F.lit(float(HOUR_US))


def epoch_seconds_to_utc(seconds: Column) -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,0)"))


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def calendar(ts: Column) -> dict[str, Column]:
    """Hour, weekday (Monday is 0), month and weekend flag."""
    weekday = F.weekday(ts)
    return {
        "hour": F.hour(ts),
        "day_of_week": weekday,
        "month": F.month(ts),
        "is_weekend": F.when(weekday >= 5, 1).when(weekday.isNotNull(), 0).cast("int"),
    }


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "EEE d MMM")


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def weekday_text(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def reading_text(ts: Column) -> Column:
    return F.date_format(ts, "dd MMM, HH:mm 'UTC'")
