"""Row-level column functions: coercion, index conversion, categories, flags, phrasing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from seriesforge import config as C


def to_double(col: Column) -> Column:
    """Text or number to double; unreadable input and NaN become null."""
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number)


def resolve_index(raw_index: Column, pm25: Column) -> Column:
    """The published index if it is a number, else the PM2.5 reading as a stand-in."""
    text = raw_index.cast("string")
    return F.coalesce(F.when(~text.isin("-", ""), to_double(text)), to_double(pm25))


def pm25_segment_value(pm25: Column) -> Column:
    """Unrounded piecewise-linear index; null below zero, unreadable, or between two segments.

    A generated CASE expression: stays in whole-stage codegen, no range join.
    """
    conc = pm25.try_cast("double")
    top = C.PM25_BREAKPOINTS[-1][1]
    out = F.when((conc > top) & ~F.isnan(conc), C.PM25_OVER_RANGE_INDEX)
    for lo, hi, index_lo, index_hi in C.PM25_BREAKPOINTS:
        slope = (index_hi - index_lo) / (hi - lo)
        out = out.when(conc.between(lo, hi), F.lit(slope) * (conc - lo) + index_lo)
    return out


def has_index(pm25: Column) -> Column:
    """Does the concentration have an index at all? Cheaper to push down than the index itself."""
    conc = pm25.try_cast("double")
    segments = [conc.between(lo, hi) for lo, hi, *_ in C.PM25_BREAKPOINTS]
    over = (conc > C.PM25_BREAKPOINTS[-1][1]) & ~F.isnan(conc)
    return F.coalesce(reduce(Column.__or__, segments, over), F.lit(False))


def pm25_index(pm25: Column) -> Column:
    """EPA index with one decimal. ``lookups.with_pm25_index`` is the cheaper two-step form."""
    return half_even_tenths(pm25_segment_value(pm25))


def forecast_category(index: Column) -> Column:
    cases = F.when(index.isNull() | F.isnan(index), C.FORECAST_CATEGORY_MISSING)
    for limit, name in C.FORECAST_CATEGORIES:
        cases = cases.when(index <= limit, name)
    return cases.otherwise(C.FORECAST_CATEGORY_ABOVE)


def _display(index: Column, field: int) -> Column:
    # NaN compares greater than every number, so it lands in the last category.
    *lower, last = C.DISPLAY_CATEGORIES
    cases = reduce(lambda acc, c: acc.when(index <= c[0], c[field]), lower[1:],
                   F.when(index <= lower[0][0], lower[0][field]))
    return cases.otherwise(last[field])


def category_key(index: Column) -> Column:
    return _display(index, 1)


def category_label(index: Column) -> Column:
    return _display(index, 2)


def category_phrase(index: Column) -> Column:
    return _display(index, 3)


def is_hazardous(index: Column, threshold: float = C.HAZARD_THRESHOLD) -> Column:
    return index >= threshold


def is_stale(ts_us: Column, as_of_us: Column, after_hours: float = C.STALE_AFTER_HOURS) -> Column:
    """Older than the threshold, or no readable time at all."""
    return F.coalesce(as_of_us - ts_us > round(after_hours * C.HOUR_US), F.lit(True))


def station_matches(station: Column, city: Column) -> Column:
    """Does the matched station name mention the city or one of its known aliases?"""
    name, key = F.lower(F.coalesce(station, F.lit(""))), F.lower(city)
    ok = F.contains(name, key)
    for known, aliases in C.STATION_ALIASES.items():
        ok = ok | ((key == known) & reduce(Column.__or__, [F.contains(name, F.lit(a)) for a in aliases]))
    return ok


def half_even(col: Column, digits: int = 0) -> Column:
    return F.bround(col, digits)


def half_even_tenths(col: Column) -> Column:
    """One decimal, half-even on the exact binary value (0.35 is below its tie and gives 0.3).

    ``bround`` rounds the printed decimal. Here 20x - m is formed as (16x - m) + 4x, two
    subtractions without rounding error, so its sign tells on which side of a tie x lies.
    """
    m = F.bround(col * 20, 0)
    side = (col * 16 - m) + col * 4
    # An even m is a whole number of tenths and stays; an odd one is a tie that ``side`` breaks.
    return F.bround(m / 2 + F.signum(side) / 4, 0) / 10


def clamp(col: Column, low: float | None = None, high: float | None = None) -> Column:
    out = col if low is None else F.greatest(col, F.lit(float(low)))
    return out if high is None else F.least(out, F.lit(float(high)))


def driver_phrase(attribution: Column) -> Column:
    verb = F.when(attribution > 0, "Adds about").otherwise("Cuts about")
    return F.concat_ws(" ", verb, F.bround(F.abs(attribution), 0).cast("bigint").cast("string"))
