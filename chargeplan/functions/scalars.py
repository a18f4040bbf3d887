"""Scalar expressions of the engine. All are Column expressions and stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The number that stands before a site's index in its id.
USE_CASE_PREFIX = {"home_detached": 1, "home_apartment": 2, "work": 3, "hpc": 4, "retail": 5, "public": 6, "depot": 7}
#: Weekday names of labels.
WEEKDAYS_DE = ["Montag", "Dienstag", "Mittwoch", "Donnerstag", "Freitag", "Samstag", "Sonntag"]
STEPS_PER_DAY, MINUTES_PER_STEP, WEEK_STEPS = 96, 15, 24 * 4 * 7
MULTIPLIER, MODULUS = 2654435761, 4294967296


def uniform(k: Column) -> Column:
    """A portable uniform number in [0, 1) for an integer key: the same in any SQL engine. Keys from 2**31 on repeat, so that nothing overflows."""
    return ((k % F.lit(1 << 31) * F.lit(MULTIPLIER)) % F.lit(MODULUS)).cast("double") / F.lit(float(MODULUS))


def differs(c: Column, value) -> Column:
    """c <> value where a null differs from every value."""
    return ~c.eqNullSafe(F.lit(value))


def not_in(c: Column, *values) -> Column:
    """Not among the values; a null is among none."""
    return F.coalesce(~c.isin(*values), F.lit(True))


def site_id(use_case: str, index: Column) -> Column:
    return F.concat(F.lit(str(USE_CASE_PREFIX[use_case])), index.cast("string")).cast("long")


def street_name(c: Column) -> Column:
    """Literal replacement, not a pattern."""
    return F.replace(c, F.lit("public"), F.lit("street"))


def overwrite_third(c: Column, letter: str = "x") -> Column:
    return F.when(F.length(c) > 2, F.overlay(c, F.lit(letter), F.lit(3), F.lit(1))).otherwise(c)


def before_equals(c: Column) -> Column:
    return F.regexp_replace(c, "=.*", "")


def underscored(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit("_"))


def charge_steps(energy: Column, capacity: Column) -> Column:
    """Quarter hours that a charge takes; null without capacity."""
    return F.try_divide(energy, capacity) * 4


def average_power(energy: Column, start: Column, end: Column) -> Column:
    return F.try_divide(energy, end - start)


def hours_to_steps(h: Column, offset: int = 0) -> Column:
    """Hours to quarter-hour steps, cut toward zero."""
    return (h * 4 + offset).cast("int")


def step_to_timestamp(step: Column, base: str) -> Column:
    return F.timestamp_add("MINUTE", step * MINUTES_PER_STEP, F.lit(base).cast("timestamp_ntz"))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def weekday_de(ts: Column) -> Column:
    """Weekday name and time of day."""
    name = F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS_DE]), F.weekday(ts) + 1)
    return F.concat_ws(" ", name, F.date_format(ts, "HH:mm"))


def quarter_floor(ts: Column) -> Column:
    return F.date_trunc("HOUR", ts) + F.make_dt_interval(mins=F.floor(F.minute(ts) / 15).cast("int") * 15)


def quarter_grid(first: Column, last: Column) -> Column:
    """All quarter hours from the floor of first to the ceiling of last, both included."""
    low = quarter_floor(last)
    high = F.when(low < last, low + F.expr("INTERVAL 15 MINUTES")).otherwise(low)
    return F.sequence(quarter_floor(first), high, F.expr("INTERVAL 15 MINUTES"))


def is_day_hour(index: Column) -> Column:
    """Hours 8 to 20 of each day of one week."""
    return (F.pmod(index, F.lit(24)).between(8, 20)) & (index < 168)


def car_type(path: Column) -> Column:
    """Drive and size from a file path: the first that occurs, in list order; drive in any case, size as written; else None."""
    first = lambda words, text: F.coalesce(*[F.when(text.contains(w), F.lit(w)) for w in words], F.lit("None"))
    return F.concat_ws("_", first(["bev", "phev"], F.lower(path)), first(["mini", "medium", "luxury"], path))
