"""Half-open step intervals [start, start + time): activity per step, peaks, parking-time limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chargeplan.functions.scalars import STEPS_PER_DAY, charge_steps

START, TIME = "event_start", "event_time"


def activity(events: DataFrame, by: list[str], start: str = START, time: str = TIME) -> DataFrame:
    """(step, by, active): events active at each step; steps without any are absent. Empty intervals are nowhere."""
    steps = events.where(F.col(time) > 0).select(*by, F.explode(F.sequence(F.col(start), F.col(start) + F.col(time) - 1)).alias("step"))
    return steps.groupBy("step", *by).agg(F.count(F.lit(1)).alias("active"))


def last_step(events: DataFrame, start: str = START, time: str = TIME) -> int:
    """Last step at which an event is active; -1 without events."""
    last = events.where(F.col(time) > 0).agg(F.max(F.col(start) + F.col(time)) - 1).first()[0]
    return -1 if last is None else int(last)


def wide_activity(events: DataFrame, by: str, values: list[str], first: int, last: int, start: str = START, time: str = TIME) -> DataFrame:
    """One column a value, one row a step of first..last, zero where nothing is active."""
    counts = activity(events, [by], start, time).groupBy("step").pivot(by, values).agg(F.first("active"))
    grid = events.sparkSession.range(first, last + 1).select(F.col("id").alias("step"))
    return grid.join(counts, "step", "left").na.fill(0, values)


def occupation(events: DataFrame, by: str, values: list[str], start: str = START, time: str = TIME) -> DataFrame:
    """Active events a value from the first start to the last end, in steps numbered from 1 (Zeitschritt); starts and ends are rounded."""
    a, b = F.bround(start, 0).cast("int"), F.bround(F.col(start) + F.col(time), 0).cast("int")
    e = events.select(by, a.alias(start), (b - a).alias(time))
    ends = events.agg(F.floor(F.min(start)).cast("int").alias("a"), F.max(F.col(start) + F.col(time)).cast("int").alias("b")).first()
    first, last = (0, -1) if ends["a"] is None else (ends["a"], ends["b"] - 1)
    return wide_activity(e, by, values, first, last, start, time).select(*values, (F.col("step") - first + 1).alias("Zeitschritt"))


def timestamp_activity(events: DataFrame, by: str, start: str, minutes: str, every: int = 15) -> DataFrame:
    """(by, zeitschritt, anzahl_aktiver_ladeevents): for each value of by and each instant of the grid that spans all events.

    An event is active at t if start <= t < start + minutes. The grid runs from the first start, floored, to the last end, raised.
    """
    step = every * 60_000_000
    e = events.select(by, F.unix_micros(F.col(start).cast("timestamp")).alias("s"), F.col(minutes).alias("m")).withColumn("e", F.col("s") + F.col("m") * 60_000_000)
    ends = e.agg(F.min("s").alias("a"), F.max("e").alias("b"))
    grid = ends.where("a IS NOT NULL").select(F.explode(F.sequence(F.expr(f"a div {step}"), F.expr(f"(b + {step - 1}) div {step}"))).alias("q"))
    every_one = grid.crossJoin(F.broadcast(events.select(by).distinct()))  # the values of by are few, the grid is the result
    first, last = F.expr(f"(s + {step - 1}) div {step}"), F.expr(f"(e + {step - 1}) div {step} - 1")
    counts = e.where(first <= last).select(by, F.explode(F.sequence(first, last)).alias("q")).groupBy(by, "q").agg(F.count(F.lit(1)).alias("n"))
    return every_one.join(counts, [by, "q"], "left").select(by, F.timestamp_micros(F.col("q") * step).cast("timestamp_ntz").alias("zeitschritt"), F.coalesce("n", F.lit(0)).alias("anzahl_aktiver_ladeevents"))


def peak(events: DataFrame, by: list[str], start: str = START, time: str = TIME) -> DataFrame:
    """(by, peak): most events active at once, by a sweep over starts and ends instead of steps."""
    some = events.where(F.col(time) > 0)
    deltas = some.select(*by, F.col(start).alias("t"), F.lit(1).alias("d")).unionAll(some.select(*by, (F.col(start) + F.col(time)).alias("t"), F.lit(-1).alias("d")))
    level = F.sum("d").over(Window.partitionBy(*by).orderBy("t").rowsBetween(Window.unboundedPreceding, 0))
    return deltas.groupBy(*by, "t").agg(F.sum("d").alias("d")).withColumn("level", level).groupBy(*by).agg(F.max("level").cast("long").alias("peak"))


def limit_parking(events: DataFrame, limit: int, begin: int, end: int, key: str = "event_id", unit: str = "steps") -> DataFrame:
    """Shorten event_time by a daily parking limit and add wurde_begrenzt.

    Within [begin, end) of each day an event stays max(limit, its charge) at most, unless it starts later than end - limit. Each
    day that an event touches contributes on its own, so no cursor is needed. unit: steps as configured, or hours (times 4).
    """
    scale = 4 if unit == "hours" else 1
    limit, a, b, day = limit * scale, begin * scale, end * scale, STEPS_PER_DAY
    if not 0 <= a <= b <= day:
        raise ValueError("0 <= begin <= end <= a day")
    stop = F.col(START) + F.col(TIME)
    days = events.where(F.col(TIME) > 0).select(key, START, TIME, charge_steps(F.col("energy").cast("double"), F.col("station_charging_capacity")).alias("charge"), F.explode(F.sequence(F.floor(F.col(START) / day), F.floor((stop - 1) / day))).alias("d"))
    s, e = F.greatest(F.col(START), F.col("d") * day), F.least(stop, F.col("d") * day + day)
    w0, w1 = F.col("d") * day + a, F.col("d") * day + b
    zero = F.lit(0)
    inside = F.least(F.greatest(zero, F.least(e, w1) - F.greatest(s, w0)), F.greatest(F.coalesce("charge", F.lit(0.0)), F.lit(limit)))
    part = F.when((s >= w1) | (e <= w0) | (s >= w1 - limit), (e - s).cast("double")).otherwise((F.greatest(zero, w0 - s) + inside + F.greatest(zero, e - w1)).cast("double"))
    total = days.groupBy(key).agg(F.sum(part).alias("_allowed"))
    new = F.when(F.col(TIME) > 0, F.least(F.coalesce("_allowed", F.lit(0.0)), F.col(TIME).cast("double"))).otherwise(F.least(zero, F.col(TIME))).cast("int")
    out = events.join(total, key, "left").withColumn("_new", new)
    return out.withColumn("wurde_begrenzt", F.col("_new") < F.col(TIME)).withColumn(TIME, F.col("_new")).drop("_new", "_allowed")


def day_night_percentile(timeline: DataFrame, index: Column, columns: list[str], p: float = 0.99) -> DataFrame:
    """(column, all, day, night): exact percentiles, interpolated and cut to int, over all hours of a week and parts of them."""
    from chargeplan.functions.scalars import is_day_hour

    week, day = index < 168, is_day_hour(index)
    cut = lambda c, keep: F.percentile(F.when(keep, F.col(c)), F.lit(p)).cast("int")
    one = timeline.agg(*[x for c in columns for x in (F.percentile(c, F.lit(p)).cast("int").alias(f"{c}|all"), cut(c, week & day).alias(f"{c}|day"), cut(c, week & ~day).alias(f"{c}|night"))])
    rows = F.array(*[F.struct(F.lit(c).alias("use_case"), *[F.col(f"`{c}|{k}`").alias(f"p_{k}") for k in ("all", "day", "night")]) for c in columns])
    return one.select(F.inline(rows))
