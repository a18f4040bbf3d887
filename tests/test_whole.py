"""Queries take part of no table: each is held against all rows of tables made here."""

import numpy as np
from pyspark.sql import functions as F

from __spark_entry__ import queries

PART = "p_partkey long, p_size int"
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def made(spark, path, parts=(), events=()):
    """Tables part and events; events are (id, quarter-hour step, user, type)."""
    spark.createDataFrame(list(parts), PART).write.parquet(f"{path}/part.parquet")
    rows = [(i, step, user, kind) for i, step, user, kind in events]
    e = spark.createDataFrame(rows, "event_id long, step long, user_id long, event_type string")
    at = F.expr("timestampadd(MINUTE, step * 15, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("ts")
    e.select("event_id", at, "user_id", "event_type", F.lit(1.0).alias("value"), F.lit('{"k": 1}').alias("props")).write.parquet(f"{path}/events.parquet")
    return str(path)


def test_allocation_takes_all_lots(spark, tmp_path):
    """Of lots with ids from 400 and with gaps, only those from 600 have a weight; all events must stand there."""
    parts = [(400 + 2 * i, 7 if i >= 100 else 0) for i in range(400)]
    d = made(spark, tmp_path, parts, [(i, i % 7, i, "purchase" if i % 2 else "view") for i in range(400)])
    placed = queries()["alloc_shared"](spark, d).collect()
    at = {r["assigned_location"] for r in placed}
    assert len(placed) == 400 and min(at) >= 100 and max(at) > 300 and max(at) < 400
    assert {r["overfull"] for r in queries()["alloc_shared_check"](spark, d).collect()} == {0}
    assert queries()["multi_use_shift"](spark, d).first()["overfull"] == 0


def test_activity_reaches_the_last_event(spark, tmp_path):
    """Events at steps 3200 and later count among all hours, in the percentile and in the wide time-line."""
    rows = [(i, 3200 + i % 40, i, "view") for i in range(300)] + [(300, 0, 0, "view")]
    d = made(spark, tmp_path, events=rows)
    active = np.zeros(3400, int)
    for i, step, _, _ in rows:
        active[step : step + 1 + (i * 7919) % 48] += 1
    last = int(np.flatnonzero(active)[-1])
    wide = {r["step"]: r["street"] for r in queries()["activity_timeline_wide"](spark, d).collect()}
    assert sorted(wide) == list(range(last + 1)) and all(wide[s] == active[s] for s in wide)
    got = {r["use_case"]: r["p_all"] for r in queries()["p99_day_night"](spark, d).collect()}
    assert got["street"] == int(np.percentile(active[: last + 1 : 4], 99)) > 0 and got["home"] == 0


def test_retail_takes_every_parcel(spark, tmp_path):
    spark.range(9).select(F.col("id").cast("int").alias("n_nationkey")).write.parquet(f"{tmp_path}/nation.parquet")
    assert {r["lot_id"] for r in queries()["geodata_for_retail"](spark, str(tmp_path)).collect()} == set(range(9))


def test_timeline_counts_every_start(spark, tmp_path):
    rows = [(i, (i * i) % 701, i, "view") for i in range(500)]
    got = {r["time_step"]: (r["n_df1"], r["n_df2"]) for r in queries()["timeline_full_outer_ffill"](spark, made(spark, tmp_path, events=rows)).collect()}
    private = [step for _, step, user, _ in rows if user % 2 == 0]
    commercial = [step for _, step, user, _ in rows if user % 2]
    last = max(private + commercial)
    assert got == {s: (private.count(s), sum(c // 4 == s // 4 for c in commercial)) for s in range(last + 1)}
    sums = {r["time_step"]: r["retail"] for r in queries()["row_sums_after_fill"](spark, str(tmp_path)).collect()}
    assert sums == {s: sum(v) for s, v in got.items() if s <= 672}
