"""What the second list of findings of round 2 named for the engine, each by a small case that failed before."""

import threading

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from __spark_entry__ import queries
from chargeplan.config import ScenarioConfig
from chargeplan.operators import allocators, spatial
from chargeplan.plans import usecases


def scattered(spark, rng, n, name, first=0):
    xy = rng.uniform(-900, 900, (n, 2)).round(3)
    return xy, spark.createDataFrame([(first + i, float(a), float(b)) for i, (a, b) in enumerate(xy)], f"{name} long, {name}x double, {name}y double")


def test_candidates_are_no_rows_of_a_shuffle(spark):
    """Lists against brute force, in several parts of a cell; F14."""
    rng = np.random.default_rng(1)
    (p, a), (q, b) = scattered(spark, rng, 300, "a"), scattered(spark, rng, 200, "b", 7)
    got = {r["a"]: r["l"] for r in spatial.near_lists(a, b, 150.0, "a", "b", "l", "ax", "ay", "bx", "by", rows=4).collect()}
    near = np.sqrt(((p[:, None] - q[None]) ** 2).sum(2)) <= 150
    assert got == {i: (np.flatnonzero(row) + 7).tolist() for i, row in enumerate(near) if row.any()}


def test_street_candidates_collect_no_pairs(spark):
    plan = queries()["street_candidates_1000m"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def test_regions_tear_no_near_points_apart(spark):
    rng = np.random.default_rng(2)
    (p, a), (q, b) = scattered(spark, rng, 40, "k"), scattered(spark, rng, 30, "k", 1000)
    a, b = (d.toDF("k", "x", "y") for d in (a, b))
    got = {r["k"]: r["region"] for r in spatial.near_regions(a, b, 90.0, "k").collect()}
    pairs = np.argwhere(np.sqrt(((p[:, None] - q[None]) ** 2).sum(2)) <= 90)
    assert len(pairs) and all(got[i] == got[1000 + j] for i, j in pairs) and len(set(got.values())) > 1


def test_rebalancing_finds_candidates_by_itself():
    """The same moves as with lists of candidates, with full sites, windows past the horizon and more events than points; F13, F15."""
    rng = np.random.default_rng(3)
    for _ in range(30):
        homes = pd.DataFrame({"location_id": np.arange(100, 120), "x": rng.uniform(0, 900, 20), "y": rng.uniform(0, 900, 20)})
        streets = pd.DataFrame({"location_id": rng.permutation(15), "x": rng.uniform(0, 900, 15), "y": rng.uniform(0, 900, 15), "charging_points": rng.integers(0, 4, 15)})
        n = 200
        e = pd.DataFrame({"event_id": np.arange(n), "event_start": rng.integers(3, 33, n), "event_time": rng.integers(0, 9, n), "location_id": np.where(rng.random(n) < 0.5, rng.integers(100, 120, n), rng.integers(0, 15, n))})
        place, near = homes.set_index("location_id"), {}
        for h, r in place.iterrows():
            near[h] = sorted(streets["location_id"][np.sqrt((r["x"] - streets["x"]) ** 2 + (r["y"] - streets["y"]) ** 2) <= 300].tolist())
        old = allocators.rebalance(e.assign(candidates=[near.get(k) for k in e["location_id"]]), dict(zip(streets["location_id"], streets["charging_points"])), 36)
        got = allocators.rebalance_near(e, homes, streets, 300.0, 36)
        want = old[old["moved"]]
        assert got["event_id"].tolist() == want["event_id"].tolist() and got["location_id"].tolist() == want["location_id"].tolist() and len(want)


def test_use_cases_run_side_by_side(spark, monkeypatch):
    """Allocations of independent use cases meet at a barrier that only jobs at one time can pass; F4, F11, F12."""
    barrier, shared = threading.Barrier(4), usecases.shared

    def waits(*args, **how):
        barrier.wait(60)
        return shared(*args, **how)

    monkeypatch.setattr(usecases, "shared", waits)
    events = spark.range(40).select(F.col("id").alias("event_id"), F.element_at(F.array(*[F.lit(x) for x in ("work", "depot", "retail", "urban_fast")]), (F.col("id") % 4 + 1).cast("int")).alias("charging_use_case"), F.lit("x").alias("location"), (F.col("id") % 9).cast("int").alias("event_start"), F.lit(4).alias("event_time"), F.lit(11.0).alias("station_charging_capacity"), F.lit(5.0).alias("energy"))
    sites = spark.range(6).select(F.col("id").alias("idx"), F.lit(200).alias("area"), F.lit(1).alias("gewicht"))
    cfg = ScenarioConfig(run=("work", "hpc", "retail", "depot"), simulation_steps=20)
    out = usecases.run_scenario(cfg, events, dict.fromkeys(("work", "hpc", "retail", "depot"), sites))
    assert list(out) == ["work", "hpc", "retail", "depot"] and all(r.events.count() == 10 for r in out.values())
