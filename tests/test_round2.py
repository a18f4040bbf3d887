"""What the review of round 2 found, each by a small case that failed before."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from chargeplan.functions import geo
from chargeplan.operators import allocators, spatial


def twin(spark, d, name, *tables):
    """(rows of the query, rows of its SQL) over the tables in folder d, as sorted texts."""
    import duckdb

    c = duckdb.connect()
    for t in tables:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet/*.parquet'")
    texts = lambda rows: sorted(str(tuple(r)) for r in rows)
    return texts(queries()[name](spark, str(d)).collect()), texts(c.execute(oracle_sql()[name]).fetchall())


def test_points_on_edges_are_not_inside(spark):
    corner = lambda x, y: geo.point(F.lit(float(x)), F.lit(float(y)))
    ring, slanted = F.array(corner(0, 0), corner(4, 0), corner(4, 4), corner(0, 4)), F.array(corner(0, 0), corner(4, 4), corner(0, 4))
    points = [(0.0, 2.0), (2.0, 0.0), (4.0, 2.0), (2.0, 4.0), (0.0, 0.0), (4.0, 4.0), (1.0, 2.0), (2.0, 2.0), (5.0, 2.0)]
    got = spark.createDataFrame(points, "x double, y double").select("x", "y", geo.in_ring(F.col("x"), F.col("y"), ring).alias("a"), geo.in_ring(F.col("x"), F.col("y"), slanted).alias("b")).collect()
    assert {(r["x"], r["y"]) for r in got if r["a"]} == {(1.0, 2.0), (2.0, 2.0)}
    assert {(r["x"], r["y"]) for r in got if r["b"]} == {(1.0, 2.0)}


def test_points_in_polygon_on_an_edge(spark, tmp_path):
    """Lot 458857 stands on the left edge of parcel 2."""
    spark.range(25).select(F.col("id").cast("int").alias("n_nationkey")).write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(458850, 458890).select(F.col("id").alias("p_partkey"), F.lit(1).alias("p_size")).write.parquet(f"{tmp_path}/part.parquet")
    got, want = twin(spark, tmp_path, "points_in_polygon", "nation", "part")
    assert got == want and "(458857, 2)" not in got


def test_projections_by_the_series_of_the_sql(spark, tmp_path):
    """Stations whose tens of metres hang on millimetres of the series, and one (9699) at a negative zero."""
    ids = [9699, 13506, 15315, 20972, 21949, 27036, 28166]
    spark.createDataFrame([(i,) for i in ids], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    got, want = twin(spark, tmp_path, "projections", "supplier")
    assert got == want


def test_opened_sites_are_searched_by_words():
    """With many sites open, no search looks at every site's steps, and rows don't move when a site opens below others."""
    rng, n = np.random.default_rng(3), 3000
    e = pd.DataFrame({"event_id": np.arange(n), "event_start": rng.integers(0, 20, n), "event_time": rng.integers(1, 20, n), "station_charging_capacity": 11.0, "energy": 5.0, "u": rng.random(n)})
    placed, points, _, occupied = allocators.allocate_shared(e, rng.integers(1, 9, 700).astype(float), 40)
    mask, free = np.zeros((700, 40), int), np.zeros(700, int)
    for i, (s, t, u) in enumerate(zip(e["event_start"], e["event_time"], e["u"], strict=True)):
        room = np.flatnonzero(mask[:, s : s + t].max(1) < free)
        free[placed[i]] += 0 if len(room) else 1
        assert not len(room) or room[0] == placed[i]
        mask[placed[i], s : s + t] += 1
    assert (free == points).all() and len(occupied.sites) > 500
    assert occupied.sites != sorted(occupied.sites)  # in the order of opening


def test_dbscan_lists_no_near_pairs(spark, monkeypatch):
    """Clusters, borders and noise of scattered points against brute force; torn pairs of a wrong clustering are counted."""
    monkeypatch.setattr(spatial, "eps_pairs", None)
    rng = np.random.default_rng(5)
    xy = np.concatenate((rng.normal(0, 40, (60, 2)), rng.normal(300, 60, (60, 2)), rng.uniform(-900, 900, (120, 2)), [[700.0, 700.0], [700.0, 800.0], [700.0, 900.0]]))
    near = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(2)) <= 100
    p = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)], "idx long, x double, y double")
    for least in (1, 4):
        core, label = near.sum(1) >= least, np.arange(len(xy))
        for _ in range(len(xy)):
            label = np.array([min(label[near[i] & core]) if core[i] else label[i] for i in range(len(xy))])
        want = [int(label[i]) if core[i] else int(label[np.flatnonzero(near[i] & core)[0]]) if (near[i] & core).any() else -1 for i in range(len(xy))]
        got = {r["idx"]: r["cluster"] for r in spatial.dbscan(p, "idx", 100.0, least).collect()}
        assert [got[i] for i in range(len(xy))] == want
    wrong = p.withColumn("cluster", F.col("idx") % 3)
    assert spatial.torn_pairs(wrong, "idx", "cluster", 100.0).count() == sum(near[i, j] and i % 3 != j % 3 for i in range(len(xy)) for j in range(i))


def test_near_pairs_are_not_joined_by_broadcast(spark):
    """A side that is spread over nine cells is larger than its estimate, by which it would be broadcast."""
    p = spark.range(50).select(F.col("id").alias("idx"), (F.col("id") * 40.0).alias("x"), F.lit(1.0).alias("y"))
    pairs = spatial.eps_pairs(p, "idx", 100.0)
    assert "BroadcastHashJoin" not in pairs._jdf.queryExecution().executedPlan().toString() and pairs.count() == 49 + 48
