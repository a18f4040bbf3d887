"""Edges of the relational operators, sources and configuration."""

import os
import sqlite3

import pytest
from pyspark.sql import functions as F

from chargeplan.config import ConfigError, ScenarioConfig, load_config
from chargeplan.functions import scalars as S
from chargeplan.operators import intervals, relational, spatial
from chargeplan.sources import gpkg


def test_null_is_different_and_not_in(spark):
    df = spark.createDataFrame([("home",), ("work",), (None,)], "v string")
    assert df.where(S.differs(F.col("v"), "home")).count() == 2
    assert df.where(S.not_in(F.col("v"), "home", "x")).count() == 2


def test_dense_index_and_running(spark):
    df = spark.createDataFrame([(k * 7 % 101,) for k in range(101)], "k long")
    rows = sorted(relational.dense_index(df, "k").collect(), key=lambda r: r["k"])
    assert [r["idx"] for r in rows] == list(range(101))
    rows = sorted(relational.running(df, F.lit(2), "k", "s").collect(), key=lambda r: r["k"])
    assert [r["s"] for r in rows] == list(range(2, 204, 2))
    assert relational.dense_index(df.where("k < 0"), "k").count() == 0


def test_weighted_pick_covers_the_unit_interval(spark):
    sites = spark.createDataFrame([(0, 1.0), (1, 0.0), (2, 3.0)], "idx long, w double")
    draws = spark.createDataFrame([(0.0,), (0.2499,), (0.25,), (0.999,)], "u double")
    got = {r["u"]: r["idx"] for r in relational.weighted_pick(draws, sites, "u", "w").collect()}
    assert got == {0.0: 0, 0.2499: 0, 0.25: 2, 0.999: 2}


def literal_limit(start, time, charge, limit, a, b):
    total, at, end = 0.0, start, start + time
    for day in range(start // 96, (end - 1) // 96 + 1):
        s, e, w0, w1 = max(at, 96 * day), min(end, 96 * day + 96), 96 * day + a, 96 * day + b
        if s >= w1 or e <= w0 or s >= w1 - limit:
            total += e - s
        else:
            total += max(0, w0 - s) + min(max(0, min(e, w1) - max(s, w0)), max(charge, limit)) + max(0, e - w1)
    return int(min(total, time))


def test_parking_limit(spark):
    rows = [(i, i * 13 % 300, 1 + i * 29 % 250, float(i % 40), 11.0 if i % 5 else 0.0) for i in range(300)]
    df = spark.createDataFrame(rows, "event_id long, event_start int, event_time int, energy double, station_charging_capacity double")
    got = {r["event_id"]: r["event_time"] for r in intervals.limit_parking(df, 16, 36, 84).collect()}
    assert got == {i: literal_limit(s, t, e / c * 4 if c else 0.0, 16, 36, 84) for i, s, t, e, c in rows}


def test_peak_and_activity_of_touching_intervals(spark):
    df = spark.createDataFrame([(1, 0, 4), (1, 4, 4), (1, 2, 0), (2, 1, 3), (2, 2, 3)], "g int, event_start int, event_time int")
    assert {r["g"]: r["peak"] for r in intervals.peak(df, ["g"]).collect()} == {1: 1, 2: 2}


def test_distance_join_at_the_radius(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0)], "i int, ax double, ay double")
    b = spark.createDataFrame([(1, 999.0, 0.0), (2, 1000.0, 0.0), (3, 1001.0, 0.0), (4, -600.0, -800.0)], "j int, bx double, by double")
    assert sorted(r["j"] for r in spatial.distance_join(a, b, 1000.0, "ax", "ay", "bx", "by").collect()) == [1, 2, 4]


def test_nearest_line_beyond_reach_and_many_lines(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 5000.0, 0.0)], "k int, x double, y double")
    lines = spark.createDataFrame([(7, [(0.0, 100.0), (10.0, 100.0)]), (8, [(0.0, -100.0), (10.0, -100.0)])], "l int, line array<struct<x:double,y:double>>")
    for bound in (10, 0):
        got = {r["k"]: (r["l"], round(r["line_distance"])) for r in spatial.nearest_line(points, lines, "k", "l", "line", 200.0, bound=bound).collect()}
        assert got == {1: (7, 100), 2: (7, 4991)}


def test_nearest_line_ends_with_nulls_and_without_lines(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 5.0), (None, 1.0, 1.0), (4, float("nan"), 0.0), (5, 9e5, 9e5)], "k int, x double, y double")
    lines = spark.createDataFrame([(7, [(0.0, 100.0), (10.0, 100.0)])], "l int, line array<struct<x:double,y:double>>")
    got = {r["k"]: r["l"] for r in spatial.nearest_line(points, lines, "k", "l", "line", 200.0).collect()}
    assert got == {1: 7, 2: None, None: None, 4: None, 5: 7}
    assert {r["l"] for r in spatial.nearest_line(points, lines.where("l < 0"), "k", "l", "line", 200.0).collect()} == {None}


def test_dense_index_and_running_over_many_ranges(spark):
    df = spark.range(0, 5000, 7, 11).select((F.col("id") * F.col("id") % 10007).alias("k")).distinct()
    keys = sorted(r["k"] for r in df.collect())
    got = {r["k"]: (r["idx"], r["cum"]) for r in relational.running(relational.dense_index(df, "k"), F.lit(2), "k", "cum").collect()}
    assert got == {k: (i, 2 * i + 2) for i, k in enumerate(keys)}
    assert relational.dense_index(df.where("k < 0"), "k").count() == 0


def test_sites_get_their_ids_whatever_their_numbers(spark):
    """Filtered sites keep their numbers: a position is never taken for an id."""
    from chargeplan.operators import allocators

    e = spark.createDataFrame([("a", i, i % 7, 3, 5.0, 11.0) for i in range(40)], "g string, event_id long, event_start int, event_time int, energy double, station_charging_capacity double")
    s = spark.createDataFrame([("a", 10 * i + 5, 1.0) for i in range(6)], "g string, idx long, weight double")
    placed, points = allocators.shared_allocation(e, s, "g", 40)
    known = {r["idx"]: r["points"] for r in points.collect()}
    assert {r["assigned_location"] for r in placed.collect()} == {i for i, n in known.items() if n} <= {5, 15, 25, 35, 45, 55}
    more = allocators.multi_use_allocation(e, e.withColumn("event_start", F.col("event_start") + 20), s, "g", 40, 2).collect()
    assert {r["assigned_location"] for r in more} <= {None, 5, 15, 25, 35, 45, 55} and any(r["assigned_location"] for r in more)


def test_projections_of_known_places(spark):
    from chargeplan.functions import geo

    df = spark.createDataFrame([(10.0, 52.0, 4321000.0, 3210000.0), (5.0, 50.0, 3962799.45, 2999718.85)], "lon double, lat double, x double, y double")
    for r in df.select("x", "y", geo.to_laea(F.col("lon"), F.col("lat")).alias("p")).collect():
        assert abs(r["p"]["x"] - r["x"]) < 0.02 and abs(r["p"]["y"] - r["y"]) < 0.02
    u = spark.range(1).select(geo.to_utm(F.lit(15.0), F.lit(45.0)).alias("a"), geo.to_utm(F.lit(15.0), F.lit(0.0)).alias("b")).first()
    assert abs(u["a"]["x"] - 500000) < 1e-3 and abs(u["a"]["y"] - 4982950.40) < 0.02 and abs(u["b"]["y"]) < 1e-3


def test_dbscan_noise_and_border(spark):
    pts = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 2.0), (4, 3.0), (9, 50.0)], "k long, x double").withColumn("y", F.lit(0.0))
    got = {r["k"]: r["cluster"] for r in spatial.dbscan(pts, "k", 1.0, 3).collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 2, 9: -1}


def test_geopackage_round_trip_and_pushdown(spark, tmp_path):
    g = lambda kind, pts: {"type": kind, "points": pts, "srs": 3035}
    p = lambda x, y: {"x": x, "y": y}
    rows = [("a", 1, g("Point", [[p(1.0, 2.0)]])), ("b", 2, g("LineString", [[p(0.0, 0.0), p(1.0, 1.0)]])), ("c", None, g("Polygon", [[p(0.0, 0.0), p(4.0, 0.0), p(4.0, 4.0), p(0.0, 0.0)]])), ("d", 4, None)]
    df = spark.createDataFrame(rows, f"name string, n long, geometry {gpkg.GEOMETRY}")
    path = os.path.join(tmp_path, "x.gpkg")
    gpkg.write_gpkg(df, path, "layer")
    back = gpkg.read_gpkg(spark, path, partitions=3)
    assert sorted((r["name"], r["n"], r["geometry"] and r["geometry"]["type"]) for r in back.collect()) == [("a", 1, "Point"), ("b", 2, "LineString"), ("c", None, "Polygon"), ("d", 4, None)]
    assert [r["name"] for r in back.where("n >= 2 AND name <> 'x'").orderBy("name").collect()] == ["b", "d"]
    assert back.where("n IS NULL").select("name").first()["name"] == "c"
    with sqlite3.connect(path) as db:
        assert db.execute("SELECT count(*) FROM layer").fetchone()[0] == 4


def test_configuration(tmp_path):
    path = tmp_path / "c.cfg"
    path.write_text("[data]\nretail_data = x\n[basic]\nrandom_seed = 3\nmulti_use_concept = true\nmulti_use_group = Private, Commercial\n[use_cases]\npublic = true\nretail = true\n[uc_params]\nshare_home_detached = 0.2\nshare_home_apartment = 0.8\n", encoding="utf-8")
    cfg = load_config(str(path), "s")
    assert (cfg.run, cfg.random_seed, cfg.inputs["retail_data"], cfg.share_home_detached) == (("retail", "public"), 3, "x", 0.2)
    with pytest.raises(ConfigError):
        ScenarioConfig(run=("public",), multi_use_concept=True)
    with pytest.raises(FileNotFoundError):
        load_config(str(tmp_path / "none.cfg"))


def test_every_twin_has_its_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 80
