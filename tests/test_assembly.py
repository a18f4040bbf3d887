"""From raw files to results: events, site layers, the command line, sinks."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from chargeplan import cli
from chargeplan.config import ScenarioConfig, load_config
from chargeplan.plans import assembly
from chargeplan.sources import files
from chargeplan.sources.gpkg import read_gpkg, write_gpkg

EVENT = "event_start int, event_time int, energy double, station_charging_capacity double, charging_use_case string, location string, soc_start double, soc_end double, average_charging_power double"


def layer(spark, rows, columns, path, name, kind="Point", srs=3035):
    """rows: (points, other values)."""
    shaped = [({"type": kind, "points": [[{"x": float(x), "y": float(y)} for x, y in p]], "srs": srs}, *more) for p, *more in rows]
    geometry = "geometry struct<type:string,points:array<array<struct<x:double,y:double>>>,srs:int>"
    write_gpkg(spark.createDataFrame(shaped, f"{geometry}, {columns}"), path, name, srs=srs)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    d, rng = str(tmp_path_factory.mktemp("raw")), np.random.default_rng(4)
    kinds = ["public", "home", "retail", "urban_fast", "work", "depot"]
    event = lambda i: (int(700 + i % 600), int(1 + i % 9), 8.0, 0.0 if i % 50 == 7 else 11.0, kinds[i % 6], [None, "home", "shopping"][i % 3], 0.2, 0.8, 4.0)
    for part in ("bev_mini", "phev_luxury"):
        spark.createDataFrame([event(i) for i in range(300)], EVENT).coalesce(1).write.parquet(f"{d}/private/{part}.parquet")
        inner = next(f for f in os.listdir(f"{d}/private/{part}.parquet") if f.endswith(".parquet"))
        os.rename(f"{d}/private/{part}.parquet/{inner}", f"{d}/private/{part}_1.parquet")
        for f in os.listdir(f"{d}/private/{part}.parquet"):
            os.remove(f"{d}/private/{part}.parquet/{f}")
        os.rmdir(f"{d}/private/{part}.parquet")
    commercial = [(int(i % 900), int(1 + i % 5), 0, 0, 104, 22.0, 5.0, 1.0, kinds[i % 6]) for i in range(200)]
    spark.createDataFrame(commercial, "event_start int, event_time int, charge_end int, event_end_parking int, ppc_id int, station_charging_capacity double, energy double, average_charging_power double, use_case string").write.parquet(f"{d}/commercial.parquet")
    at = lambda: (4550000 + float(rng.integers(0, 900)), 3270000 + float(rng.integers(0, 900)))
    layer(spark, [([at()], i, "0" if i % 4 else "1.5") for i in range(60)], "id long, cts_demand string", f"{d}/buildings.gpkg", "b")
    with open(f"{d}/profiles.csv", "w") as f:
        f.write("building_id,households_total\n" + "".join(f"{i},{1 + i % 5}\n" for i in range(50)))
    layer(spark, [([at()], i) for i in range(9)], "id long", f"{d}/fuel.gpkg", "f")
    layer(spark, [([at(), at()], i, 1000.0 * (i + 1)) for i in range(4)], "id long, dtvw_kfz double", f"{d}/traffic.gpkg", "t", "LineString")
    layer(spark, [([at()], i, 1.0 + i) for i in range(12)], "id long, Weight double", f"{d}/poi.gpkg", "p")
    layer(spark, [([(13.0 + i / 100, 52.5)], i, 10.0 + i) for i in range(8)], "id long, area double", f"{d}/work.gpkg", "w", srs=4326)
    box = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]
    layer(spark, [(box(*at(), 8.0 + 4 * i), i, "parking") for i in range(10)], "nid long, building string", f"{d}/retail.gpkg", "r", "Polygon")
    layer(spark, [([at()], i, 0.5 + i) for i in range(7)], "id long, `Area[m2]` double", f"{d}/depot.gpkg", "d")
    spark.createDataFrame([(i, 2, 22.0, *at()) for i in range(5)], "location_id long, charging_points int, average_charging_capacity double, x double, y double").write.parquet(f"{d}/network_sites")
    with open(f"{d}/scenario.cfg", "w") as f:
        f.write("""[data]
charging_events_private = private
charging_events_commercial = commercial.parquet
building_data = buildings.gpkg
home_demand_profiles = profiles.csv
hpc_positions_fuel_stations = fuel.gpkg
hpc_traffic_count = traffic.gpkg
public_poi = poi.gpkg
work_data = work.gpkg
retail_data = retail.gpkg
depot_data = depot.gpkg
additional_input_public_locations = False
[basic]
random_seed = 3
simulations_time_steps = 1400
[use_cases]
home = True
work = True
hpc = True
retail = True
public = True
depot = True
""")
    return d


def test_raw_events(spark, raw):
    e = assembly.event_table(spark, f"{raw}/private", f"{raw}/commercial.parquet")
    rows = e.collect()
    assert sorted(r["event_id"] for r in rows) == list(range(1, len(rows) + 1)) and max(r["event_start"] for r in rows) <= 672
    private = 2 * sum(1 for i in range(300) if i % 50 != 7)
    assert len(rows) == private + sum(1 for i in range(200) if i % 900 <= 672)
    first = [r for r in rows if r["Type"] == "Commercial"]
    assert max(r["event_id"] for r in first) == len(first) and {r["car_type"] for r in rows} == {None, "bev_mini", "phev_luxury"}
    assert "public" not in {r["charging_use_case"] for r in rows}


def test_layers(spark, raw):
    cfg = load_config(f"{raw}/scenario.cfg")
    _, sites = cli.raw(spark, cfg, raw)
    homes = [i for i in range(50) if i % 4]
    assert sites["home_detached"].count() == sum(i % 5 < 2 for i in homes) and sites["home_apartment"].count() == sum(i % 5 >= 2 for i in homes)
    assert sorted(round(r["area"]) for r in sites["retail"].collect()) == [(8 + 4 * i) ** 2 for i in range(10)]
    w = sites["work"].orderBy("id").first()
    assert abs(w["x"] - 4524764) < 3000 and abs(w["y"] - 3271000) < 5000 and sites["hpc"].where("gewicht BETWEEN 0 AND 1").count() == 9
    assert all(sorted(r["idx"] for r in s.collect()) == list(range(s.count())) for s in sites.values())


def test_command_line_from_raw_files(spark, raw, tmp_path):
    folder = cli.main(["base", "--config_file", f"{raw}/scenario.cfg", "--raw", raw, "--results", str(tmp_path)])
    for use_case in ("home_apartment", "home_detached", "work", "hpc", "retail", "public", "depot"):
        base = f"{folder}/output_{use_case}_charging"
        sites, events = spark.read.parquet(f"{base}-locations_base.parquet"), spark.read.parquet(f"{base}-events_base.parquet")
        assert events.join(sites, "location_id", "left_anti").count() == 0, use_case
        assert read_gpkg(spark, f"{base}-locations_base.gpkg").count() == sites.count()
    assert spark.read.option("header", "true").csv(f"{folder}/result_summary.csv").count() == 7
    assert json.load(open(f"{folder}/metadata.json"))["multi_use_concept"] is False


def test_given_network(spark, raw, tmp_path):
    e = assembly.event_table(spark, f"{raw}/private", f"{raw}/commercial.parquet")
    known = e.where("charging_use_case = 'street'").select("event_id", "event_start", "event_time", (F.col("event_id") % 5).alias("location_id"))
    network = spark.read.parquet(f"{raw}/network_sites")
    from chargeplan.plans.usecases import run_scenario

    cfg = ScenarioConfig(run=("public",), simulation_steps=1400, additional_input_public_locations=True)
    out = run_scenario(cfg, e, {"public": None, "home_street": None, "network_sites": network, "network_events": known})["public"]
    rows = out.events.collect()
    assert len(rows) == known.count() and all(r["assigned_location_id"] == r["location_id"] for r in rows if not r["unserved"])
    assert {r["charging_points"] for r in out.sites.collect()} <= {1, 2}


def test_decompose_from_the_command_line(spark, tmp_path):
    with open(tmp_path / "counts.csv", "w") as f:
        f.write("row_idx,ppc_id,weekhour,charging_vehicles\n" + "".join(f"{i},{101 + i % 2},{i // 2},{1 + i % 4}\n" for i in range(40)))
    base = cli.main(["decompose", "--counts", str(tmp_path / "counts.csv"), "--results", str(tmp_path / "out")])
    e = spark.read.parquet(f"{base}.parquet")
    assert {r["use_case"] for r in e.collect()} == {"depot"} and e.where("event_time <= 0").count() == 0
    assert spark.read.option("header", "true").csv(str(tmp_path / "out/timelines")).columns == ["step", "active", "use_case"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, '{"type":"Feature"}'), (2, None), (3, '{"type":"Feature","id":3}')], "i int, feature string")
    assert files.save_feature_collection(df, str(tmp_path / "f.geojson")) == 2
    got = json.load(open(tmp_path / "f.geojson"))
    assert got["type"] == "FeatureCollection" and [f.get("id") for f in got["features"]] == [None, 3]
    assert files.save_feature_collection(df.where("i > 9"), str(tmp_path / "e.geojson")) == 0 and json.load(open(tmp_path / "e.geojson"))["features"] == []
    path = files.write_sheet(df.select("i"), str(tmp_path / "s.xlsx"))
    assert files.read_sheet(spark, str(tmp_path / "s.xlsx")).count() == 3 and os.path.exists(path)
    with pytest.raises(ValueError):
        files.write_sheet(df, str(tmp_path / "t.xlsx"), bound=2)
    assert files.compact_csv(spark, str(tmp_path / "nowhere"), str(tmp_path / "x")) == 0
    os.makedirs(tmp_path / "csv")
    (tmp_path / "csv/a.csv").write_text("event,station_charging_capacity\n1,0\n2,11\n3,\n")
    assert files.compact_csv(spark, str(tmp_path / "csv"), str(tmp_path / "compact")) == 2
    (tmp_path / "p.csv").write_text("AGS,potential\n01001,2.5\n")
    assert files.potentials(spark, str(tmp_path / "p.csv")).first()["AGS"] == "01001"
    (tmp_path / "semi.csv").write_text("a;b\n1;x\n")
    assert files.csv(spark, str(tmp_path / "semi.csv"), sep=";").first().asDict() == {"a": 1, "b": "x"}
    files.save_timelines(spark.createDataFrame([(0, "a b", 1)], "step int, use_case string, active int"), str(tmp_path / "t"))
    assert os.listdir(tmp_path / "t") and any("a_b" in x for x in os.listdir(tmp_path / "t"))
