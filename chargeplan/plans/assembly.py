"""From raw inputs to what a scenario takes: the event table and the site layers.

Raw layers are tables with a column geometry as the GeoPackage source reads it. All layers come out in EPSG 3035 as points x, y
with their own columns and a position idx from 0; shapes become area and centroid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chargeplan.config import ScenarioConfig
from chargeplan.functions import geo
from chargeplan.operators import allocators, spatial
from chargeplan.operators.relational import checkpointed, dense_index
from chargeplan.plans.basic_queries import PPC_USE_CASE
from chargeplan.plans.usecases import retail_columns, unify
from chargeplan.sources import files

#: Work sites at most so far from an office lot give way to it, in metres.
OFFICE_BUFFER = 200.0


def event_table(spark: SparkSession, private_folder: str, commercial_file: str) -> DataFrame:
    """Raw private and commercial events as one table, numbered in order of file and row."""
    place = F.struct("_metadata.file_path", "_metadata.row_index").alias("_place")
    private = files.private_events(spark, private_folder, place)
    commercial = files.commercial_events(spark, commercial_file, place)
    commercial = commercial.withColumn("charging_use_case", F.col("use_case")).drop("charge_end", "use_case")
    return unify(private, commercial, "_place").drop("_place", "average_charging_power")


def _to_laea(p: Column, srs: Column) -> Column:
    """A point of EPSG 4326, 25832, 25833 or 3035 in EPSG 3035."""
    degrees = F.when(srs == 25832, geo.from_utm(p["x"], p["y"], 32)).when(srs == 25833, geo.from_utm(p["x"], p["y"], 33)).otherwise(p)
    known = srs.isin(3035, 4326, 25832, 25833)
    return F.when(srs == 3035, p).when(known, geo.to_laea(degrees["x"], degrees["y"])).otherwise(F.raise_error(F.concat(F.lit("unknown reference system "), F.coalesce(srs.cast("string"), F.lit("null")))).cast("struct<x:double,y:double>"))


def projected(layer: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Adds polygon, all parts of a geometry in EPSG 3035, and ring, the first; rows without a geometry go.

    The result is checkpointed: what follows measures plain columns and doesn't repeat the projection inside each measure.
    """
    srs = F.col(f"{geometry}.srs")
    out = layer.where(F.col(geometry).isNotNull()).withColumn("polygon", F.transform(F.col(f"{geometry}.points"), lambda r: F.transform(r, lambda p: _to_laea(p, srs))))
    return checkpointed(out.drop(geometry)).withColumn("ring", F.col("polygon")[0])


def points(layer: DataFrame, geometry: str = "geometry") -> DataFrame:
    """A layer of points with x and y instead of its geometry."""
    return projected(layer, geometry).withColumn("x", F.col("ring")[0]["x"]).withColumn("y", F.col("ring")[0]["y"]).drop("ring", "polygon")


def shapes(layer: DataFrame, geometry: str = "geometry") -> DataFrame:
    """A layer of polygons as centroids x and y, with area of the whole polygon and its ring."""
    out = projected(layer, geometry).withColumn("area", geo.polygon_area(F.col("polygon"))).withColumn("_c", geo.ring_centroid(F.col("ring")))
    return out.withColumn("x", F.col("_c.x")).withColumn("y", F.col("_c.y")).drop("polygon", "_c")


def _numbered(layer: DataFrame, key: str) -> DataFrame:
    return dense_index(layer.drop("idx"), key)


def homes(buildings: DataFrame, profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(detached, apartment): buildings without commerce and with known households; one or two of these are detached."""
    known = profiles.select(F.col("building_id").alias("id"), "households_total")
    b = points(buildings).join(known, "id", "left").where((F.col("cts_demand").try_cast("double") == 0) & F.col("households_total").isNotNull())
    small = F.col("households_total").isin(1, 2)
    return _numbered(b.where(small), "id"), _numbered(b.where(~small), "id")


def fast_sites(stations: DataFrame, traffic: DataFrame, key: str, traffic_key: str) -> DataFrame:
    """Fuel stations weighted by the traffic of their nearest road and its distance."""
    name = next(c for c in ("dtvw_kfz", "AverageTrafficVolume") if c in traffic.columns)
    lines = projected(traffic).select(F.col(traffic_key).alias("_line_key"), F.col("ring").alias("_line"), F.col(name).cast("double").alias("dtvw_kfz"))
    return _numbered(spatial.traffic_weight(points(stations), lines, key, "_line_key", "_line", "dtvw_kfz"), key)


def work_sites(work: DataFrame, key: str, office: DataFrame | None = None, office_key: str = "id") -> tuple[DataFrame, DataFrame | None]:
    """(work, office): with office lots, work sites within their buffer give way, and a lot counts one."""
    sites = points(work)
    if office is None:
        return _numbered(sites, key), None
    lots = shapes(office).withColumn("area", F.lit(1.0))
    left = spatial.without_buffered(sites, lots.select(F.col("ring").alias("_ring")), key, "_ring", OFFICE_BUFFER)
    return _numbered(left, key), _numbered(lots.drop("ring"), office_key)


def site_layers(cfg: ScenarioConfig, raw: dict[str, DataFrame], keys: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The layers that a scenario's use cases take, from raw tables named as in the configuration's data section.

    keys: of each raw table, the column that orders its sites; id where it is not named.
    """
    key = lambda name: (keys or {}).get(name, "id")
    out = {}
    if {"home", "public"} & set(cfg.run):
        out["home_detached"], out["home_apartment"] = homes(raw["building_data"], raw["home_demand_profiles"])
        out["home_street"] = out["home_apartment"]
    if "hpc" in cfg.run:
        out["hpc"] = fast_sites(raw["hpc_positions_fuel_stations"], raw["hpc_traffic_count"], key("hpc_positions_fuel_stations"), key("hpc_traffic_count"))
    if "public" in cfg.run:
        poi = points(raw["public_poi"])
        poi = poi.withColumnRenamed("Weight", "weight") if "Weight" in poi.columns else poi
        out["public"] = _numbered(poi, key("public_poi"))
        if cfg.additional_input_public_locations:
            out["network_sites"], out["network_events"] = points(raw["additional_public_locations"]), raw["additional_public_events"]
    if "work" in cfg.run:
        office = raw.get("office_parking_lots_data") if cfg.multi_use_concept and cfg.use_case_multi_use == "work" else None
        out["work"], lots = work_sites(raw["work_data"], key("work_data"), office, key("office_parking_lots_data"))
        out |= {"office": lots} if lots is not None else {}
    if "retail" in cfg.run:
        out["retail"] = _numbered(retail_columns(shapes(raw["retail_data"]).drop("ring")), key("retail_data"))
    if "depot" in cfg.run:
        depot = points(raw["depot_data"])
        depot = depot.withColumnRenamed("Area[m2]", "area") if "Area[m2]" in depot.columns else depot
        out["depot"] = _numbered(depot, key("depot_data"))
    return out


def decomposed_steps(counts: DataFrame, means: dict[int, tuple[float, float]], seed: int = 1) -> DataFrame:
    """Hourly counts by aggregate id as single events in quarter-hour steps, with use case, mean power and capacity."""
    from chargeplan.functions import scalars as S

    look = F.create_map(*[F.lit(x) for kv in PPC_USE_CASE.items() for x in kv])
    e = allocators.decomposition(counts, means, seed)
    end, stop = F.col("start_hour") + F.col("charge_hours"), F.col("start_hour") + F.col("stay_hours")
    return e.select(
        S.hours_to_steps(F.col("start_hour"), -3).alias("event_start"), S.hours_to_steps(F.col("stay_hours")).alias("event_time"), S.hours_to_steps(end, -3).alias("charge_end"), S.hours_to_steps(stop, -3).alias("event_end_parking"),
        "ppc_id", F.lit(allocators.CAPACITY_KW).alias("station_charging_capacity"), "energy", S.average_power(F.col("energy"), F.lit(0), F.col("stay_hours")).alias("average_charging_power"), F.try_element_at(look, F.col("ppc_id")).alias("use_case"),
    )
