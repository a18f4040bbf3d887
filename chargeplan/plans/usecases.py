"""The six use cases, the event pipeline and a whole scenario, as functions of DataFrames."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargeplan.config import ScenarioConfig
from chargeplan.functions.scalars import WEEK_STEPS, differs, not_in, site_id, street_name, uniform
from chargeplan.operators import allocators, intervals
from chargeplan.operators.relational import checkpointed, dense_index, weighted_pick
from chargeplan.operators.spatial import near_regions


@dataclass
class Located:
    sites: DataFrame
    events: DataFrame
    kpi: DataFrame
    leftovers: DataFrame | None = None


def unify(private: DataFrame, commercial: DataFrame, order: str) -> DataFrame:
    """Commercial, then private rows (those of the second week on, moved to step 0); event_id from 1 in that order, by ``order``."""
    usable = lambda d: d.where(differs(F.col("station_charging_capacity"), 0))
    private = usable(private).where(F.col("event_start") > WEEK_STEPS).withColumn("event_start", F.col("event_start") - WEEK_STEPS)
    private = private.withColumn("Type", F.lit("Private"))
    commercial = commercial.withColumn("Type", F.lit("Commercial")).withColumn("charging_use_case", street_name(F.col("charging_use_case")))
    private = private.withColumn("charging_use_case", street_name(F.col("charging_use_case")))
    both = commercial.withColumn("_src", F.lit(0)).unionByName(private.withColumn("_src", F.lit(1)), allowMissingColumns=True).where(F.col("event_start") <= WEEK_STEPS)
    keyed = both.withColumn("_key", F.struct("_src", order)).drop("event_id")
    return dense_index(keyed, "_key", "event_id", first=1).drop("_key", "_src")


def split_home(events: DataFrame, share_apartment: float, u: Column) -> DataFrame:
    """Home events become home_apartment or home_detached by a uniform number."""
    kind = F.when(u < share_apartment, "home_apartment").otherwise("home_detached")
    return events.withColumn("charging_use_case", F.when(F.col("charging_use_case") == "home", kind).otherwise(F.col("charging_use_case")))


def kpi(use_case: str, sites: DataFrame, events: DataFrame) -> DataFrame:
    """(location, charging_points, energy, installed_power): one row."""
    a = sites.agg(F.coalesce(F.sum("charging_points"), F.lit(0)).cast("long").alias("charging_points"), F.coalesce(F.sum(F.col("charging_points") * F.col("average_charging_capacity")), F.lit(0)).cast("long").alias("installed_power"))
    b = events.agg(F.coalesce(F.sum("energy"), F.lit(0)).cast("long").alias("energy"))
    return a.crossJoin(F.broadcast(b)).select(F.lit(use_case).alias("location"), "charging_points", "energy", "installed_power")


def one_point_per_event(events: DataFrame, sites: DataFrame, use_case: str, weight: str, u: str = "u") -> tuple[DataFrame, DataFrame]:
    """Without sharing: a draw and a new point for each event. Fully relational, whatever the number of events and sites."""
    placed = weighted_pick(events, sites.select("idx", weight), u, weight).withColumnRenamed("idx", "assigned_location").drop(weight)
    used = placed.groupBy("assigned_location").agg(F.count(F.lit(1)).alias("charging_points"), F.avg("station_charging_capacity").cast("long").alias("average_charging_capacity"))
    out = sites.join(used, sites["idx"] == used["assigned_location"]).withColumn("location_id", site_id(use_case, F.col("idx")))
    return placed.withColumn("location_id", site_id(use_case, F.col("assigned_location"))), out


def shared(events: DataFrame, sites: DataFrame, use_case: str, weight: str, steps: int, energy_of: str = "input") -> Located:
    """Allocation with sharing for one use case; energy of the KPI: of all input or of located events."""
    e, s = events.withColumn("_g", F.lit(use_case)), sites.withColumn("_g", F.lit(use_case)).withColumn("weight", F.col(weight).cast("double"))
    placed, points = allocators.shared_allocation(e, s, "_g", steps)
    located = events.join(placed.select("event_id", "assigned_location"), "event_id").withColumn("location_id", site_id(use_case, F.col("assigned_location")))
    out = sites.drop("charging_points", "average_charging_capacity").join(points.where("points > 0").select("idx", F.col("points").alias("charging_points"), F.col("capacity").alias("average_charging_capacity")), "idx").withColumn("location_id", site_id(use_case, F.col("idx")))
    return Located(out, located, kpi(use_case, out, events if energy_of == "input" else located))


def hpc_events(events: DataFrame) -> DataFrame:
    return events.where((F.col("charging_use_case") == "urban_fast") & differs(F.col("location"), "shopping"))


def retail_events(events: DataFrame) -> DataFrame:
    """Slow retail and fast charging while shopping; slow ones are allocated first."""
    slow = F.col("charging_use_case") == "retail"
    fast = (F.col("charging_use_case") == "urban_fast") & (F.col("location") == "shopping")
    return events.where(slow | fast).withColumn("turn", F.when(slow, 0).otherwise(1))


def street_split(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(home, not home) street events; a null location is not home."""
    street = events.where(F.col("charging_use_case") == "street")
    return street.where(F.col("location") == "home"), street.where(differs(F.col("location"), "home"))


def hpc(events: DataFrame, sites: DataFrame, steps: int = 2000) -> Located:
    return shared(hpc_events(events), sites, "hpc", "gewicht", steps)


def depot(events: DataFrame, sites: DataFrame, steps: int = 2000) -> Located:
    sites = sites.withColumnRenamed("Area[m2]", "area") if "Area[m2]" in sites.columns else sites
    return shared(events.where(F.col("charging_use_case") == "depot"), dense_index(sites.where("area > 1").drop("idx"), _key(sites), "idx") if "idx" not in sites.columns else sites.where("area > 1"), "depot", "area", steps, "located")


def _offset(sites: DataFrame) -> int:
    """Where a second layer's positions begin, so that its ids differ from those of the first."""
    last = sites.agg(F.max("idx")).first()[0]
    return 0 if last is None else int(last) + 1


def _key(sites: DataFrame) -> str:
    return next(c for c in ("id", "location_id", sites.columns[0]) if c in sites.columns)


def home(events: DataFrame, sites: DataFrame, mode: str, steps: int = 2000) -> Located:
    """apartment: shared points; detached: one point for each event."""
    own = events.where(F.col("charging_use_case") == f"home_{mode}")
    if mode == "apartment":
        return shared(own, sites, "home_apartment", "households_total", steps)
    placed, used = one_point_per_event(own.withColumn("u", uniform(F.col("event_id"))), sites, "home_detached", "households_total")
    return Located(used, placed, kpi("home_detached", used, own))


def retail(events: DataFrame, sites: DataFrame, cfg: ScenarioConfig) -> Located:
    own, sites = retail_events(events), retail_columns(sites).where("area > 100")
    own = own.withColumn("_id", F.col("event_id")).withColumn("event_id", F.col("turn") * F.lit(1 << 50) + F.col("event_id"))
    out = shared(own, sites, "retail", "area", cfg.simulation_steps, "located")
    out.events = out.events.withColumn("event_id", F.col("_id")).drop("_id")
    if cfg.multi_use_concept and cfg.use_case_multi_use == "retail":
        _, street = street_split(events)
        moved, left = multi_use(own, street.where(F.col("Type").isin(*cfg.multi_use_group)), sites, "retail", "area", cfg)
        out.events = out.events.withColumn("multi_use", F.lit(False)).unionByName(moved.withColumn("multi_use", F.lit(True)), allowMissingColumns=True)
        out.leftovers = left
    return out


def multi_use(first: DataFrame, street: DataFrame, sites: DataFrame, use_case: str, weight: str, cfg: ScenarioConfig) -> tuple[DataFrame, DataFrame]:
    """(street events on idle points of first's allocation, those without room)."""
    g = lambda d: d.withColumn("_g", F.lit(use_case))
    got = allocators.multi_use_allocation(g(first), g(street), g(sites).withColumn("weight", F.col(weight).cast("double")), "_g", cfg.simulation_steps, cfg.flexibility_multi_use)
    hit = got.where(F.col("assigned_location").isNotNull()).select("event_id", F.col("event_start").alias("_s"), F.col("event_time").alias("_t"), "assigned_location")
    moved = street.join(hit, "event_id").withColumn("event_start", F.col("_s")).withColumn("event_time", F.col("_t")).drop("_s", "_t").withColumn("location_id", site_id(use_case, F.col("assigned_location")))
    return moved, street.join(hit.select("event_id"), "event_id", "left_anti")


def work(events: DataFrame, sites: DataFrame, cfg: ScenarioConfig, office: DataFrame | None = None) -> Located:
    """Plain, or with office lots: a seeded share of the events parks there, and street events fill what is idle."""
    own = events.where(F.col("charging_use_case") == "work")
    if office is None or not cfg.multi_use_concept:
        return shared(own, sites, "work", "area", cfg.simulation_steps)
    at_office = uniform(F.col("event_id") + cfg.random_seed) < cfg.share_office_parking
    plain = shared(own.where(~at_office), sites, "work", "area", cfg.simulation_steps, "located")
    n = _offset(sites)
    lots = office.withColumn("area", F.lit(1.0))
    there = shared(own.where(at_office), lots, "work", "area", cfg.simulation_steps, "located")
    _, street = street_split(events)
    moved, left = multi_use(own.where(at_office), street.where(F.col("Type").isin(*cfg.multi_use_group)), lots, "work", "area", cfg)
    shift = lambda d, c: d.withColumn("location_id", site_id("work", F.col(c) + n))
    mark = lambda d, o, m: d.withColumn("office", F.lit(o)).withColumn("multi_use", F.lit(m))
    located = mark(plain.events, False, False).unionByName(mark(shift(there.events, "assigned_location"), True, False), True).unionByName(mark(shift(moved, "assigned_location"), True, True), True)
    every = plain.sites.withColumn("office", F.lit(False)).unionByName(shift(there.sites, "idx").withColumn("office", F.lit(True)), True)
    office_events = located.where("office")
    figures = kpi("work", plain.sites, plain.events).unionAll(kpi("work_office", there.sites, office_events))
    return Located(every, located, figures, left)


def public(events: DataFrame, poi: DataFrame, home_sites: DataFrame, cfg: ScenarioConfig, leftovers: DataFrame | None = None, network: tuple[DataFrame, DataFrame] | None = None) -> Located:
    """Street events: on a given network by least load, or on public and home-street sites with the 1000 m rebalancing.

    The least loaded site of a network is one choice over all its sites, hence one task, unless both tables of the network have
    a column region: then each region is a network of its own.
    """
    if leftovers is not None:
        private_only = set(cfg.multi_use_group) == {"Private", "Commercial"}
        street = leftovers if private_only else leftovers.unionByName(events.where((F.col("charging_use_case") == "street") & (F.col("Type") == "Private")))
    else:
        street = events.where(F.col("charging_use_case") == "street")
    if network is not None:
        sites, known = network
        whole = lambda d: d if "region" in d.columns else d.withColumn("region", F.lit(0).cast("long"))
        e = whole(known.join(street.select("event_id"), "event_id", "left_semi"))
        got = allocators.network_assignment(e, whole(sites), "region")
        top = intervals.peak(got.where("NOT unserved"), ["assigned_location_id"])
        used = sites.drop("charging_points").join(top, sites["location_id"] == top["assigned_location_id"]).withColumnRenamed("peak", "charging_points")
        located = got.withColumn("location_id", F.coalesce("assigned_location_id", "location_id")).join(street.select("event_id", "energy", "station_charging_capacity"), "event_id")
        return Located(used, located, kpi("public", used, street))
    home_events, other = street.where(F.col("location") == "home"), street.where(differs(F.col("location"), "home"))
    poi = poi.withColumnRenamed("Category_Weight", "weight") if "Category_Weight" in poi.columns else poi
    a, b = at_once([lambda: shared(other, poi, "public", "weight", cfg.simulation_steps), lambda: shared(home_events, home_sites, "public", "households_total", cfg.simulation_steps)])
    n = _offset(poi)
    moved_id = lambda d, c: d.withColumn("location_id", site_id("public", F.col(c) + n))
    sites = a.sites.withColumn("mode", F.lit("street")).unionByName(moved_id(b.sites, "idx").withColumn("mode", F.lit("home_street")), True)
    located = a.events.withColumn("mode", F.lit("street")).unionByName(moved_id(b.events, "assigned_location").withColumn("mode", F.lit("home_street")), True)
    return rebalanced(located, sites, cfg, street)


def rebalanced(located: DataFrame, sites: DataFrame, cfg: ScenarioConfig, street: DataFrame, radius: float = 1000.0) -> Located:
    """Home-street events move to near idle street points; then every site gets its peak as points and those without go.

    Regions that no event can leave are independent of each other and run in parallel. Events elsewhere stay, and no kernel
    sees them. A kernel finds an event's candidates from coordinates, so no list of candidates is stored or sent.
    """
    at_home = located.where("mode = 'home_street'").select("location_id").distinct()
    homes = sites.where("mode = 'home_street'").join(at_home, "location_id", "left_semi")
    places = homes.unionByName(sites.where("mode = 'street'")).select("location_id", "mode", "charging_points", "x", "y")
    region = checkpointed(near_regions(homes, sites.where("mode = 'street'"), radius, "location_id"))
    inside = lambda d: d.join(region, "location_id")
    got = allocators.street_rebalance(inside(located.select("event_id", "event_start", "event_time", "location_id")), inside(places), "region", radius, 2 * cfg.simulation_steps)
    got = checkpointed(got.select("event_id", F.col("location_id").alias("_to")))
    out = located.join(got, "event_id", "left").withColumn("location_id", F.coalesce("_to", "location_id")).withColumn("mode", F.when(F.col("_to").isNotNull(), "street").otherwise(F.col("mode"))).drop("_to")
    top = intervals.peak(out, ["location_id"]).withColumnRenamed("peak", "charging_points")
    left = sites.drop("charging_points").join(top, "location_id").where("charging_points > 0")
    return Located(left, out, kpi("public", left, street))


def retail_columns(sites: DataFrame) -> DataFrame:
    """Either naming of the retail layer."""
    raw = {"nid": "id_0", "osm_id": "osm_way_id", "building": "amenity", "access": "other_tags"}
    out = sites.withColumnsRenamed({a: b for a, b in raw.items() if a in sites.columns and b not in sites.columns})
    return out.withColumn("id", F.col("id_0")) if "id_0" in out.columns and "id" not in out.columns else out


def run_scenario(cfg: ScenarioConfig, events: DataFrame, sites: dict[str, DataFrame]) -> dict[str, Located]:
    """All use cases of a scenario. home, work, hpc, retail, public, depot; what multi-use leaves over goes to public."""
    events = split_home(events, cfg.share_home_apartment, uniform(F.col("event_id") + cfg.random_seed))
    if cfg.charging_time_limit:
        street = F.col("charging_use_case") == "street"
        limited = intervals.limit_parking(events.where(street), cfg.charging_time_limit_duration, cfg.charging_time_limit_start, cfg.charging_time_limit_end, unit=cfg.limit_unit)
        events = limited.unionByName(events.where(not_in(F.col("charging_use_case"), "street")), allowMissingColumns=True)
    events = checkpointed(events) if cfg.charging_time_limit else events  # read by six use cases
    network = (sites["network_sites"], sites["network_events"]) if cfg.additional_input_public_locations else None
    run, steps = set(cfg.run), cfg.simulation_steps
    parts = {
        "home": {"home_apartment": lambda: home(events, sites["home_apartment"], "apartment", steps), "home_detached": lambda: home(events, sites["home_detached"], "detached")},
        "work": {"work": lambda: work(events, sites["work"], cfg, sites.get("office") if cfg.use_case_multi_use == "work" else None)},
        "hpc": {"hpc": lambda: hpc(events, sites["hpc"], steps)},
        "retail": {"retail": lambda: retail(events, sites["retail"], cfg)},
        "public": {"public": lambda: public(events, sites["public"], sites["home_street"], cfg, None, network)},
        "depot": {"depot": lambda: depot(events, sites["depot"], steps)},
    }
    order = [name for part, own in parts.items() if part in run for name in own]
    last = ["public"] if "public" in run and cfg.multi_use_concept else []  # it waits for what multi-use leaves over
    makes = {name: make for own in parts.values() for name, make in own.items()}
    first = [name for name in order if name not in last]
    out = dict(zip(first, at_once([makes[name] for name in first]), strict=True))
    if last:
        left = [out[k].leftovers for k in ("retail", "work") if k in out and out[k].leftovers is not None]
        out["public"] = public(events, sites["public"], sites["home_street"], cfg, left[0] if left else None, network)
    return {name: out[name] for name in order}


def at_once(makes: list) -> list:
    """What the functions return. Their jobs run side by side: an allocation is one task, and use cases are independent."""
    if not makes:
        return []
    with ThreadPoolExecutor(len(makes)) as pool:
        return [f.result() for f in [pool.submit(m) for m in makes]]


def summary(results: dict[str, Located]) -> DataFrame:
    rows = [r.kpi for r in results.values()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionAll(r)
    return out
