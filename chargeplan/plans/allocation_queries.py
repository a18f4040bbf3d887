"""Queries over the fixtures: allocators, use cases, scenarios.

An allocation by regions has a recursive SQL twin that repeats the greedy rule event by event, all regions at a time. Where one
allocation covers a whole table, recursion over it is too slow; such a query returns counts and violations of its laws, and the
SQL twin has the counts from the raw table and zero violations.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from chargeplan.config import ScenarioConfig
from chargeplan.operators import allocators, intervals, relational
from chargeplan.plans import assembly, usecases
from chargeplan.plans.registry import query
from chargeplan.sources import fixtures as X
from chargeplan.sources.fixtures import with_sql

STEPS = 4096
#: Mean charge and mean stay in hours of each aggregate id.
PPC_MEANS = {101: (1.1, 6.8), 102: (2.4, 6.9), 103: (0.7, 3.1), 104: (1.7, 6.7), 201: (0.9, 5.3), 301: (0.9, 7.0), 302: (1.4, 5.4), 401: (2.4, 5.5), 402: (2.4, 6.2), 403: (2.1, 5.1)}


def _grouped(spark, d):
    """Events by use case, and every group's own copy of all lots as candidate sites, numbered 0..n-1 by id."""
    e = X.events(spark, d)
    s = relational.dense_index(X.lots(spark, d).select("idx", F.col("weight").cast("double").alias("weight")), "idx")
    groups = e.select("charging_use_case").distinct()
    return e, s.crossJoin(F.broadcast(groups))


def _allocated(spark, d):
    e, s = _grouped(spark, d)
    return e, *allocators.shared_allocation(e, s, "charging_use_case", STEPS)


@query()
def alloc_shared(spark, d):
    return _allocated(spark, d)[1]


@query(with_sql("ev", "SELECT charging_use_case AS alloc_group, count(*) AS n_events, cast(0 AS bigint) AS overfull FROM ev GROUP BY 1"))
def alloc_shared_check(spark, d):
    """Every event stands at one site, and no site is ever fuller than its points."""
    e, placed, sites = _allocated(spark, d)
    both = placed.join(e, "event_id")
    top = intervals.peak(both, ["alloc_group", "assigned_location"]).join(sites.withColumnRenamed("idx", "assigned_location"), ["alloc_group", "assigned_location"], "left")
    bad = top.groupBy("alloc_group").agg(F.count_if(F.coalesce(F.col("peak") > F.col("points"), F.lit(True))).alias("overfull"))
    return both.groupBy("alloc_group").agg(F.countDistinct("event_id").alias("n_events")).join(bad, "alloc_group")


@query(with_sql("ev", "SELECT count(*) AS n_street, cast(0 AS bigint) AS late, cast(0 AS bigint) AS overfull FROM ev WHERE charging_use_case = 'street' AND station_charging_capacity > 0"))
def multi_use_shift(spark, d):
    """Street events on points that retail leaves idle, up to four steps later."""
    e, s = _grouped(spark, d)
    g = lambda df: df.withColumn("g", F.lit("retail"))
    first, street = e.where("charging_use_case = 'retail'"), e.where("charging_use_case = 'street' AND station_charging_capacity > 0")
    sites = s.where("charging_use_case = 'retail'")
    got = allocators.multi_use_allocation(g(first), g(street), g(sites), "g", STEPS, 4)
    was = street.select("event_id", F.col("event_start").alias("s0"))
    hit = got.join(was, "event_id")
    placed, points = allocators.shared_allocation(g(first), g(sites), "g", STEPS)
    at = placed.join(first, "event_id").select("assigned_location", "event_start", "event_time").unionByName(hit.where("assigned_location IS NOT NULL").select("assigned_location", "event_start", "event_time"))
    over = intervals.peak(at, ["assigned_location"]).join(points.withColumnRenamed("idx", "assigned_location"), "assigned_location").agg(F.count_if(F.col("peak") > F.col("points")).alias("overfull"))
    return hit.agg(F.count(F.lit(1)).alias("n_street"), F.count_if((F.col("event_start") < F.col("s0")) | (F.col("event_start") > F.col("s0") + 4)).alias("late")).crossJoin(over)


#: Regions of the allocations with a recursive twin, and of the given network.
REGIONS, NETWORKS = 40, 20


def _regional(spark, d):
    e = X.events(spark, d).withColumn("region", (F.col("user_id") % REGIONS).cast("string"))
    s = X.lots(spark, d).select("idx", F.col("weight").cast("double").alias("weight"), (F.col("idx") % REGIONS).cast("string").alias("region"))
    return e, s


# a region's sites in order of id, and its events in the order of an expression
_REGIONAL = f"""w0 AS (SELECT idx % {REGIONS} AS g, idx, weight, sum(weight) OVER (PARTITION BY idx % {REGIONS} ORDER BY idx) AS hi, sum(weight) OVER (PARTITION BY idx % {REGIONS}) AS total FROM lot),
 w AS (SELECT g, list(idx ORDER BY idx) AS ids, list(cast(hi AS double) / total ORDER BY idx) AS cdf FROM w0 GROUP BY g),
 r0 AS (SELECT g, ids, cdf, list_transform(ids, lambda p: cast(0 AS bigint)) AS pts, list_transform(ids, lambda p: cast(0 AS double)) AS mean, cast([] AS STRUCT(p BIGINT, s INT, e INT)[]) AS plc FROM w)"""
# of the placements at that overlap [s, e): most at once at site p, by looking at each start; and the steps that they fill
_MOST = "coalesce(list_max(list_transform(list_filter(near, lambda y: y.p = k), lambda y: len(list_filter(near, lambda z: z.p = k AND z.s <= greatest(y.s, s) AND z.e > greatest(y.s, s))))), 0)"
_STEP = f"""n AS (SELECT r.* EXCLUDE (event_id, location), e.event_id, e.s, e.e, e.cap, e.u, list_filter(r.plc, lambda x: x.s < e.e AND x.e > e.s) AS near FROM r JOIN q e ON e.g = r.g AND e.i = r.i + 1),
 f AS (SELECT *, list_filter(range(1, len(ids) + 1), lambda k: pts[k] > 0 AND {_MOST} < pts[k])[1] AS free FROM n),
 t AS (SELECT *, coalesce(free, list_position(list_transform(cdf, lambda c: c > u), true)) AS site FROM f)
 SELECT g, ids, cdf, list_transform(pts, lambda v, k: CASE WHEN free IS NULL AND k = site THEN v + 1 ELSE v END), list_transform(mean, lambda v, k: CASE WHEN free IS NULL AND k = site THEN (v * pts[k] + cap) / (pts[k] + 1) ELSE v END), list_append(plc, struct_pack(p := cast(site AS bigint), s := s, e := e)), i + 1, event_id, ids[site]"""


def _recursion(events: str) -> str:
    """Tables q (events numbered within their region) and r (a row for each event that has been placed)."""
    return f"""{_REGIONAL}, q AS (SELECT g, event_id, s, least(s + t, {STEPS}) AS e, cap, u, row_number() OVER (PARTITION BY g ORDER BY event_id) AS i FROM (SELECT user_id % {REGIONS} AS g, event_id, event_start AS s, event_time AS t, station_charging_capacity AS cap, {X.U.format(k='event_id + 1')} AS u FROM ev WHERE {events}) v),
 r AS (SELECT g, ids, cdf, pts, mean, plc, cast(0 AS bigint) AS i, cast(NULL AS bigint) AS event_id, cast(NULL AS bigint) AS location FROM r0 UNION ALL (WITH {_STEP} FROM t))"""


def recursive(names: str, body: str) -> str:
    return X.with_sql(names, body).replace("WITH ", "WITH RECURSIVE ", 1)


@query(recursive("ev lot", ", " + _recursion("true") + " SELECT cast(g AS varchar) AS region, event_id, location FROM r WHERE i > 0"))
def alloc_shared_regions(spark, d):
    """Shared allocation of all events, an allocation for each region: the site of every event."""
    e, s = _regional(spark, d)
    placed, _ = allocators.shared_allocation(e, s, "region", STEPS)
    return placed.select(F.col("alloc_group").alias("region"), "event_id", F.col("assigned_location").alias("location"))


_LAST = " last AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY g ORDER BY i DESC) = 1), o AS (SELECT g, unnest(ids) AS idx, unnest(pts) AS points, unnest(mean) AS mean FROM last)"


@query(recursive("ev lot", ", " + _recursion("true") + "," + _LAST + " SELECT cast(g AS varchar) AS region, idx, points, cast(trunc(mean) AS bigint) AS capacity FROM o"))
def alloc_shared_points(spark, d):
    """Points and truncated running mean of the capacity at every site of the same allocation."""
    e, s = _regional(spark, d)
    _, sites = allocators.shared_allocation(e, s, "region", STEPS)
    return sites.select(F.col("alloc_group").alias("region"), "idx", "points", "capacity")


_SHIFT = 4


@query(recursive("ev lot", ", " + _recursion("charging_use_case = 'retail'") + "," + _LAST.split(", o AS")[0] + f""",
 q2 AS (SELECT user_id % {REGIONS} AS g, event_id, event_start AS s, event_time AS t, cast(energy AS double) / station_charging_capacity * 4 AS need, row_number() OVER (PARTITION BY user_id % {REGIONS} ORDER BY event_id) AS i FROM ev WHERE charging_use_case = 'street' AND station_charging_capacity > 0),
 m AS (SELECT g, ids, pts, plc, cast(0 AS bigint) AS i, cast(NULL AS bigint) AS event_id, cast(NULL AS int) AS s, cast(NULL AS int) AS t, cast(NULL AS bigint) AS site FROM last UNION ALL (
  WITH n AS (SELECT m.g, m.ids, m.pts, m.plc, m.i, e.event_id, e.s, e.t, list_transform(range(0, {_SHIFT + 1}), lambda x: struct_pack(s := cast(e.s + x AS int), t := cast(CASE WHEN e.t - x < e.need THEN least(ceil(e.need), e.t) ELSE e.t - x END AS int))) AS tries FROM m JOIN q2 e ON e.g = m.g AND e.i = m.i + 1),
  b AS (SELECT *, list_filter(list_transform(tries, lambda x: struct_pack(s := x.s, t := x.t, p := CASE WHEN x.t > 0 AND x.s + x.t <= {STEPS} THEN list_filter(range(1, len(ids) + 1), lambda k: coalesce(list_sum(list_transform(list_filter(plc, lambda y: y.p = k AND y.s < x.s + x.t AND y.e > x.s), lambda y: least(y.e, x.s + x.t) - greatest(y.s, x.s))), 0) < pts[k])[1] END)), lambda x: x.p IS NOT NULL)[1] AS best FROM n)
  SELECT g, ids, pts, CASE WHEN best IS NULL THEN plc ELSE list_append(plc, struct_pack(p := cast(best.p AS bigint), s := best.s, e := cast(best.s + best.t AS int))) END, i + 1, event_id, coalesce(best.s, s), coalesce(best.t, t), ids[best.p] FROM b))
 SELECT cast(g AS varchar) AS region, event_id, s AS event_start, t AS event_time, site AS location FROM m WHERE i > 0"""))
def multi_use_regions(spark, d):
    """Street events on the points that a region's retail events leave idle, up to four steps later; null without room."""
    e, s = _regional(spark, d)
    got = allocators.multi_use_allocation(e.where("charging_use_case = 'retail'"), e.where("charging_use_case = 'street' AND station_charging_capacity > 0"), s, "region", STEPS, _SHIFT)
    return got.select(F.col("alloc_group").alias("region"), "event_id", "event_start", "event_time", F.col("assigned_location").alias("location"))


def _network(spark, d):
    sites = X.stations(spark, d).select(F.col("idx").alias("location_id"), "charging_points", (F.col("idx") % NETWORKS).alias("region"))
    n = sites.count()
    e = X.events(spark, d).withColumn("location_id", F.col("event_id") % n).withColumn("region", F.col("location_id") % NETWORKS)
    return e, sites, allocators.network_assignment(e, sites, "region")


@query(recursive("ev sta", f""", c AS (SELECT idx % {{REGIONS}} AS g, list(idx ORDER BY idx) AS ids, list(charging_points ORDER BY idx) AS pts FROM sta GROUP BY 1),
 q AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY s, e DESC, event_id) AS i FROM (SELECT event_id, event_start AS s, event_start + event_time AS e, location_id, location_id % {{REGIONS}} AS g FROM (SELECT *, event_id % (SELECT count(*) FROM sta) AS location_id FROM ev) v) v),
 r AS (SELECT g, ids, pts, cast([] AS STRUCT(p BIGINT, e INT)[]) AS plc, cast(0 AS bigint) AS i, cast(NULL AS bigint) AS event_id, cast(NULL AS bigint) AS location_id, cast(NULL AS bigint) AS site FROM c UNION ALL (
  WITH n AS (SELECT r.g, r.ids, r.pts, list_filter(r.plc, lambda x: x.e > e.s) AS plc, r.i, e.event_id, e.location_id, e.e, list_position(r.ids, e.location_id) AS own FROM r JOIN q e ON e.g = r.g AND e.i = r.i + 1),
  l AS (SELECT *, list_transform(ids, lambda x, k: len(list_filter(plc, lambda y: y.p = k))) AS load FROM n),
  b AS (SELECT *, CASE WHEN load[own] < pts[own] THEN own ELSE list_sort(list_transform(list_filter(range(1, len(ids) + 1), lambda k: load[k] < pts[k]), lambda k: struct_pack(l := load[k], k := k)))[1].k END AS k FROM l)
  SELECT g, ids, pts, CASE WHEN k IS NULL THEN plc ELSE list_append(plc, struct_pack(p := cast(k AS bigint), e := e)) END, i + 1, event_id, location_id, ids[k] FROM b))
 SELECT event_id, location_id, site AS assigned_location_id, coalesce(site <> location_id, false) AS was_reassigned, site IS NULL AS unserved FROM r WHERE i > 0""".replace("{REGIONS}", str(NETWORKS))))
def min_load_reassign(spark, d):
    """Every event at its own site, at its region's least loaded one, or unserved."""
    return _network(spark, d)[2].select("event_id", "location_id", "assigned_location_id", "was_reassigned", "unserved")


@query(with_sql("ev", "SELECT count(*) AS n_events, cast(0 AS bigint) AS overfull, cast(0 AS bigint) AS both_states FROM ev"))
def min_load_reassign_check(spark, d):
    _, sites, got = _network(spark, d)
    top = intervals.peak(got.where("NOT unserved"), ["assigned_location_id"])
    over = top.join(sites, top["assigned_location_id"] == sites["location_id"], "left").agg(F.count_if(F.coalesce(F.col("peak") > F.col("charging_points"), F.lit(True))).alias("overfull"))
    return got.agg(F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("unserved") == F.col("assigned_location_id").isNotNull()).alias("both_states")).crossJoin(over)


def _rebalance_input(spark, d):
    street = X.stations(spark, d).select(F.concat(F.lit("6"), F.col("idx")).cast("long").alias("location_id"), "charging_points", "x", "y", F.lit("street").alias("mode"))
    home = X.buildings(spark, d).select(F.concat(F.lit("2"), F.col("idx")).cast("long").alias("location_id"), F.lit(3).alias("charging_points"), "x", "y", F.lit("home_street").alias("mode"))
    sites = street.unionByName(home).withColumn("average_charging_capacity", F.lit(22))
    n, m = X.stations(spark, d).count(), X.buildings(spark, d).count()
    e = X.events(spark, d).where("charging_use_case = 'street'")
    at_home = F.col("location") == "home"
    located = e.withColumn("mode", F.when(at_home, "home_street").otherwise("street")).withColumn("location_id", F.when(at_home, F.concat(F.lit("2"), (F.col("event_id") % m))).otherwise(F.concat(F.lit("6"), F.col("event_id") % n)).cast("long"))
    return located, sites


@query(recursive("ev sta bld", """, loc AS (SELECT *, row_number() OVER (ORDER BY event_id) AS j FROM (SELECT event_id, event_start AS s, event_start + event_time AS e, coalesce(location = 'home', false) AS home, cast(CASE WHEN location = 'home' THEN concat('2', event_id % (SELECT count(*) FROM bld)) ELSE concat('6', event_id % (SELECT count(*) FROM sta)) END AS bigint) AS l FROM ev WHERE charging_use_case = 'street') v),
 near0 AS (SELECT cast(concat('2', b.idx) AS bigint) AS l, list(struct_pack(l := cast(concat('6', s.idx) AS bigint), p := s.charging_points) ORDER BY cast(concat('6', s.idx) AS bigint)) AS c FROM bld b JOIN sta s ON sqrt((b.x - s.x) * (b.x - s.x) + (b.y - s.y) * (b.y - s.y)) <= 1000 GROUP BY b.idx),
 q AS (SELECT loc.*, c, row_number() OVER (ORDER BY event_id) AS i FROM loc JOIN near0 USING (l) WHERE home),
 r AS (SELECT cast(0 AS bigint) AS i, (SELECT list(struct_pack(l := l, s := s, e := e) ORDER BY j) FROM loc) AS occ UNION ALL (
  WITH n AS (SELECT r.i, r.occ, q.j, q.s, q.e, q.c, list_filter(r.occ, lambda x: x.s < q.e AND x.e > q.s) AS busy FROM r JOIN q ON q.i = r.i + 1),
  t AS (SELECT *, list_filter(c, lambda k: coalesce(list_max(list_transform(list_filter(busy, lambda y: y.l = k.l), lambda y: len(list_filter(busy, lambda z: z.l = k.l AND z.s <= greatest(y.s, s) AND z.e > greatest(y.s, s))))), 0) < k.p)[1].l AS pick FROM n)
  SELECT i + 1, CASE WHEN pick IS NULL THEN occ ELSE list_transform(occ, lambda x, k: CASE WHEN k = j THEN struct_pack(l := pick, s := x.s, e := x.e) ELSE x END) END FROM t)),
 last AS (SELECT occ FROM r ORDER BY i DESC LIMIT 1), o AS (SELECT unnest(range(1, len(occ) + 1)) AS j, unnest(occ).l AS location_id FROM last)
 SELECT event_id, location_id FROM loc JOIN o USING (j)"""))
def street_rebalance(spark, d):
    """Where every street event stands after home-street events moved to idle street points at most 1000 m away."""
    located, sites = _rebalance_input(spark, d)
    return usecases.rebalanced(located, sites, ScenarioConfig(simulation_steps=2048), located).events.select("event_id", "location_id")


@query(with_sql("ev", "SELECT count(*) AS n_events, cast(0 AS bigint) AS too_far, cast(0 AS bigint) AS wrong_peak FROM ev WHERE charging_use_case = 'street'"))
def street_rebalance_check(spark, d):
    """No event is lost, none moves over 1000 m, and every site ends with its peak as points."""
    located, sites = _rebalance_input(spark, d)
    out = usecases.rebalanced(located, sites, ScenarioConfig(simulation_steps=2048), located)
    place = sites.select("location_id", "x", "y")
    was = located.select("event_id", F.col("location_id").alias("l0")).join(place.toDF("l0", "x0", "y0"), "l0", "left")
    moved = out.events.join(was, "event_id").join(place, "location_id", "left").where("location_id <> l0")
    far = moved.agg(F.count_if(F.hypot(F.col("x") - F.col("x0"), F.col("y") - F.col("y0")) > 1000).alias("too_far"))
    top = intervals.peak(out.events, ["location_id"]).join(out.sites.select("location_id", "charging_points"), "location_id")
    wrong = top.agg(F.count_if(F.col("peak") != F.col("charging_points")).alias("wrong_peak"))
    return out.events.agg(F.count(F.lit(1)).alias("n_events")).crossJoin(far).crossJoin(wrong)


def _hour_counts(spark, d):
    kinds = {"view": 104, "click": 301, "purchase": 402, "error": 201, "signup": 101}
    look = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    e = X.table(spark, d, "events").select(F.try_element_at(look, F.col("event_type")).alias("ppc_id"), ((F.weekday("ts") * 24) + F.hour("ts")).alias("weekhour"))
    return e.groupBy("ppc_id", "weekhour").agg(F.count(F.lit(1)).cast("int").alias("charging_vehicles"))


@query(""" SELECT cast(count(DISTINCT event_type) AS bigint) AS ids, cast(0 AS bigint) AS short_stays, cast(0 AS bigint) AS wrong_counts FROM events""")
def decompose_counts(spark, d):
    """Hourly counts to events: stays cover charges, and at each counted hour at least as many charge as are counted."""
    counts = _hour_counts(spark, d)
    e = allocators.decomposition(counts, PPC_MEANS)
    running = e.select("ppc_id", F.explode(F.sequence(F.col("start_hour"), (F.ceil(F.col("start_hour") + F.col("charge_hours")) - 1).cast("int"))).alias("weekhour")).groupBy("ppc_id", "weekhour").agg(F.count(F.lit(1)).alias("n"))
    wrong = counts.join(running, ["ppc_id", "weekhour"], "left").agg(F.count_if(F.coalesce("n", F.lit(0)) < F.col("charging_vehicles")).alias("wrong_counts"))
    return e.agg(F.countDistinct("ppc_id").alias("ids"), F.count_if((F.col("stay_hours") < F.col("charge_hours")) | (F.col("charge_hours") < 0.5)).alias("short_stays")).crossJoin(wrong)


@query()
def decomposed_events(spark, d):
    """The decomposed events in quarter-hour steps with use case, mean power and capacity."""
    return assembly.decomposed_steps(_hour_counts(spark, d), PPC_MEANS)


@query(recursive("lot", """, p AS (SELECT idx % 8 AS g, list(struct_pack(x := x, y := y, w := cast(weight AS double)) ORDER BY idx) AS pts FROM lot GROUP BY 1),
 r AS (SELECT g, pts, list_transform(pts, lambda v: true) AS free, cast(0 AS bigint) AS i, cast(NULL AS STRUCT(r DOUBLE, w DOUBLE, n BIGINT)) AS c FROM p UNION ALL (
  WITH n AS (SELECT g, pts, free, i + 1 AS i, list_transform(pts, lambda v: sqrt((v.x - pts[i + 1].x) * (v.x - pts[i + 1].x) + (v.y - pts[i + 1].y) * (v.y - pts[i + 1].y))) AS dist FROM r WHERE i < len(pts)),
  o AS (SELECT *, list_transform(range(1, 11), lambda k: struct_pack(r := cast(100 * k AS double), w := coalesce(list_sum(list_transform(pts, lambda v, j: CASE WHEN free[j] AND dist[j] < 100 * k THEN v.w ELSE 0 END)), 0))) AS grown FROM n),
  b AS (SELECT *, CASE WHEN free[i] THEN list_filter(grown, lambda v: v.r + 100 > 1000 OR v.w > 300)[1] END AS best FROM o)
  SELECT g, pts, list_transform(free, lambda v, j: v AND (best IS NULL OR dist[j] >= best.r)), i, CASE WHEN best IS NOT NULL THEN struct_pack(r := best.r, w := best.w, n := cast(len(list_filter(range(1, len(pts) + 1), lambda j: free[j] AND dist[j] < best.r)) AS bigint)) END FROM b))
 SELECT g AS region, pts[i].x AS x, pts[i].y AS y, c.w AS potential, c.r AS radius, c.n AS members FROM r WHERE c IS NOT NULL"""))
def poi_clusters(spark, d):
    p = X.lots(spark, d).withColumn("region", F.col("idx") % 8)
    return allocators.poi_clusters(p, "region", 1000.0, 300.0, 100.0)


@query(with_sql("lot", "SELECT idx % 8 AS region, count(*) AS members, cast(sum(weight) AS double) AS potential FROM lot GROUP BY 1"))
def poi_clusters_check(spark, d):
    """Clusters part the points: members and weights add up."""
    return poi_clusters(spark, d).groupBy("region").agg(F.sum("members").alias("members"), F.sum("potential").alias("potential"))


def _layers(spark, d):
    b, lots = X.buildings(spark, d), X.lots(spark, d)
    return {
        "home_apartment": b.where("households_total > 2"), "home_detached": b.where("households_total <= 2"), "home_street": b.where("households_total > 2"),
        "work": lots, "hpc": X.stations(spark, d).withColumn("gewicht", F.col("charging_points")), "retail": lots, "public": X.stations(spark, d).withColumn("weight", F.col("charging_points")), "depot": lots,
    }


def _scenario(spark, d):
    """All use cases over the fixtures."""
    e = X.events(spark, d).where("station_charging_capacity <> 0").withColumn("energy", F.col("energy").cast("double"))
    cfg = ScenarioConfig(run=("home", "work", "hpc", "retail", "public", "depot"), simulation_steps=3072, charging_time_limit=True)
    return e, usecases.run_scenario(cfg, e, _layers(spark, d))


@query()
def result_summary(spark, d):
    return usecases.summary(_scenario(spark, d)[1])


_USE_CASES = ("home_apartment", "home_detached", "work", "hpc", "retail", "public", "depot")


@query(" UNION ALL ".join(f"SELECT '{u}' AS use_case, cast(0 AS bigint) AS orphans, cast(0 AS bigint) AS overfull, cast(0 AS bigint) AS strangers" for u in _USE_CASES))
def scenario_orphans(spark, d):
    """Per use case: events at no site of it, sites fuller than their points, sites that stand on none of its candidates."""
    _, out = _scenario(spark, d)
    layers, parts = _layers(spark, d), []
    for name, r in out.items():
        at = r.events.join(r.sites.select("location_id", "charging_points"), "location_id", "left")
        lost = at.agg(F.count_if(F.col("charging_points").isNull()).alias("orphans"))
        top = intervals.peak(r.events, ["location_id"]).join(r.sites.select("location_id", "charging_points"), "location_id")
        full = top.agg(F.count_if(F.col("peak") > F.col("charging_points")).alias("overfull"))
        layer = layers[name] if name != "public" else layers["public"].select("x", "y").unionByName(layers["home_street"].select("x", "y"))
        strange = r.sites.join(layer.select("x", "y").distinct(), ["x", "y"], "left_anti").agg(F.count(F.lit(1)).alias("strangers"))
        parts.append(lost.crossJoin(full).crossJoin(strange).select(F.lit(name).alias("use_case"), "orphans", "overfull", "strangers"))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionAll(p)
    return whole


@query(with_sql("ev", """, v AS (SELECT *, (cast(((event_id + 1)*2654435761) % 4294967296 AS double) / cast(4294967296 AS double)) AS h FROM ev WHERE station_charging_capacity <> 0)
 SELECT CASE WHEN charging_use_case = 'home' THEN CASE WHEN h < 0.87 THEN 'home_apartment' ELSE 'home_detached' END WHEN charging_use_case = 'street' THEN 'public' WHEN charging_use_case = 'urban_fast' THEN CASE WHEN location = 'shopping' THEN 'retail' ELSE 'hpc' END ELSE charging_use_case END AS use_case, count(*) AS n FROM v GROUP BY 1"""))
def scenario_located_counts(spark, d):
    """Every usable event of every use case is located once."""
    _, out = _scenario(spark, d)
    parts = [r.events.agg(F.countDistinct("event_id").alias("n")).select(F.lit(k).alias("use_case"), "n") for k, r in out.items()]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionAll(p)
    return whole
