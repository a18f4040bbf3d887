"""Queries over the fixtures: scans, filters, joins, aggregates, windows, scalars, intervals. Each has a SQL twin."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chargeplan.functions import scalars as S
from chargeplan.operators import intervals, relational
from chargeplan.plans import usecases
from chargeplan.plans.registry import query
from chargeplan.sources import fixtures as X
from chargeplan.sources.fixtures import with_sql

USES = ["street", "home", "retail", "urban_fast", "work", "depot"]


@query(with_sql("ev", """SELECT row_number() OVER (ORDER BY CASE WHEN "Type" = 'Commercial' THEN 0 ELSE 1 END, event_id) AS event_id, charging_use_case,
 "Type" AS kind, location, event_start FROM (SELECT event_id, charging_use_case, "Type", NULL AS location, event_start FROM ev WHERE "Type" = 'Commercial' AND event_start <= 672
 UNION ALL SELECT event_id, charging_use_case, "Type", location, event_start - 672 FROM ev WHERE "Type" = 'Private' AND station_charging_capacity <> 0 AND event_start > 672 AND event_start <= 1344) t"""))
def scan_union_events(spark, d):
    e = X.events(spark, d).withColumn("k", F.col("event_id"))
    private = e.where("Type = 'Private'").drop("Type")
    commercial = e.where("Type = 'Commercial'").drop("Type", "location")
    return usecases.unify(private, commercial, "k").select("event_id", "charging_use_case", F.col("Type").alias("kind"), "location", "event_start")


_PATHS = """SELECT concat('/data/', CASE n_nationkey % 3 WHEN 0 THEN 'BEV' WHEN 1 THEN 'phev' ELSE 'ice' END, '_', CASE n_nationkey % 4 WHEN 0 THEN 'mini' WHEN 1 THEN 'medium' WHEN 2 THEN 'luxury' ELSE 'Mini' END, '/', lower(n_name), '.parquet') AS path FROM nation"""


@query(f"""SELECT path, concat(CASE WHEN lower(path) LIKE '%bev%' THEN 'bev' WHEN lower(path) LIKE '%phev%' THEN 'phev' ELSE 'None' END, '_',
 CASE WHEN path LIKE '%mini%' THEN 'mini' WHEN path LIKE '%medium%' THEN 'medium' WHEN path LIKE '%luxury%' THEN 'luxury' ELSE 'None' END) AS car_type FROM ({_PATHS}) t""")
def car_type_from_path(spark, d):
    k = F.col("n_nationkey") % 3, F.col("n_nationkey") % 4
    drive, size = F.when(k[0] == 0, "BEV").when(k[0] == 1, "phev").otherwise("ice"), F.when(k[1] == 0, "mini").when(k[1] == 1, "medium").when(k[1] == 2, "luxury").otherwise("Mini")
    path = F.concat(F.lit("/data/"), drive, F.lit("_"), size, F.lit("/"), F.lower("n_name"), F.lit(".parquet"))
    return X.table(spark, d, "nation").select(path.alias("path")).withColumn("car_type", S.car_type(F.col("path")))


@query(with_sql("ev", """SELECT event_id, cast(event_start - 672 AS int) AS event_start, event_time FROM ev WHERE (station_charging_capacity = 0) IS NOT TRUE AND event_start > 672"""))
def events_week_window(spark, d):
    e = X.events(spark, d).where(S.differs(F.col("station_charging_capacity"), 0.0) & (F.col("event_start") > S.WEEK_STEPS))
    return e.select("event_id", (F.col("event_start") - S.WEEK_STEPS).cast("int").alias("event_start"), "event_time")


@query(with_sql("ev", "SELECT event_id, location FROM ev WHERE charging_use_case = 'street' AND location IS DISTINCT FROM 'home'"))
def null_safe_not_home(spark, d):
    return usecases.street_split(X.events(spark, d))[1].select("event_id", "location")


@query(with_sql("ev", "SELECT event_id FROM ev WHERE charging_use_case = 'urban_fast' AND (location IN ('shopping', 'mall')) IS NOT TRUE"))
def not_in_shopping_null_safe(spark, d):
    return X.events(spark, d).where((F.col("charging_use_case") == "urban_fast") & S.not_in(F.col("location"), "shopping", "mall")).select("event_id")


@query(with_sql("ev", "SELECT event_id FROM ev WHERE location IS NULL AND station_charging_capacity IS NOT NULL"))
def null_filters(spark, d):
    return X.events(spark, d).where(F.col("location").isNull()).dropna(subset=["station_charging_capacity"]).select("event_id")


@query(with_sql("ev", "SELECT event_id, CASE WHEN charging_use_case <> 'home' THEN charging_use_case WHEN u < 0.87 THEN 'home_apartment' ELSE 'home_detached' END AS charging_use_case FROM ev"))
def home_split(spark, d):
    return usecases.split_home(X.events(spark, d), 0.87, F.col("u")).select("event_id", "charging_use_case")


_DETACHED = """, s AS (SELECT idx, households_total, sum(households_total) OVER (ORDER BY idx) AS hi, sum(households_total) OVER () AS total FROM bld WHERE households_total < 3),
 p AS (SELECT e.event_id, e.energy, e.station_charging_capacity, s.idx FROM ev e JOIN s ON e.u >= cast(s.hi - s.households_total AS double) / s.total AND e.u < cast(s.hi AS double) / s.total WHERE e.charging_use_case = 'home'),
 g AS (SELECT idx, count(*) AS charging_points, cast(floor(avg(station_charging_capacity)) AS bigint) AS average_charging_capacity FROM p GROUP BY idx) """


def _detached(spark, d):
    e = X.events(spark, d).where("charging_use_case = 'home'")
    return (*usecases.one_point_per_event(e, X.buildings(spark, d).where("households_total < 3"), "home_detached", "households_total"), e)


@query(with_sql("ev bld", _DETACHED + "SELECT cast(concat('1', idx) AS bigint) AS location_id, charging_points, average_charging_capacity, x, y FROM g JOIN bld USING (idx)"))
def home_detached_sites(spark, d):
    return _detached(spark, d)[1].select("location_id", "charging_points", "average_charging_capacity", "x", "y")


@query(with_sql("ev bld", _DETACHED + "SELECT event_id, cast(concat('1', idx) AS bigint) AS location_id FROM p"))
def home_detached_events(spark, d):
    return _detached(spark, d)[0].select("event_id", "location_id")


@query(with_sql("ev bld", _DETACHED + "SELECT 'home_detached' AS location, cast(sum(charging_points) AS bigint) AS charging_points, (SELECT cast(floor(cast(sum(energy) AS double)) AS bigint) FROM ev WHERE charging_use_case = 'home') AS energy, cast(sum(charging_points * average_charging_capacity) AS bigint) AS installed_power FROM g"))
def home_detached_kpi(spark, d):
    _, sites, e = _detached(spark, d)
    return usecases.kpi("home_detached", sites, e)


@query(with_sql("bld", "SELECT b.idx, b.households_total, p.total FROM bld b LEFT JOIN (SELECT o_custkey AS idx, count(*) AS total FROM orders GROUP BY o_custkey) p USING (idx)"))
def households_left_join(spark, d):
    profiles = X.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("idx")).agg(F.count(F.lit(1)).alias("total"))
    return X.buildings(spark, d).join(profiles, "idx", "left").select("idx", "households_total", "total")


@query(with_sql("bld", "SELECT idx, CASE WHEN households_total IN (1, 2) THEN 'detached' ELSE 'apartment' END AS kind FROM bld WHERE try_cast(cts_demand AS double) = 0 AND households_total IS NOT NULL"))
def home_detached_apartment_split(spark, d):
    b = X.buildings(spark, d).where((F.try_to_number("cts_demand", F.lit("9.9")).cast("double") == 0) & F.col("households_total").isNotNull())
    small = b.where(F.col("households_total").isin(1, 2)).withColumn("kind", F.lit("detached"))
    return small.unionByName(b.where(~F.col("households_total").isin(1, 2)).withColumn("kind", F.lit("apartment"))).select("idx", "kind")


@query(with_sql("ev sta", "SELECT e.event_id, s.idx AS location_id, e.energy, s.x, s.y FROM ev e JOIN sta s ON e.event_id % 120 = s.idx"))
def located_join(spark, d):
    e = X.events(spark, d).withColumn("assigned_location", F.col("event_id") % 120)
    s = X.stations(spark, d).withColumnRenamed("idx", "location_id")
    return e.join(s, e["assigned_location"] == s["location_id"]).select("event_id", s["location_id"], "energy", s["x"], s["y"])


@query(with_sql("ev", "SELECT event_id, event_start FROM ev WHERE charging_use_case = 'street' AND event_id IN (SELECT event_id FROM ev WHERE station_charging_capacity > 20)"))
def existing_semi(spark, d):
    e = X.events(spark, d)
    return e.where("charging_use_case = 'street'").join(e.where("station_charging_capacity > 20").select("event_id"), "event_id", "left_semi").select("event_id", "event_start")


_STARTS = """, g AS (SELECT unnest(range(0, (SELECT max(event_start) FROM ev) + 1)) AS time_step),
 a AS (SELECT time_step, (SELECT count(*) FROM ev WHERE event_start = time_step AND "Type" = 'Private') AS n_df1 FROM g),
 b AS (SELECT time_step, (SELECT count(*) FROM ev WHERE event_start >= time_step AND event_start < time_step + 4 AND "Type" = 'Commercial') AS n_df2 FROM g WHERE time_step % 4 = 0),
 f AS (SELECT time_step, last_value(n_df1 IGNORE NULLS) OVER w AS n_df1, last_value(n_df2 IGNORE NULLS) OVER w AS n_df2 FROM a FULL JOIN b USING (time_step) WINDOW w AS (ORDER BY time_step ROWS UNBOUNDED PRECEDING))"""


@query(with_sql("ev", _STARTS + " SELECT time_step, n_df1, n_df2 FROM f"))
def timeline_full_outer_ffill(spark, d):
    """Starts at every step (private) and in every hour (commercial, at the hour's first step), zero where there are none."""
    e = X.events(spark, d)
    last = e.agg(F.max("event_start")).first()[0]

    def side(t, width, n):
        step = (F.floor(F.col("event_start") / width) * width).cast("long")
        counts = e.where(F.col("Type") == t).groupBy(step.alias("time_step")).agg(F.count(F.lit(1)).alias(n))
        grid = spark.range(0, 0 if last is None else last + 1, width).select(F.col("id").alias("time_step"))
        return grid.join(counts, "time_step", "left").na.fill(0, [n])

    return relational.forward_fill(side("Private", 1, "n_df1").join(side("Commercial", 4, "n_df2"), "time_step", "full"), "time_step", ["n_df1", "n_df2"])


@query(with_sql("ev", _STARTS + " SELECT time_step, n_df1 + n_df2 AS retail FROM f WHERE time_step <= 672"))
def row_sums_after_fill(spark, d):
    f = timeline_full_outer_ffill(spark, d).where(F.col("time_step") <= S.WEEK_STEPS)
    return f.select("time_step", (F.col("n_df1") + F.col("n_df2")).alias("retail"))




@query(with_sql("ev", """, a AS (SELECT event_start AS row_idx, count(*) AS n FROM ev WHERE "Type" = 'Private' GROUP BY 1), b AS (SELECT event_start AS row_idx, count(*) AS n FROM ev WHERE "Type" = 'Commercial' GROUP BY 1)
 SELECT cast(row_idx AS bigint) AS row_idx, cast(trunc((a.n - b.n) * 0.55) AS bigint) + b.n AS n FROM a FULL JOIN b USING (row_idx)"""))
def index_aligned_arith(spark, d):
    e = X.events(spark, d)
    side = lambda t: e.where(F.col("Type") == t).groupBy(F.col("event_start").cast("long").alias("row_idx")).agg(F.count(F.lit(1)).alias("n"))
    return relational.index_aligned(side("Private"), side("Commercial"), "row_idx", "n", lambda a, b: ((a - b) * F.lit(0.55)).cast("long") + b)


#: Aggregate id to use case.
PPC_USE_CASE = {101: "depot", 102: "depot", 103: "depot", 104: "street", 201: "street", 301: "home", 302: "street", 401: "home", 402: "retail", 403: "street"}


@query("SELECT cast(p_partkey AS bigint) AS idx, cast(100 + p_partkey % 5 + 100 * (p_partkey % 4) AS int) AS ppc_id, CASE 100 + p_partkey % 5 + 100 * (p_partkey % 4) " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in PPC_USE_CASE.items()) + " END AS use_case FROM part")
def lookup_map(spark, d):
    k = F.col("p_partkey")
    look = F.create_map(*[F.lit(x) for kv in PPC_USE_CASE.items() for x in kv])
    return X.table(spark, d, "part").select(k.alias("idx"), (100 + k % 5 + 100 * (k % 4)).cast("int").alias("ppc_id")).withColumn("use_case", F.try_element_at(look, F.col("ppc_id")))


@query(with_sql("ev lot", """, s AS (SELECT idx, weight, sum(weight) OVER (ORDER BY idx) AS hi, sum(weight) OVER () AS total FROM lot)
 SELECT e.event_id, s.idx FROM ev e JOIN s ON e.u >= cast(s.hi - s.weight AS double) / s.total AND e.u < cast(s.hi AS double) / s.total"""))
def weighted_pick(spark, d):
    return relational.weighted_pick(X.events(spark, d).select("event_id", "u"), X.lots(spark, d).select("idx", "weight"), "u", "weight").select("event_id", "idx")


@query(with_sql("lot", "SELECT idx, cast(sum(weight) OVER (ORDER BY idx) AS double) / sum(weight) OVER () AS cdf FROM lot"))
def cumulative_distribution(spark, d):
    s = X.lots(spark, d)
    total = s.agg(F.sum("weight").alias("total"))
    return relational.running(s.select("idx", "weight"), F.col("weight"), "idx", "cum").crossJoin(F.broadcast(total)).select("idx", (F.col("cum") / F.col("total")).alias("cdf"))


_STEPS = ", st AS (SELECT charging_use_case, unnest(range(event_start, event_start + event_time)) AS step FROM ev) "


@query(with_sql("ev", _STEPS + "SELECT cast(step AS bigint) AS step, charging_use_case, count(*) AS active FROM st GROUP BY ALL"))
def activity_timeline_long(spark, d):
    return intervals.activity(X.events(spark, d), ["charging_use_case"]).select(F.col("step").cast("long").alias("step"), "charging_use_case", "active")


@query(with_sql("ev", _STEPS + "SELECT g.step, " + ", ".join(f"count(*) FILTER (charging_use_case = '{u}') AS {u}" for u in USES) + " FROM (SELECT unnest(range(0, (SELECT greatest(3000, max(event_start + event_time) - 1) + 1 FROM ev))) AS step) g LEFT JOIN st USING (step) GROUP BY g.step"))
def activity_timeline_wide(spark, d):
    """Steps 0..3000 at least, and as many more as the table's events reach."""
    e = X.events(spark, d)
    return intervals.wide_activity(e, "charging_use_case", USES, 0, max(3000, intervals.last_step(e)))


@query(with_sql("ev", _STEPS + "SELECT " + ", ".join(f"count(*) FILTER (charging_use_case = '{u}') AS {u}" for u in USES) + ", g.step - (SELECT min(event_start) FROM ev) + 1 AS \"Zeitschritt\" FROM (SELECT unnest(range((SELECT min(event_start) FROM ev), (SELECT max(event_start + event_time) FROM ev))) AS step) g LEFT JOIN st USING (step) GROUP BY g.step"))
def occupation_timeline(spark, d):
    return intervals.occupation(X.events(spark, d), "charging_use_case", USES)


@query("""WITH e AS (SELECT event_type, epoch_us(ts) AS s, epoch_us(ts) + (1 + (event_id * 7919) % 48) * 60000000 AS e FROM events), g AS (SELECT unnest(range(min(s) // 900000000, (max(e) + 899999999) // 900000000 + 1)) AS q FROM e),
 c AS (SELECT event_type, q, count(*) AS n FROM (SELECT event_type, unnest(range((s + 899999999) // 900000000, (e + 899999999) // 900000000)) AS q FROM e) v GROUP BY ALL)
 SELECT t.event_type, make_timestamp(g.q * 900000000) AS zeitschritt, coalesce(n, 0) AS anzahl_aktiver_ladeevents FROM g CROSS JOIN (SELECT DISTINCT event_type FROM events) t LEFT JOIN c ON c.q = g.q AND c.event_type = t.event_type""")
def timestamp_timeline(spark, d):
    e = X.table(spark, d, "events").select("event_type", "ts", (1 + (F.col("event_id") * 7919) % 48).alias("minutes"))
    return intervals.timestamp_activity(e, "event_type", "ts", "minutes")


@query(with_sql("ev", """, dl AS (SELECT location_id, t, sum(dd) AS dd FROM (SELECT event_id % 97 AS location_id, event_start AS t, 1 AS dd FROM ev UNION ALL SELECT event_id % 97, event_start + event_time, -1 FROM ev) x GROUP BY ALL),
 lv AS (SELECT location_id, sum(dd) OVER (PARTITION BY location_id ORDER BY t) AS level FROM dl) SELECT location_id, cast(max(level) AS bigint) AS peak FROM lv GROUP BY location_id"""))
def peak_concurrency(spark, d):
    return intervals.peak(X.events(spark, d).withColumn("location_id", F.col("event_id") % 97), ["location_id"])


@query(with_sql("ev", """SELECT charging_use_case AS location, count(*) AS charging_points, cast(floor(cast(sum(energy) AS double)) AS bigint) AS energy, cast(floor(cast(sum(cast(station_charging_capacity AS decimal(12,2))) AS double)) AS bigint) AS installed_power FROM ev GROUP BY 1"""))
def kpi_by_use_case(spark, d):
    power = F.sum(F.col("station_charging_capacity").cast("decimal(12,2)"))
    return X.events(spark, d).groupBy(F.col("charging_use_case").alias("location")).agg(F.count(F.lit(1)).alias("charging_points"), F.sum("energy").cast("long").alias("energy"), power.cast("long").alias("installed_power"))


@query(with_sql("ev", "SELECT min(event_start) AS first_step, max(event_start + event_time) AS last_step, min(u) AS low, max(u) AS high FROM ev"))
def global_min_max(spark, d):
    return X.events(spark, d).agg(F.min("event_start").alias("first_step"), F.max(F.col("event_start") + F.col("event_time")).alias("last_step"), F.min("u").alias("low"), F.max("u").alias("high"))


@query(with_sql("ev", "SELECT count(*) FILTER (charging_use_case = 'home') AS home, count(*) FILTER (location IS NULL) AS unknown, count(*) AS total FROM ev"))
def filtered_counts(spark, d):
    return X.events(spark, d).agg(F.count_if(F.col("charging_use_case") == "home").alias("home"), F.count_if(F.col("location").isNull()).alias("unknown"), F.count(F.lit(1)).alias("total"))


@query(with_sql("ev", "SELECT \"Type\" AS kind, round(avg(CASE WHEN location = 'home' THEN 1.0 ELSE 0.0 END), 9) AS share_home, round(1 - avg(CASE WHEN location = 'home' THEN 1.0 ELSE 0.0 END), 9) AS share_other FROM ev WHERE charging_use_case = 'street' GROUP BY 1"))
def share_home_street(spark, d):
    at_home = F.avg(F.when(F.col("location") == "home", 1.0).otherwise(0.0))
    return X.events(spark, d).where("charging_use_case = 'street'").groupBy(F.col("Type").alias("kind")).agg(F.round(at_home, 9).alias("share_home"), F.round(1 - at_home, 9).alias("share_other"))


@query(with_sql("ev", "SELECT charging_use_case, cast(trunc(quantile_cont(event_time, 0.99)) AS int) AS p99 FROM ev GROUP BY 1"))
def p99_by_use_case(spark, d):
    return X.events(spark, d).groupBy("charging_use_case").agg(F.percentile("event_time", F.lit(0.99)).cast("int").alias("p99"))


_HOURLY = _STEPS + ", h AS (SELECT g.hour, " + ", ".join(f"count(*) FILTER (charging_use_case = '{u}') AS {u}" for u in USES) + " FROM (SELECT unnest(range(0, (SELECT (max(event_start + event_time) - 1) // 4 + 1 FROM ev))) AS hour) g LEFT JOIN st ON st.step = g.hour * 4 GROUP BY g.hour) "
_DAY = "(hour % 24 BETWEEN 8 AND 20)"


@query(with_sql("ev", _HOURLY + " UNION ALL ".join(f"SELECT '{u}' AS use_case, cast(trunc(quantile_cont({u}, 0.99)) AS int) AS p_all, cast(trunc(quantile_cont({u}, 0.99) FILTER (hour < 168 AND {_DAY})) AS int) AS p_day, cast(trunc(quantile_cont({u}, 0.99) FILTER (hour < 168 AND NOT {_DAY})) AS int) AS p_night FROM h" for u in USES)))
def p99_day_night(spark, d):
    """Over all hours up to the last with an active event."""
    e = X.events(spark, d)
    wide = intervals.wide_activity(e, "charging_use_case", USES, 0, intervals.last_step(e)).where(F.col("step") % 4 == 0)
    return intervals.day_night_percentile(wide, F.floor(F.col("step") / 4), USES)


@query(with_sql("lot", "SELECT idx, cast(weight AS double) / sum(weight) OVER () AS share FROM lot"))
def weight_share(spark, d):
    return relational.share(X.lots(spark, d).select("idx", "weight"), "weight", "share").select("idx", "share")


@query(with_sql("lot", "SELECT idx, CASE WHEN max(area) OVER () = min(area) OVER () THEN 1.0 ELSE cast(area - min(area) OVER () AS double) / (max(area) OVER () - min(area) OVER ()) END AS scaled, area < 100 AS small FROM lot"))
def minmax_flagged(spark, d):
    return relational.min_max(X.lots(spark, d), "area", "scaled").select("idx", F.col("scaled").cast("double").alias("scaled"), (F.col("area") < 100).alias("small"))


_SHUFFLED = ", o AS (SELECT event_id, energy, (event_id * 7919) % 1000003 AS place FROM ev WHERE \"Type\" = 'Commercial'), c AS (SELECT event_id, place, sum(energy) OVER (ORDER BY place, event_id) AS cum FROM o) "


@query(with_sql("ev", _SHUFFLED + "SELECT event_id, place FROM c WHERE cum <= (SELECT sum(energy) FROM o) * 1055 / 89373"))
def energy_prefix_to_target(spark, d):
    """A shuffle in a fixed order, then events while their energy stays within the smaller fleet's share."""
    e = X.events(spark, d).where("Type = 'Commercial'").select("event_id", "energy", ((F.col("event_id") * 7919) % 1000003).alias("place"))
    target = e.agg(F.sum("energy") * 1055 / 89373).first()[0]
    return relational.prefix_to_target(e, "energy", "place", F.lit(target or 0)).select("event_id", "place")


@query("SELECT concat(p_brand, ':', p_type) AS k, cast(max_by(p_size, p_partkey) AS double) AS w FROM part GROUP BY 1")
def weights_to_map(spark, d):
    """A map column for each first key; the last weight of a key wins."""
    last = X.table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.max_by("p_size", "p_partkey").cast("double").alias("w"))
    maps = last.groupBy("p_brand").agg(F.map_from_entries(F.collect_list(F.struct("p_type", "w"))).alias("m"))
    return maps.select("p_brand", F.explode("m").alias("t", "w")).select(F.concat_ws(":", "p_brand", "t").alias("k"), "w")


@query(with_sql("sta", "SELECT idx % 10 AS region, min(idx) AS location_id FROM sta WHERE charging_points > 1 GROUP BY 1"))
def first_free_site(spark, d):
    return X.stations(spark, d).where("charging_points > 1").groupBy((F.col("idx") % 10).alias("region")).agg(F.min_by("idx", "idx").alias("location_id"))


@query(with_sql("ev", "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_start, event_time DESC, event_id) AS turn FROM ev"))
def sorted_dispatch_order(spark, d):
    w = Window.partitionBy("user_id").orderBy("event_start", F.desc("event_time"), "event_id")
    return X.events(spark, d).select("event_id", "user_id", F.row_number().over(w).cast("long").alias("turn"))


_LIMIT = """, x AS (SELECT event_id, event_start AS st, event_time AS tm, CASE WHEN station_charging_capacity = 0 THEN 0 ELSE cast(energy AS double) / station_charging_capacity * 4 END AS lade, unnest(range(event_start // 96, (event_start + event_time - 1) // 96 + 1)) AS dd FROM ev),
 y AS (SELECT *, greatest(st, dd * 96) AS s, least(st + tm, dd * 96 + 96) AS e, dd * 96 + 9 AS w0, dd * 96 + 21 AS w1 FROM x),
 z AS (SELECT event_id, any_value(tm) AS tm, sum(CASE WHEN s >= w1 OR e <= w0 OR s >= w1 - 4 THEN cast(e - s AS double) ELSE greatest(0, w0 - s) + least(greatest(0, least(e, w1) - greatest(s, w0)), greatest(lade, 4)) + greatest(0, e - w1) END) AS allowed FROM y GROUP BY event_id) """


@query(with_sql("ev", _LIMIT + "SELECT event_id, cast(trunc(least(allowed, tm)) AS int) AS event_time, trunc(least(allowed, tm)) < tm AS wurde_begrenzt FROM z"))
def parking_limit(spark, d):
    return intervals.limit_parking(X.events(spark, d), 4, 9, 21).select("event_id", "event_time", "wurde_begrenzt")


@query(with_sql("sta", "SELECT idx, cast(concat('4', idx) AS bigint) AS hpc, cast(concat('6', idx) AS bigint) AS public, cast(concat('7', idx) AS bigint) AS depot FROM sta"))
def location_ids(spark, d):
    return X.stations(spark, d).select("idx", *[S.site_id(u, F.col("idx")).alias(u) for u in ("hpc", "public", "depot")])


@query("""SELECT p_partkey AS idx, replace(p_type, 'STANDARD', 'street') AS replaced, regexp_replace(concat(p_brand, '=', p_size), '=.*', '') AS cut, CASE WHEN length(p_name) > 2 THEN concat(substr(p_name, 1, 2), 'x', substr(p_name, 4)) ELSE p_name END AS third, replace(p_type, ' ', '_') AS blanks, concat(p_brand, '-', cast(p_size AS varchar)) AS joined FROM part""")
def string_cleanup(spark, d):
    p = X.table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("idx"), F.replace("p_type", F.lit("STANDARD"), F.lit("street")).alias("replaced"), S.before_equals(F.concat_ws("=", "p_brand", F.col("p_size").cast("string"))).alias("cut"), S.overwrite_third(F.col("p_name")).alias("third"), S.underscored(F.col("p_type")).alias("blanks"), F.concat_ws("-", "p_brand", F.col("p_size").cast("string")).alias("joined"))


@query("SELECT p_partkey AS idx, cast(round_even(p_size / 4.0, 0) AS bigint) AS even, cast(ceil(p_size / 4.0) AS bigint) AS up, cast(floor(p_size / 4.0) AS bigint) AS down, least(greatest(p_size, 10), 40) AS clamped, p_size // 7 AS days FROM part")
def round_half_even(spark, d):
    q = F.col("p_size") / 4
    return X.table(spark, d, "part").select(F.col("p_partkey").alias("idx"), F.bround(q, 0).cast("long").alias("even"), F.ceil(q).alias("up"), F.floor(q).alias("down"), F.least(F.greatest("p_size", F.lit(10)), F.lit(40)).alias("clamped"), F.floor(F.col("p_size") / 7).cast("int").alias("days"))


@query("SELECT p_partkey AS idx, try_cast(p_brand AS int) AS lenient, try_cast(cast(p_size AS varchar) AS int) AS size, cast(trunc(p_retailprice) AS bigint) AS cut FROM part")
def lenient_casts(spark, d):
    return X.table(spark, d, "part").select(F.col("p_partkey").alias("idx"), F.col("p_brand").try_cast("int").alias("lenient"), F.col("p_size").cast("string").try_cast("int").alias("size"), F.col("p_retailprice").cast("long").alias("cut"))


@query(with_sql("ev", "SELECT event_id, cast(trunc(u * 100 * 4 - 3) AS int) AS start_step, cast(trunc(u * 100 * 4) AS int) AS time_steps, CASE WHEN station_charging_capacity = 0 THEN NULL ELSE cast(energy AS double) / station_charging_capacity * 4 END AS charge, cast(energy AS double) / event_time AS power FROM ev"))
def hours_to_steps(spark, d):
    h, energy = F.col("u") * 100, F.col("energy").cast("double")
    return X.events(spark, d).select("event_id", S.hours_to_steps(h, -3).alias("start_step"), S.hours_to_steps(h).alias("time_steps"), S.charge_steps(energy, F.col("station_charging_capacity")).alias("charge"), S.average_power(energy, F.lit(0), F.col("event_time")).alias("power"))


@query(with_sql("ev", "SELECT event_id, strftime(TIMESTAMP '2024-01-01' + to_minutes(cast(15 * event_start AS bigint)), '%Y-%m-%dT%H:%M:%S') AS at FROM ev"))
def step_to_timestamp(spark, d):
    return X.events(spark, d).select("event_id", S.iso(S.step_to_timestamp(F.col("event_start"), X.BASE)).alias("at"))


@query(with_sql("ev", "SELECT event_id, concat(CASE isodow(t) " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(S.WEEKDAYS_DE, 1)) + " END, ' ', strftime(t, '%H:%M')) AS label FROM (SELECT event_id, TIMESTAMP '2024-01-01' + to_hours(cast(event_start // 4 - 2 AS bigint)) AS t FROM ev) x"))
def weekday_label_de(spark, d):
    hour = F.timestamp_add("HOUR", (F.floor(F.col("event_start") / 4) - 2).cast("int"), F.lit(X.BASE).cast("timestamp_ntz"))
    return X.events(spark, d).select("event_id", S.weekday_de(hour).alias("label"))


@query("SELECT event_id, cast(count(*) AS bigint) AS quarters, min(q) AS first, max(q) AS last FROM (SELECT event_id, unnest(generate_series(time_bucket(INTERVAL 15 MINUTES, ts), time_bucket(INTERVAL 15 MINUTES, ts + INTERVAL 100 MINUTES) + CASE WHEN time_bucket(INTERVAL 15 MINUTES, ts + INTERVAL 100 MINUTES) < ts + INTERVAL 100 MINUTES THEN INTERVAL 15 MINUTES ELSE INTERVAL 0 MINUTES END, INTERVAL 15 MINUTES)) AS q FROM events) t GROUP BY event_id")
def quarter_hour_grid(spark, d):
    g = S.quarter_grid(F.col("ts"), F.col("ts") + F.expr("INTERVAL 100 MINUTES"))
    return X.table(spark, d, "events").select("event_id", g.alias("g")).select("event_id", F.size("g").cast("long").alias("quarters"), F.element_at("g", 1).alias("first"), F.element_at("g", -1).alias("last"))


@query(with_sql("sta", """SELECT idx, concat('{"type":"Feature","geometry":{"type":"Point","coordinates":[', idx, ',', charging_points, ']},"properties":{"times":["', strftime(TIMESTAMP '2024-01-01' + to_minutes(15 * idx), '%Y-%m-%dT%H:%M:%S'), '"],"popup":"site ', idx, '"}}') AS feature FROM sta"""))
def geojson_features(spark, d):
    geometry = F.struct(F.lit("Point").alias("type"), F.array(F.col("idx"), F.col("charging_points").cast("long")).alias("coordinates"))
    properties = F.struct(F.array(S.iso(S.step_to_timestamp(F.col("idx").cast("int"), X.BASE))).alias("times"), F.concat(F.lit("site "), F.col("idx").cast("string")).alias("popup"))
    return X.stations(spark, d).select("idx", F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties"))).alias("feature"))


@query(with_sql("ev", "SELECT DISTINCT charging_use_case, \"Type\" AS kind FROM ev"))
def distinct_values(spark, d):
    return X.events(spark, d).select("charging_use_case", F.col("Type").alias("kind")).distinct()


@query(with_sql("ev", "SELECT event_id, CASE WHEN charging_use_case = 'retail' THEN 0 ELSE 1 END AS turn FROM ev WHERE charging_use_case = 'retail' OR (charging_use_case = 'urban_fast' AND location = 'shopping')"))
def retail_slow_and_fast(spark, d):
    return usecases.retail_events(X.events(spark, d)).select("event_id", "turn")


@query(with_sql("sta lot", "SELECT idx, x, y, 'street' AS mode FROM sta UNION ALL SELECT idx, x, y, 'home_street' FROM lot"))
def union_sites_tagged(spark, d):
    tag = lambda df, m: df.select("idx", "x", "y", F.lit(m).alias("mode"))
    return tag(X.stations(spark, d), "street").unionByName(tag(X.lots(spark, d), "home_street"))


@query(with_sql("ev", "SELECT event_id FROM ev WHERE charging_use_case = 'street' EXCEPT SELECT event_id FROM ev WHERE station_charging_capacity > 20"))
def difference(spark, d):
    e = X.events(spark, d)
    return e.where("charging_use_case = 'street'").select("event_id").join(e.where("station_charging_capacity > 20").select("event_id"), "event_id", "left_anti")


@query(with_sql("ev", "SELECT event_id % 97 AS location_id, cast(floor(avg(station_charging_capacity)) AS bigint) AS capacity, count(*) AS points, max(event_id) AS last_event FROM ev WHERE charging_use_case = 'depot' GROUP BY 1"))
def mean_capacity_per_site(spark, d):
    return X.events(spark, d).where("charging_use_case = 'depot'").groupBy((F.col("event_id") % 97).alias("location_id")).agg(F.floor(F.avg("station_charging_capacity")).alias("capacity"), F.count(F.lit(1)).alias("points"), F.max("event_id").alias("last_event"))


@query(with_sql("bld", "SELECT idx, row_number() OVER (ORDER BY idx) - 1 AS position FROM bld WHERE households_total > 2"))
def dense_positions(spark, d):
    return relational.dense_index(X.buildings(spark, d).where("households_total > 2").select("idx"), "idx", "position")


@query(with_sql("ev", "SELECT event_id, (event_id % 7 = 0) AS flagged, CASE WHEN event_id % 7 = 0 THEN 'x' ELSE charging_use_case END AS kind, event_start + event_time AS event_end FROM ev"))
def computed_and_overwritten(spark, d):
    flag = F.col("event_id") % 7 == 0
    return X.events(spark, d).select("event_id", flag.alias("flagged"), F.when(flag, "x").otherwise(F.col("charging_use_case")).alias("kind"), (F.col("event_start") + F.col("event_time")).alias("event_end"))
