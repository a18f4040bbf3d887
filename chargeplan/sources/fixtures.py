"""The engine's inputs derived from the driver's tables, the same in any SQL engine (FIXTURES.md, part B)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chargeplan.functions.scalars import uniform

BASE = "2024-01-01 00:00:00"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _case(key: Column, values: list) -> Column:
    out = F.lit(None)
    for i, v in enumerate(values):
        out = F.when(key == i, F.lit(v)).otherwise(out)
    return out


def events(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "events")
    i, user = F.col("event_id"), F.col("user_id")
    use_case = (
        F.when(F.col("event_type") == "view", "street").when(F.col("event_type") == "click", "home").when(F.col("event_type") == "purchase", "retail")
        .when(F.col("event_type") == "error", "urban_fast").when(i % 2 == 0, "work").otherwise("depot")
    )
    k = F.get_json_object("props", "$.k").cast("int")
    return t.select(
        (i + 1).alias("event_id"),
        F.expr(f"cast(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{BASE}', ts) div 900000000 as int)").alias("event_start"),
        (1 + (i * 7919) % 48).cast("int").alias("event_time"),
        F.col("value").cast("decimal(12,2)").alias("energy"),
        _case(i % 6, [3.7, 11.0, 22.0, 50.0, 150.0, 0.0]).alias("station_charging_capacity"),
        use_case.alias("charging_use_case"),
        F.when(user % 2 == 1, None).otherwise(_case(k % 3, ["home", "shopping", "work"])).alias("location"),
        F.when(user % 2 == 1, "Commercial").otherwise("Private").alias("Type"),
        uniform(i + 1).alias("u"),
        user.alias("user_id"),
    )


def _xy(key: Column, a: int) -> list[Column]:
    return [F.round(4540000 + 20000 * uniform(key + a), 3).alias("x"), F.round(3270000 + 20000 * uniform(key + 1000002 + a), 3).alias("y")]


def buildings(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.alias("idx"), (1 + k % 7).cast("int").alias("households_total"), F.when(k % 5 == 0, "1.5").otherwise("0").alias("cts_demand"), *_xy(k, 1))


def stations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(k.alias("idx"), (1 + k % 3).cast("int").alias("charging_points"), *_xy(k, 17))


def lots(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, d, "part").select(k.alias("idx"), (F.col("p_size") * 10).alias("area"), F.col("p_size").alias("weight"), *_xy(k, 29))


def lines(spark: SparkSession, d: str) -> DataFrame:
    """Two points each: (line_id, dtvw_kfz, ax, ay, zx, zy, line)."""
    k = F.col("n_nationkey").cast("long")
    ends = [F.round(base + 20000 * uniform(k + off), 3).alias(n) for n, base, off in (("ax", 4540000, 41), ("ay", 3270000, 43), ("zx", 4540000, 47), ("zy", 3270000, 53))]
    t = table(spark, d, "nation").select(k.alias("line_id"), (1000 * (1 + k)).alias("dtvw_kfz"), *ends)
    return t.withColumn("line", F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("zx").alias("x"), F.col("zy").alias("y"))))


def parcels(spark: SparkSession, d: str) -> DataFrame:
    """Axis-aligned rectangles: (lot_id, x0, y0, x1, y1, ring)."""
    k = F.col("n_nationkey").cast("long")
    x0, y0 = F.round(4539700 + 20000 * uniform(k + 29), 3), F.round(3269700 + 20000 * uniform(k + 1000031), 3)
    t = table(spark, d, "nation").select(k.alias("lot_id"), x0.alias("x0"), y0.alias("y0"), F.round(x0 + 100 + 1500 * uniform(k + 71), 3).alias("x1"), F.round(y0 + 100 + 1500 * uniform(k + 73), 3).alias("y1"))
    corner = lambda a, b: F.struct(F.col(a).alias("x"), F.col(b).alias("y"))
    return t.withColumn("ring", F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1")))


#: The same as SQL, a WITH list for the oracles.
U = "(cast((({k})*2654435761) % 4294967296 as double) / cast(4294967296 as double))"


def _u(k: str) -> str:
    return U.format(k=k)


def _sxy(k: str, a: int) -> str:
    return f"round(4540000 + 20000 * {_u(f'{k} + {a}')}, 3) AS x, round(3270000 + 20000 * {_u(f'{k} + {1000002 + a}')}, 3) AS y"


SQL = {
    "ev": f"""ev AS (SELECT event_id + 1 AS event_id, cast((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 900000000 AS int) AS event_start,
      cast(1 + (event_id * 7919) % 48 AS int) AS event_time, cast(value AS decimal(12,2)) AS energy,
      cast(CASE event_id % 6 WHEN 0 THEN 3.7 WHEN 1 THEN 11 WHEN 2 THEN 22 WHEN 3 THEN 50 WHEN 4 THEN 150 ELSE 0 END AS double) AS station_charging_capacity,
      CASE event_type WHEN 'view' THEN 'street' WHEN 'click' THEN 'home' WHEN 'purchase' THEN 'retail' WHEN 'error' THEN 'urban_fast' ELSE CASE WHEN event_id % 2 = 0 THEN 'work' ELSE 'depot' END END AS charging_use_case,
      CASE WHEN user_id % 2 = 1 THEN NULL ELSE CASE cast(json_extract_string(props, '$.k') AS int) % 3 WHEN 0 THEN 'home' WHEN 1 THEN 'shopping' WHEN 2 THEN 'work' END END AS location,
      CASE WHEN user_id % 2 = 1 THEN 'Commercial' ELSE 'Private' END AS "Type", {_u('event_id + 1')} AS u, user_id FROM events)""",
    "bld": f"bld AS (SELECT c_custkey AS idx, cast(1 + c_custkey % 7 AS int) AS households_total, CASE WHEN c_custkey % 5 = 0 THEN '1.5' ELSE '0' END AS cts_demand, {_sxy('c_custkey', 1)} FROM customer)",
    "sta": f"sta AS (SELECT s_suppkey AS idx, cast(1 + s_suppkey % 3 AS int) AS charging_points, {_sxy('s_suppkey', 17)} FROM supplier)",
    "lot": f"lot AS (SELECT p_partkey AS idx, p_size * 10 AS area, p_size AS weight, {_sxy('p_partkey', 29)} FROM part)",
    "lin": "lin AS (SELECT cast(n_nationkey AS bigint) AS line_id, cast(1000 * (1 + n_nationkey) AS bigint) AS dtvw_kfz, "
    + ", ".join(f"round({base} + 20000 * {_u(f'cast(n_nationkey AS bigint) + {off}')}, 3) AS {n}" for n, base, off in (("ax", 4540000, 41), ("ay", 3270000, 43), ("zx", 4540000, 47), ("zy", 3270000, 53)))
    + " FROM nation)",
    "par": f"""par0 AS (SELECT cast(n_nationkey AS bigint) AS lot_id, round(4539700 + 20000 * {_u('cast(n_nationkey AS bigint) + 29')}, 3) AS x0, round(3269700 + 20000 * {_u('cast(n_nationkey AS bigint) + 1000031')}, 3) AS y0 FROM nation),
      par AS (SELECT *, round(x0 + 100 + 1500 * {_u('lot_id + 71')}, 3) AS x1, round(y0 + 100 + 1500 * {_u('lot_id + 73')}, 3) AS y1 FROM par0)""",
}


def with_sql(names: str, body: str) -> str:
    """A query over the fixtures named, e.g. "ev bld"."""
    return "WITH " + ",\n".join(SQL[n] for n in names.split()) + "\n" + body
