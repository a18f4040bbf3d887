"""Plain files: Parquet folders, CSV variants, spreadsheets; and the sinks of a run."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chargeplan import schema
from chargeplan.functions.scalars import car_type, differs, underscored
from chargeplan.sources.gpkg import write_gpkg


def private_events(spark: SparkSession, folder: str, *more: Column) -> DataFrame:
    """All Parquet files of a folder as one table, with the car type from each file's path. more: of a file's metadata, for instance."""
    df = spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", "true").parquet(folder)
    return df.select("*", car_type(F.col("_metadata.file_path")).alias("car_type"), *more)


def commercial_events(spark: SparkSession, path: str, *more: Column) -> DataFrame:
    return spark.read.parquet(path).select("*", *more)


def csv(spark: SparkSession, path: str, ddl: str | None = None, sep: str = ",") -> DataFrame:
    reader = spark.read.option("header", "true").option("sep", sep)
    return (reader.schema(ddl) if ddl else reader.option("inferSchema", "true")).csv(path)


def hour_counts(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """First column is the row index."""
    return csv(spark, path, schema.HOUR_COUNTS, sep)


def potentials(spark: SparkSession, path: str) -> DataFrame:
    """The regional key stays a string: leading zeros count."""
    return csv(spark, path, schema.POTENTIAL)


def compact_csv(spark: SparkSession, folder: str, target: str) -> int:
    """CSV files of a folder to a few Parquet files without rows of no capacity; rows written, 0 for a missing folder."""
    if not os.path.isdir(folder):
        print(f"folder {folder} not found")
        return 0
    df = csv(spark, f"{folder}/*.csv").where(differs(F.col("station_charging_capacity"), 0))
    df.repartition(max(1, df.sparkSession.sparkContext.defaultParallelism // 8)).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target).count()


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A small spreadsheet through pandas where it has an engine for it; a CSV of the same name otherwise."""
    import pandas as pd

    if os.path.exists(path):
        try:
            return spark.createDataFrame(pd.read_excel(path, dtype=str))
        except ImportError:
            pass
    return csv(spark, str(Path(path).with_suffix(".csv")))


def write_sheet(df: DataFrame, path: str, bound: int = 1_000_000) -> str:
    """A small table as a spreadsheet where pandas has an engine for it, else as a CSV of the same name; over bound rows are refused."""
    rows = df.limit(bound + 1).toPandas()
    if len(rows) > bound:
        raise ValueError(f"more than {bound} rows do not fit a sheet")
    try:
        rows.to_excel(path, index=False)
    except ImportError:
        path = str(Path(path).with_suffix(".csv"))
        rows.to_csv(path, index=False)
    return path


def save(df: DataFrame, folder: str, use_case: str, name: str, scenario: str, geopackage: bool = True, srs: int = 3035) -> str:
    """CSV with a header, Parquet and, of rows with a place, a GeoPackage beside them; nested columns only in the latter two.

    A place is a column geometry, or x and y. A GeoPackage is one file with one writer, to which rows are streamed.
    """
    base = f"{folder}/output_{use_case}_{name}_{scenario}"
    flat = [c for c, kind in df.dtypes if not kind.startswith(("struct", "array", "map"))]
    df.select(*flat).write.mode("overwrite").option("header", "true").csv(f"{base}.csv")
    df.write.mode("overwrite").parquet(f"{base}.parquet")
    if geopackage and ("geometry" in df.columns or {"x", "y"} <= set(df.columns)):
        kept = df.sparkSession.read.parquet(f"{base}.parquet")
        if "geometry" not in df.columns:
            point = F.struct(F.lit("Point").alias("type"), F.array(F.array(F.struct("x", "y"))).alias("points"), F.lit(srs).alias("srs"))
            kept = kept.withColumn("geometry", F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), point))
        write_gpkg(kept.select("geometry", *[c for c in flat if c not in ("x", "y", "geometry")]), f"{base}.gpkg", f"{use_case}_{name}", srs=srs)
    return base


def save_feature_collection(features: DataFrame, path: str, column: str = "feature") -> int:
    """GeoJSON features, one text a row, as one FeatureCollection; rows are streamed to the one file. Returns their number."""
    n = 0
    with open(path, "w", encoding="utf-8") as out:
        out.write('{"type":"FeatureCollection","features":[')
        for row in features.select(column).where(F.col(column).isNotNull()).toLocalIterator(prefetchPartitions=True):
            out.write(",\n" * (n > 0) + row[0])
            n += 1
        out.write("]}")
    return n


def save_timelines(long: DataFrame, folder: str, by: str = "use_case") -> None:
    """A CSV folder for each use case, blanks of its name as underscores."""
    long.withColumn(by, underscored(F.col(by))).repartition(by).write.mode("overwrite").partitionBy(by).option("header", "true").csv(folder)


def save_summary(kpis: DataFrame, folder: str, metadata: dict) -> None:
    kpis.select(*schema.KPI).coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{folder}/result_summary.csv")
    os.makedirs(folder, exist_ok=True)
    Path(folder, "metadata.json").write_text(json.dumps(metadata))
