"""Run a scenario: python -m chargeplan.cli SCENARIO --config_file FILE (--tables FOLDER | --raw FOLDER) --results FOLDER.

--tables: Parquet folders, events and one for each site layer, as the sources and operators of this package make them.
--raw: the folder below which the files of the configuration's data section lie: Parquet events, GeoPackage layers, CSV profiles.
Decomposition of hourly counts: python -m chargeplan.cli decompose --counts FILE --results FOLDER.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from chargeplan.config import ScenarioConfig, load_config, result_folder
from chargeplan.plans.usecases import run_scenario, summary
from chargeplan.sources.files import csv, hour_counts, save, save_summary, save_timelines
from chargeplan.sources.gpkg import read_gpkg

LAYERS = ("home_apartment", "home_detached", "home_street", "work", "office", "hpc", "retail", "public", "depot", "network_sites", "network_events")
NOT_LAYERS = ("charging_events_private", "charging_events_commercial", "additional_input_public_locations")


def ready(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    return spark.read.parquet(f"{folder}/events"), {x: spark.read.parquet(f"{folder}/{x}") for x in LAYERS if os.path.exists(f"{folder}/{x}")}


def raw(spark: SparkSession, cfg: ScenarioConfig, folder: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Events and layers from the files that the configuration names; latin1: the layers of fast charging."""
    from chargeplan.plans.assembly import event_table, site_layers

    tables = {}
    for name, file in cfg.inputs.items():
        path = f"{folder}/{file}"
        if name in NOT_LAYERS or not os.path.exists(path):
            continue
        if path.endswith(".csv"):
            tables[name] = csv(spark, path)
        elif path.endswith(".gpkg"):
            tables[name] = read_gpkg(spark, path, **({"encoding": "latin1"} if name.startswith("hpc") else {}))
        else:
            tables[name] = spark.read.parquet(path)
    events = event_table(spark, f"{folder}/{cfg.inputs['charging_events_private']}", f"{folder}/{cfg.inputs['charging_events_commercial']}")
    keys = {name: next(c for c in ("id", "fid", "location_id", t.columns[0]) if c in t.columns) for name, t in tables.items()}
    return events, site_layers(cfg, tables, keys)


def decompose(given) -> str:
    from chargeplan.plans.allocation_queries import PPC_MEANS
    from chargeplan.plans.assembly import decomposed_steps

    spark = SparkSession.builder.appName("chargeplan decompose").getOrCreate()
    events = decomposed_steps(hour_counts(spark, given.counts), PPC_MEANS, given.seed)
    base = save(events, given.results, "commercial", "charging-events", "decomposed")
    from chargeplan.operators.intervals import activity

    save_timelines(activity(spark.read.parquet(f"{base}.parquet"), ["use_case"]), f"{given.results}/timelines")
    return base


def main(args: list[str] | None = None) -> str:
    parser = argparse.ArgumentParser(description="Allocation of charging infrastructure")
    parser.add_argument("scenario", help="a scenario's name, or decompose")
    parser.add_argument("--config_file")
    parser.add_argument("--tables")
    parser.add_argument("--raw")
    parser.add_argument("--counts")
    parser.add_argument("--seed", type=int, default=1)
    parser.add_argument("--results", default="results")
    given = parser.parse_args(args)
    if given.scenario == "decompose" and given.counts:
        return decompose(given)
    if not given.config_file or bool(given.tables) == bool(given.raw):
        parser.error("--config_file and one of --tables and --raw are needed")
    cfg = load_config(given.config_file, given.scenario)
    spark = SparkSession.builder.appName(f"chargeplan {given.scenario}").getOrCreate()
    events, sites = ready(spark, given.tables) if given.tables else raw(spark, cfg, given.raw)
    out = run_scenario(cfg, events, sites)
    folder = str(result_folder(given.results, cfg.scenario))
    for name, located in out.items():
        save(located.sites, folder, name, "charging-locations", cfg.scenario)
        save(located.events, folder, name, "charging-events", cfg.scenario)
    save_summary(summary(out), folder, cfg.metadata())
    return folder


if __name__ == "__main__":
    main()
