"""Scenario configuration: INI file to a frozen, validated dataclass."""

from __future__ import annotations

import configparser
from dataclasses import dataclass, field, fields
from datetime import datetime
from pathlib import Path

USE_CASES = ("home", "work", "hpc", "retail", "public", "depot")


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class ScenarioConfig:
    scenario: str = "default"
    run: tuple[str, ...] = ()
    inputs: dict = field(default_factory=dict)
    random_seed: int = 1
    simulation_steps: int = 2000
    plots: bool = False
    multi_use_concept: bool = False
    flexibility_multi_use: int = 0
    multi_use_group: tuple[str, ...] = ("Private", "Commercial")
    use_case_multi_use: str = "retail"
    share_office_parking: float = 0.4
    share_home_detached: float = 0.13
    share_home_apartment: float = 0.87
    charging_time_limit: bool = False
    charging_time_limit_duration: int = 4
    charging_time_limit_start: int = 9
    charging_time_limit_end: int = 21
    limit_unit: str = "steps"  # the limits are given in hours but used as steps; "hours" multiplies by four
    additional_input_public_locations: bool = False

    def __post_init__(self):
        if bad := set(self.run) - set(USE_CASES):
            raise ConfigError(f"unknown use cases: {sorted(bad)}")
        if self.multi_use_concept and self.use_case_multi_use not in ("retail", "work"):
            raise ConfigError("use_case_multi_use is retail or work")
        if self.multi_use_concept and "public" in self.run and self.use_case_multi_use not in self.run:
            raise ConfigError(f"multi-use needs {self.use_case_multi_use}, which leaves events for public")
        if bad := set(self.multi_use_group) - {"Private", "Commercial"}:
            raise ConfigError(f"unknown multi-use groups: {sorted(bad)}")
        if abs(self.share_home_detached + self.share_home_apartment - 1) > 1e-9:
            raise ConfigError("home shares must add up to 1")
        if self.limit_unit not in ("steps", "hours"):
            raise ConfigError("limit_unit is steps or hours")

    def metadata(self) -> dict:
        """What a run leaves in metadata.json."""
        return {
            "charge_events_private_path": self.inputs.get("charging_events_private"),
            "charge_events_commercial_path": self.inputs.get("charging_events_commercial"),
            "multi_use_concept": self.multi_use_concept,
            "flexibility_multi_use": self.flexibility_multi_use,
            "multi_use_group": list(self.multi_use_group),
            "charging_time_limit": self.charging_time_limit,
            "charging_time_limit_duration": self.charging_time_limit_duration,
            "charging_time_limit_start": self.charging_time_limit_start,
            "charging_time_limit_end": self.charging_time_limit_end,
        }


_RENAMED = {"simulations_time_steps": "simulation_steps"}


def load_config(path: str, scenario: str = "default") -> ScenarioConfig:
    """Sections data, basic, use_cases and uc_params; values take the type of the field, unknown keys are left alone."""
    parser = configparser.ConfigParser()
    if not parser.read(path, encoding="utf-8"):
        raise FileNotFoundError(f"config file {path} not found")
    kinds = {f.name: f.default for f in fields(ScenarioConfig)}
    values: dict = {"scenario": scenario, "inputs": dict(parser["data"]) if parser.has_section("data") else {}}
    if parser.has_section("use_cases"):
        values["run"] = tuple(u for u in USE_CASES if parser["use_cases"].getboolean(u, fallback=False))
    for section in parser.sections():
        for key in parser[section]:
            name = _RENAMED.get(key, key)
            if name not in kinds or name in ("scenario", "run", "inputs"):
                continue
            default, cell = kinds[name], parser[section]
            if isinstance(default, bool):
                values[name] = cell.getboolean(key)
            elif isinstance(default, int):
                values[name] = cell.getint(key)
            elif isinstance(default, float):
                values[name] = cell.getfloat(key)
            elif isinstance(default, tuple):
                values[name] = tuple(cell[key].split(", "))
            else:
                values[name] = cell[key]
    return ScenarioConfig(**values)


def result_folder(base: str, scenario: str, now: datetime | None = None) -> Path:
    return Path(base) / f"{scenario}_{(now or datetime.now()).strftime('%y-%m-%d_%H%M%S')}"
