"""Fixed schemas of events, sites and results."""

PRIVATE_EVENT = "event_start int, event_time int, energy double, station_charging_capacity double, charging_use_case string, location string, soc_start double, soc_end double, average_charging_power double"
COMMERCIAL_EVENT = "event_start int, event_time int, charge_end int, event_end_parking int, ppc_id int, station_charging_capacity double, energy double, average_charging_power double, use_case string"
LOCATED_EVENT = ["event_id", "charging_use_case", "car_type", "event_start", "event_time", "energy", "soc_start", "soc_end", "station_charging_capacity", "location_id", "geometry"]
SITE = ["location_id", "charging_points", "average_charging_capacity", "geometry"]
KPI = ["location", "charging_points", "energy", "installed_power"]
HOUR_COUNTS = "row_idx int, ppc_id int, weekhour int, charging_vehicles int"
DEMAND_PROFILE = "building_id long, households_total double"
POTENTIAL = "AGS string, potential double"
