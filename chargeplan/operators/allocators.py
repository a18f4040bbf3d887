"""Order-dependent allocators as grouped kernels: one group is one independent allocation, groups run in parallel.

The order within a group decides results, so each kernel sorts by an explicit key. Occupancy is kept for opened sites only
(a site without a point can never be free): memory is opened sites x steps x 2 bytes.
"""

from __future__ import annotations

import bisect
import heapq
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargeplan.functions.scalars import uniform
from chargeplan.operators.relational import checkpointed


_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


class Occupancy:
    """Occupied points per step of opened sites, a row each in the order of opening.

    For the search, sites stand in order of position in blocks of at most 63, and a word of bits tells for each block and step
    which of its sites are full (unused bits are set). So a window costs one OR over its steps, 64 sites at a time.
    """

    def __init__(self, steps: int):
        self.steps, self.sites = steps, []
        self.mask, self.points = np.zeros((16, steps), np.int16), np.zeros(16, np.int64)
        self._row: dict[int, int] = {}
        self._word: dict[int, int] = {}  # of a site
        self._blocks: list[list[int]] = [[]]  # sites of a word
        self._order, self._firsts = np.zeros(1, np.int64), [-1]  # words in order of position, and their least positions
        self._full = np.full((steps, 4), _ALL, np.uint64)
        self._single = np.zeros(4, np.uint64)  # bits of the sites with one point

    def row(self, site: int) -> int:
        """Row of a site, opened if needed."""
        row = self._row.get(site)
        if row is None:
            row = self._row[site] = len(self.sites)
            if row == len(self.mask):
                self.mask = np.concatenate((self.mask, np.zeros_like(self.mask)))
                self.points = np.concatenate((self.points, np.zeros_like(self.points)))
            self.sites.append(site)
            self._insert(site)
        return row

    def _insert(self, site: int) -> None:
        k = max(0, bisect.bisect_right(self._firsts, site) - 1)
        w = self._word[site] = int(self._order[k])
        block = self._blocks[w]
        at = bisect.bisect_left(block, site)
        block.insert(at, site)
        column, low = self._full[:, w], np.uint64((1 << at) - 1)
        column = (column & low) | ((column & ~low) << np.uint64(1)) | np.uint64(1 << at)
        single = self._single[w]
        self._single[w] = single = (single & low) | ((single & ~low) << np.uint64(1))
        if len(block) < 64:
            self._full[:, w] = column
            return
        new = len(self._blocks)
        if new == self._full.shape[1]:
            self._full = np.concatenate((self._full, np.full_like(self._full, _ALL)), axis=1)
            self._single = np.concatenate((self._single, np.zeros_like(self._single)))
        half, upper = np.uint64(32), np.uint64(0xFFFFFFFF00000000)
        self._full[:, w], self._full[:, new] = column | upper, (column >> half) | upper
        self._single[w], self._single[new] = single & ~upper, single >> half
        self._blocks[w], right = block[:32], block[32:]
        self._blocks.append(right)
        self._word.update(dict.fromkeys(right, new))
        self._order = np.insert(self._order, k + 1, new)
        self._firsts.insert(k + 1, right[0])

    def refresh(self, row: int, start: int = 0, end: int | None = None) -> None:
        """Read the bits of a row anew, after its points or its steps were changed."""
        end, site = self.steps if end is None else end, self.sites[row]
        w = self._word[site]
        bit = np.uint64(1 << bisect.bisect_left(self._blocks[w], site))
        column = self._full[start:end, w]
        self._single[w] = self._single[w] | bit if self.points[row] == 1 else self._single[w] & ~bit
        self._full[start:end, w] = np.where(self.mask[row, start:end] >= self.points[row], column | bit, column & ~bit)

    def add_point(self, row: int) -> None:
        self.points[row] += 1
        if self.points[row] > np.iinfo(self.mask.dtype).max:
            self.mask = self.mask.astype(np.int32)
        self.refresh(row)

    def occupy(self, row: int, start: int, end: int) -> None:
        """One more event at a row that has room over [start, end)."""
        window = self.mask[row, start:end]
        window += 1
        site = self.sites[row]
        w = self._word[site]
        bit = np.uint64(1 << bisect.bisect_left(self._blocks[w], site))
        n = self.points[row]
        self._full[start:end, w] |= bit if n == 1 else (window >= n) * bit

    def first_free(self, start: int, end: int, summed: bool = False) -> int | None:
        """Row of the lowest position with a free point over [start, end). summed: the window's sum has to be below the points."""
        full = np.bitwise_or.reduce(self._full[start:end, : len(self._blocks)], axis=0)[self._order]
        some = full != _ALL
        k = int(some.argmax())
        if not some[k]:
            return None
        if not summed:
            v = ~int(full[k]) & int(_ALL)
            return self._row[self._blocks[int(self._order[k])][(v & -v).bit_length() - 1]]
        one = ~full & self._single[self._order]
        k = int((one != 0).argmax())  # with a single point, not full is empty; sites of more points before the first such are summed
        lone = None
        if one[k]:
            v = int(one[k])
            lone = self._blocks[int(self._order[k])][(v & -v).bit_length() - 1]
        end_of = k + 1 if lone is not None else len(full)
        more, rows = ~full[:end_of] & ~self._single[self._order[:end_of]], []
        for k in np.flatnonzero(more).tolist():
            block, v = self._blocks[int(self._order[k])], int(more[k])
            while v:
                rows.append(self._row[block[(v & -v).bit_length() - 1]])
                v &= v - 1
        if rows:
            room = self.mask[rows, start:end].sum(1, dtype=np.int64) < self.points[rows]
            first = int(room.argmax())
            if room[first] and (lone is None or self.sites[rows[first]] < lone):
                return rows[first]
        return None if lone is None else self._row[lone]


def _check(start: int, end: int, steps: int) -> None:
    if start >= end or start >= steps or start < 0:
        raise ValueError(f"empty charging interval [{start}, {end}) on a horizon of {steps} steps")


def allocate_shared(events: pd.DataFrame, weights: np.ndarray, steps: int, share: bool = True, seed: int = 1, offset: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, Occupancy]:
    """(position of each event, points, truncated mean capacity, occupancy) for events in row order.

    With share, the lowest free opened position takes the event; else, or if none is free, a site is drawn by weight and gets
    one point more. An event draws by its own number in column u; without that column draws come from one seeded stream, used on
    misses only.
    """
    rng, cdf = np.random.default_rng(seed), np.cumsum(weights) / weights.sum()
    cdf /= cdf[-1]
    draws = events["u"].to_numpy(float) if "u" in events.columns else None
    occupied, mean = Occupancy(steps), {}
    placed = np.empty(len(events), np.int64)
    for i, (start, time, capacity) in enumerate(zip(*(events[c].tolist() for c in ("event_start", "event_time", "station_charging_capacity")), strict=True)):
        start, end = int(start), min(int(start) + int(time), steps)
        _check(start, end, steps)
        row = occupied.first_free(start, end) if share and occupied.sites else None
        if row is None:
            site = int(np.searchsorted(cdf, rng.random() if draws is None else draws[i], "right"))
            row = occupied.row(site)
            n = occupied.points[row]
            mean[site] = (mean.get(site, 0.0) * n + capacity) / (n + 1)
            occupied.add_point(row)
        occupied.occupy(row, start, end)
        placed[i] = occupied.sites[row]
    points, capacity = np.zeros(len(weights), np.int64), np.zeros(len(weights), np.int64)
    for row, site in enumerate(occupied.sites):
        points[site], capacity[site] = occupied.points[row], int(mean[site])
    return placed + offset, points, capacity, occupied


def place_on_existing(events: pd.DataFrame, occupied: Occupancy, shift: int = 0, summed: bool = True, offset: int = 0) -> pd.DataFrame:
    """Events in row order on idle points of an occupancy, each started up to shift steps later; no point is added.

    A later start shortens the stay, but not below the charge. summed: free means that the window's *sum* is below the points.
    Adds assigned_location, null if there is no room, and overwrites event_start and event_time of placed events.
    """
    out = events.copy()
    assigned = pd.array([None] * len(out), dtype="Int64")
    starts, times = out["event_start"].to_numpy().copy(), out["event_time"].to_numpy().copy()
    for row in range(len(occupied.sites)):
        occupied.refresh(row)
    for i, (energy, capacity) in enumerate(zip(out["energy"].tolist(), out["station_charging_capacity"].tolist(), strict=True)):
        need = energy / capacity * 4 if capacity else 0.0
        base, begin = int(times[i]), int(starts[i])
        tries = []
        for s in range(shift + 1):
            start, time = begin + s, base - s
            if time < need:
                time = min(int(np.ceil(need)), base)
            if time > 0 and start + time <= occupied.steps:
                tries.append((start, time))
        if len(tries) > 1:  # a point that is taken in what all windows share is taken in each of them
            a, b = max(s for s, _ in tries), min(s + t for s, t in tries)
            if a < b and occupied.first_free(a, b, summed) is None:
                continue
        for start, time in tries:
            row = occupied.first_free(start, start + time, summed)
            if row is not None:
                occupied.occupy(row, start, start + time)
                assigned[i], starts[i], times[i] = occupied.sites[row] + offset, start, time
                break
    out["event_start"], out["event_time"], out["assigned_location"] = starts, times, assigned
    return out


def least_loaded(events: pd.DataFrame, capacity: dict[int, int]) -> pd.DataFrame:
    """Events on an existing network, by (start, longest first, id): the own site if free, else the least loaded, else unserved.

    Ends at or before a start are released first. Adds assigned_location_id, was_reassigned and unserved.
    """
    out = events.sort_values(["event_start", "event_time", "event_id"], ascending=[True, False, True], kind="stable").copy()
    load, ends, heap = dict.fromkeys(capacity, 0), [], [(0, s) for s in sorted(capacity)]
    assigned, moved, lost = [], [], []
    for start, time, own in zip(out["event_start"], out["event_time"], out["location_id"], strict=True):
        while ends and ends[0][0] <= start:
            _, s = heapq.heappop(ends)
            load[s] -= 1
            heapq.heappush(heap, (load[s], s))
        site = int(own) if own in capacity and load[int(own)] < capacity[int(own)] else None
        held = []
        while site is None and heap:
            n, s = heapq.heappop(heap)
            if n != load[s]:
                continue  # an old entry
            if n < capacity[s]:
                site = s
            held.append((n, s))
        for entry in held:
            heapq.heappush(heap, entry)
        if site is not None:
            load[site] += 1
            heapq.heappush(heap, (load[site], site))
            heapq.heappush(ends, (start + time, site))
        assigned.append(site)
        moved.append(site is not None and site != own)
        lost.append(site is None)
    out["assigned_location_id"] = pd.array(assigned, dtype="Int64")
    out["was_reassigned"], out["unserved"] = moved, lost
    return out


def rebalance(events: pd.DataFrame, points: dict[int, int], steps: int) -> pd.DataFrame:
    """Move home-street events, in row order, to the first candidate street site with a free point on every step.

    events: event_start, event_time, location_id, candidates (ordered site ids, null for events that stay). Adds moved.
    """
    mask = defaultdict(lambda: np.zeros(steps, np.int32))  # of sites that an event stands at or may go to
    for s, a, t in zip(events["location_id"], events["event_start"], events["event_time"], strict=True):
        mask[int(s)][int(a) : int(a) + int(t)] += 1
    out, where, moved = events.copy(), events["location_id"].to_numpy().copy(), np.zeros(len(events), bool)
    for i, (a, t, candidates) in enumerate(zip(out["event_start"], out["event_time"], out["candidates"], strict=True)):
        a, b = int(a), int(a) + int(t)
        for s in candidates if candidates is not None else ():
            if (mask[int(s)][a:b] < points[int(s)]).all():
                mask[int(where[i])][a:b] -= 1
                mask[int(s)][a:b] += 1
                where[i], moved[i] = s, True
                break
    out["location_id"], out["moved"] = where, moved
    return out


def rebalance_near(events: pd.DataFrame, homes: pd.DataFrame, streets: pd.DataFrame, radius: float, steps: int) -> pd.DataFrame:
    """rebalance() with candidates by distance: street sites at most radius from an event's home site, by location_id. Rows that moved.

    events: event_id, event_start, event_time, location_id, in order; homes and streets: location_id, x, y, streets also
    charging_points. Occupancy is kept for street sites only, as no event moves to a home, and never counts beyond the points.
    """
    streets = streets.sort_values("location_id", kind="stable")
    ids, points = streets["location_id"].to_numpy(np.int64), streets["charging_points"].to_numpy(np.int64)
    by_x = np.argsort(streets["x"].to_numpy(float), kind="stable")
    x, y = streets["x"].to_numpy(float)[by_x], streets["y"].to_numpy(float)[by_x]
    place = dict(zip(homes["location_id"].tolist(), zip(homes["x"].tolist(), homes["y"].tolist(), strict=True), strict=True))
    start, location = events["event_start"].to_numpy(np.int64), events["location_id"].to_numpy(np.int64)
    end = np.minimum(start + events["event_time"].to_numpy(np.int64), steps)
    first = int(start.min(initial=0))
    most = int(points.max(initial=0))
    count = np.zeros((len(ids), max(0, int(end.max(initial=0)) - first)), np.uint8 if most < 255 else np.int64)
    limit = points.astype(count.dtype)
    row = np.searchsorted(ids, location)
    row[(row == len(ids)) | (ids[np.minimum(row, len(ids) - 1)] != location)] = -1
    begin, stop = (start - first).tolist(), (end - first).tolist()
    for r, a, b in zip(row.tolist(), begin, stop, strict=True):
        if r >= 0:
            window = count[r, a:b]
            window += window < limit[r]
    to = np.full(len(events), -1, np.int64)
    for i, (home, a, b) in enumerate(zip(location.tolist(), begin, stop, strict=True)):
        at = place.get(home)
        if at is None:
            continue
        slab = slice(np.searchsorted(x, at[0] - radius * (1 + 1e-9)), np.searchsorted(x, at[0] + radius * (1 + 1e-9), "right"))
        dx, dy = at[0] - x[slab], at[1] - y[slab]
        near = np.sort(by_x[slab][np.sqrt(dx * dx + dy * dy) <= radius])
        k, size = 0, 32
        while k < len(near):
            some = near[k : k + size]
            room = (count[some, a:b] < limit[some, None]).all(1)
            hit = int(room.argmax())
            if room[hit]:
                to[i] = ids[some[hit]]
                count[some[hit], a:b] += 1
                break
            k, size = k + size, 2 * size
    out = events.assign(location_id=to)
    return out[to >= 0]


CAPACITY_KW = 22.0


def decompose(counts: pd.DataFrame, mean_charge: float, mean_stay: float, seed: int) -> pd.DataFrame:
    """Hourly numbers of charging vehicles of one id -> events, in row order (weekhour, charging_vehicles).

    Each hour, events past their end go; as many start as are missing. Charge max(0.5, N(mean, 1)) h, stay max(charge, N(mean, 4)) h.
    """
    rng, active, out = np.random.default_rng(seed), [], []
    for hour, want in zip(counts["weekhour"], counts["charging_vehicles"], strict=True):
        active = [e for e in active if e > hour]
        for _ in range(max(0, int(want - len(active)))):
            charge = max(0.5, rng.normal(mean_charge, 1))
            stay = max(charge, rng.normal(mean_stay, 4))
            out.append((hour, charge, stay, charge * CAPACITY_KW))
            active.append(hour + charge)
    return pd.DataFrame(out, columns=["start_hour", "charge_hours", "stay_hours", "energy"])


def greedy_clusters(x: np.ndarray, y: np.ndarray, weight: np.ndarray, max_radius: float, max_weight: float, increment: float) -> list[tuple[float, float, float, float, int]]:
    """(x, y, weight, radius, members): from the first point left, grow a circle until radius or weight passes its bound."""
    left, out = np.ones(len(x), bool), []
    for i in range(len(x)):
        if not left[i]:
            continue
        d, radius = np.hypot(x - x[i], y - y[i]), increment
        while True:
            inside = left & (d < radius)
            total = float(weight[inside].sum())
            if radius + increment > max_radius or total > max_weight:
                break
            radius += increment
        out.append((float(x[i]), float(y[i]), total, radius, int(inside.sum())))
        left &= ~inside
    return out


# ---- DataFrame forms ----



def _draw(seed: int):
    return uniform(F.col("event_id") + F.lit(seed)).alias("u")


_PLACED = "alloc_group string, event_id long, event_start int, event_time int, assigned_location long"


def shared_allocation(events: DataFrame, sites: DataFrame, group: str, steps: int, weight: str = "weight", share: bool = True, order: str = "event_id", seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(placed events, sites with points): cogrouped by allocation group; assigned_location is the idx of a site, any unique number.

    Exactness asks for one pass over a group's events in order; groups are independent use cases or regions and run in parallel.
    An event draws by a portable uniform of its id and the seed, so it draws the same number wherever it is placed. The kernel
    runs once: its rows are checkpointed, and both results read them.
    """

    def run(key, e: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        if not len(e) or not len(s):
            return pd.DataFrame(columns=["kind", "alloc_group", "event_id", "assigned_location", "points", "capacity"])
        s, e = s.sort_values("idx"), e.sort_values(order, kind="stable")
        placed, points, capacity, _ = allocate_shared(e, s[weight].to_numpy(float), steps, share)
        a = pd.DataFrame({"kind": 0, "event_id": e["event_id"].to_numpy(), "assigned_location": s["idx"].to_numpy()[placed]})
        b = pd.DataFrame({"kind": 1, "assigned_location": s["idx"].to_numpy(), "points": points, "capacity": capacity})
        return pd.concat([a, b]).assign(alloc_group=key[0])

    e = events.select(F.col(group).alias("alloc_group"), "event_id", "event_start", "event_time", F.col("station_charging_capacity").cast("double").alias("station_charging_capacity"), _draw(seed))
    s = sites.select(F.col(group).alias("alloc_group"), "idx", F.col(weight).cast("double").alias(weight))
    both = e.groupBy("alloc_group").cogroup(s.groupBy("alloc_group")).applyInPandas(run, "kind int, alloc_group string, event_id long, assigned_location long, points long, capacity long")
    both = checkpointed(both)
    return both.where("kind = 0").select("alloc_group", "event_id", "assigned_location"), both.where("kind = 1").select("alloc_group", F.col("assigned_location").alias("idx"), "points", "capacity")


def multi_use_allocation(first: DataFrame, second: DataFrame, sites: DataFrame, group: str, steps: int, shift: int, weight: str = "weight", summed: bool = True, seed: int = 1) -> DataFrame:
    """First events allocated like shared_allocation, then second events on the points that these leave idle; rows of the second events."""

    def run(key, t: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        columns = ["alloc_group", "event_id", "event_start", "event_time", "assigned_location"]
        if not len(t) or not len(s):
            return pd.DataFrame(columns=columns)
        t, s = t.sort_values("event_id", kind="stable"), s.sort_values("idx")
        occupied = Occupancy(steps)
        if (t["turn"] == 0).any():
            occupied = allocate_shared(t[t["turn"] == 0], s[weight].to_numpy(float), steps)[3]
        out = place_on_existing(t[t["turn"] == 1], occupied, shift, summed).assign(alloc_group=key[0])
        hit, idx = out["assigned_location"].notna(), s["idx"].to_numpy()
        out.loc[hit, "assigned_location"] = idx[out.loc[hit, "assigned_location"].astype(int)]
        return out[columns]

    cols = ["event_id", "event_start", "event_time", F.col("energy").cast("double").alias("energy"), F.col("station_charging_capacity").cast("double").alias("station_charging_capacity"), _draw(seed)]
    turn = lambda d, n: d.select(F.col(group).alias("alloc_group"), *cols, F.lit(n).alias("turn"))
    s = sites.select(F.col(group).alias("alloc_group"), "idx", F.col(weight).cast("double").alias(weight))
    return turn(first, 0).unionAll(turn(second, 1)).groupBy("alloc_group").cogroup(s.groupBy("alloc_group")).applyInPandas(run, _PLACED)


def network_assignment(events: DataFrame, sites: DataFrame, region: str) -> DataFrame:
    """least_loaded for each region; sites: location_id, charging_points (null is 0)."""

    def run(key, e: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        out = least_loaded(e, {int(i): int(c) for i, c in zip(s["location_id"], s["charging_points"].fillna(0), strict=True)})
        return out[["event_id", "event_start", "event_time", "location_id", "assigned_location_id", "was_reassigned", "unserved"]].assign(region=key[0])

    e = events.select(F.col(region).alias("region"), "event_id", "event_start", "event_time", "location_id").dropna()
    s = sites.select(F.col(region).alias("region"), "location_id", "charging_points")
    return e.groupBy("region").cogroup(s.groupBy("region")).applyInPandas(run, "event_id long, event_start int, event_time int, location_id long, assigned_location_id long, was_reassigned boolean, unserved boolean, region long")


def street_rebalance(events: DataFrame, sites: DataFrame, region: str, radius: float, steps: int) -> DataFrame:
    """(event_id, location_id) of events that rebalance_near moves, for each region; sites: location_id, mode, charging_points, x, y."""

    def run(key, e: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        if not len(e) or not len(s):
            return pd.DataFrame({"event_id": [], "location_id": []})
        street = s["mode"] == "street"
        return rebalance_near(e.sort_values("event_id", kind="stable"), s[~street], s[street], radius, steps)[["event_id", "location_id"]]

    e = events.select(F.col(region).alias("region"), "event_id", "event_start", "event_time", "location_id")
    s = sites.select(F.col(region).alias("region"), "location_id", "mode", "charging_points", "x", "y")
    return e.groupBy("region").cogroup(s.groupBy("region")).applyInPandas(run, "event_id long, location_id long")


def decomposition(counts: DataFrame, means: dict[int, tuple[float, float]], seed: int = 1) -> DataFrame:
    """decompose for each ppc_id, seeded by seed + id."""

    def run(key, c: pd.DataFrame) -> pd.DataFrame:
        charge, stay = means.get(int(key[0]), (2.0, 4.0))
        return decompose(c.sort_values("weekhour", kind="stable"), charge, stay, seed + int(key[0])).assign(ppc_id=key[0])

    return counts.select("ppc_id", "weekhour", "charging_vehicles").groupBy("ppc_id").applyInPandas(run, "ppc_id int, start_hour int, charge_hours double, stay_hours double, energy double")


def poi_clusters(points: DataFrame, region: str, max_radius: float, max_weight: float, increment: float) -> DataFrame:
    """greedy_clusters for each region, in order of idx."""

    def run(key, p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("idx", kind="stable")
        found = greedy_clusters(p["x"].to_numpy(), p["y"].to_numpy(), p["weight"].to_numpy(float), max_radius, max_weight, increment)
        return pd.DataFrame(found, columns=["x", "y", "potential", "radius", "members"]).assign(region=key[0])

    return points.select(F.col(region).alias("region"), "idx", "x", "y", "weight").groupBy("region").applyInPandas(run, "region long, x double, y double, potential double, radius double, members long")


