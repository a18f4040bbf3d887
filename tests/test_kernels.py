"""Allocators against slow, literal models of their rules."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chargeplan.operators import allocators as A

EVENTS = st.lists(st.tuples(st.integers(0, 30), st.integers(1, 12), st.sampled_from([3.7, 11.0, 22.0])), min_size=1, max_size=50)


def frame(rows):
    return pd.DataFrame([(i, s, t, c, 5.0) for i, (s, t, c) in enumerate(rows)], columns=["event_id", "event_start", "event_time", "station_charging_capacity", "energy"])


def literal_shared(rows, weights, steps, seed=1):
    rng, p = np.random.default_rng(seed), np.array(weights) / np.sum(weights)
    mask, points, mean, placed = np.zeros((len(weights), steps), int), [0] * len(weights), [0.0] * len(weights), []
    for s, t, c in rows:
        e = min(s + t, steps)
        free = [i for i in range(len(weights)) if max(mask[i, s:e]) < points[i]]
        if free:
            at = free[0]
        else:
            at = int(rng.choice(len(weights), p=p))
            mean[at] = (mean[at] * points[at] + c) / (points[at] + 1)
            points[at] += 1
        mask[at, s:e] += 1
        placed.append(at)
    return placed, points, [int(m) for m in mean]


@settings(max_examples=60, deadline=None)
@given(EVENTS, st.lists(st.integers(1, 9), min_size=1, max_size=6))
def test_shared_allocation_equals_the_literal_rule(rows, weights):
    placed, points, capacity, _ = A.allocate_shared(frame(rows), np.array(weights, float), 40)
    assert (placed.tolist(), points.tolist(), capacity.tolist()) == literal_shared(rows, weights, 40)


def test_without_sharing_every_event_gets_a_point():
    placed, points, _, _ = A.allocate_shared(frame([(0, 2, 11.0), (5, 2, 11.0), (9, 1, 11.0)]), np.array([1.0, 2.0]), 40, share=False)
    assert points.sum() == 3 and len(placed) == 3


@pytest.mark.parametrize("rows", [[(5, 0, 11.0)], [(40, 2, 11.0)]])
def test_empty_intervals_are_refused(rows):
    with pytest.raises(ValueError):
        A.allocate_shared(frame(rows), np.ones(2), 40)


@settings(max_examples=60, deadline=None)
@given(EVENTS, EVENTS, st.integers(0, 4))
def test_multi_use_moves_within_bounds_and_fills_only_idle_points(first, second, shift):
    _, points, _, occupied = A.allocate_shared(frame(first), np.ones(3), 60)
    before = occupied.points.copy()
    got = A.place_on_existing(frame(second), occupied, shift)
    hit = got[got["assigned_location"].notna()]
    was = frame(second).set_index("event_id")
    for r in hit.itertuples():
        old = was.loc[r.event_id]
        assert 0 <= r.event_start - old.event_start <= shift and r.event_start + r.event_time <= 60 and r.event_time <= old.event_time
    assert (occupied.points == before).all() and (occupied.mask.max(1) <= occupied.points).all()


def test_sum_and_maximum_of_a_window_differ_on_two_points():
    rows = [(0, 4, 11.0), (0, 4, 11.0), (4, 4, 11.0)]
    for summed, want in ((True, 0), (False, 1)):
        occupied = A.Occupancy(20)
        occupied.row(0)
        occupied.points[0] = 2
        occupied.mask[0, 0:4] = 1
        got = A.place_on_existing(frame(rows[:1]), occupied, 0, summed)
        assert int(got["assigned_location"].notna().sum()) == want


def literal_least_loaded(rows, capacity):
    load, ends, out = dict.fromkeys(capacity, 0), [], {}
    for i, s, t, own in sorted(rows, key=lambda r: (r[1], -r[2], r[0])):
        for e in [e for e in ends if e[0] <= s]:
            load[e[1]] -= 1
            ends.remove(e)
        free = [x for x in capacity if load[x] < capacity[x]]
        site = own if own in free else min(free, key=lambda x: (load[x], x), default=None)
        if site is not None:
            load[site] += 1
            ends.append((s + t, site))
        out[i] = site
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(1, 10), st.integers(0, 4)), min_size=1, max_size=40), st.lists(st.integers(0, 2), min_size=1, max_size=5))
def test_least_loaded_equals_the_literal_rule(rows, capacities):
    rows = [(i, *r) for i, r in enumerate(rows)]
    e = pd.DataFrame(rows, columns=["event_id", "event_start", "event_time", "location_id"])
    got = A.least_loaded(e, dict(enumerate(capacities)))
    want = literal_least_loaded(rows, dict(enumerate(capacities)))
    assert {r.event_id: None if pd.isna(r.assigned_location_id) else int(r.assigned_location_id) for r in got.itertuples()} == want
    assert (got["unserved"] == got["assigned_location_id"].isna()).all()


def test_rebalance_takes_the_first_free_candidate():
    e = pd.DataFrame({"event_id": [1, 2, 3], "event_start": [0, 0, 0], "event_time": [4, 4, 4], "location_id": [10, 10, 1], "candidates": [[1, 2], [1, 2], None]})
    out = A.rebalance(e, {1: 1, 2: 1, 10: 2}, 10)
    assert out["location_id"].tolist() == [2, 10, 1] and out["moved"].tolist() == [True, False, False]


def test_decomposition_fills_up_to_the_count():
    c = pd.DataFrame({"weekhour": [0, 1, 2], "charging_vehicles": [3, 1, 4]})
    e = A.decompose(c, 1.1, 6.8, 7)
    for hour, want in zip(c["weekhour"], c["charging_vehicles"]):
        assert ((e["start_hour"] <= hour) & (e["start_hour"] + e["charge_hours"] > hour)).sum() >= want
    assert (e["charge_hours"] >= 0.5).all() and (e["stay_hours"] >= e["charge_hours"]).all()


def test_greedy_clusters_by_hand():
    x, y, w = np.array([0.0, 50, 1000]), np.zeros(3), np.array([1.0, 2, 3])
    assert A.greedy_clusters(x, y, w, 300, 100, 100) == [(0.0, 0.0, 3.0, 300, 2), (1000.0, 0.0, 3.0, 300, 1)]
