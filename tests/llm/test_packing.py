from __future__ import annotations

import math
import random

import numpy as np
import pytest

packing = pytest.importorskip("tidemark.llm.packing")


def histogram(rng, n, capacity, most=None):
    out = {}
    for _ in range(n):
        size = min(capacity, max(1, int(rng.lognormvariate(math.log(capacity / 8), 1.0)))) if most is None else rng.randint(1, most)
        out[size] = out.get(size, 0) + 1
    return out


def used(plan):
    out = {}
    for config, n in plan.configurations:
        assert n > 0 and sum(s * c for s, c in config.items()) <= plan.capacity
        for size, copies in config.items():
            out[size] = out.get(size, 0) + n * copies
    return out


@pytest.mark.parametrize(("n", "capacity"), [(0, 64), (1, 64), (300, 64), (5000, 64), (50_000, 128), (2000, 512)])
def test_plans_place_every_item_once_and_leave_little_room(n, capacity):
    h = histogram(random.Random(n), n, capacity)
    plan = packing.plan(h, capacity)
    assert used(plan) == h
    total = sum(s * c for s, c in h.items())
    if n >= 300:
        assert plan.containers <= 1.03 * total / capacity + 1 or plan.containers <= 1.01 * sum(c for s, c in h.items() if 2 * s > capacity) + 1


def longest_first(h, capacity):
    """Containers that filling with the longest item that still fits would need."""
    left, n = dict(h), 0
    while any(left.values()):
        room, n = capacity, n + 1
        for size in sorted((s for s in left if left[s]), reverse=True):
            c = min(room // size, left[size])
            room -= c * size
            left[size] -= c
    return n


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("capacity", [64, 256, 1024])
def test_plans_are_near_the_bound_and_no_worse_than_longest_first(seed, capacity):
    h = histogram(random.Random(seed), 3000, capacity)
    plan = packing.plan(h, capacity)
    assert used(plan) == h and plan.containers == min(plan.laps) >= plan.bound
    assert plan.containers <= longest_first(h, capacity)
    assert plan.containers <= 1.004 * plan.bound + 1


def test_planning_does_not_grow_with_the_items():
    h = {s: c * 10**7 for s, c in histogram(random.Random(1), 1000, 128).items()}
    plan = packing.plan(h, 128)
    assert used(plan) == h and len(plan.configurations) < 8000


def test_bounds_hold():
    # three items over half the capacity need three containers though their volume fits two
    assert packing.plan({6: 3}, 10).bound == 3
    # thirds and a bit: two fit a container, by the priced weights as well
    sizes, demand = np.array([4]), np.array([6])
    assert packing.dual_bound(sizes, demand, np.array([1.0]), 10) == 3 and packing.plan({4: 6}, 10).containers == 3


@pytest.mark.parametrize("seed", range(20))
def test_pricing_is_the_best_knapsack(seed):
    rng = random.Random(seed)
    sizes = np.array(sorted(rng.sample(range(2, 20), 5)))
    values, most = np.array([rng.random() for _ in sizes]), np.array([rng.randint(1, 6) for _ in sizes])
    best = [0.0] * 41
    for s, v, n in zip(sizes.tolist(), values, most.tolist()):
        best = [max(best[c - s * k] + v * k for k in range(n + 1) if s * k <= c) for c in range(41)]
    got = packing.price(sizes, values, most, 40)
    assert sum(sizes[k] * n for k, n in got.items()) <= 40 and all(n <= most[k] for k, n in got.items())
    assert sum(values[k] * n for k, n in got.items()) == pytest.approx(best[40], rel=1e-5)
    assert packing.dual_bound(sizes, np.ones(5), values, 40) == pytest.approx(values.sum() / max_unbounded(sizes, values, 40))


def max_unbounded(sizes, values, capacity):
    best = [0.0] * (capacity + 1)
    for c in range(1, capacity + 1):
        best[c] = max([best[c - 1], *[best[c - s] + v for s, v in zip(sizes.tolist(), values) if s <= c]])
    return best[capacity]


def filled(spark, sizes, kinds, **more):
    items = spark.createDataFrame(list(enumerate(sizes)), "doc_id bigint, n_tokens bigint")
    capacities = spark.createDataFrame(kinds, "container_kind string, capacity_tokens bigint")
    return packing.fill_containers(items, capacities, **more).toPandas()


def check(rows, sizes, kinds):
    for kind, capacity in kinds:
        own = rows[rows.container_kind == kind]
        room = own[own.container_id.notna()].groupby("container_id").n_tokens.sum()
        assert (room <= capacity).all() and len(own) >= len(sizes)
        for doc, n in enumerate(sizes):
            parts = own[own.doc_id == doc].sort_values("piece")
            assert parts.n_tokens.sum() == (n or 0)
            assert parts.token_start.tolist() == [k * capacity for k in range(len(parts))]
            assert len(parts) == max(1, -(-(n or 0) // capacity))
            if not n:
                assert parts.container_id.isna().all()
        if len(room):
            assert sorted(room.index) == list(range(len(room)))  # no empty container


def test_every_item_is_placed_whole_unless_it_is_too_long(spark):
    rng = random.Random(4)
    sizes = [rng.choice([None, 0, 5, 5, 5, 64, 65, 200, 129, *range(1, 64)]) for _ in range(800)]
    kinds = [("small", 64), ("large", 300)]
    check(filled(spark, sizes, kinds), sizes, kinds)


def test_one_length_may_hold_most_items(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_SALT", 50)
    sizes = [7] * 900 + [3] * 100
    kinds = [("k", 20)]
    rows = filled(spark, sizes, kinds)
    check(rows, sizes, kinds)
    assert rows.container_id.nunique() <= math.ceil(900 / 2) + 2


def test_empty(spark):
    assert len(filled(spark, [], [("k", 20)])) == 0 and len(filled(spark, [1], [])) == 0
