"""Filling containers of fixed capacity with whole items.

The lengths of all items form a histogram with at most ``capacity`` bins, so the
planning problem does not grow with the number of items. A *configuration* says
how many items of each length one container takes; the configuration linear
program asks for the least total of configurations that covers the histogram.
It is solved by multiplicative weights in *laps*. A lap covers the histogram
once: a length is worth its weight, which falls as its demand is met; a knapsack
dynamic program finds the configuration worth most (the pricing step), which is
used for half of what its scarcest length allows. After a lap the weight of each
length is multiplied by the exponential of its loss, the mean share of room left
over in the containers it travelled in, so that lengths that are hard to place
come earlier and in better company. The weights also give a dual bound, as do
the volume and the items longer than half a container. Laps end when the best is
within ``GAP`` of the bound, when a lap betters the best by less than that, or
after ``LAPS``; the rule is the same for every capacity.

The mean of the laps is the fractional solution. Amounts within a lap are whole
numbers, so rounding takes the lap with the fewest containers, which is at most
the mean; no container comes from elsewhere.

Items learn their container without ever coming together: an item's number
among those of its length decides on configuration, container and place.

Defined cases: items longer than the capacity are split into full containers and
a rest, which is an item like any other; items of length 0 or null need no room
and get no container (null) but keep their row; ties of length are broken by
item id and piece; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import buckets_for

#: Most laps, and what ends them earlier: a gap to the bound, or a gain over the laps before, of less than this share.
LAPS, GAP = 6, 1e-4
#: How sharply a weight falls as demand is met, how much more a token of a long item is worth at first, the share
#: of the scarcest demand used at once, and how strongly a lap's losses change the weights of the next.
SHARPNESS, LONGER, STEP, LEARNING = 0.05, 1.0, 0.5, 1.0
#: Lengths priced at once: the heaviest and as many spread over the others (partial pricing; the bound prices all).
CANDIDATES = 256
#: Items of one length that one task numbers.
ROWS_PER_SALT = 250_000


def _copies(most: int) -> Iterator[int]:
    """Powers of two and a rest that add up to ``most``, so that every number up to it is a sum of some of them."""
    c = 1
    while most > 0:
        yield min(c, most)
        most -= c
        c *= 2


def price(sizes: np.ndarray, values: np.ndarray, most: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration (index of size -> copies, at most ``most``) of greatest total value that fits ``capacity``."""
    best = np.zeros(capacity + 1, np.float32)
    taken: list[tuple[int, int, int, np.ndarray]] = []
    for k, (size, value, n) in enumerate(zip(sizes.tolist(), values.tolist(), most.tolist())):
        for m in _copies(min(n, capacity // size)):
            room = m * size
            with_it = best[: capacity + 1 - room] + np.float32(m * value)
            better = with_it > best[room:]
            np.maximum(best[room:], with_it, out=best[room:])
            taken.append((k, m, room, better))
    out: dict[int, int] = {}
    at = capacity
    for k, m, room, better in reversed(taken):
        if at >= room and better[at - room]:
            out[k] = out.get(k, 0) + m
            at -= room
    return out


def dual_bound(sizes: np.ndarray, demand: np.ndarray, values: np.ndarray, capacity: int) -> float:
    """Containers that any covering needs: the value of all items over the most that one container can be worth."""
    best = np.zeros(capacity + 1)
    for size, value in zip(sizes.tolist(), values.tolist()):
        for m in _copies(capacity // size):
            best[m * size :] = np.maximum(best[m * size :], best[: capacity + 1 - m * size] + m * value)
    return float(demand @ values / best[-1])


@dataclass(frozen=True)
class Plan:
    """Configurations (length -> copies) with the number of containers of each, and what the program proved about it."""

    capacity: int
    configurations: list[tuple[dict[int, int], int]]
    #: no packing has fewer containers than this
    bound: int = 0
    #: containers of each lap; their mean is the value of the fractional solution
    laps: tuple[int, ...] = ()

    @property
    def containers(self) -> int:
        return sum(n for _, n in self.configurations)


def _lap(sizes: np.ndarray, demand: np.ndarray, weights: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """One covering of ``demand``: configurations (index -> copies) and how often each is used."""
    left = demand.copy()
    worth = sizes * weights
    out = []
    while True:
        open_ = np.flatnonzero(left)
        if not len(open_):
            return out
        now = worth[open_] * np.exp(SHARPNESS * (left[open_] / demand[open_] - 1.0))
        order = np.argsort(-now / sizes[open_], kind="stable")
        others = np.sort(order[CANDIDATES // 2 :])
        if len(others) > CANDIDATES // 2:
            others = others[np.linspace(0, len(others) - 1, CANDIDATES // 2).astype(int)]
        chosen = np.concatenate([order[: CANDIDATES // 2], others])
        found = price(sizes[open_[chosen]], now[chosen], left[open_[chosen]], capacity)
        config = {int(open_[chosen[k]]): c for k, c in found.items()}
        amount = max(1, int(min(int(left[k]) // c for k, c in config.items()) * STEP))
        out.append((config, amount))
        for k, c in config.items():
            left[k] -= amount * c


def plan(histogram: dict[int, int], capacity: int, laps: int = LAPS) -> Plan:
    """Containers for ``histogram`` (length -> number of items, lengths from 1 to ``capacity``)."""
    sizes = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[int(s)] for s in sizes], np.int64)
    if not len(sizes):
        return Plan(capacity, [])
    halves = np.where(2 * sizes > capacity, 1.0, np.where(2 * sizes == capacity, 0.5, 0.0))
    bound = max(float(demand @ sizes) / capacity, float(demand @ halves))
    weights = np.exp(LONGER * sizes / capacity)
    best, counts = None, []
    for _ in range(laps):
        found = _lap(sizes, demand, weights, capacity)
        count, before = sum(n for _, n in found), min(counts, default=None)
        counts.append(count)
        if before is None or count < before:
            best = found
        bound = max(bound, dual_bound(sizes, demand, sizes * weights, capacity))
        if min(counts) <= np.ceil(bound - 1e-6) * (1 + GAP) or before is not None and before - count < GAP * before:
            break
        loss = np.zeros(len(sizes))
        for config, n in found:
            spare = 1 - sum(int(sizes[k]) * c for k, c in config.items()) / capacity
            for k, c in config.items():
                loss[k] += n * c * spare
        weights = weights * np.exp(LEARNING * loss / demand)
        weights /= weights.mean()
    return Plan(capacity, [({int(sizes[k]): c for k, c in config.items()}, n) for config, n in best], int(np.ceil(bound - 1e-6)), tuple(counts))


def slots(p: Plan) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each length: running number of the first item of each run of containers, copies per container, first container."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    first = 0
    for config, n in p.configurations:
        for size, copies in config.items():
            runs.setdefault(size, []).append((n * copies, copies, first))
        first += n
    out = {}
    for size, parts in runs.items():
        count, copies, start = (np.array(x, np.int64) for x in zip(*parts))
        out[size] = (np.cumsum(count) - count, copies, start)
    return out


def pieces(items: DataFrame, capacities: DataFrame) -> DataFrame:
    """Items cut to the capacity of each container kind: doc_id, container_kind, capacity, piece, token_start, length.

    The kinds are a parameter of a few rows and come to the driver; rows of items never do.
    """
    kinds = capacities.where("container_kind IS NOT NULL AND capacity_tokens > 0").distinct().collect()
    if not kinds:
        return items.limit(0).select(
            "doc_id", F.lit("").alias("container_kind"), *[F.lit(0).cast(t).alias(c) for c, t in (("capacity", "bigint"), ("piece", "int"), ("token_start", "bigint"), ("length", "bigint"))]
        )
    each = F.array(*[F.struct(F.lit(k["container_kind"]).alias("container_kind"), F.lit(k["capacity_tokens"]).cast("bigint").alias("capacity_tokens")) for k in kinds])
    n, c = F.coalesce(F.col("n_tokens"), F.lit(0)), F.col("capacity_tokens")
    count = F.greatest(F.lit(1), F.ceil(n / c)).cast("int")
    cut = items.select("doc_id", "n_tokens", F.inline(each)).select("doc_id", "container_kind", c.alias("capacity"), n.alias("n"), F.explode(F.sequence(F.lit(0), count - 1)).alias("piece"))
    start = F.col("piece").cast("bigint") * F.col("capacity")
    return cut.select(
        "doc_id", "container_kind", "capacity", "piece", start.alias("token_start"), F.least("capacity", F.col("n") - start).cast("bigint").alias("length")
    )


def _numbered(cut: DataFrame, salts: int) -> DataFrame:
    """Adds ``number``: 0, 1, 2... among the pieces of one kind and length.

    A length may hold a large part of all items, so each length is numbered in
    ``salts`` parts, and the parts are offset by the counts of those before.
    """
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    parts = salted.groupBy("container_kind", "length", "salt").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("container_kind", "length").orderBy("salt")
    offsets = parts.select("container_kind", "length", "salt", (F.sum("n").over(order) - F.col("n")).alias("offset"))
    within = F.row_number().over(Window.partitionBy("container_kind", "length", "salt").orderBy("doc_id", "piece")) - 1
    return salted.withColumn("within", within).join(offsets, ["container_kind", "length", "salt"]).withColumn("number", F.col("within") + F.col("offset"))


PLACES = "container_kind string, length bigint, first array<bigint>, copies array<bigint>, start array<bigint>, containers bigint, bound bigint, laps array<bigint>"


def planned(cut: DataFrame, laps: int = LAPS) -> DataFrame:
    """The places of each kind and length, planned where the histograms are, one task per kind.

    A row names a length: the running number of the first item of each of its
    runs, the copies per container and the first container; further the
    containers of its kind, their bound and the containers of each lap.
    """
    bins = cut.where("length > 0").groupBy("container_kind", "capacity", "length").agg(F.count(F.lit(1)).alias("n"))

    def run(t: pa.Table) -> pa.Table:
        kind, capacity = t["container_kind"][0].as_py(), t["capacity"][0].as_py()
        p = plan(dict(zip(t["length"].to_pylist(), t["n"].to_pylist())), capacity, laps)
        own = sorted(slots(p).items())
        n, whole = len(own), pa.list_(pa.int64())
        runs = [pa.array([x[k].tolist() for _, x in own], whole) for k in range(3)]
        return pa.table(
            [pa.array([kind] * n), pa.array([length for length, _ in own], pa.int64()), *runs, pa.array([p.containers] * n, pa.int64()), pa.array([p.bound] * n, pa.int64()), pa.array([list(p.laps)] * n, whole)],
            names=[c.split()[0] for c in PLACES.split(", ")],
        )

    # a number of partitions of its own keeps the kinds in tasks of their own, small as their histograms are
    return bins.repartition(32, "container_kind").groupBy("container_kind").applyInArrow(run, PLACES)


def fill_containers(items: DataFrame, capacities: DataFrame, laps: int = LAPS) -> DataFrame:
    """A container for every piece of every item and container kind.

    ``items`` (doc_id, n_tokens) is read three times, so it should be a written
    table. Columns: container_kind, container_id, doc_id, piece, token_start,
    n_tokens (of the piece).
    """
    cut = pieces(items, capacities)
    places: dict[str, dict[int, tuple]] = {}
    # at most ``capacity`` lengths a kind; a kind's runs are as many as its configurations have lengths
    for r in planned(cut, laps).select("container_kind", "length", "first", "copies", "start").collect():
        places.setdefault(r["container_kind"], {})[r["length"]] = tuple(np.array(r[c], np.int64) for c in ("first", "copies", "start"))
    salts = buckets_for(items.count(), ROWS_PER_SALT, least=4)
    shared = items.sparkSession.sparkContext.broadcast(places)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.column(0).dictionary_encode()
            codes = kind.indices.to_numpy()
            length, number = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            container = np.full(len(length), -1, np.int64)
            keys = codes.astype(np.int64) * (1 << 32) + length
            order = np.argsort(keys, kind="stable")
            cuts = np.flatnonzero(np.diff(keys[order])) + 1
            for rows in np.split(order, cuts):
                if len(rows) and length[rows[0]] > 0:
                    first, copies, start = shared.value[kind.dictionary[int(codes[rows[0]])].as_py()][int(length[rows[0]])]
                    run = np.searchsorted(first, number[rows], side="right") - 1
                    container[rows] = start[run] + (number[rows] - first[run]) // copies[run]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(container, mask=container < 0), *[batch.column(k) for k in (1, 2, 3, 4)]],
                names=["container_kind", "container_id", "doc_id", "piece", "token_start", "n_tokens"],
            )

    numbered = _numbered(cut.where("length > 0"), salts).select("container_kind", "doc_id", "piece", "token_start", "length", "number")
    roomless = cut.where("length <= 0").select("container_kind", "doc_id", "piece", "token_start", "length", F.lit(0).cast("bigint").alias("number"))
    schema = "container_kind string, container_id bigint, doc_id bigint, piece int, token_start bigint, n_tokens bigint"
    return numbered.unionByName(roomless).mapInArrow(place, schema)
