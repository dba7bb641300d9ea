"""Near-exact distinct counts over huge identifier sets.

An identifier becomes a 64-bit hash. The hashes of a cell (here a day, an
organization and a team) that fall into one range of the hash space are kept as
a *run*: sorted, and coded as differences in variable-length bytes. Runs of one
day and range lie together in one *block*, the unit that is stored; blocks of
further days or deliveries are simply added. A union merges the sorted runs of
the same range (k-way: a natural merge sort takes the runs as they are), so no
task ever holds more than one range, and counts of different ranges add up.

Runs hold user identifiers, which are many. The organizations and teams of the
rows are the names of the cells, and every block lists its cells; their distinct
numbers come from these lists by grouping, which spreads the cells of one large
organization over all tasks.

Counts are exact unless two identifiers share a hash. By the birthday bound the
expected number of identifiers lost that way is at most n(n-1)/2 / 2^64, which
is reported next to each count.

Defined cases: null identifiers are not counted; a null day, organization or
team is a group of its own; repeated rows count once; empty input, empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import buckets_for

#: Identifier rows per hash range that one task may hold.
ROWS_PER_RANGE = 400_000
KINDS = ("user_id", "organization_id", "team_id")
BLOCK_SCHEMA = "hash_range int, has_team boolean, day string, orgs array<string>, teams array<bigint>, sizes array<int>, runs binary"
COUNT_SCHEMA = "grouping int, day string, organization_id string, team_id bigint, n bigint"


def encode_runs(hashes: np.ndarray, starts: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit ``hashes`` as differences within each run, in 7-bit groups, least first.

    ``starts`` holds the position of each run's first hash, which is kept whole.
    """
    if not len(hashes):
        return b""
    delta = np.empty_like(hashes)
    delta[0] = hashes[0]
    delta[1:] = hashes[1:] - hashes[:-1]
    delta[starts] = hashes[starts]
    groups = np.ones(len(delta), np.int64)
    for k in range(1, 10):
        groups += delta >= np.uint64(1 << (7 * k))
    ends = np.cumsum(groups)
    first = ends - groups
    out = np.zeros(int(ends[-1]), np.uint8)
    for k in range(10):
        has = groups > k
        if not has.any():
            break
        part = ((delta[has] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8)
        out[first[has] + k] = part | np.where(groups[has] > k + 1, 128, 0).astype(np.uint8)
    return out.tobytes()


def decode_runs(data: bytes, sizes: np.ndarray) -> np.ndarray:
    """The hashes of ``encode_runs``; ``sizes`` are the lengths of the runs."""
    if not len(data):
        return np.empty(0, np.uint64)
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 128)
    first = np.concatenate(([0], ends[:-1] + 1))
    place = (np.arange(len(raw)) - np.repeat(first, ends - first + 1)).astype(np.uint64)
    delta = np.add.reduceat((raw & 127).astype(np.uint64) << (place * np.uint64(7)), first)
    running = np.cumsum(delta, dtype=np.uint64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    before = running[starts] - delta[starts]
    return running - np.repeat(before, sizes)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a partition whose rows come sorted by range, team flag and day; a null hash only names its cell."""
    held: list[pa.Table] = []

    def flush(tables: list[pa.Table]) -> pa.RecordBatch:
        t = pa.concat_tables(tables).combine_chunks()
        org = t["organization_id"].combine_chunks().dictionary_encode()
        codes = org.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        team_null = t["team_id"].is_null().to_numpy()
        team = t["team_id"].fill_null(0).to_numpy()
        empty = t["h"].is_null().to_numpy()
        h = t["h"].fill_null(0).to_numpy().view(np.uint64)
        order = np.lexsort((h, empty, team, team_null, codes))
        codes, team, team_null, h, empty = codes[order], team[order], team_null[order], h[order], empty[order]
        new_cell = np.ones(len(h), bool)
        new_cell[1:] = (codes[1:] != codes[:-1]) | (team[1:] != team[:-1]) | (team_null[1:] != team_null[:-1])
        keep = new_cell.copy()
        keep[1:] |= h[1:] != h[:-1]
        keep &= ~empty
        at = np.flatnonzero(new_cell)
        sizes = np.add.reduceat(keep, at)
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        names = org.dictionary.to_pylist()
        one = t.slice(0, 1)
        return pa.RecordBatch.from_pydict(
            {
                "hash_range": one["hash_range"].to_pylist(),
                "has_team": one["has_team"].to_pylist(),
                "day": one["day"].to_pylist(),
                "orgs": [[names[c] if c >= 0 else None for c in codes[at].tolist()]],
                "teams": [[None if no else v for v, no in zip(team[at].tolist(), team_null[at].tolist())]],
                "sizes": [sizes.tolist()],
                "runs": [encode_runs(h[keep], starts)],
            },
            schema=pa.schema(
                [
                    ("hash_range", pa.int32()), ("has_team", pa.bool_()), ("day", pa.string()),
                    ("orgs", pa.list_(pa.string())), ("teams", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("runs", pa.binary()),
                ]
            ),
        )

    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        day = t["day"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        range_, flag = (t[c].to_numpy() for c in ("hash_range", "has_team"))
        cut = np.flatnonzero((day[1:] != day[:-1]) | (range_[1:] != range_[:-1]) | (flag[1:] != flag[:-1])) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), t.num_rows]):
            piece = t.slice(a, b - a)
            key = tuple(piece.slice(0, 1)[c].to_pylist()[0] for c in ("hash_range", "has_team", "day"))
            if held and key != current:
                yield flush(held)
                held = []
            current = key
            held.append(piece)
    if held:
        yield flush(held)


def build_blocks(hashes: DataFrame, ranges: int) -> DataFrame:
    """Blocks of runs from ``hashes`` (has_team, day, organization_id, team_id, h).

    The blocks are the mergeable partial result: write them once per day and
    read those of any days together. Two blocks may cover the same cell.
    """
    bits = max(1, (ranges - 1).bit_length())
    # rows without an identifier only name their cell; they go by cell, as they have no hash to go by
    place = F.shiftrightunsigned(F.coalesce("h", F.xxhash64("day", "organization_id", "team_id")), 64 - bits).cast("int")
    ranged = hashes.select(place.alias("hash_range"), "has_team", "day", "organization_id", "team_id", "h")
    placed = ranged.repartition("hash_range").sortWithinPartitions("hash_range", "has_team", "day")
    return placed.mapInArrow(_blocks, BLOCK_SCHEMA)


def merged_order(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that merges the concatenated sorted runs ``h``, and the rank of each value in that order.

    A stable sort of integers of this width is a natural merge sort: it finds the
    runs as they lie and merges them.
    """
    order = np.argsort(h, kind="stable")
    merged = h[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = merged[1:] != merged[:-1]
    return order, np.cumsum(fresh) - 1


def _united(code: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of elements in merged order, the first of each (code, rank): the union of the runs of every code."""
    by_code = np.argsort(code, kind="stable")  # keeps the merged order within a code
    c, r = code[by_code], rank[by_code]
    first = np.ones(len(c), bool)
    first[1:] = (c[1:] != c[:-1]) | (r[1:] != r[:-1])
    return by_code[first]


def _union_counts(groupings: tuple[int, ...]):
    """A function that unites the runs of one hash range for every grouping (bit 0 day, 1 organization, 2 team)."""

    def run(t: pa.Table) -> pa.Table:
        sizes = [np.asarray(s, np.int64) for s in t["sizes"].to_pylist()]
        h = np.concatenate([decode_runs(r, s[s > 0]) for r, s in zip(t["runs"].to_pylist(), sizes)])
        cells = np.array([len(s) for s in sizes])
        per_cell = np.concatenate(sizes)
        day = t["day"].combine_chunks().dictionary_encode()
        block = np.repeat(np.arange(len(cells)), cells)
        day_of = day.indices.fill_null(len(day.dictionary)).to_numpy(zero_copy_only=False)[block].astype(np.int64)
        team_flag = t["has_team"].to_numpy(zero_copy_only=False)[block]
        org = t["orgs"].combine_chunks().flatten().dictionary_encode()
        org_of = org.indices.fill_null(len(org.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
        team = t["teams"].combine_chunks().flatten().dictionary_encode()
        team_of = team.indices.fill_null(len(team.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
        nd, no, nt = len(day.dictionary) + 1, len(org.dictionary) + 1, len(team.dictionary) + 1
        days, orgs, teams = (x.dictionary.to_pylist() + [None] for x in (day, org, team))
        order, rank = merged_order(h)
        cell = np.repeat(np.arange(len(per_cell)), per_cell)[order]
        out = {k: [] for k in ("grouping", "day", "organization_id", "team_id", "n")}

        def code(g: int, of: np.ndarray) -> np.ndarray:
            c = (day_of[of] if g & 1 else 0) * np.ones(len(of), np.int64)
            return (c * no + (org_of[of] if g & 2 else 0)) * nt + (team_of[of] if g & 4 else 0)

        # unions over days come first: most identifiers occur on many days, and what is left serves all groupings without a day
        every = np.arange(len(cell))
        whole = _united(code(6, cell) * 2 + team_flag[cell], rank)
        whole = np.sort(whole)
        for g in groupings:
            listed = np.unique(code(g, np.flatnonzero(team_flag) if g & 4 else np.arange(len(team_flag))))
            if not len(listed):
                continue
            at = every if g & 1 else whole
            at = at[team_flag[cell[at]]] if g & 4 else at
            c = code(g, cell[at])
            keys, n = listed, np.bincount(np.searchsorted(listed, c[_united(c, rank[at])]), minlength=len(listed))
            rest, tc = np.divmod(keys, nt)
            dc, oc = np.divmod(rest, no)
            out["grouping"].append(pa.array(np.full(len(keys), g, np.int32)))
            for name, names, k, bit, kind in (("day", days, dc, 1, pa.string()), ("organization_id", orgs, oc, 2, pa.string()), ("team_id", teams, tc, 4, pa.int64())):
                out[name].append(pa.array(names, kind).take(pa.array(k)) if g & bit else pa.nulls(len(keys), kind))
            out["n"].append(pa.array(n.astype(np.int64)))
        kinds = {"grouping": pa.int32(), "day": pa.string(), "organization_id": pa.string(), "team_id": pa.int64(), "n": pa.int64()}
        return pa.table({k: pa.chunked_array(v, kinds[k]) for k, v in out.items()})

    return run


def cell_names(blocks: DataFrame) -> DataFrame:
    """The distinct cells that blocks list: has_team, day, organization_id, team_id."""
    listed = blocks.select("has_team", "day", F.inline(F.arrays_zip(F.col("orgs").alias("organization_id"), F.col("teams").alias("team_id"))))
    return listed.toDF("has_team", "day", "organization_id", "team_id").distinct()


def _named(cells: DataFrame, groupings: tuple[int, ...]) -> DataFrame:
    """Of each group the organizations and teams that its cells name, where the group itself does not name one: kind 1 or 2, and n.

    A group that names its organization has that one only, so just the others
    are counted, each name once per group; no key gathers more than one name.
    """
    bits = (("day", 1), ("organization_id", 2), ("team_id", 4))
    outside = lambda c: F.lit(None).cast(cells.schema[c].dataType)
    each = [
        F.when(F.col("has_team") if g & 4 else F.lit(True), F.struct(
            F.lit(g).alias("grouping"), *[(F.col(c) if g & b else outside(c)).alias(c) for c, b in bits], F.lit(kind).alias("kind"),
            (F.col("organization_id") if kind == 1 else outside("organization_id")).alias("_org"), (F.col("team_id") if kind == 2 else outside("team_id")).alias("_team"),
        ))
        for g in groupings for kind in (1, 2) if not g & (2, 4)[kind - 1]
    ]
    names = cells.select(F.inline(F.array_compact(F.array(*each)))).where("_org IS NOT NULL OR _team IS NOT NULL").distinct()
    return names.groupBy("grouping", "day", "organization_id", "team_id", "kind").agg(F.count(F.lit(1)).alias("n"))


def merged_counts(blocks: DataFrame, groupings: tuple[int, ...] = (0, 1, 2, 3, 4, 5, 6, 7)) -> DataFrame:
    """Distinct counts for each grouping of day (bit 0), organization (bit 1) and team (bit 2).

    Runs of one hash range are united in one task, at most a range of the whole
    hash space; the counts of the ranges are added afterwards. Groupings by team
    count only rows that have a team attribute (``has_team``).
    """
    keys = ["grouping", "day", "organization_id", "team_id"]
    users = blocks.groupBy("hash_range").applyInArrow(_union_counts(groupings), COUNT_SCHEMA).withColumn("kind", F.lit(0))
    names = _named(cell_names(blocks), groupings)
    parts = users.select(*keys, "kind", "n").unionByName(names.select(*keys, "kind", "n"))
    of = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0))
    own = lambda c, b, n: F.when(F.col("grouping").bitwiseAND(b) > 0, F.col(c).isNotNull().cast("bigint")).otherwise(F.col(n)).alias(n)
    summed = parts.groupBy(*keys).agg(*[of(k).alias(f"distinct_{name}s") for k, name in enumerate(KINDS)])
    counted = summed.select(*keys, "distinct_user_ids", own("organization_id", 2, "distinct_organization_ids"), own("team_id", 4, "distinct_team_ids"))
    error = lambda c: F.col(c).cast("double") * (F.col(c).cast("double") - 1.0) / F.lit(float(2**65))
    return counted.select(
        (F.col("grouping").bitwiseAND(1) > 0).alias("by_day"),
        (F.col("grouping").bitwiseAND(2) > 0).alias("by_organization"),
        (F.col("grouping").bitwiseAND(4) > 0).alias("by_team"),
        "day",
        "organization_id",
        "team_id",
        *[f"distinct_{name}s" for name in KINDS],
        *[error(f"distinct_{name}s").alias(f"{name}s_error_bound") for name in KINDS],
    )


def usage_hashes(users: DataFrame, teams: DataFrame) -> DataFrame:
    """Hashes of the user identifiers of both reports with the cell of their row.

    The users report has no team, so its rows take part in groupings without a
    team only. Repeated rows are dropped map-side first: an identifier that holds
    a large part of all rows reaches its hash range once per cell and task.
    """
    no_team = F.lit(None).cast("bigint")
    h = F.when(F.col("user_id").isNotNull(), F.xxhash64("user_id")).alias("h")
    u = users.select(F.lit(False).alias("has_team"), "day", "organization_id", no_team.alias("team_id"), h)
    t = teams.select(F.lit(True).alias("has_team"), "day", "organization_id", F.col("team_id").cast("bigint"), h)
    return u.unionByName(t).distinct()


def usage_blocks(users: DataFrame, teams: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Blocks of both reports, with enough hash ranges for their number of rows."""
    rows = users.count() + teams.count()
    return build_blocks(usage_hashes(users, teams), buckets_for(rows, rows_per_range))
