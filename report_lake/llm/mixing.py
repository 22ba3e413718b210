"""Mixing sources to target weights by Pfair scheduling.

The rows of each source are put in a hash order and cut into blocks of
``block_rows``. One block is served a slot. With weights u / L (integers u that
add up to L), block i of a source may be served from its release time
floor(i L / u) until its deadline ceil((i + 1) L / u); among the released blocks
the earliest deadline goes first. At every point each source has then received
its share to less than one block. L is 2^30 (a source's share is off by less
than 2^-30), and the slots of a phase are scheduled once, on block counts: no
row passes the scheduler. A phase of more than 2^20 slots takes L = 2^20 and
repeats after L slots; any block's slot follows by arithmetic. There a
source's unit, rounded by less than one, adds up to 2^-20 of the slots to the
deviation (the largest source also gives the units of those below one).

When a source runs out, a new phase begins: the others go on with their weights
in proportion. Every row is placed exactly once; none is dropped or repeated.

Targets: ``targets`` (source -> weight) or, if None, the source's rows to the
power ``alpha``. A source without a target gets the smallest weight. Null
sources count as one source. The number of sources is checked against ``max_sources`` because the
plan holds a row for each source and phase.

Only DataFrame functions touch rows. A hot source is ranked over sub-ranges of
its hash order. Equal rows are interchangeable; ties are broken by a hash of
all columns. An empty table gives an empty table. Extra columns are kept; one
with the name of an output column is replaced.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh
from .sharding import literal_frame

#: Parts of the weights in a phase that is scheduled whole, and its most slots.
PARTS, LONGEST = 1 << 30, 1 << 20
BROADCAST_BYTES = 16 << 20
NO_SOURCE = "\u0000"


def period(units: dict[str, int]) -> dict[str, list[int]]:
    """Slots of each source in one period of sum(units) slots, earliest deadline first."""
    length = sum(units.values())
    pending = [(0, s, 0) for s in sorted(units)]  # by release time
    heapq.heapify(pending)
    ready: list[tuple[int, str, int]] = []  # by deadline
    out: dict[str, list[int]] = {s: [] for s in units}
    for t in range(length):
        while pending and pending[0][0] <= t:
            _, s, i = heapq.heappop(pending)
            heapq.heappush(ready, (-(-(i + 1) * length // units[s]), s, i))
        _, s, i = heapq.heappop(ready)
        out[s].append(t)
        if i + 1 < units[s]:
            heapq.heappush(pending, ((i + 1) * length // units[s], s, i + 1))
    return out


def apportion(weights: dict[str, float], parts: int) -> dict[str, int]:
    """Integers in proportion to the weights, at least one each, that add up to ``parts``
    (or to more if there are more sources): largest remainders first."""
    whole = sum(weights.values()) or 1.0
    exact = {s: parts * w / whole for s, w in weights.items()}
    units = {s: max(1, int(x)) for s, x in exact.items()}
    over = sum(units.values()) - parts
    for s in sorted(exact, key=lambda s: (units[s] - exact[s], s))[: max(0, -over)]:
        units[s] += 1
    for s in sorted(units, key=lambda s: (-units[s], s)):
        if over <= 0:
            break
        less = min(over, units[s] - 1)
        units[s], over = units[s] - less, over - less
    return units


def first_slots(units: dict[str, int], left: dict[str, int], most: int) -> tuple[dict[str, list[int]], int] | None:
    """Slots of each source, earliest deadline first, until one has had all the
    blocks it has left, and the number of slots; None if that takes more than ``most``."""
    length = sum(units.values())
    pending = [(0, s, 0) for s in sorted(units)]
    ready: list[tuple[int, str, int]] = []
    out: dict[str, list[int]] = {s: [] for s in units}
    for t in range(most):
        while pending and pending[0][0] <= t:
            _, s, i = heapq.heappop(pending)
            heapq.heappush(ready, (-(-(i + 1) * length // units[s]), s, i))
        _, s, i = heapq.heappop(ready)
        out[s].append(t)
        if i + 1 == left[s]:
            return out, t + 1
        heapq.heappush(pending, ((i + 1) * length // units[s], s, i + 1))
    return None


def schedule(blocks: dict[str, int], weights: dict[str, float], resolution: int = 1000) -> list[dict]:
    """Segments of the plan: for each phase and source, which blocks it serves and how.

    ``pattern`` holds the source's slots in a period; block first + i is served
    in slot base + (i // u) * length + pattern[i % u]. A phase of up to ``LONGEST``
    slots is scheduled whole, by weights of ``PARTS`` parts; a longer one repeats
    a period of ``LONGEST`` (or ``resolution``, if more) parts.
    """
    left, done, base, phase, out = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0, 0, []
    while left:
        mine = {s: weights[s] for s in left}
        now = apportion(mine, PARTS)
        length = sum(now.values())
        # a source is not done before its blocks' last release: phases known to be longer are not tried
        found = first_slots(now, left, LONGEST) if min((n - 1) * length // now[s] for s, n in left.items()) < LONGEST else None
        if found:
            slots, end = found
        else:
            now = apportion(mine, max(resolution, LONGEST))
            length = sum(now.values())
            slots = period(now)
            last = lambda s: (left[s] - 1) // now[s] * length + slots[s][(left[s] - 1) % now[s]] + 1
            end = min(map(last, left))
        for s in sorted(left):
            n = min(left[s], end // length * now[s] + bisect_left(slots[s], end % length))
            if n:
                out.append({"key": s, "phase": phase, "first": done[s], "last": done[s] + n, "base": base, "units": now[s], "length": length, "pattern": slots[s]})
            done[s] += n
            left[s] -= n
        left = {s: n for s, n in left.items() if n}
        base, phase = base + end, phase + 1
    return out


def mix(
    df: DataFrame, source: str = "source", targets: dict | None = None, alpha: float = 0.5, block_rows: int = 16, resolution: int = 1000, seed: int = 23,
    rows_per_range: int = 1 << 18, max_sources: int = 5000, full: bool = False,
) -> DataFrame:
    """``df`` with ``position``, the row's place in the mixture (gapless from 0).

    ``full`` adds phase, block, slot, release and deadline.
    """
    spark, c = df.sparkSession, fresh(df, "key", "draw", "tie", "sub", "n", "rank", "block", "first", "last", "base", "units", "length", "pattern", "phase", "slot", "i", "late", "nth")
    g = {k: f"`{v}`" for k, v in c.items()}
    keyed = df.withColumn(c["key"], F.coalesce(F.col(source).cast("string"), F.lit(NO_SOURCE)))
    counts = {r[c["key"]]: r["n"] for r in keyed.groupBy(c["key"]).agg(F.count(F.lit(1)).alias("n")).limit(max_sources + 1).collect()}
    if len(counts) > max_sources:
        raise ValueError(f"more than {max_sources} sources: group them first, or raise max_sources")
    if targets is None:
        weights = {s: n**alpha for s, n in counts.items()}
    else:
        given = {NO_SOURCE if k is None else str(k): float(v) for k, v in targets.items() if v > 0}
        weights = {s: given.get(s, min(given.values(), default=1.0)) for s in counts}
    plan = schedule({s: -(-n // block_rows) for s, n in counts.items()}, weights, resolution)
    # a source's last block may be short: rows after its slot stand that much earlier
    short = []
    for x in plan:
        n = counts[x["key"]]
        if x["last"] == -(-n // block_rows) and n % block_rows:
            i = x["last"] - 1 - x["first"]
            short.append((x["base"] + i // x["units"] * x["length"] + x["pattern"][i % x["units"]], block_rows - n % block_rows))
    short.sort()
    late, gaps = 0, []
    for slot, missing in short:
        late += missing
        gaps.append({"slot": slot, "late": late})
    names = ("key", "phase", "first", "last", "base", "units", "length", "pattern")
    segments = literal_frame(
        spark, [{c[k]: x[k] for k in names} for x in plan],
        ", ".join(f"{g[k]} {t}" for k, t in zip(names, ("string", "int", "bigint", "bigint", "bigint", "int", "int", "array<int>"))),
    )
    # one entry a block up to LONGEST slots a phase; only a small plan is broadcast
    small = sum(len(x["pattern"]) + 8 for x in plan) * 4 <= BROADCAST_BYTES

    columns = [F.col(f"`{x}`") for x in df.columns]
    n_sub = max(1, -(-sum(counts.values()) // rows_per_range))
    n_sub = max(n_sub, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranked = (
        keyed.withColumn(c["tie"], F.xxhash64(*columns))
        .withColumn(c["draw"], F.shiftrightunsigned(F.xxhash64(F.lit(seed), c["tie"]), 1))
        .withColumn(c["sub"], F.expr(f"cast(shiftright({g['draw']}, 32) * {n_sub} div {1 << 31} as int)"))
    )
    before = W.partitionBy(c["key"]).orderBy(c["sub"]).rowsBetween(W.unboundedPreceding, -1)
    offsets = ranked.groupBy(c["key"], c["sub"]).agg(F.count(F.lit(1)).alias(c["n"])).withColumn(c["n"], F.coalesce(F.sum(c["n"]).over(before), F.lit(0)))
    rank = F.row_number().over(W.partitionBy(c["key"], c["sub"]).orderBy(c["draw"], c["tie"])).cast("long") - 1
    out = (
        ranked.withColumn(c["rank"], rank)
        .join(offsets, [c["key"], c["sub"]])
        .withColumn(c["rank"], F.col(c["rank"]) + F.col(c["n"]))
        .withColumn(c["block"], F.expr(f"{g['rank']} div {block_rows}"))
    )
    out = out.join(F.broadcast(segments) if small else segments.drop(c["pattern"]), c["key"]).filter(f"{g['block']} >= {g['first']} and {g['block']} < {g['last']}")
    out = out.withColumn(c["i"], F.expr(f"{g['block']} - {g['first']}"))
    if small:
        served = f"get({g['pattern']}, cast({g['i']} % {g['units']} as int))"
    else:  # rows meet one slot of the pattern each, not the whole
        slots = segments.select(c["key"], c["phase"], F.posexplode(c["pattern"]).alias(c["nth"], c["pattern"]))
        out = out.withColumn(c["nth"], F.expr(f"cast({g['i']} % {g['units']} as int)")).join(slots, [c["key"], c["phase"], c["nth"]])
        served = g["pattern"]
    out = (
        out.withColumn(c["slot"], F.expr(f"{g['base']} + ({g['i']} div {g['units']}) * {g['length']} + {served}"))
        .withColumn("position", F.expr(f"{g['slot']} * {block_rows} + {g['rank']} % {block_rows}"))
    )
    if gaps:
        # rows after a short block stand earlier by what it lacks (at most one gap a source)
        steps = F.from_json(F.lit(json.dumps(gaps)), "array<struct<slot bigint, late bigint>>")
        passed = F.try_element_at(F.filter(steps, lambda x: x["slot"] < F.col(c["slot"])), F.lit(-1))["late"]
        out = out.withColumn("position", F.col("position") - F.coalesce(passed, F.lit(0)))
    if full:
        out = (
            out.withColumn("phase", F.col(c["phase"])).withColumn("block", F.col(c["block"])).withColumn("slot", F.col(c["slot"]))
            .withColumn("release", F.expr(f"{g['base']} + ({g['i']} * {g['length']}) div {g['units']}"))
            .withColumn("deadline", F.expr(f"{g['base']} + (({g['i']} + 1) * {g['length']} + {g['units']} - 1) div {g['units']}"))
        )
    return out.drop(*(c[k] for k in c))
