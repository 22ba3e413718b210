import random

import pytest
from pyspark.sql import functions as F

from llm_helpers import docs_of, python_nodes  # noqa: F401
from report_lake.llm import mixing as M


def edf(units):
    """Brute force: in every slot serve the released block with the earliest deadline."""
    length, served, out = sum(units.values()), dict.fromkeys(units, 0), []
    for t in range(length):
        ready = [(-(-(i + 1) * length // units[s]), s) for s, i in served.items() if i < units[s] and i * length // units[s] <= t]
        s = min(ready)[1]
        out.append(s)
        served[s] += 1
    return out


def test_period_is_earliest_deadline_first_and_within_one_block():
    rng = random.Random(4)
    for _ in range(30):
        units = {f"s{i}": rng.randrange(1, 60) for i in range(rng.randrange(1, 9))}
        slots = M.period(units)
        length = sum(units.values())
        order = [None] * length
        for s, at in slots.items():
            for t in at:
                order[t] = s
        assert order == edf(units)
        for s, u in units.items():
            for t in range(length + 1):
                assert abs(sum(x < t for x in slots[s]) - u * t / length) < 1
            assert all(i * length // u <= t < -(-(i + 1) * length // u) for i, t in enumerate(slots[s]))


def test_schedule_serves_every_block_once():
    rng = random.Random(6)
    for _ in range(20):
        blocks = {f"s{i}": rng.randrange(0, 200) for i in range(6)}
        plan = M.schedule(blocks, {s: rng.random() + 0.01 for s in blocks}, 100)
        slots, seen = [], dict.fromkeys(blocks, 0)
        for x in plan:
            assert x["first"] == seen[x["key"]]
            seen[x["key"]] = x["last"]
            slots += [x["base"] + i // x["units"] * x["length"] + x["pattern"][i % x["units"]] for i in range(x["last"] - x["first"])]
        assert seen == blocks and sorted(slots) == list(range(sum(blocks.values())))


def test_large_plans_are_joined_slot_by_slot(spark, monkeypatch):
    df = spark.range(900).select("id", F.concat(F.lit("s"), F.col("id") % 7 % 4).alias("source"))
    want = sorted(tuple(r) for r in M.mix(df, block_rows=8).collect())
    monkeypatch.setattr(M, "BROADCAST_BYTES", 0)
    assert sorted(tuple(r) for r in M.mix(df, block_rows=8).collect()) == want


@pytest.mark.parametrize("longest", [1 << 20, 1 << 14])
def test_deviation_from_the_true_targets(monkeypatch, longest):
    monkeypatch.setattr(M, "LONGEST", longest)
    weights = {"a": 2**0.5, "b": 1 / 3, "c": 0.00037, "d": 0.00002} | {f"s{i}": 0.0003 for i in range(300)}
    whole = sum(weights.values())
    blocks = {s: int(60_000 * w / whole) + 5 for s, w in weights.items()}
    plan = [x for x in M.schedule(blocks, weights) if x["phase"] == 0]
    at = {x["key"]: sorted(x["base"] + i // x["units"] * x["length"] + x["pattern"][i % x["units"]] for i in range(x["last"] - x["first"])) for x in plan}
    end = sum(map(len, at.values()))
    assert end > 20_000
    room = 0.001 if longest > end else 1 + end / longest  # units of a repeated period are rounded
    for s, w in weights.items():
        for i, t in enumerate(at.get(s, [])):
            assert abs(i - t * w / whole) < 1 + room and abs(i + 1 - (t + 1) * w / whole) < 1 + room
        assert abs(len(at.get(s, [])) - end * w / whole) < 1 + room


@pytest.mark.parametrize("targets", [None, {"s0": 0.7, "s1": 0.2, "s2": 0.1}])
def test_rows_follow_the_schedule(spark, targets):
    df = spark.range(2000).select("id", F.when(F.col("id") < 900, "s0").when(F.col("id") < 1500, "s1").otherwise("s2").alias("source")).repartition(5)
    out = M.mix(df, targets=targets, block_rows=8, rows_per_range=100, full=True)
    assert not python_nodes(out)
    got = sorted(out.collect(), key=lambda r: r["position"])
    assert sorted(r["id"] for r in got) == list(range(2000)) and [r["position"] for r in got] == list(range(2000))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    assert [r["slot"] for r in got] == sorted(r["slot"] for r in got)
    if targets:
        phase = [r for r in got if r["phase"] == 0]
        for n in range(0, len(phase), 50):
            share = {s: sum(r["source"] == s for r in phase[:n]) for s in targets}
            assert all(abs(share[s] - w * n) <= 2 * 8 for s, w in targets.items())


def test_edges(docs_of):
    rows = [(1, None, "en", None), (1, None, "en", None), (2, "", "en", "a"), (None, "x", None, "a"), (3, "y" * 100000, "en", "b"), (4, "z", "en", "")]
    docs = docs_of(rows).withColumn("key", F.lit("k")).withColumn("_draw", F.lit(1)).withColumn("Position", F.lit(9))
    got = M.mix(docs, block_rows=2).collect()
    assert sorted(r["position"] for r in got) == list(range(6))
    assert sorted(r["position"] for r in M.mix(docs, targets={"a": 1.0, None: 3.0, "gone": 2.0}, block_rows=1).collect()) == list(range(6))
    assert M.mix(docs_of([])).count() == 0
    with pytest.raises(ValueError):
        M.mix(docs, max_sources=2)
