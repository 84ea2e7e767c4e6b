"""Resharding: the fewest bytes move, groups stay whole, untouched files stay as they are."""

from __future__ import annotations

import itertools
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import reshard


def cheapest(supply: list[int], capacity: list[int], cost) -> int:
    """The least cost of all ways to send whole units."""
    if not supply:
        return 0
    best = None
    for parts in itertools.product(*[range(min(supply[0], c) + 1) for c in capacity]):
        if sum(parts) != supply[0]:
            continue
        rest = cheapest(supply[1:], [c - p for c, p in zip(capacity, parts, strict=True)], lambda o, n: cost(o + 1, n))
        if rest is not None:
            total = rest + sum(p * cost(0, n) for n, p in enumerate(parts))
            best = total if best is None else min(best, total)
    return best


def test_the_flow_is_the_cheapest():
    rng = random.Random(4)
    for _ in range(60):
        supply = [rng.randint(0, 4) for _ in range(rng.randint(1, 3))]
        capacity = [rng.randint(0, 4) for _ in range(rng.randint(1, 3))]
        capacity[0] += max(0, sum(supply) - sum(capacity))
        table = [[rng.randint(0, 3) for _ in capacity] for _ in supply]
        flow = reshard.minimum_cost_flow(dict(enumerate(supply)), dict(enumerate(capacity)), lambda o, n: table[o][n])
        for o, s in enumerate(supply):
            assert sum(v for (a, _), v in flow.items() if a == o) == s
        for n, c in enumerate(capacity):
            assert sum(v for (_, b), v in flow.items() if b == n) <= c
        assert sum(v * table[o][n] for (o, n), v in flow.items()) == cheapest(supply, capacity, lambda o, n: table[o][n])


def files(folder) -> dict[str, tuple]:
    found = {}
    for top, _, names in os.walk(folder):
        for name in names:
            path = os.path.join(top, name)
            with open(path, "rb") as file:
                found[path] = (os.stat(path).st_mtime_ns, file.read())
    return found


def made(spark, texts):
    rows = [(i, t, f"mine{i}", i % 3, -i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, slot string, old int, `b0` int")


def of_text(shards):
    return F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(shards)).cast("int")


def test_few_bytes_move_and_other_files_stay(spark, tmp_path):
    rng = random.Random(6)
    texts = [f"{rng.random()}" * rng.randint(1, 9) for _ in range(2000)]
    texts += [rng.choice(texts) for _ in range(500)] + ["frequent " * 3] * 200 + [None, "", None]
    docs = made(spark, texts)
    layout = reshard.lay_out(docs, of_text(3), f"{tmp_path}/old")
    before = files(tmp_path / "old")
    moves = reshard.planned(layout, 5)
    found = reshard.resharded(layout, 5).collect()
    assert files(tmp_path / "old") == before

    assert sorted(r["doc_id"] for r in found) == list(range(len(texts)))
    assert all(r["text"] == texts[r["doc_id"]] and r["old"] == r["doc_id"] % 3 and r["b0"] == -r["doc_id"] for r in found)
    size = {i: len(t or "") + 1 for i, t in enumerate(texts)}
    old = {r["doc_id"]: r["shard"] for r in docs.select("doc_id", of_text(3).alias("shard")).collect()}
    homes, slots, sizes = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in found:
        homes[r["text"] or ""].add(r["shard_no"])
        slots[r["shard_no"]].append(r["slot"])
        sizes[r["shard_no"]] += size[r["doc_id"]]
    assert all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(sum(size[i] for i, t in enumerate(texts) if t == text) for text in set(texts))
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
    # The optimum: what an old shard holds beyond a new one's capacity has to go.
    supply = defaultdict(int)
    for i in size:
        supply[old[i]] += size[i]
    total = sum(size.values())
    optimum = sum(max(0, s - (total // 5 + (o < total % 5))) for o, s in supply.items())
    assert sum(v for (o, n), v in moves.flow.items() if o != n) == optimum
    moved = sum(size[r["doc_id"]] for r in found if r["shard_no"] != old[r["doc_id"]])
    assert abs(moved - optimum) <= 5 * largest
    # Files of ranges in which nothing leaves are not rewritten.
    assert 0 < len(moves.places) < 3 * layout.parts and len(slots) == 5


def test_only_a_group_beyond_a_whole_shard_is_split(spark, tmp_path):
    texts = ["copy"] * 900 + [f"t{i}" for i in range(300)]
    layout = reshard.lay_out(made(spark, texts), F.lit(0), f"{tmp_path}/old")
    found = reshard.resharded(layout, 4).collect()
    sizes, homes = defaultdict(int), defaultdict(set)
    for r in found:
        sizes[r["shard_no"]] += len(r["text"]) + 1
        homes[r["text"]].add(r["shard_no"])
    assert len(found) == 1200 and max(sizes.values()) - min(sizes.values()) <= 0.05 * sum(sizes.values())
    assert [t for t, h in homes.items() if len(h) > 1] == ["copy"]


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows_repeated_rows_and_no_rows(spark, tmp_path, n):
    docs = spark.createDataFrame([(None, "a" * 100_000)] * n, "doc_id long, text string")
    layout = reshard.lay_out(docs, of_text(2), f"{tmp_path}/old")
    found = reshard.resharded(layout, 2).collect()
    assert len(found) == n and all(r["text"] == "a" * 100_000 for r in found)
    assert len({(r["shard_no"], r["slot"]) for r in found}) == n
