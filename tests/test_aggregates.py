import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from samples import SALE_TOTALS, SALES

from tidemark import session
from tidemark.operators import aggregates
from tidemark.operators.running import hot_keys, running
from tidemark.operators.stateless import peek, rekey, rekey_by_number, with_key

SCHEMA = "key string, value long, partition int, offset long"


@pytest.fixture(scope="module")
def sales(spark):
    records = [(title, amount, 0, i) for i, (title, _, amount) in enumerate(SALES)]
    return spark.createDataFrame(records, SCHEMA).cache()


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the records have one key; offsets have gaps and go below zero."""
    draw = random.Random(7)
    records = []
    for partition in range(3):
        for offset in sorted(draw.sample(range(-500, 3000), 200)):
            key = "hot" if draw.random() < 0.5 else f"k{draw.randrange(40)}"
            records.append((key, draw.randrange(-50, 100), partition, offset))
    draw.shuffle(records)
    return records, spark.createDataFrame(records, SCHEMA).cache()


def replay(records, step, first=None):
    """What a record-at-a-time engine would emit."""
    state, out = dict(first or {}), []
    for key, value, partition, offset in sorted(records, key=lambda r: (r[2], r[3])):
        state[key] = step(state.get(key), value)
        out.append((key, partition, offset, state[key]))
    return sorted(out, key=repr)


STEPS = {
    "sum": lambda old, new: (old or 0) + new,
    "count": lambda old, new: (old or 0) + 1,
    "max": lambda old, new: new if old is None else max(old, new),
    "min": lambda old, new: new if old is None else min(old, new),
}


def test_totals(sales):
    assert dict(rows(aggregates.grouped(sales))) == SALE_TOTALS


def test_changelog_of_totals(sales):
    found = rows(aggregates.changelog(sales), "offset", "key", "value")
    of = lambda title: [v for _, k, v in sorted(found) if k == title]
    assert len(found) == len(SALES)
    assert of("Die Hard") == [2, 26]
    assert of("The Godfather") == [4, 22, 58, 76]
    assert of("ZZZ") == [18, 36]
    assert of("The Big Lebowski") == [12, 24]


@pytest.mark.parametrize("widths", [(1 << 20,), (7,), (1,), (5, 50), (3, 30, 300)])
def test_running_equals_replay_whatever_the_blocks(skewed, widths):
    records, df = skewed
    measures = {how: (how, None if how == "count" else "value") for how in STEPS}
    found = running(
        df, ["key"], ["partition", "offset"], measures, block_on="offset", widths=widths
    ).collect()
    for how, step in STEPS.items():
        got = sorted(((r["key"], r["partition"], r["offset"], r[how]) for r in found), key=repr)
        assert got == replay(records, step)


@pytest.mark.parametrize("widths", [(1 << 20,), (7,), (5, 50)])
@pytest.mark.parametrize("limit", [0, 6, 100, 10_000])
def test_only_hot_keys_are_cut(skewed, limit, widths):
    records, df = skewed
    hot = hot_keys(df, ["key"], limit)
    if limit == 100:
        assert rows(hot) == [("hot",)]
    found = running(
        df,
        ["key"],
        ["partition", "offset"],
        {"value": ("sum", "value")},
        block_on="offset",
        widths=widths,
        hot=hot,
    )
    assert rows(found, "key", "partition", "offset", "value") == replay(records, STEPS["sum"])


@pytest.mark.parametrize("widths", [(1 << 20,), (5, 50)])
def test_running_goes_on_from_given_totals(spark, skewed, widths):
    records, df = skewed
    first = {"hot": 1000, "k1": -5, "never seen": 3}
    start = spark.createDataFrame(list(first.items()), "key string, value long")
    found = running(
        df,
        ["key"],
        ["partition", "offset"],
        {"value": ("sum", "value")},
        block_on="offset",
        widths=widths,
        start=start,
    )
    assert rows(found, "key", "partition", "offset", "value") == replay(records, STEPS["sum"], first)


@pytest.mark.parametrize("how", sorted(STEPS))
def test_compacted_changelog_is_the_table(skewed, how):
    _, df = skewed
    changes = aggregates.changelog(df, how)
    table = aggregates.compact(changes, ["partition", "offset"])
    assert rows(table, "key", "value") == rows(aggregates.grouped(df, how), "key", "value")


def test_records_without_a_key_are_left_out(spark):
    df = spark.createDataFrame([("a", 1, 0, 0), (None, 5, 0, 1), ("a", 2, 0, 2)], SCHEMA)
    assert rows(aggregates.grouped(df)) == [("a", 3)]
    assert rows(aggregates.changelog(df), "key", "value") == [("a", 1), ("a", 3)]
    assert with_key(df).count() == 2


def test_null_amounts_do_not_change_a_total(spark):
    df = spark.createDataFrame([("a", 1, 0, 0), ("a", None, 0, 1), ("a", 2, 0, 2)], SCHEMA)
    assert rows(aggregates.changelog(df), "offset", "value") == [(0, 1), (1, 1), (2, 3)]


def test_overflow_raises(spark):
    df = spark.createDataFrame([("a", 2**63 - 1, 0, 0), ("a", 1, 0, 1)], SCHEMA)
    with pytest.raises(Exception, match="(?i)overflow"):
        aggregates.grouped(df).collect()


def test_rekeying(sales):
    assert rekey(sales, "offset").first().key == 0
    moved = rekey(sales, F.col("offset").cast("string"), F.col("value") * 2).orderBy("offset").first()
    assert (moved.key, moved.value) == ("0", 4)
    assert rekey_by_number(sales, "offset").orderBy("offset").first().key == "0"


def test_peek_leaves_rows_alone(sales):
    assert rows(peek(sales, "seen")) == rows(sales)


def test_records_without_an_order_are_an_error(spark):
    df = spark.createDataFrame([("a", 1, None)], "key string, value long, offset long")
    with pytest.raises(Exception, match="offset is null"):
        aggregates.changelog(df, order=["offset"]).collect()


def test_stored_tables_go_with_their_owner(spark):
    import os

    with session.scratch(spark):
        stored = session.written(spark.range(3), "owned")
        folder = os.path.dirname(stored.inputFiles()[0].removeprefix("file://"))
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
