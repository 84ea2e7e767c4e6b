import random
from datetime import datetime, timedelta

import pytest
from conftest import at, rows
from samples import SALES

from tidemark.operators import windows
from tidemark.plans import ticket_sales

EPOCH = datetime(1970, 1, 1)
MINUTE = timedelta(minutes=1)
SCHEMA = "key string, value long, ts timestamp, partition int, offset long"


@pytest.fixture(scope="module")
def sales(spark):
    records = [
        (title, amount, datetime.fromisoformat(when[:-1]), 0, i)
        for i, (title, when, amount) in enumerate(SALES)
    ]
    return spark.createDataFrame(records, SCHEMA).cache()


def clock(hour, minute):
    return datetime(2019, 7, 18, hour, minute)


def final(df, size, grace=timedelta(0), how="sum", partition=("partition",)):
    closed = windows.closings(df, size, grace, partition)
    return windows.tumbling_final(df, closed, size, how, partition)


def test_window_totals(sales):
    found = {(r.window_start, r.key): r.value for r in windows.tumbling(sales, MINUTE).collect()}
    assert found == {
        (clock(10, 1), "Die Hard"): 26,
        (clock(10, 1), "The Godfather"): 4,
        (clock(10, 2), "The Godfather"): 18,
        (clock(11, 3), "The Big Lebowski"): 24,
        (clock(11, 40), "AAA"): 1,
        (clock(11, 40), "BBB"): 4,
        (clock(11, 40), "The Godfather"): 54,
        (clock(11, 40), "ZZZ"): 36,
    }


def test_final_results_of_one_partition(sales):
    assert rows(final(sales, MINUTE), "window_start", "window_end", "key", "value") == sorted(
        [
            (clock(10, 1), clock(10, 2), "Die Hard", 26),
            (clock(10, 1), clock(10, 2), "The Godfather", 4),
            (clock(10, 2), clock(10, 3), "The Godfather", 18),
        ],
        key=repr,
    )


def test_late_records_of_one_partition(sales):
    found = windows.late(sales, windows.closings(sales, MINUTE), MINUTE)
    assert rows(found, "offset", "key", "window_start") == [
        (5, "The Big Lebowski", clock(11, 3)),
        (6, "The Big Lebowski", clock(11, 3)),
    ]


def test_grace_decides_whether_the_old_window_is_still_open(sales):
    # Stream time is 11:40:09 when the two sales of the window ending 11:04 arrive.
    closed = windows.closings(sales, MINUTE, timedelta(minutes=36))
    assert windows.late(sales, closed, MINUTE).count() == 2
    closed = windows.closings(sales, MINUTE, timedelta(minutes=37))
    assert windows.late(sales, closed, MINUTE).count() == 0


def test_a_record_at_the_end_opens_the_next_window(spark):
    df = spark.createDataFrame(
        [("a", 1, at(0), 0, 0), ("a", 2, at(59.999999), 0, 1), ("a", 4, at(60), 0, 2)], SCHEMA
    )
    assert rows(windows.tumbling(df, MINUTE), "window_start", "value") == [(at(0), 3), (at(60), 4)]
    assert rows(final(df, MINUTE), "window_start", "value") == [(at(0), 3)]


def test_windows_before_the_epoch_are_aligned_too(spark):
    df = spark.createDataFrame(
        [("a", 1, datetime(1969, 12, 31, 23, 59, 30), 0, 0), ("a", 2, datetime(1970, 1, 1), 0, 1)], SCHEMA
    )
    assert rows(final(df, MINUTE), "window_start", "value") == [(datetime(1969, 12, 31, 23, 59), 1)]


@pytest.fixture(scope="module")
def disorder(spark):
    """Times that jump back and forth; one partition holds most records."""
    draw = random.Random(11)
    records = []
    for i in range(600):
        partition = 0 if draw.random() < 0.7 else draw.randrange(1, 4)
        moment = max(0, i * 2 + draw.randrange(-200, 200))
        records.append((f"k{draw.randrange(5)}", draw.randrange(100), at(moment), partition, i))
    return records, spark.createDataFrame(records, SCHEMA).repartition(5).cache()


def replay(records, size, grace):
    """Apply the rules record by record: (late offsets, final totals, stream times)."""
    stream_time, late, kept, times = {}, [], {}, []
    for key, value, ts, partition, offset in sorted(records, key=lambda r: (r[3], r[4])):
        now = max(stream_time.get(partition, ts), ts)
        stream_time[partition] = now
        times.append((offset, now))
        start = EPOCH + (ts - EPOCH) // size * size
        if start + size + grace <= now:
            late.append((offset,))
        else:
            where = (partition, start, key)
            kept[where] = kept.get(where, 0) + value
    final = [
        (*where, total)
        for where, total in kept.items()
        if where[1] + size + grace <= stream_time[where[0]]
    ]
    return sorted(late, key=repr), sorted(final, key=repr), sorted(times, key=repr)


@pytest.mark.parametrize("grace", [0, 1, 45, 60, 150])
@pytest.mark.parametrize("size", [7, 60])
def test_rules_hold_for_any_grace(disorder, size, grace):
    records, df = disorder
    size, grace = timedelta(seconds=size), timedelta(seconds=grace)
    late, totals, _ = replay(records, size, grace)
    closed = windows.closings(df, size, grace)
    assert rows(windows.late(df, closed, size), "offset") == late
    found = windows.tumbling_final(df, closed, size)
    assert rows(found, "partition", "window_start", "key", "value") == totals


@pytest.mark.parametrize("widths", [(1 << 20,), (16,), (4, 64)])
def test_stream_time(disorder, widths):
    records, df = disorder
    *_, times = replay(records, MINUTE, timedelta(0))
    assert rows(windows.stream_time(df, widths=widths), "offset", "stream_time") == times


def test_stream_time_of_each_key(disorder):
    records, df = disorder
    by_key = [(k, v, ts, k, o) for k, v, ts, _, o in records]
    late, totals, _ = replay(by_key, MINUTE, timedelta(0))
    closed = windows.closings(df, MINUTE, partition=["key"])
    assert rows(windows.late(df, closed, MINUTE, partition=["key"]), "offset") == late
    found = windows.tumbling_final(df, closed, MINUTE, partition=["key"])
    assert found.columns == ["window_start", "window_end", "key", "value"]
    wanted = sorted(((start, key, total) for _, start, key, total in totals), key=repr)
    assert rows(found, "window_start", "key", "value") == wanted


def test_counts_instead_of_sums(disorder):
    records, df = disorder
    ones = [(k, 1, ts, p, o) for k, _, ts, p, o in records]
    _, totals, _ = replay(ones, MINUTE, timedelta(0))
    found = final(df, MINUTE, how="count")
    assert rows(found, "partition", "window_start", "key", "value") == totals


def test_record_order_needs_partitions(sales):
    with pytest.raises(ValueError):
        windows.stream_time(sales, partition=())
    with pytest.raises(ValueError):
        windows.closings(sales, MINUTE, partition=())


def test_closed_windows_as_messages(sales):
    row = {"window_start": at(0), "window_end": at(60), "key": "a", "value": 3}
    df = sales.sparkSession.createDataFrame([row], "window_start timestamp, window_end timestamp, key string, value long")
    sent = ticket_sales.minute_messages(df).first()
    assert sent.key == "a"
    assert sent.value == (
        '{"window_start":"2024-01-01T00:00:00.000Z","window_end":"2024-01-01T00:01:00.000Z","value":3}'
    )


def test_emission_time_is_added(sales):
    found = windows.emitted(windows.tumbling(sales, MINUTE))
    assert found.columns == ["window_start", "window_end", "key", "value", "emitted_at"]
    assert found.first().emitted_at is not None


def test_records_without_a_key_close_nothing(spark):
    records = [("a", 1, at(0), 0, 0), (None, 1, at(300), 0, 1), ("a", 2, at(5), 0, 2)]
    df = spark.createDataFrame(records, "key string, value long, ts timestamp, partition int, offset long")
    minute = timedelta(minutes=1)
    closed = windows.closings(df, minute)
    assert rows(closed) == []
    assert rows(windows.late(df, closed, minute)) == []
    assert rows(windows.tumbling_final(df, closed, minute)) == []
