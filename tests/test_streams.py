import os
from datetime import timedelta

import pytest
from conftest import at, rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from samples import LINES, MOVIES, RATINGS, SALES, WORD_COUNTS

from tidemark import session
from tidemark.functions.records import TICKET_SALE
from tidemark.operators import aggregates, joins, windows
from tidemark.operators.stateless import peek
from tidemark.plans import rated_movies, ticket_sales, word_count
from tidemark.streaming import changelog, fan_out, replay, sinks
from tidemark.streaming.batches import Carried, Results

MINUTE = timedelta(minutes=1)
LINE = "key string, value string, ts timestamp, topic string, partition int, offset long"
SALE = "key string, value long, ts timestamp, partition int, offset long"


def lines(*texts, first=0):
    return [(None, text, at(first + i), "lines", 0, first + i) for i, text in enumerate(texts)]


def finish(df, sink, root, name, mode="append"):
    query = sinks.start(
        df, sink, name=name, checkpoint=f"{root}/progress-{name}", mode=mode, every=None
    )
    return sinks.drain(query)


def appended(df, root, name):
    finish(df, sinks.to_parquet(f"{root}/{name}"), root, name)
    return df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}")


def test_word_count_goes_on_after_a_restart(spark, feed, tmp_path):
    source = feed(LINE).add(lines(LINES[0]), lines(LINES[1], first=1))

    def run():
        query = word_count.start(
            source.stream(),
            sinks.to_updates(f"{tmp_path}/updates"),
            checkpoint=f"{tmp_path}/progress",
            every=None,
        )
        sinks.drain(query)
        return dict(rows(sinks.latest_of_updates(spark, f"{tmp_path}/updates")))

    assert run()["kafka"] == 2
    source.add(lines(LINES[2], first=2))
    assert run() == WORD_COUNTS
    assert run() == WORD_COUNTS
    assert rows(word_count.counts(source.table())) == sorted(WORD_COUNTS.items(), key=repr)


def test_a_word_count_reads_each_key_once_a_batch(spark, feed, tmp_path):
    before = {key: spark.conf.get(key, None) for key in session.MANY_KEYS}
    source = feed(LINE).add(lines("a b b c"), lines("a d", first=1))
    query = word_count.start(
        source.stream(), sinks.to_updates(f"{tmp_path}/updates"), checkpoint=f"{tmp_path}/progress", every=None
    )
    sinks.drain(query)
    states = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]]
    assert [s["numRowsUpdated"] for s in states] == [3, 2]
    assert [s["customMetrics"]["rocksdbGetCount"] for s in states] == [3, 2]
    assert dict(rows(sinks.latest_of_updates(spark, f"{tmp_path}/updates"))) == {"a": 2, "b": 2, "c": 1, "d": 1}
    assert {key: spark.conf.get(key, None) for key in session.MANY_KEYS} == before


@pytest.mark.parametrize("how", ["sum", "count"])
def test_changelog_stream_equals_the_changelog_of_the_table(spark, feed, tmp_path, how):
    sales = [(title, amount, at(i), 0, i) for i, (title, _, amount) in enumerate(SALES)]
    source = feed(SALE).add(sales[:4], sales[4:7])
    root = str(tmp_path / "changes")

    def run():
        sinks.drain(
            changelog.start_changelog(source.stream(), root, name=f"changes-{how}", how=how, every=None)
        )

    run()
    source.add(sales[7:8], sales[8:])
    run()
    found = changelog.read_changelog(spark, root)
    wanted = aggregates.changelog(source.table(), how)
    assert found.select("batch").distinct().count() == 4
    assert rows(found, "key", "offset", "value") == rows(wanted, "key", "offset", "value")
    table = changelog.changelog_table(spark, root)
    assert rows(table, "key", "value") == rows(aggregates.grouped(source.table(), how), "key", "value")


def test_a_repeated_micro_batch_changes_nothing(spark, feed, tmp_path):
    """A batch whose commit was lost runs again, on the totals it started from."""
    sales = [(title, amount, at(i), 0, i) for i, (title, _, amount) in enumerate(SALES)]
    source = feed(SALE).add(sales[:5], sales[5:])
    root = str(tmp_path / "changes")

    def run():
        sinks.drain(changelog.start_changelog(source.stream(), root, name="again", every=None))

    run()
    first = rows(changelog.read_changelog(spark, root))
    for leftover in (tmp_path / "changes" / "progress" / "commits").iterdir():
        if leftover.name in ("1", ".1.crc"):
            leftover.unlink()
    run()
    assert rows(changelog.read_changelog(spark, root)) == first


def test_tables_of_a_changelog_with_several_partitions_and_batches(spark, feed, tmp_path):
    """Batches come one after the other, whatever their partitions and offsets."""
    source = feed(SALE).add(
        [("a", 1, at(0), 0, 100), ("a", 2, at(1), 1, 5)],
        [("a", 4, at(2), 0, 101), ("b", 1, at(2), 3, 9)],
        [("b", 1, at(3), 0, 102)],
        [("a", 8, at(4), 0, 103)],
        [("c", 1, at(5), 1, 6)],
    )
    root = str(tmp_path / "changes")
    query = changelog.start_changelog(source.stream(), root, name="partitions", every=None)
    sinks.drain(query)
    wanted = rows(aggregates.grouped(source.table()), "key", "value")
    assert rows(changelog.changelog_table(spark, root), "key", "value") == wanted
    assert rows(changelog.totals_table(spark, root), "key", "value") == wanted
    assert dict(wanted)["a"] == 15


def test_a_batch_updates_the_state_of_its_own_keys_only(spark, feed, tmp_path):
    many = [(f"k{i}", 1, at(0), 0, i) for i in range(50)]
    source = feed(SALE).add(many, [("k7", 1, at(1), 0, 100), (None, 9, at(1), 0, 101)])
    root = str(tmp_path / "changes")
    query = changelog.start_changelog(source.stream(), root, name="own-keys", every=None)
    sinks.drain(query)
    updated = [p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["numInputRows"]]
    assert updated == [50, 1]
    state = dict(rows(changelog.totals_table(spark, root), "key", "value"))
    assert len(state) == 50 and state["k7"] == 2
    before = sinks.state_table(spark, f"{root}/progress", batch=0)
    assert dict(rows(before, "key", "value"))["k7"] == 1


def test_hot_keys_of_a_stream_are_cut_and_go_on_from_their_totals(spark, feed, tmp_path):
    """Keys over the limit in a batch, under it, with totals from before and without."""
    sales = [(k, i % 7 if i % 5 else None, at(i), i % 2, i) for i, k in enumerate("abaacabadaab" * 6)]
    source = feed(SALE).add(sales[:20], sales[20:23], sales[23:50], sales[50:])
    root = str(tmp_path / "changes")
    query = changelog.start_changelog(
        source.stream(), root, name="hot", order=["offset"], widths=(4, 16), limit=3, every=None
    )
    sinks.drain(query)
    found = rows(changelog.read_changelog(spark, root), "key", "offset", "value")
    assert found == rows(aggregates.changelog(source.table(), order=["offset"]), "key", "offset", "value")


def test_running_totals_with_hot_keys_and_totals_to_start_from(spark):
    records = [(k, i, i) for i, k in enumerate("aababcaadaab" * 5)]
    df = spark.createDataFrame(records, "key string, value long, offset long")
    start = spark.createDataFrame([("a", 100), ("b", 1000), ("z", 5)], "key string, value long")
    hot = spark.createDataFrame([("a",), ("d",)], "key string")
    wanted, totals = [], {"a": 100, "b": 1000}
    for k, v, o in records:
        totals[k] = totals.get(k, 0) + v
        wanted.append((k, o, totals[k]))
    for widths in ((8,), (4, 16)):
        found = aggregates.changelog(df, order=["offset"], widths=widths, hot=hot, start=start)
        assert rows(found, "key", "offset", "value") == sorted(wanted, key=repr)


def test_tables_before_the_first_batch_are_empty(spark, feed, tmp_path):
    assert rows(sinks.latest_of_updates(spark, f"{tmp_path}/none")) == []
    source = feed(SALE).add([])
    root = str(tmp_path / "changes")
    sinks.drain(changelog.start_changelog(source.stream(), root, name="no-batch", every=None))
    assert rows(changelog.changelog_table(spark, root)) == []


def test_a_batch_written_twice_stays_as_it_was(spark, tmp_path):
    table = Results(spark, f"{tmp_path}/table")
    schema = StructType().add("key", "string").add("value", "long")

    def batch(number, *pairs):
        table.write(spark.createDataFrame(list(pairs), schema), number)

    batch(0, ("a", 1), ("b", 1))
    batch(1, ("a", 2))
    batch(1, ("a", 3))
    (tmp_path / "table" / "batch=1" / "_SUCCESS").unlink()  # as if the run had ended while writing
    assert rows(table.read(schema), "key", "value", "batch") == [("a", 1, 0), ("b", 1, 0)]
    batch(1, ("a", 2))
    batch(2, ("b", 5))
    assert rows(sinks.latest_of_updates(spark, f"{tmp_path}/table")) == [("a", 2), ("b", 5)]


def test_what_is_carried_is_the_last_version_before_a_batch(spark, tmp_path):
    schema = StructType().add("key", "string").add("value", "long")
    table = Carried(spark, f"{tmp_path}/table", schema)
    assert table.before(0).count() == 0
    for number in (0, 1, 2, 3):
        table.leave(table.before(number).union(spark.createDataFrame([("k", number)], schema)), number)
    assert sorted(r["value"] for r in table.before(3).collect()) == [0, 1, 2]
    assert table.before(4).count() == 4
    assert sorted(os.listdir(tmp_path / "table")) == ["batch=2", "batch=3"]


def test_words_as_a_row_per_word_on_a_stream(spark, feed, tmp_path):
    source = feed(LINE).add(lines(LINES[0]), lines(LINES[1], first=1), lines(LINES[2], first=2))
    root = str(tmp_path / "changes")
    sinks.drain(word_count.start_changes(source.stream(), root, every=None))
    found = changelog.read_changelog(spark, root)
    wanted = word_count.count_changes(source.table())
    assert rows(found, "key", "offset", "pos", "value") == rows(wanted, "key", "offset", "pos", "value")


def test_a_hot_slot_may_be_salted_in_the_job(spark, feed, tmp_path):
    movies = feed(LINE).add(texts(MOVIES, ["id", "title", "releaseyear"], "movies"))
    ratings = feed(LINE).add(texts(RATINGS, ["id", "rating"], "ratings"), [(None, "broken", at(3), "ratings", 0, 99)])
    queries = rated_movies.start(
        movies.stream(),
        ratings.stream(),
        f"{tmp_path}/movies",
        sinks.to_parquet(f"{tmp_path}/rated"),
        checkpoint_root=str(tmp_path),
        every=None,
        salts=3,
        rejected_sink=sinks.to_parquet(f"{tmp_path}/rejected"),
    )
    for query in queries:
        sinks.drain(query)
    wanted = rated_movies.rated(rated_movies.ratings(ratings.table()), rated_movies.movies(movies.table()))
    assert rows(spark.read.parquet(f"{tmp_path}/rated")) == rows(wanted)
    assert rows(spark.read.parquet(f"{tmp_path}/rejected"), "offset", "reject_reason") == [(99, "malformed")]


def test_windows_come_out_once_and_closed(spark, feed, tmp_path):
    in_order = [
        ("a", 1, at(0), 0, 0),
        ("a", 2, at(59), 0, 1),
        ("b", 4, at(30), 0, 2),
        ("a", 8, at(60), 0, 3),
        ("b", 16, at(125), 0, 4),
        ("b", 32, at(190), 0, 5),
    ]
    source = feed(SALE).add(in_order[:3], in_order[3:5], in_order[5:])
    found = appended(windows.tumbling_stream(source.stream(), MINUTE), tmp_path, "minutes")
    assert rows(found, "window_start", "key", "value") == sorted(
        [(at(0), "a", 3), (at(0), "b", 4), (at(60), "a", 8), (at(120), "b", 16)], key=repr
    )


def test_the_watermark_form_is_never_stricter_than_the_replay(spark, feed, tmp_path):
    from datetime import datetime

    records = [
        (title, amount, datetime.fromisoformat(when[:-1]), 0, i)
        for i, (title, when, amount) in enumerate(SALES)
    ]
    source = feed(SALE).add(records[:4], records[4:6], records[6:9], records[9:])
    df = source.table()
    replayed = windows.tumbling_final(df, windows.closings(df, MINUTE), MINUTE)
    streamed = appended(windows.tumbling_stream(source.stream(), MINUTE), tmp_path, "never-stricter")
    got = {(w, k): v for w, k, v in rows(streamed, "window_start", "key", "value")}
    wanted = rows(replayed, "window_start", "key", "value")
    assert len(wanted) == 3
    assert all(got[w, k] >= v for w, k, v in wanted)


def pairs(left, right):
    return joins.interval_join(
        left,
        right,
        timedelta(seconds=30),
        timedelta(seconds=30),
        [F.col("left.offset").alias("l"), F.col("right.offset").alias("r")],
        grace=timedelta(seconds=30),
    )


def test_join_of_streams_equals_the_join_of_tables(spark, feed, tmp_path):
    left = feed(SALE).add(
        [("a", 1, at(0), 0, 0), ("b", 1, at(5), 0, 1)], [("a", 1, at(40), 0, 2)], [("b", 1, at(61), 0, 3)]
    )
    right = feed(SALE).add(
        [("a", 2, at(30), 0, 10)], [("b", 2, at(20), 0, 11), (None, 2, at(20), 0, 12)], [("a", 2, at(70), 0, 13)]
    )
    found = appended(pairs(left.stream(), right.stream()), tmp_path, "pairs")
    wanted = rows(pairs(left.table(), right.table()), "key", "ts", "l", "r")
    assert len(wanted) == 4
    assert rows(found, "key", "ts", "l", "r") == wanted


def test_join_lets_go_of_what_is_past_its_grace(spark, feed, tmp_path):
    """The watermark passes the old record by more than reach and grace together."""
    left = feed(SALE).add(
        [("a", 1, at(0), 0, 0)], [("z", 1, at(1000), 0, 1)], [("z", 1, at(1001), 0, 2)], [("z", 1, at(1002), 0, 3)]
    )
    right = feed(SALE).add(
        [("y", 2, at(0), 0, 10)], [("y", 2, at(1000), 0, 11)], [("y", 2, at(1001), 0, 12)], [("a", 2, at(10), 0, 13)]
    )
    assert pairs(left.table(), right.table()).count() == 1
    query = finish(pairs(left.stream(), right.stream()), sinks.to_parquet(f"{tmp_path}/out"), tmp_path, "late")
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == []
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    # Four left and six right rows (two slots each) came in time; the three of time 0 are gone.
    assert states[-1] == 4 + 6 - 3


def texts(records, fields, topic):
    out = []
    for i, record in enumerate(records):
        body = ",".join(
            f'"{f}":' + (f'"{v}"' if isinstance(v, str) else str(v)) for f, v in zip(fields, record)
        )
        out.append((None, "{" + body + "}", at(i), topic, 0, i))
    return out


def test_rated_movies_through_the_stored_stream(spark, feed, tmp_path):
    movies = feed(LINE).add(texts(MOVIES, ["id", "title", "releaseyear"], "movies"))
    broken = [(None, "broken", at(3), "ratings", 0, 99)]
    ratings = feed(LINE).add(texts(RATINGS, ["id", "rating"], "ratings"), broken)
    first, second = rated_movies.start(
        movies.stream(),
        ratings.stream(),
        f"{tmp_path}/movies",
        sinks.to_json_lines(f"{tmp_path}/rated"),
        checkpoint_root=str(tmp_path),
        every=None,
    )
    sinks.drain(second)
    assert first.id != second.id
    batch = rated_movies.rated(
        rated_movies.ratings(ratings.table()), rated_movies.movies(movies.table())
    )
    found = spark.read.schema(batch.schema).json(f"{tmp_path}/rated")
    assert rows(found) == rows(batch)
    assert len(rows(found)) == 9


def sale_messages():
    out = texts(SALES, TICKET_SALE.fieldNames(), "sales")
    return [*out, (None, '{"title":"x","other":1}', at(50), "sales", 0, 12), (None, None, at(51), "sales", 0, 13)]


def run_ticket_sales(spark, source, root, **more):
    queries = ticket_sales.start(
        source.stream(),
        sinks.to_updates(f"{root}/totals"),
        sinks.to_parquet(f"{root}/minutes"),
        sinks.to_parquet(f"{root}/rejected"),
        sales_table=f"{root}/sales",
        checkpoint_root=str(root),
        every=None,
        maxFilesPerTrigger="1",
        **more,
    )
    for query in queries:
        sinks.drain(query)


def test_ticket_sales_gives_all_results_of_one_decoding(spark, feed, tmp_path):
    later = (None, '{"title":"late closer","tickettotalvalue":1}', at(300), "sales", 0, 201)
    source = feed(LINE).add(sale_messages()[:7], sale_messages()[7:], lines("{}", first=200), [later])
    run_ticket_sales(spark, source, tmp_path)
    table = rows(ticket_sales.totals(source.table()))
    assert rows(sinks.latest_of_updates(spark, f"{tmp_path}/totals")) == table
    assert dict(table)["The Godfather"] == 76
    # All sales lie in the first minute; a record without a title closes nothing, the next one does.
    minutes = rows(spark.read.parquet(f"{tmp_path}/minutes"), "window_start", "key", "value")
    assert minutes == rows(ticket_sales.closed_minutes(source.table()), "window_start", "key", "value")
    assert (at(0), "The Godfather", 76) in minutes
    rejected = spark.read.parquet(f"{tmp_path}/rejected")
    assert rows(rejected, "offset", "reject_reason") == [(12, "unknown field"), (13, "malformed")]
    stored = spark.read.parquet(f"{tmp_path}/sales")
    assert stored.where("reject_reason IS NULL").count() + rejected.count() == source.table().count()


def test_ticket_totals_as_a_row_per_sale(spark, feed, tmp_path):
    source = feed(LINE).add(sale_messages()[:7], sale_messages()[7:])
    run_ticket_sales(spark, source, tmp_path, changes_root=f"{tmp_path}/changes")
    found = changelog.read_changelog(spark, f"{tmp_path}/changes")
    wanted = aggregates.changelog(ticket_sales.amounts(source.table()))
    assert rows(found, "key", "offset", "value") == rows(wanted, "key", "offset", "value")


def test_one_reading_for_several_writers(spark, feed, tmp_path):
    source = feed(SALE).add([("a", 1, at(0), 0, 0)], [("b", 2, at(1), 0, 1)])

    def writer(name, change):
        return lambda batch, batch_id: change(batch).write.mode("overwrite").parquet(
            f"{tmp_path}/{name}/batch={batch_id}"
        )

    branches = {
        "all": writer("all", lambda b: b.select("key", "value")),
        "big": writer("big", lambda b: b.where("value > 1").select("key", "value")),
    }
    finish(source.stream(), fan_out.each_batch(branches), tmp_path, "several")
    assert rows(spark.read.parquet(f"{tmp_path}/all"), "key", "value") == [("a", 1), ("b", 2)]
    assert rows(spark.read.parquet(f"{tmp_path}/big"), "key", "value") == [("b", 2)]


def test_an_action_for_every_row(spark, feed, tmp_path):
    source = feed(SALE).add([("a", 1, at(0), 0, 0), ("b", 2, at(1), 0, 1)])
    target = str(tmp_path / "seen")
    open(target, "w").close()

    def note(row):
        with open(target, "a") as out:
            out.write(f"{row.key}\n")

    finish(source.stream(), sinks.to_each(note), tmp_path, "each")
    assert sorted(open(target).read().split()) == ["a", "b"]


def test_peek_reports_counts_and_passes_rows(spark, feed, tmp_path):
    source = feed(SALE).add([("a", 1, at(0), 0, 0), ("b", 2, at(1), 0, 1)])
    query = finish(peek(source.stream(), "seen"), sinks.to_memory(), tmp_path, "peeked")
    assert spark.table("peeked").count() == 2
    assert query.recentProgress[0]["observedMetrics"]["seen"]["records"] == 2


def test_reset_picks_a_fresh_checkpoint(spark, tmp_path):
    kept = sinks.checkpoint(spark, "job", str(tmp_path))
    assert kept == sinks.checkpoint(spark, "job", str(tmp_path))
    assert sinks.checkpoint(spark, "job", str(tmp_path), reset=True) != kept

def test_ticket_minutes_by_the_record_order_rule(spark, feed, tmp_path):
    closer = (None, '{"title":"late closer","tickettotalvalue":1}', at(300), "sales", 0, 201)
    late = (None, '{"title":"BBB","tickettotalvalue":5}', at(20), "sales", 0, 202)
    source = feed(LINE).add(sale_messages()[:7], sale_messages()[7:], [closer, late])
    queries = ticket_sales.start(
        source.stream(),
        None,
        None,
        sales_table=f"{tmp_path}/sales",
        checkpoint_root=str(tmp_path),
        exact_root=f"{tmp_path}/exact",
        every=None,
        maxFilesPerTrigger="1",
    )
    for query in queries:
        sinks.drain(query)
    found = replay.read(spark, f"{tmp_path}/exact", replay.FINAL)
    wanted = ticket_sales.closed_minutes(source.table())
    assert rows(found, "partition", "window_start", "key", "value") == rows(
        wanted, "partition", "window_start", "key", "value"
    )
    assert rows(replay.read(spark, f"{tmp_path}/exact", replay.LATE), "offset", "key") == [(202, "BBB")]
