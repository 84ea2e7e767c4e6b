import os
import signal
from datetime import UTC, datetime

import pytest
from conftest import rows
from samples import LINES, MOVIES, RATINGS, SALES, SALE_TOTALS, WORD_COUNTS

from tidemark import jobs
from tidemark.streaming import sinks


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


def as_json(record, fields):
    pairs = zip(fields, record)
    return "{" + ",".join(f'"{f}":' + (f'"{v}"' if isinstance(v, str) else str(v)) for f, v in pairs) + "}"


def test_word_count(spark, tmp_path):
    put(tmp_path / "in", "a.txt", LINES[:2])
    where = ["--files", "--input", f"{tmp_path}/in", "--output", f"{tmp_path}/out"]
    command = ["word-count", *where, "--checkpoint", f"{tmp_path}/progress", "--once"]
    jobs.run(spark, command)
    put(tmp_path / "in", "b.txt", LINES[2:])
    jobs.run(spark, command)
    assert dict(rows(sinks.latest_of_updates(spark, f"{tmp_path}/out"))) == WORD_COUNTS


def test_ticket_sales(spark, tmp_path):
    fields = ["title", "salets", "tickettotalvalue"]
    put(tmp_path / "in", "a.txt", [as_json(s, fields) for s in SALES] + ["broken", '{"title":"A","x":1}'])
    os.utime(tmp_path / "in" / "a.txt", (1_700_000_000, 1_700_000_000))
    where = ["--files", "--input", f"{tmp_path}/in", "--output", f"{tmp_path}/out"]
    more = ["--minutes", f"{tmp_path}/minutes", "--rejected", f"{tmp_path}/rejected"]
    command = ["ticket-sales", *where, *more, "--checkpoint", f"{tmp_path}/progress", "--once"]
    jobs.run(spark, command)
    assert dict(rows(sinks.latest_of_updates(spark, f"{tmp_path}/out"))) == SALE_TOTALS
    rejected = spark.read.parquet(f"{tmp_path}/rejected")
    assert rows(rejected, "reject_reason") == [("malformed",), ("unknown field",)]
    # A file of a later minute closes that of the first.
    put(tmp_path / "in", "b.txt", [as_json(("Later", "", 1), fields)])
    os.utime(tmp_path / "in" / "b.txt", (1_700_000_300, 1_700_000_300))
    jobs.run(spark, command)
    minutes = spark.read.parquet(f"{tmp_path}/minutes")
    assert dict(rows(minutes, "key", "value")) == SALE_TOTALS


def test_older_files_may_be_left_out(spark, tmp_path):
    for number, line in enumerate(LINES):
        put(tmp_path / "in", f"{number}.txt", [line])
        os.utime(tmp_path / "in" / f"{number}.txt", (1_700_000_000 + number, 1_700_000_000 + number))
    since = datetime.fromtimestamp(1_700_000_002, UTC).replace(tzinfo=None).isoformat()
    where = ["--files", "--input", f"{tmp_path}/in", "--output", f"{tmp_path}/out", "--since", since]
    jobs.run(spark, ["word-count", *where, "--once"])
    found = dict(rows(sinks.latest_of_updates(spark, f"{tmp_path}/out")))
    assert found == {word: 1 for word in LINES[2].split()}


@pytest.mark.parametrize("more", [["--start", "latest"], ["--changes"]])
def test_what_only_topics_have_is_refused_for_files(spark, more):
    with pytest.raises(SystemExit):
        jobs.run(spark, ["word-count", "--files", "--input", "a", "--output", "b", *more])


def test_a_signal_stops_the_queries_and_ends_the_wait(spark, tmp_path):
    put(tmp_path / "in", "a.txt", LINES)
    where = ["--files", "--input", f"{tmp_path}/in", "--output", f"{tmp_path}/out"]
    before = [signal.getsignal(s) for s in (signal.SIGINT, signal.SIGTERM)]
    queries = jobs.run(spark, ["word-count", *where, "--every", "1 second"])
    try:
        jobs.stop_on_signals(queries)
        assert queries[0].isActive
        signal.raise_signal(signal.SIGTERM)
        jobs.wait(queries)
        assert not queries[0].isActive
    finally:
        for number, handler in zip((signal.SIGINT, signal.SIGTERM), before):
            signal.signal(number, handler)


def test_rated_movies(spark, tmp_path):
    put(tmp_path / "movies", "a.txt", [as_json(m, ["id", "title", "releaseyear"]) for m in MOVIES])
    put(tmp_path / "ratings", "a.txt", [as_json(r, ["id", "rating"]) for r in RATINGS])
    for folder in ("movies", "ratings"):
        os.utime(tmp_path / folder / "a.txt", (1_700_000_000, 1_700_000_000))
    where = ["--files", "--input", f"{tmp_path}/ratings", "--output", f"{tmp_path}/out"]
    more = ["--movies", f"{tmp_path}/movies", "--movie-table", f"{tmp_path}/keyed", "--once"]
    jobs.run(spark, ["rated-movies", *where, *more])
    found = rows(spark.read.parquet(f"{tmp_path}/out"), "key", "title", "rating")
    assert len(found) == len(RATINGS)
    assert ("780", "Super Mario Bros.", 2.1) in found


@pytest.mark.parametrize("missing", ["--servers", "--input"])
def test_addresses_have_no_default(spark, missing):
    given = {"--servers": "b:1", "--input": "lines", "--output": "counts"}
    command = [part for name, value in given.items() if name != missing for part in (name, value)]
    with pytest.raises(SystemExit):
        jobs.run(spark, ["word-count", *command])
