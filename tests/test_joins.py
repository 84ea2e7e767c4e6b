import random
from datetime import timedelta

import pytest
from conftest import at, rows
from pyspark.sql import functions as F
from samples import MOVIES, RATINGS

from tidemark.operators.joins import interval_join
from tidemark.plans import rated_movies

HALF_MINUTE = timedelta(seconds=30)
LEFT = "key string, ts timestamp, partition int, offset long"


def joined(left, right, before=HALF_MINUTE, after=HALF_MINUTE, **more):
    columns = [F.col("left.offset").alias("l"), F.col("right.offset").alias("r")]
    return interval_join(left, right, before, after, columns, **more)


def one(spark, *records):
    return spark.createDataFrame([(k, at(t), 0, o) for k, t, o in records], LEFT)


@pytest.mark.parametrize("apart", [0, 29.999999, 30, -30])
def test_within_reach(spark, apart):
    found = joined(one(spark, ("a", 100, 1)), one(spark, ("a", 100 + apart, 2)))
    assert rows(found) == [("a", at(max(100, 100 + apart)), 1, 2)]


@pytest.mark.parametrize("apart", [30.001, -30.001, 30.000001, -30.000001, 3600])
def test_out_of_reach(spark, apart):
    assert joined(one(spark, ("a", 100, 1)), one(spark, ("a", 100 + apart, 2))).count() == 0


def test_a_record_sent_twice_matches_twice(spark):
    left = one(spark, ("a", 10, 1))
    right = one(spark, ("a", 10, 2), ("a", 10, 3), ("b", 10, 4))
    assert rows(joined(left, right), "l", "r") == [(1, 2), (1, 3)]


def test_records_without_a_key_match_nothing(spark):
    left = one(spark, (None, 10, 1), ("a", 10, 2))
    right = one(spark, (None, 10, 3))
    assert joined(left, right).count() == 0


@pytest.mark.parametrize("salts", [1, 4])
@pytest.mark.parametrize(("before", "after"), [(30, 30), (0, 45), (45, 0), (0, 0), (100, 5)])
def test_equals_comparing_every_pair(spark, before, after, salts):
    draw = random.Random(before * 1000 + after)

    def records(n):
        return [
            ("hot" if draw.random() < 0.6 else f"k{draw.randrange(5)}", draw.randrange(-300, 600), i)
            for i in range(n)
        ]

    left, right = records(150), records(120)
    wanted = sorted(
        (
            (l[2], r[2])
            for l in left
            for r in right
            if l[0] == r[0] and l[1] - before <= r[1] <= l[1] + after
        ),
        key=repr,
    )
    found = joined(
        one(spark, *left),
        one(spark, *right),
        timedelta(seconds=before),
        timedelta(seconds=after),
        salts=salts,
    )
    assert rows(found, "l", "r") == wanted


def test_a_stream_needs_a_grace_period(spark, feed):
    source = feed(LEFT).add([("a", at(0), 0, 0)])
    with pytest.raises(ValueError):
        joined(source.stream(), source.stream())


def test_both_streams_carry_a_watermark(spark, feed):
    source = feed(LEFT).add([("a", at(0), 0, 0)])
    df = joined(source.stream(), source.stream(), grace=HALF_MINUTE)
    assert df._jdf.queryExecution().analyzed().toString().count("EventTimeWatermark") == 2


@pytest.fixture(scope="module")
def messages(spark):
    def of(records, fields):
        texts = []
        for i, record in enumerate(records):
            pairs = ", ".join(
                f'"{f}": ' + (f'"{v}"' if isinstance(v, str) else str(v)) for f, v in zip(fields, record)
            )
            texts.append((None, "{" + pairs + "}", at(i), "t", 0, i))
        schema = "key string, value string, ts timestamp, topic string, partition int, offset long"
        return spark.createDataFrame(texts, schema)

    return of(MOVIES, ["id", "title", "releaseyear"]), of(RATINGS, ["id", "rating"])


def test_rated_movies(messages):
    movies, ratings = messages
    found = rated_movies.rated(rated_movies.ratings(ratings), rated_movies.movies(movies))
    by_id = {m[0]: m for m in MOVIES}
    wanted = [(str(i), i, by_id[i][1], by_id[i][2], rating) for i, rating in RATINGS]
    assert rows(found, "key", "id", "title", "releaseyear", "rating") == sorted(wanted, key=repr)


def test_rated_movie_messages(messages):
    movies, ratings = messages
    rated = rated_movies.rated(rated_movies.ratings(ratings), rated_movies.movies(movies))
    found = dict(rows(rated_movies.messages(rated.where("rating = 2.1"))))
    assert found == {"780": '{"id":780,"title":"Super Mario Bros.","releaseyear":1993,"rating":2.1}'}
