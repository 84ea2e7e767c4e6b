"""Tables staged as several files to a micro-batch, and changelogs of large batches."""

import os

from conftest import rows
from pyspark.sql import functions as F

from tidemark import session
from tidemark.plans import catalog
from tidemark.streaming import changelog, sinks


def test_a_large_table_has_several_files_to_a_micro_batch(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/documents.parquet"
    spark.range(4000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(
        1
    ).write.parquet(path)
    size = sum(os.path.getsize(f"{path}/{name}") for name in os.listdir(path) if name.endswith(".parquet"))
    monkeypatch.setattr(catalog, "FILE", size // (catalog.BATCHES * 3))
    batches = []
    staged = catalog._in_batches(spark, path, F.col("doc_id")).withColumn("file", F.input_file_name())

    def note(rows, _):
        batches.append(rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id"), F.count_distinct("file")).first())

    sinks.drain(sinks.start(staged, sinks.to_batches(note), name="files", checkpoint=f"{tmp_path}/p", every=None))
    assert len(batches) == catalog.BATCHES
    assert [files for *_, files in batches] == [3] * catalog.BATCHES
    assert all(last - first + 1 == count for first, last, count, _ in batches)
    assert sum(count for _, _, count, _ in batches) == 4000


def test_a_large_batch_of_a_changelog_is_cut_into_more_tasks(spark, tmp_path, feed, monkeypatch):
    monkeypatch.setattr(changelog, "BLOCK", 5)
    made = feed("key string, value long, offset long").add([("a", i, i) for i in range(40)], [("a", 1, 40)])
    used = []
    real = changelog.changelog

    def noted(rows, *args, **kwargs):
        used.append(rows.sparkSession.conf.get(session.SHUFFLE_PARTITIONS))
        return real(rows, *args, **kwargs)

    monkeypatch.setattr(changelog, "changelog", noted)
    query = changelog.start_changelog(made.stream(), f"{tmp_path}/c", name="cut", order=["offset"], every=None, partitions=3)
    sinks.drain(query)
    assert used[1:] == ["8", "3"]
    found = changelog.read_changelog(spark, f"{tmp_path}/c")
    assert found.where("offset = 40").first()["value"] == sum(range(40)) + 1


def test_stored_movies_are_read_in_step_with_the_ratings(spark, tmp_path, monkeypatch):
    spark.range(400).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts", "id DIV 2 % 5 AS user_id",
        "'a' AS event_type", "1.5D AS value", "'' AS props",
    ).write.parquet(f"{tmp_path}/events.parquet")
    read = []
    real = sinks.start

    def noted(df, *args, name, **kwargs):
        query = real(df, *args, name=name, **kwargs)
        if name == "rated-movies":
            sinks.drain(query)
            for progress in query.recentProgress:
                read.extend(s["numInputRows"] for s in progress["sources"])
        return query

    monkeypatch.setattr(catalog.rated_movies.sinks, "start", noted)
    found = catalog.rated_movies_stream(spark, str(tmp_path))
    # All lie within the reach of the join: 200 ratings, read as 400 events, meet the 40 movies of their user.
    assert found.count() == 200 * 40
    assert sum(read) == 400 + 200 and max(read) < 100


def test_a_stream_join_keeps_one_state_store_to_a_partition(spark):
    session.configure(spark)
    assert spark.conf.get(session.JOIN_STATE) == session.JOIN_STATE_VERSION == "3"
