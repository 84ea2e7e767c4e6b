"""Changelogs of texts and records laid out in blocks."""

from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import session
from tidemark.functions.durations import floor_div
from tidemark.operators.running import running, running_in_blocks
from tidemark.plans import word_count

TEXTS = [(i, None if i % 7 == 3 else " ".join(["the", f"w{i % 5}", "the", f"only{i}"][: i % 5])) for i in range(60)]


def brute(texts):
    seen, out = Counter(), []
    for offset, text in sorted(texts):
        for pos, word in enumerate(text.split(" ") if text is not None else []):
            seen[word] += 1
            out.append((offset, pos, word, seen[word]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [3, 1 << 22])
def test_word_changes_move_texts_and_store_no_words(spark, monkeypatch, limit):
    stored = []
    real = session.written

    def noted(df, name):
        stored.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, name)

    lines = spark.createDataFrame(TEXTS, "offset long, value string")
    monkeypatch.setattr(session, "written", noted)
    found = word_count.count_changes(lines, order=["offset"], limit=limit)
    assert rows(found, "offset", "pos", "key", "value") == brute(TEXTS)
    [(name, plan)] = stored
    assert name == "word-changes"
    # Records come to their windows as they lie: only texts, totals and what lies before are shuffled.
    assert "Exchange hashpartitioning(key" not in plan.split("Union")[0]


def test_word_changes_of_no_texts(spark):
    lines = spark.createDataFrame([(1, None)], "offset long, value string")
    assert rows(word_count.count_changes(lines, order=["offset"])) == []


def test_records_without_an_order_are_an_error_in_blocks_too(spark):
    lines = spark.createDataFrame([(1, "a b"), (None, "b")], "offset long, value string")
    with pytest.raises(Exception, match="have no order"):
        word_count.count_changes(lines, order=["offset"]).collect()


@pytest.mark.parametrize("how", ["sum", "count", "max", "min"])
def test_running_in_blocks_equals_running(spark, how):
    made = [(f"k{i % 3}" if i % 4 else "hot", None if i % 6 == 0 else i * 37 % 11, i % 2, i - 25) for i in range(80)]
    df = spark.createDataFrame(made, "key string, value long, partition int, offset long")
    measure = {"value": (how, None if how == "count" else "value")}
    order = ["partition", "offset"]
    wanted = running(df, ["key"], order, measure, block_on="offset", widths=(7,))
    laid = df.withColumns({"a": F.col("partition"), "b": floor_div(F.col("offset"), 7)}).repartition(3, "a", "b")
    found = running_in_blocks(laid, ["key"], order, measure, blocks=["a", "b"], parts=3)
    columns = ["key", "partition", "offset", "value"]
    assert rows(found, *columns) == rows(wanted, *columns)
