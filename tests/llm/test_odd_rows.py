"""Nulls, empty and long texts, repeated rows, empty tables and clashing names, for the text operators."""

from __future__ import annotations

import re

import pytest

from tidemark.llm import cotraining, decontaminate, jaccard, line_dedup, secret_scan, warc_index

CLASHING = "doc_id long, text string, source string, lang string, n_chars long, _id string, _mark int, _slot int, _deleted string, n_deleted string, _hit int, `a.b` string"
LINE = " ".join(f"w{i}" for i in range(60))
LONG = "\n".join(" ".join(f"{i}x{j}" for j in range(20)) for i in range(3000))


def docs(spark, texts):
    rows = [(i, t, None if i == 0 else "web", "en", 0, "mine", 7, 8, "d", "n", 9, "dot") for i, t in texts]
    return spark.createDataFrame(rows, CLASHING)


TEXTS = [(1, None), (2, ""), (None, LINE + "\ny"), (3, LINE + "\nx"), (3, LINE + "\nx"), (4, LONG), (5, "z\n" + LONG), (0, " \t\n")]


def test_line_dedup(spark):
    found = line_dedup.deduplicated(docs(spark, TEXTS)).collect()
    assert len(found) == len(TEXTS)
    by = {(r["doc_id"], r["n_deleted"]): r["text"] for r in found}
    assert by[None, 0] == LINE + "\ny" and by[3, 1] == "x" and by[1, 0] is None and by[2, 0] == ""
    assert by[4, 0] == LONG and by[5, 3000] == "z"
    assert all((r["_id"], r["_mark"], r["_slot"], r["_deleted"], r["_hit"], r["a.b"]) == ("mine", 7, 8, "d", 9, "dot") for r in found)
    assert line_dedup.deduplicated(docs(spark, TEXTS).limit(0)).count() == 0


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def test_decontamination(spark):
    items = [("a", " ".join(words(LINE)[5:17])), ("b", "Nine words here."), ("b", "nine, words here"), ("c", None), ("d", "..."), (None, "lone")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    texts = [*TEXTS, (6, "x NINE words-here y"), (6, "x NINE words-here y"), (7, "nine words"), (8, "lone lone"), (9, "nine words there")]
    table = docs(spark, texts)
    found = [r.asDict() for r in decontaminate.reported(table, benchmark).collect()]
    assert len(found) == len(texts)
    hit = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"]) for r in found}
    assert hit[3] == (61, 12, 1) and hit[6] == (5, 3, 1) and hit[7] == (2, 0, 0) and hit[1] == hit[2] == (0, 0, 0)
    assert hit[8] == (2, 2, 0 if hit[8][2] == 0 else 1) and hit[9] == (3, 0, 0) and hit[4][1] == 0
    clean = decontaminate.clean(table, benchmark)
    assert clean.columns == table.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [0, 1, 2, 4, 5, 7, 9]
    cut = decontaminate.without_spans(table, benchmark)
    assert cut.columns == table.columns
    by = {r["doc_id"]: r for r in cut.collect()}
    assert by[6]["text"] == "x y" and by[8]["text"] == "" and by[1]["text"] is None and by[4]["text"] == LONG
    assert words(by[3]["text"]) == [*words(LINE)[:5], *words(LINE)[17:], "x"] and by[3]["_hit"] == 9
    assert decontaminate.reported(table.limit(0), benchmark).count() == 0
    without = decontaminate.reported(table, benchmark.limit(0)).collect()
    assert len(without) == len(texts) and not any(r["contaminated"] for r in without)
    assert decontaminate.clean(table, benchmark.where("item_id = 'd'")).count() == len(texts)


def test_jaccard(spark):
    texts = [*TEXTS, (None, None), (6, "a b c"), (7, "A B\tC"), (8, LINE + " x"), (9, LINE + " x y")]
    found = sorted(tuple(r) for r in jaccard.similar_documents(docs(spark, [t for t in texts if t[0] is not None])).collect())
    component = {i: c for i, _, c in found}
    assert component[6] == component[7] == 6 and component[1] == 1 and component[2] == 2 and component[0] == 0
    assert component[3] == component[8] == component[9] == 3 and component[4] == component[5] == 4
    assert len(found) == len(texts) - 2
    with_nulls = jaccard.similar_documents(docs(spark, texts)).collect()
    assert len(with_nulls) == len(texts)
    table = docs(spark, texts)
    kept = jaccard.one_of_each(table)
    assert kept.columns == table.columns
    assert sorted({r["doc_id"] for r in kept.collect() if r["doc_id"] is not None}) == [0, 1, 2, 3, 4, 6]
    assert jaccard.similar_documents(table.limit(0)).count() == 0


@pytest.mark.parametrize("labelled", [0, 150])
def test_classifier(spark, labelled):
    table = docs(spark, [*TEXTS, *((100 + i, ("good fine " if i % 2 else "bad awful ") * 9) for i in range(200))])
    labels = [(100 + i, i % 2, None) for i in range(labelled)] + [(None, 1, 1), (100, 0, None), (777, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = cotraining.classified(table, labels).collect()
    assert len(found) == len(TEXTS) + 200 and all(0 <= r["p_quality"] <= 1 for r in found)
    keep = {r["doc_id"]: r["keep"] for r in found}
    if labelled:
        assert all(keep[100 + i] == (i % 2 == 1) for i in range(200))
    accepted = cotraining.accepted(table, labels)
    assert accepted.columns == table.columns and accepted.count() == sum(r["keep"] for r in found)
    assert cotraining.classified(table.limit(0), labels).count() == 0


def test_secrets(spark):
    texts = [*TEXTS, (6, 'password = "abcdefgh"'), (6, 'password = "abcdefgh"'), (7, "AKIA" + "Z9" * 8)]
    found = secret_scan.reported(docs(spark, texts)).collect()
    assert len(found) == len(texts)
    by = {r["doc_id"]: r for r in found}
    assert (by[6]["n_assign"], by[7]["n_access"], by[1]["n_assign"], by[1]["spans"]) == (1, 1, 0, "")
    assert secret_scan.reported(docs(spark, texts).limit(0)).count() == 0


def test_warc(spark):
    page = "<p>" + "x" * 1000
    rows = [(1, "http://a/", page), (2, "http://b/", page), (None, None, None), (3, None, ""), (3, None, ""), (4, "u\r\nv", "é" * 70_000)]
    pages = spark.createDataFrame([(*r, "mine") for r in rows], "page_id long, url string, html string, digest string")
    found = warc_index.archived(pages.select("page_id", "url", "html")).collect()
    assert len(found) == len(rows)
    by = {r["page_id"]: r for r in found}
    assert (by[1]["record_type"], by[1]["refers_to"], by[2]["record_type"]) == ("revisit", 2, "response")
    assert by[None]["payload_bytes"] == 0 and by[4]["payload_bytes"] == 140_000
    assert warc_index.archived(pages.select("page_id", "url", "html").limit(0)).count() == 0


def test_a_revisit_names_the_record_that_it_repeats():
    def headers(data):
        return dict(line.split(": ", 1) for line in data.partition(b"\r\n\r\n")[0].decode().split("\r\n")[1:])

    response = headers(warc_index.record(9, "http://b/", "x", "d1", None, "2024-01-01T00:00:00Z"))
    revisit = headers(warc_index.record(3, "http://a/", "x", "d1", 9, "2024-01-01T00:00:00Z"))
    assert revisit["WARC-Refers-To"] == response["WARC-Record-ID"] != revisit["WARC-Record-ID"]
