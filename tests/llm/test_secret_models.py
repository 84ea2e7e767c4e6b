"""Random strings that no pattern knows, found by likelihood among the words of a corpus."""

from __future__ import annotations

import math

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidemark.llm import secret_scan

DATA = "/root/testdata/sf0.01"
# Short ones, letters alone, one that ends in =, one behind a name.
PLANTED = ["Xq7Zt9Lm2P", "QxZvKjWqYpTzRbNmLkHgFd", "zkQ4vB7xJw9T", "hV3kQz+8WxP/0fJqBg==", "VqTzXkWpJhGf"]


def test_planted_strings_are_found_and_words_are_not(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    texts = [(-i - 1, f"é k={value}, and more") for i, value in enumerate(PLANTED)]
    found = {r["doc_id"]: r for r in secret_scan.reported(docs.unionAll(spark.createDataFrame(texts, docs.schema))).collect()}
    for doc_id, text in texts:
        value = text[4 : text.index(",")]
        assert found[doc_id]["spans"] == f"markov:4:{4 + len(value)}"
    rows = pq.read_table(f"{DATA}/documents.parquet").to_pylist()
    assert len(found) == len(rows) + len(PLANTED)
    # Among the words of a thousand documents hardly any looks random.
    assert sum(found[r["doc_id"]]["n_markov"] for r in rows) <= len(rows) // 100


def test_scores_are_those_of_the_two_models(spark):
    words = ["there", "other", "weather", "thought", "hearth", "theatre"] * 3
    rows = [(i, w, f"{w}ing") for i, w in enumerate(words)]
    texts = spark.createDataFrame(rows, "doc_id long, a string, b string").select("doc_id", F.lit(1).alias("mark"), F.concat_ws(" ", "a", "b").alias("t"))
    base = spark.createDataFrame([("hex", "0a9f"), ("hex", "0a9f"), ("assign", "Zq!9")], "kind string, value string")
    weights = secret_scan.train(base, texts)
    counts = {"random": {}, "ordinary": {}}
    for label, values in (("random", ["0a9f", "Zq9"]), ("ordinary", {w for _, a, b in rows for w in (a, b)})):
        for value in values:
            for two in zip(value, value[1:], strict=False):
                counts[label][two] = counts[label].get(two, 0) + 1

    def log(label, a, b):
        share, letters = secret_scan.UNIFORM[label], secret_scan.ALPHABET
        row = {c: counts[label].get((a, c), 0) + secret_scan.SMOOTHING for c in letters}
        return math.log((1 - share) * row[b] / sum(row.values()) + share / len(letters))

    tested = ["0a9fZ", "theatre", "Zq9-_+/=", "x"]
    df = spark.createDataFrame([(w,) for w in tested], "w string")
    for w, score in df.select("w", secret_scan.score(F.col("w"), weights)).collect():
        steps = list(zip(w, w[1:], strict=False))
        assert abs(score - sum(log("random", a, b) - log("ordinary", a, b) for a, b in steps)) < 1e-4
