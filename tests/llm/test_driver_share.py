"""What the classifier brings to the driver."""

import numpy as np

from tidemark.llm import common, cotraining


def test_the_driver_gets_views_not_counts(spark, monkeypatch):
    rng = np.random.default_rng(11)
    words = [[f"{kind}{i}" for i in range(30)] for kind in ("bad", "good")]
    docs = [(i, " ".join(rng.choice(words[i % 2], 12)), "web", "en") for i in range(600)]
    labels = [(i, i % 2, 0) for i in range(300)]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string")
    rows = cotraining.described(table)
    frame, sizes, freed = type(rows), [], []
    collect, free = frame.collect, common.free
    monkeypatch.setattr(common, "free", lambda s: freed.append(free(s)))

    def watched(df):
        found = collect(df)
        sizes.append(sum(len(x) for row in found for x in row if isinstance(x, bytes | bytearray)))
        return found

    monkeypatch.setattr(frame, "collect", watched)
    models = cotraining.fit_described(rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert 0 < max(sizes) < cotraining.BUCKETS  # an array of counts is 32 times that
    assert len(freed) == cotraining.ROUNDS
    assert len(models["quality"].bayes.keys) > 40  # most of the words


def test_views_from_stored_counts(spark):
    """Two parts, one weighed by the labelled shares, against the sums written out."""
    rng = np.random.default_rng(12)
    n = len(cotraining.COUNTS) * cotraining.BUCKETS
    parts = []
    for texts in ([60, 40, 70, 30], [900, 100, 0, 500]):
        counts = np.zeros(n)
        at = rng.choice(n, 3000, replace=False)
        counts[at] = rng.integers(1, 50, 3000)
        parts.append(np.append(counts, texts))
    own, more = (spark.createDataFrame([(bytearray(p.tobytes()),)], "part binary") for p in parts)
    views, totals = cotraining._by_content([0, 1], own, more)
    assert totals.tolist() == [[60, 40], [70, 30]]
    weights = [[1 / 6, 1], [1, 1]]  # 15 and 2.5 times the own texts; a class without texts: as they are
    for k, view in views.items():
        yes, no = (
            parts[0][(2 * k + i) * cotraining.BUCKETS :][: cotraining.BUCKETS]
            + weights[k][i] * parts[1][(2 * k + i) * cotraining.BUCKETS :][: cotraining.BUCKETS]
            for i in (0, 1)
        )
        texts = [parts[0][n + 2 * k + i] + weights[k][i] * parts[1][n + 2 * k + i] for i in (0, 1)]
        a, b = (yes + 0.1) / (texts[0] + 0.2), (no + 0.1) / (texts[1] + 0.2)
        assert len(view.keys) and np.isclose(view.prior, np.log(texts[0] / texts[1]))
        assert np.allclose(view.weights, np.log(a[view.keys] / b[view.keys]))
