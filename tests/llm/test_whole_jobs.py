"""Planted cases that the small tables do not have, against brute force."""

from __future__ import annotations

import os
import subprocess
import sys

import numpy as np
import pytest

from tidemark.llm import common, cotraining, line_dedup, pivots

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def near(rng: np.random.Generator, rows: int, mean: float, size: int) -> np.ndarray:
    """Vectors around one direction, pairs of which have that cosine on average."""
    center = pivots.unit(rng.normal(size=(1, size)))
    return pivots.unit(center + np.sqrt((1 / mean - 1) / size) * rng.normal(size=(rows, size)))


@pytest.mark.parametrize("mean", [0.96, 0.99])
def test_groups_of_near_copies(spark, mean):
    """Groups of 2 rows up to a third of all, in two dimensions."""
    rng = np.random.default_rng(7)
    large = [near(rng, n, mean, 64) for n in (500, 50, 10, *[2] * 20)]
    large = np.concatenate([*large, pivots.unit(rng.normal(size=(900, 64)))])
    small = np.concatenate([near(rng, 20, mean, 32), pivots.unit(rng.normal(size=(80, 32)))])
    links = []
    for v in (large, small):
        linked = v @ v.T >= pivots.LEAST
        links += (linked.sum(axis=1) - 1).tolist()
    data = [(i, v.tolist()) for i, v in enumerate([*large, *small])]
    found = {r["vec_id"]: r for r in pivots.linked(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()}
    counts = np.array([found[i]["n_links"] for i in range(len(data))])
    assert (counts <= np.array(links)).all()
    assert counts.sum() >= 0.99 * sum(links)
    assert counts[len(large) :].sum() >= 0.99 * sum(links[len(large) :]) > 0


def test_few_directions(spark):
    """All rows are copies of fewer directions than a vector has nearest points."""
    rng = np.random.default_rng(8)
    data = [(i, v.tolist()) for i, v in enumerate(np.concatenate([near(rng, 30, 0.999, 16) for _ in range(3)]))]
    found = pivots.linked(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == [(i, 29, i - i % 30) for i in range(90)]


def without_repeats(texts: list[str]) -> list[str]:
    """Texts without the lines of any run of 50 words or more that stands earlier."""
    docs = [t.split("\n") for t in texts]
    kept = []
    for d, lines in enumerate(docs):
        gone = set()
        for e, earlier in enumerate(docs[: d + 1]):
            for shift in range(-len(earlier), len(lines)):
                if e == d and shift <= 0:
                    continue
                run = []
                for i in range(len(lines) + 1):
                    if i < len(lines) and 0 <= i - shift < len(earlier) and lines[i] == earlier[i - shift]:
                        run.append(i)
                        continue
                    if sum(len(lines[k].split()) for k in run) >= 50:
                        gone.update(run)
                    run = []
        kept.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return kept


def test_nested_versions_of_a_passage(spark):
    def line(name: str, n: int) -> str:
        return " ".join(f"{name}{i}" for i in range(n))

    a, b, c = line("a", 30), line("b", 30), line("c", 19)
    texts = ["\n".join(x) for x in ([a, b], [a, b, c], [a, b, c], [c, a, b], ["x", c, a, b, "", c], [a, b, c, "", "y"])]
    rng = np.random.default_rng(9)
    pieces = ["", *(line(f"w{i}", int(rng.integers(1, 30))) for i in range(5))]
    texts += ["\n".join(rng.choice(pieces, int(rng.integers(1, 12)))) for _ in range(60)]
    found = line_dedup.deduplicated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r["text"] for r in sorted(found)] == without_repeats(texts)
    assert sorted(found)[2]["text"] == ""


def test_all_unlabelled_documents_are_used(spark, monkeypatch):
    """A word that only unlabelled documents hold, beyond any fixed pool, becomes a feature."""
    rng = np.random.default_rng(10)

    def text(good: bool, extra: str) -> str:
        return " ".join([*rng.choice([f"{'good' if good else 'bad'}{i}" for i in range(30)], 12), extra])

    docs = [(i, text(i % 2 == 0, "seen"), "web" if i % 2 else "book", "en") for i in range(400)]
    docs += [(i, text(i % 2 == 0, "fresh" if i % 2 else "other"), "web" if i % 2 else "book", "en") for i in range(400, 4400)]
    labels = [(i, 1 - i % 2, 0) for i in range(400)]
    used = []
    fit = cotraining.Bayes.fit.__func__
    monkeypatch.setattr(cotraining.Bayes, "fit", classmethod(lambda cls, *a: used.append(a) or fit(cls, *a)))
    models = cotraining.fit(
        spark.createDataFrame(docs, "doc_id long, text string, source string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
    assert cotraining.SAMPLE == 20_000
    assert sum(used[-1][2:]) > 4000  # texts that the last fit counts
    assert np.isin(cotraining.content("fresh"), models["quality"].bayes.keys).all()
    assert models["toxic"].constant == 0


def test_hashes_do_not_depend_on_order():
    """A process that has hashed nothing yet, and one that has hashed long words, agree."""
    code = "from tidemark.llm import common; print(common.hash_bytes(b'a b 0').tolist())"
    fresh = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=REPO).stdout
    common.hash_bytes(b"longer words")
    assert fresh.split() == str(common.hash_bytes(b"a b 0").tolist()).split()
