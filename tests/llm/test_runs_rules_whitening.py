"""Word runs, url rules and whitening: brute force on small tables, and the odd cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__
from tidemark.llm import periodic, queries, url_rules, whitening

DATA = "/root/testdata/sf0.001"


def table(name: str) -> list[dict]:
    return pq.read_table(f"{DATA}/{name}.parquet").to_pylist()


# --- runs -------------------------------------------------------------------


def brute_runs(words: list) -> list[tuple[int, int, int]]:
    """Stretches by each period in turn; a longer period of the same stretch is not its least."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        start = None
        for j in range(n - q + 1):
            if j < n - q and words[j] == words[j + q]:
                start = j if start is None else start
            elif start is not None:
                if j + q - start >= max(6, 4 * q):
                    found.setdefault((start, j + q - start), q)
                start = None
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_kept(words: list, runs: list) -> list:
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in dropped]


def test_runs_of_random_texts():
    rng = random.Random(7)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 5)):
            words = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.choice([0, 1, 5, 6, 13, 40, 150]))]
            for _ in range(rng.randint(0, 3)):
                if len(words) > 8:
                    a = rng.randrange(len(words))
                    p, end = rng.randint(1, max(1, (len(words) - a) // 3)), rng.randint(a, len(words))
                    for i in range(a, end):
                        words[i] = words[a + (i - a) % p]
            texts.append([b"w%d" % w for w in words])
        for words, found in zip(texts, periodic.examined([b" ".join(t) for t in texts]), strict=True):
            assert found.runs == brute_runs(words)
            assert found.kept() == brute_kept(words, found.runs)


def test_a_fibonacci_word_and_its_powers():
    a, b = [b"0"], [b"0", b"1"]
    while len(b) < 90:
        a, b = b, b + a
    for text in (b, b * 5, [b"x", *b * 4, b"y"], [b"z"] * 7 + b + [b"z"] * 6):
        (found,) = periodic.examined([b" ".join(text)])
        assert found.runs == brute_runs(text)


def test_a_long_text_is_one_run():
    unit = [b"u%d" % i for i in range(5000)]
    (found,) = periodic.examined([b" ".join(unit * 40 + [b"end"])])
    assert found.runs == [(0, 200_000, 5000)]
    assert found.kept() == [*unit, b"end"]


def test_registered_runs(spark):
    found = {r["doc_id"]: r.asDict() for r in queries.periodic_runs(spark, DATA).collect()}
    docs = table("documents")
    assert len(found) == len(docs)
    planted = 0
    for doc in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", doc["text"] or "")
        h = zlib.crc32(str(doc["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        kept = " ".join(brute_kept(words, runs))
        assert found[doc["doc_id"]] == {
            "doc_id": doc["doc_id"],
            "n_runs": len(runs),
            "start": best[0],
            "length": best[1],
            "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if runs else None,
            "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(kept.encode()).hexdigest(),
        }
    assert planted


def test_runs_of_odd_rows(spark):
    long = " ".join(["a b c"] * 20_000)
    rows = [(1, None), (None, ""), (2, " \t\n"), (3, "x\x1cx x " * 9), (4, long), (4, long), (5, "é " * 6)]
    docs = spark.createDataFrame([(*r, 9, "mine") for r in rows], "doc_id long, text string, n_runs int, `a.b` string")
    found = periodic.collapsed(docs, keep=("doc_id", "n_runs", "a.b")).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(rows) and by_id[1]["a.b"] == "mine"
    assert [by_id[i]["n_runs"] for i in (1, None, 2, 3, 4, 5)] == [0, 0, 0, 1, 1, 1]
    assert by_id[1]["collapsed"] == by_id[None]["collapsed"] == by_id[2]["collapsed"] == ""
    assert by_id[4]["collapsed"] == "a b c" and by_id[4]["exponent_milli"] == 20_000_000
    assert by_id[3]["collapsed"] == "x\x1cx x" and by_id[5]["collapsed"] == "é"
    assert by_id[1]["start"] is None and by_id[1]["runs"] == []
    assert periodic.collapsed(docs.limit(0)).count() == 0


# --- url rules --------------------------------------------------------------


def judged_alone(url, rules, default="allow"):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fit = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else default


def test_rules_on_odd_urls(spark):
    rng = random.Random(3)
    labels = ["a", "b", "net", "org", "x-y", "", "é", "a_b"]
    paths = ["", "/", "/en/", "/en", "/fr/x", "/en/deep/er", "/é/", "//", "/en/\U0010ffff"]
    rules = [
        (".".join(rng.choice(labels) for _ in range(rng.randint(1, 3))), rng.choice(paths), rng.choice(["block", "allow"]))
        for _ in range(60)
    ]
    rules += [(h, p, v) for h, p, _ in rules[:5] for v in ("allow", "block")] + [(None, "/", "block"), ("a", None, "block")]
    urls = [None, "", "x", "http://", "http:///", "ftp://a.b?x", "http://A.NET#z/y", "http://a.net/en/x?http://b"]
    urls += ["q/http://b.net/en//\nfoo", "http://a.b/" + "en/" * 50_000]
    for _ in range(600):
        host = ".".join(rng.choice([*labels, "c"]) for _ in range(rng.randint(1, 4)))
        urls.append("http://" + host + rng.choice([*paths, "/en/zz"]) + rng.choice(["", "?a", "#b", "index"]))
    urls += urls[20:40]
    pages = spark.createDataFrame([(i, u, "old", 7) for i, u in enumerate(urls)], "id long, url string, rule string, `row` int")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = {r["id"]: r for r in url_rules.judged(pages, listed).collect()}
    assert len(found) == len(urls)
    for i, url in enumerate(urls):
        r = found[i]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged_alone(url, rules)
        assert r["row"] == 7 and r["url"] == url
    assert sum(r["rule"] is not None for r in found.values()) > 100
    assert url_rules.judged(pages.limit(0), listed).count() == 0
    without = url_rules.judged(pages, listed.limit(0), default="block")
    assert {tuple(r) for r in without.select("rule", "verdict").distinct().collect()} == {(None, "block")}


def test_intervals_reach_over_many_ranges(spark):
    """Keys of one wide interval lie in every range, those of deep ones in some."""
    keys = [f"{i:05d}".encode() for i in range(3000)]
    spans = [(b"0", b"1", 1), (b"00", b"01", 2), (b"0001", b"0002", 3), (b"02", b"03", 4), (b"02500", b"02500\xff", 5)]
    points = spark.createDataFrame([(bytearray(k),) for k in keys], "key binary")
    intervals = spark.createDataFrame([(bytearray(a), bytearray(b), i) for a, b, i in spans], "lo binary, hi binary, id int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        found = {bytes(r["key"]): r["stack"] for r in url_rules.stacks(points, intervals, "test").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == {k: [i for a, b, i in spans if a <= k < b] for k in keys}


def test_registered_rules(spark):
    with duckdb.connect() as database:
        database.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{DATA}/pages.parquet')")
        wanted = database.execute(
            f"SELECT page_id, host, path, rule, verdict FROM ({__spark_entry__.oracle_sql()['op11_url_rules']})"
        ).fetchall()
    found = [tuple(r) for r in queries.url_filter(spark, DATA).select("page_id", "host", "path", "rule", "verdict").collect()]
    assert sorted(found) == sorted(wanted)
    by_hand = sorted((p["page_id"], *judged_alone(p["url"], queries.RULES)) for p in table("pages"))
    assert sorted(found) == by_hand


# --- whitening --------------------------------------------------------------


def exact(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    centred = x - x.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    values, vectors = values[::-1], vectors[:, ::-1]
    return centred @ vectors[:, :k] / np.sqrt(values[:k]), values


def test_registered_whitening(spark):
    found = queries.embedding_whitening(spark, DATA).toPandas()
    rows = table("embeddings")
    x = np.floor(1024 * np.array([r["embedding"] for r in rows], np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    w, values = exact(x, 8)
    ids = [r["vec_id"] for r in rows]
    got = found.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    got = got * np.sign((got * w).sum(0))
    assert np.abs(got - w).max() < 1e-9
    first = found[found["component"] == 1].set_index("vec_id").loc[ids]
    assert first["deviation"].tolist() == ((n * x - s) ** 2).sum(1).tolist()
    assert set(found["n"]) == {n} and len(found) == 8 * n
    share = found.groupby("component")["explained"].first().to_numpy()
    assert np.abs(share / (values[:8] / values.sum()) - 1).max() < 1e-12
    assert found["identity_error"].max() < 1e-9


def test_whitening_of_a_spectrum_without_gaps(spark):
    """Far more dimensions than the block, eigenvalues close together: only the filter helps."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((600, 80)) * np.linspace(1.3, 1, 80) @ np.linalg.qr(rng.standard_normal((80, 80)))[0] + 50
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    passes = whitening.Passes(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(20))
    fitted = whitening.fit(passes, 5)
    w, values = exact(x, 5)
    assert fitted.rounds > 1 and fitted.residual < 1e-9
    assert np.abs(fitted.eigenvalues / values[:5] - 1).max() < 1e-12
    got = (x - fitted.mean) @ fitted.components / np.sqrt(fitted.eigenvalues)
    assert np.abs(got * np.sign((got * w).sum(0)) - w).max() < 1e-8
    assert whitening.identity_error(passes, fitted) < 1e-10


@pytest.mark.parametrize("kind", ["float", "double"])
def test_whitening_of_odd_rows(spark, kind):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0, 5.0]), (1, [2.0, 1.0, 5.0]), (None, [4.0, 4.0, 5.0]), (2, [1.0, 2.0, 5.0])]
    bad = [(3, None), (4, []), (5, [1.0, None, 2.0]), (6, [nan, 1.0, 2.0]), (7, [inf, 1.0, 2.0]), (8, [1.0]), (9, [-inf, 0.0, 0.0])]
    table = spark.createDataFrame(good + bad, f"vec_id long, embedding array<{kind}>").selectExpr("*", "1 AS whitened")
    vectors = whitening.usable(table)
    passes = whitening.Passes(vectors)
    fitted = whitening.fit(passes, 8)
    # The third dimension never varies, so there are two components.
    assert fitted.n == 4 and fitted.components.shape == (3, 2)
    w, _ = exact(np.array([v for _, v in good]), 2)
    got = np.array([r["whitened"] for r in whitening.whitened(vectors, fitted, keep=("vec_id", "whitened")).collect()])
    assert np.abs(np.sort(np.abs(got), 0) - np.sort(np.abs(w), 0)).max() < 1e-9
    none = whitening.usable(table.where("vec_id > 2"))
    assert whitening.fit(whitening.Passes(none.where("size(embedding) > 1")), 8) is None
    same = whitening.fit(whitening.Passes(vectors.where("vec_id = 2")), 8)
    assert same.n == 1 and same.components.shape == (3, 0)
    assert whitening.whitened(vectors, same).select("whitened").first()[0] == []


def test_whitening_query_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.embedding_whitening(spark, str(tmp_path))
    assert found.count() == 0
    assert found.columns == queries.embedding_whitening(spark, DATA).columns
