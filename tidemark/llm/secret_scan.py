"""Secrets in texts: three fixed patterns, and runs of characters that look random.

The patterns' matches are leftmost and do not overlap within a kind; those that are too
short are dropped.  Kind `markov` adds spans by two first-order character models, one of
random strings and one of ordinary words and identifiers.  A candidate is any run of LEAST
letters, digits and `+/_-` or more, with the `=` that may end it; nothing else is asked of it.
It is a span if the log-likelihood ratio of its steps adds up to more than ODDS, and no
base span overlaps it.

The models are trained on the whole corpus: what the patterns found is random, at most SAMPLE
values of a kind, the least by hash; all other words are ordinary, each counted once.
Both are mixed with a uniform choice of characters, so that no step decides by itself.

Everything is DataFrame functions.  Words are scored in the row of their text; only texts with a
find are taken apart.  Positions count code points.  Matches are one row each until they are
put together per document, so a text with very many is no harder.  A null text is empty.  Rows
that repeat a doc_id count by themselves, but for equal texts, which have the same result.  Columns
other than id and text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common

# Kind, pattern, group whose length counts, least length.
BASE = [
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
]
LEAST = 8
CANDIDATE = ("markov", r"[A-Za-z0-9+/_-]{8,}={0,2}", 0, LEAST)
KINDS = [kind for kind, *_ in BASE] + ["markov"]
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SAMPLE = 20_000
ODDS = 5.0  # logarithm: about one in 150 is taken to be random beforehand
SMOOTHING = 0.5
UNIFORM = {"random": 0.5, "ordinary": 0.05}  # share of a uniform choice in each model


def _matches(texts: DataFrame, kinds: list[tuple]) -> DataFrame:
    """Rows (doc_id, mark, kind, start, end, value), with what is too short left out."""
    found = []
    for kind, pattern, group, least in kinds:
        rx = F.lit(pattern)
        some = F.col("t").rlike(pattern)
        found.append(
            F.struct(
                F.lit(kind).alias("kind"),
                F.lit(least).alias("least"),
                F.when(some, F.split("t", pattern, -1)).alias("gaps"),
                F.when(some, F.regexp_extract_all("t", rx, F.lit(0))).alias("wholes"),
                F.when(some, F.regexp_extract_all("t", rx, F.lit(group))).alias("values"),
            )
        )
    rows = texts.select("doc_id", "mark", F.inline(F.array(*found))).where("wholes is not null")
    rows = rows.select("doc_id", "mark", "kind", "least", F.posexplode(F.arrays_zip("gaps", "wholes", "values")).alias("k", "m"))
    rows = rows.where("m.wholes is not null").select(
        "doc_id",
        "mark",
        "kind",
        "least",
        "k",
        F.length("m.gaps").alias("gap"),
        F.length("m.wholes").alias("size"),
        F.col("m.values").alias("value"),
    )
    order = Window.partitionBy("doc_id", "mark", "kind").orderBy("k")
    placed = rows.distinct().withColumn("end", F.sum(F.col("gap") + F.col("size")).over(order).cast("long"))
    return placed.where("length(value) >= least").select(
        "doc_id", "mark", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "value"
    )


def _pairs(values: DataFrame) -> dict[str, int]:
    """How often each character of the alphabet follows each, in the values; a row a pair at most."""
    steps = F.sequence(F.lit(1), F.length("value") - 1)
    two = F.transform(steps, lambda i: F.substring(F.col("value"), i, F.lit(2)))
    pairs = values.where("length(value) > 1").select(F.explode(two).alias("two"))
    known = pairs.where(F.col("two").rlike(r"^[A-Za-z0-9+/_=-]{2}$")).groupBy("two").agg(F.count("*").alias("k"))
    return {r["two"]: r["k"] for r in known.collect()}


def train(base: DataFrame, texts: DataFrame) -> list[float]:
    """Log-likelihood ratios of random over ordinary, by pair of characters in the alphabet."""
    values = base.select("kind", F.regexp_replace("value", r"[^A-Za-z0-9+/_=-]", "").alias("value")).distinct()
    values = common.store(values, "base-values")
    samples = [
        values.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(SAMPLE) for kind, *_ in BASE
    ]
    random = samples[0].unionAll(samples[1]).unionAll(samples[2])
    words = texts.select(F.explode(F.regexp_extract_all("t", F.lit("[A-Za-z0-9_-]{4,}"), F.lit(0))).alias("value"))
    # Counted before they are dealt out, so a frequent word is one row of each task.
    words = words.groupBy("value").count().select("value").join(values.select("value").distinct(), "value", "left_anti")
    logs = {}
    for label, found in (("random", _pairs(random)), ("ordinary", _pairs(words))):
        share = UNIFORM[label]
        for a in ALPHABET:
            row = [found.get(a + b, 0) + SMOOTHING for b in ALPHABET]
            for b, x in zip(ALPHABET, row, strict=True):
                logs[label, a + b] = math.log((1 - share) * x / sum(row) + share / len(ALPHABET))
    return [logs["random", a + b] - logs["ordinary", a + b] for a in ALPHABET for b in ALPHABET]


def score(value: Column, weights: list[float]) -> Column:
    """Log-likelihood ratio of a value's steps; its characters are of the alphabet."""
    # A folded constant: one array for the whole query.
    table = F.split(F.lit(",".join(f"{w:.6f}" for w in weights)), ",").cast("array<double>")
    n = len(ALPHABET)
    codes = F.transform(
        F.sequence(F.lit(1), F.length(value)), lambda i: F.instr(F.lit(ALPHABET), F.substring(value, i, F.lit(1)))
    )
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("last"))

    def step(so_far: Column, code: Column) -> Column:
        gain = F.when(so_far["last"] > 0, F.get(table, (so_far["last"] - 1) * n + code - 1)).otherwise(F.lit(0.0))
        return F.struct((so_far["total"] + gain).alias("total"), code.alias("last"))

    return F.aggregate(codes, start, step, lambda s: s["total"])


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, mark, kind, start, end): base spans and those that the models add."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("t"))
    base = common.store(_matches(texts, BASE), "matches")
    weights = train(base, texts)
    words = F.array_distinct(F.regexp_extract_all("t", F.lit(CANDIDATE[1]), F.lit(0)))
    odd = texts.select("*", F.filter(words, lambda w: score(w, weights) > ODDS).alias("odd")).where(F.size("odd") > 0)
    odd = common.store(odd, "texts-with-finds")
    listed = odd.select("doc_id", "mark", F.explode("odd").alias("value")).distinct()
    added = _matches(odd, [CANDIDATE]).join(
        listed.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("value").alias("_value")),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")) & (F.col("value") == F.col("_value")),
        "left_semi",
    )
    both = base.unionAll(added).drop("value")
    place = Window.partitionBy("doc_id", "mark").orderBy("start", "end", "kind")
    before = F.max(F.when(F.col("kind") != "markov", F.col("end"))).over(place.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("kind") != "markov", F.col("start"))).over(
        place.orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    )
    free = (F.coalesce(before, F.lit(-1)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    marked = both.withColumn("free", (F.col("kind") != "markov") | free)
    return marked.where("free").drop("free")


def reported(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov."""
    found = spans(docs, id_col, text_col)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    listed = F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind")))
    counts = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS]
    per_doc = found.groupBy("doc_id", "mark").agg(*counts, listed.alias("listed"))
    per_doc = common.store(per_doc, "secrets").withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})

    def joined(kept: Column) -> Column:
        return F.coalesce(F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","), F.lit(""))

    keys = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("mark"))
    same = keys["doc_id"].eqNullSafe(F.col("_id")) & (keys["mark"] == F.col("_mark"))
    out = keys.join(per_doc, same, "left")
    return out.select(
        "doc_id",
        *(F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(joined(F.filter("listed", lambda s: s["kind"] != "markov")), 256).alias("base_sha256"),
        joined(F.col("listed")).alias("spans"),
        F.coalesce("n_markov", F.lit(0).cast("long")).alias("n_markov"),
    )
