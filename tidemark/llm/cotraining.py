"""Quality and toxicity by co-training: a view of the content, a view of the metadata.

* Content: which words and which raw tokens a text has, hashed into BUCKETS.  Naive Bayes over
  the FEATURES most telling buckets.
* Metadata: source, language, length and layout (shares of kinds of characters, lines, how
  often words repeat).  Logistic regression.

Over ROUNDS, each view labels all unlabelled documents it is sure of, and the other view trains
on them.  The class that is labelled more often than its share counts for less, so that the
shares stay those of the labelled rows.  Each view's log-odds are then calibrated, and combined,
on labelled rows that no view was trained on.

Every text is read once: its buckets and facts are stored, and all rounds go over those, many
documents at a time.  What a task counts is an array of fixed size, as are the sums for a
Newton step; they are added up in a tree of tasks.  The counts, megabytes of them, stay in the
shared folder: a task fits the content's views to them, and the driver gets those.

The models are fitted on SAMPLE labelled rows, the least by a hash of doc_id, and on every
unlabelled document.  The driver gets the sums of Newton steps and the labelled rows' facts.  Every
document is scored.

A document whose labels disagree counts as of low quality, and as toxic, if any label says
so.  Null labels are left out.  A target with one class only, or none, gets a constant; without
labels all documents are kept.  Null or empty texts are scored by what is left of both views.
Rows that repeat a doc_id are scored one by one; of labelled ones, the one with the least
hash of its buckets trains.  Other columns of the documents, whatever their names, stay as they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

SAMPLE = 20_000
BUCKETS = 1 << 18
FEATURES = 4096
ROUNDS = 3
SURE = 0.98
SOURCES = 32
FACTS = 12 + SOURCES + 8
GROUP = 1 << 20  # bytes of text described at a time
FAN_IN = 16  # sums that one task adds up

_SYMBOLS = np.frombuffer(b"!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~", np.uint8)
_LETTERS = np.full(256, 32, np.uint8)
for _b in [*range(65, 91), *range(97, 123), *range(128, 256)]:
    _LETTERS[_b] = _b
_LETTERS = _LETTERS.tobytes()


def _buckets(texts: list[bytes]) -> list[np.ndarray]:
    """The bucket of every word of each text."""
    found = [np.concatenate([*map(common.hash_bytes, common.cut(t))]) if len(t) > common.PIECE else None for t in texts]
    short = [i for i, x in enumerate(found) if x is None]
    for i, hashes in zip(short, common.hashed_bytes([texts[i] for i in short]), strict=True):
        found[i] = hashes
    return [(x >> np.uint64(46)).astype(np.int32) for x in found]


def contents(texts: list[bytes]) -> list[np.ndarray]:
    """Buckets of the raw tokens and of the words of each text; a word may be in both."""
    raw, words = _buckets(texts), _buckets([t.translate(_LETTERS) for t in texts])
    return [np.concatenate(both) for both in zip(raw, words, strict=True)]


def content(text: str | None) -> np.ndarray:
    return contents([(text or "").encode()])[0]


def layouts(texts: list[bytes], sizes: np.ndarray, distinct: np.ndarray, sources: list, langs: list) -> np.ndarray:
    """A row of facts for each text, of which the number of words and of different ones are known."""
    counts = np.stack([np.bincount(np.frombuffer(t, np.uint8), minlength=256) for t in texts])
    length = counts.sum(1)
    n = np.maximum(1, length)
    symbols, upper = counts[:, _SYMBOLS].sum(1) / n, counts[:, 65:91].sum(1) / n
    facts = np.zeros((len(texts), FACTS), np.float32)
    columns = [
        np.ones(len(texts)),
        upper,
        counts[:, 48:58].sum(1) / n,
        symbols,
        counts[:, 124] / n,
        counts[:, 33] / n,
        counts[:, 32] / n,
        counts[:, 10] / n,
        np.sqrt(symbols),
        np.sqrt(upper),
        distinct / np.maximum(1, sizes),
        np.log1p(length) / 10,
    ]
    facts[:, : len(columns)] = np.stack(columns, 1)
    rows = np.arange(len(texts))
    facts[rows, len(columns) + np.array([common.small_hash(x) % SOURCES for x in sources], int)] = 1
    facts[rows, len(columns) + SOURCES + np.array([common.small_hash(x) % 8 for x in langs], int)] = 1
    return facts


def describe(texts: list[str | None], sources: list, langs: list) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """(distinct buckets of each, facts) of groups of texts, in their order."""
    data = [(t or "").encode() for t in texts]
    at = 0
    while at < len(data):
        end, size = at, 0
        while end < len(data) and (end == at or size + len(data[end]) <= GROUP):
            size += len(data[end])
            end += 1
        found = contents(data[at:end])
        sizes = np.array([len(x) for x in found])
        owner = np.repeat(np.arange(end - at), sizes)
        place = np.unique((owner << 32) | np.concatenate([np.empty(0, np.int32), *found]).astype(np.int64))
        bounds = np.searchsorted(place >> 32, np.arange(end - at + 1))
        sets = [(place[a:b] & 0xFFFFFFFF).astype(np.int32) for a, b in zip(bounds, bounds[1:], strict=False)]
        yield sets, layouts(data[at:end], sizes, np.diff(bounds), sources[at:end], langs[at:end])
        at = end


def slopes(x: np.ndarray, y: np.ndarray, w: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Hessian and gradient of the log-likelihood, side by side."""
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return np.column_stack([(x * (weights * p * (1 - p))[:, None]).T @ x, x.T @ (weights * (y - p))])


def logistic(
    own: list[tuple[np.ndarray, np.ndarray]],
    ridge: float = 1.0,
    steps: int = 25,
    start: list[np.ndarray] | None = None,
    more: Callable[[list[np.ndarray]], np.ndarray] | None = None,
) -> list[np.ndarray]:
    """Weights of ridge logistic regressions of (x, y), by Newton steps taken together.

    `more` gives the slopes of rows elsewhere, for all of them at once.
    """
    ws = start or [np.zeros(x.shape[1]) for x, _ in own]
    for _ in range(steps):
        added = more(ws) if more else [0] * len(own)
        most = 0.0
        for i, (x, y) in enumerate(own):
            both = slopes(x, y, ws[i], np.ones(len(y))) + added[i]
            change = np.linalg.solve(both[:, :-1] + ridge * np.eye(x.shape[1]), both[:, -1] - ridge * ws[i])
            ws[i] = ws[i] + change
            most = max(most, float(np.abs(change).max()))
        if most < (1e-3 if more else 1e-6):
            break
    return ws


def telling(counts: np.ndarray, yes: float, no: float) -> np.ndarray:
    """The buckets that tell two classes apart, from how many texts of each have every bucket, and how many there are."""
    yes, no = max(1.0, yes), max(1.0, no)
    inside, outside = counts
    a, b = (inside + 0.1) / (yes + 0.2), (outside + 0.1) / (no + 0.2)
    apart = np.abs(a - b) / np.sqrt((inside + outside + 1) / (yes + no) * (1 / yes + 1 / no))
    apart[inside + outside == 0] = 0
    best = np.argsort(-apart, kind="stable")[:FEATURES]
    return np.sort(best[apart[best] > 5]).astype(np.int32)


@dataclass
class Bayes:
    """Bernoulli naive Bayes over the buckets that tell the classes apart best."""

    keys: np.ndarray
    weights: np.ndarray
    prior: float

    @classmethod
    def fit(cls, keys: np.ndarray, counts: np.ndarray, yes: float, no: float) -> Bayes:
        """From `telling` buckets, how many texts of each class have them, and how many there are."""
        yes, no = max(1.0, yes), max(1.0, no)
        a, b = (counts[0] + 0.1) / (yes + 0.2), (counts[1] + 0.1) / (no + 0.2)
        return cls(keys, np.log(a) - np.log(b), float(np.log(yes / no)))

    def scores(self, owner: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
        """Log-odds of n texts from their distinct buckets, laid end to end."""
        table = np.zeros(BUCKETS)
        table[self.keys] = self.weights
        return self.prior + np.bincount(owner, weights=table[buckets], minlength=n)


@dataclass
class Model:
    """The views of one target and how they are combined."""

    bayes: Bayes | None
    weights: np.ndarray | None
    combined: np.ndarray
    constant: float | None = None

    def features(self, batch: Described) -> np.ndarray:
        # Log-odds far out say no more than that a view is sure.
        a = np.clip(self.bayes.scores(batch.owner, batch.buckets, batch.n), -30, 30)
        b = np.clip(batch.facts @ self.weights, -30, 30)
        return np.stack([np.ones(batch.n), a, b, np.tanh(a / 4), np.tanh(b / 2)], 1)

    def probabilities(self, batch: Described) -> np.ndarray:
        if self.constant is not None:
            return np.full(batch.n, self.constant)
        return 1 / (1 + np.exp(-np.clip(self.features(batch) @ self.combined, -30, 30)))


TARGETS = ("quality", "toxic")
COUNTS = [f"{t}_{side}" for t in TARGETS for side in ("yes", "no")]
DESCRIBED = "doc_id long, buckets binary, facts binary"


@dataclass
class Described:
    """Documents as arrays: which text each bucket is of, the buckets, and the facts."""

    n: int
    owner: np.ndarray
    buckets: np.ndarray
    facts: np.ndarray

    @classmethod
    def of(cls, sets: list[np.ndarray], facts: np.ndarray) -> Described:
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        return cls(len(sets), owner, np.concatenate([np.empty(0, np.int32), *sets]), facts)

    @classmethod
    def read(cls, batch: pa.RecordBatch) -> Described:
        """From a batch with the columns of DESCRIBED first."""
        sets = [np.frombuffer(x, np.int32) for x in batch.column(1).to_pylist()]
        facts = [np.frombuffer(x, np.float32) for x in batch.column(2).to_pylist()]
        return cls.of(sets, np.array(facts, np.float64).reshape(-1, FACTS))


def described(docs: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Buckets and facts of every row, stored."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at = 0
        for sets, facts in describe(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(at, len(sets)),
                    pa.array([x.tobytes() for x in sets], pa.binary()),
                    pa.array([x.tobytes() for x in facts], pa.binary()),
                ],
                names=["doc_id", "buckets", "facts"],
            )
            at += len(sets)

    return common.store(common.in_batches(_columns(docs, columns or COLUMNS), run, DESCRIBED), "described")


def in_one(parts: DataFrame, tasks: int) -> DataFrame:
    """The sum of arrays of doubles, one row `part` from each task, in a tree of tasks: one row, or none."""

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in batch.column(0).to_pylist():
                part = np.frombuffer(part)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    while tasks > 1:
        tasks = math.ceil(tasks / FAN_IN)
        parts = parts.repartition(tasks).mapInArrow(merge, "part binary")
    return parts


def added_up(parts: DataFrame, tasks: int) -> np.ndarray | None:
    """The same, brought to the driver."""
    found = in_one(parts, tasks).collect()
    return np.frombuffer(found[0]["part"]) if found else None


def _held(doc_id: int) -> bool:
    """Whether a labelled row is trained on (False) or calibrated on."""
    return common.small_hash(str(doc_id)) % 3 == 0


def _marks(batch: pa.RecordBatch) -> np.ndarray:
    """The labels after the columns of DESCRIBED, nan for none."""
    return np.stack([batch.column(3 + k).to_numpy(zero_copy_only=False).astype(float) for k in range(len(TARGETS))], 1)


def _training_marks(batch: pa.RecordBatch, _: Described) -> np.ndarray:
    held = np.array([_held(x) for x in batch.column(0).to_pylist()], bool)
    return np.where(held[:, None], np.nan, _marks(batch))


def _counted(rows: DataFrame, marks: Callable[[pa.RecordBatch, Described], np.ndarray]) -> DataFrame:
    """How many texts of each class have each bucket, and how many texts of each class there are, stored."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros((len(COUNTS), BUCKETS)), np.zeros(len(COUNTS))
        for batch in batches:
            docs = Described.read(batch)
            given = marks(batch, docs)
            for i in range(len(COUNTS)):
                chosen = given[:, i // 2] == 1 - i % 2
                texts[i] += chosen.sum()
                if chosen.any():
                    total[i] += np.bincount(docs.buckets[chosen[docs.owner]], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array([np.append(total.ravel(), texts).tobytes()], pa.binary())], names=["part"])

    return common.store(in_one(rows.mapInArrow(run, "part binary"), rows.rdd.getNumPartitions()), "counts")


def _by_content(targets: list[int], own: DataFrame, more: DataFrame | None = None) -> tuple[dict[int, Bayes], np.ndarray]:
    """Views of the content, and how many texts of each class are labelled.

    From what `_counted` stored of the labelled rows, and of more rows.  A task, which holds two
    such arrays, picks the buckets; the driver gets those.
    """
    parts = own.select(F.lit(0).alias("side"), "part")
    if more is not None:
        parts = parts.unionAll(more.select(F.lit(1).alias("side"), "part"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, len(COUNTS) * (BUCKETS + 1)))
        for batch in batches:
            for side, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found[side] += np.frombuffer(part.as_buffer())
        own_counts, counts = found[:, : -len(COUNTS)].reshape(2, len(TARGETS), 2, BUCKETS)
        own_totals, totals = found[:, -len(COUNTS) :].reshape(2, len(TARGETS), 2)
        for k in targets:
            balance = _balance(totals[k], own_totals[k])
            both, texts = own_counts[k] + counts[k] * balance[:, None], own_totals[k] + totals[k] * balance
            keys = telling(both, *texts)
            made = [keys, both[:, keys], texts, own_totals]
            columns = [pa.array([k], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in made)]
            yield pa.RecordBatch.from_arrays(columns, names=["k", "keys", "counts", "texts", "own"])

    shape = "k int, keys binary, counts binary, texts binary, own binary"
    views = {}
    for r in parts.coalesce(1).mapInArrow(run, shape).collect():
        keys, own_totals = np.frombuffer(r["keys"], np.int32), np.frombuffer(r["own"]).reshape(-1, 2)
        counts = np.frombuffer(r["counts"]).reshape(2, -1)
        views[r["k"]] = Bayes.fit(keys, counts, *np.frombuffer(r["texts"]))
    return views, own_totals


def _balance(given: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Weights, one at most, by which given classes have the shares of the own ones."""
    most = given / own
    return np.where(given > 0, most.min() / np.maximum(most, 1e-9), 1.0) if (given > 0).all() else np.ones(2)


def _elsewhere(given: DataFrame, targets: list[int], balances: list[np.ndarray]) -> Callable:
    """The slopes of stored rows (facts, a label per target) as a function of the weights."""
    tasks = given.rdd.getNumPartitions()

    def more(ws: list[np.ndarray]) -> np.ndarray:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(targets), FACTS, FACTS + 1))
            for batch in batches:
                x = np.array([np.frombuffer(f, np.float32) for f in batch.column(0).to_pylist()], float).reshape(-1, FACTS)
                for i, k in enumerate(targets):
                    y = batch.column(1 + k).to_numpy(zero_copy_only=False)
                    sure = ~np.isnan(y)
                    total[i] += slopes(x[sure], y[sure], ws[i], np.where(y[sure] == 1, *balances[i]))
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

        found = added_up(given.mapInArrow(run, "part binary"), tasks)
        shape = (len(targets), FACTS, FACTS + 1)
        return np.zeros(shape) if found is None else found.reshape(shape)

    return more


def _sure(odds: np.ndarray) -> np.ndarray:
    """Labels of the rows whose log-odds are beyond SURE, nan for the others."""
    return np.where(np.abs(odds) > np.log(SURE / (1 - SURE)), (odds > 0).astype(float), np.nan)


def _columns(docs: DataFrame, columns: dict[str, str]) -> DataFrame:
    def named(part: str):
        name = columns.get(part)
        return F.col(name) if name and name in docs.columns else F.lit(None)

    return docs.select(
        F.col(columns["id"]).cast("long").alias("doc_id"),
        F.col(columns["text"]).alias("text"),
        named("source").cast("string").alias("source"),
        named("lang").cast("string").alias("lang"),
    )


COLUMNS = {"id": "doc_id", "text": "text", "source": "source", "lang": "lang"}


def fit(docs: DataFrame, labels: DataFrame, columns: dict[str, str] = COLUMNS) -> dict[str, Model]:
    """Models of `quality` and `toxic`, from columns doc_id, quality and toxic of the labels."""
    return fit_described(described(docs, columns), labels)


def fit_described(rows: DataFrame, labels: DataFrame) -> dict[str, Model]:
    """The same from `described` rows."""
    each = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id"))
    each = each.agg(*[worst(F.col(t).cast("double")).alias(t) for t, worst in zip(TARGETS, (F.min, F.max), strict=True)])
    asked = common.store(each.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE), "labelled")
    given_ids = F.broadcast(asked)  # SAMPLE rows at most
    names = ["doc_id", "buckets", "facts", *TARGETS]
    labelled = rows.join(given_ids, F.col("doc_id") == F.col("_id")).select(names)
    first = F.min_by(F.struct(*names), F.xxhash64("buckets", "facts")).alias("row")
    labelled = common.store(labelled.groupBy("doc_id").agg(first).select("row.*"), "labelled-rows")
    free = rows.join(given_ids, F.col("doc_id") == F.col("_id"), "left_anti")

    known = labelled.select("doc_id", "facts", *TARGETS).toArrow().sort_by("doc_id").combine_chunks()
    held = np.array([_held(x) for x in known["doc_id"].to_pylist()], bool)
    facts = np.array([np.frombuffer(x, np.float32) for x in known["facts"].to_pylist()], float).reshape(-1, FACTS)
    marks = np.stack([known[t].to_numpy().astype(float) for t in TARGETS], 1)
    models: dict[str, Model] = {}
    fitted: dict[int, Model] = {}
    for k, target in enumerate(TARGETS):
        y = marks[:, k]
        trained, kept = y[~held & ~np.isnan(y)], y[held & ~np.isnan(y)]
        y = y[~np.isnan(y)]
        if len(y) < 20 or len(np.unique(trained)) < 2 or len(np.unique(kept)) < 2:
            models[target] = Model(None, None, np.zeros(5), float(y.mean()) if len(y) and len(np.unique(y)) == 1 else 0.5)
        else:
            models[target] = fitted[k] = Model(None, None, np.zeros(5))
    if not fitted:
        return models
    targets = list(fitted)
    own = [(facts[~held & ~np.isnan(marks[:, k])], marks[~held & ~np.isnan(marks[:, k]), k]) for k in targets]
    own_counts = _counted(labelled, _training_marks)
    content, own_totals = _by_content(targets, own_counts)
    _train(fitted, content, logistic(own))
    for _ in range(ROUNDS):
        views = dict(fitted)

        def by_metadata(_: pa.RecordBatch, docs: Described, views: dict[int, Model] = views) -> np.ndarray:
            out = np.full((docs.n, len(TARGETS)), np.nan)
            for k, model in views.items():
                out[:, k] = _sure(docs.facts @ model.weights)
            return out

        counts = _counted(free, by_metadata)
        given = common.store(_labelled_by_content(free, views), "given")
        said = given.agg(*[F.count_if(F.col(t) == side).alias(f"{t}_{side}") for t in TARGETS for side in (1, 0)]).first()
        balances = [_balance(np.array(said[2 * k : 2 * k + 2], float), own_totals[k]) for k in targets]
        weights = logistic(own, start=[fitted[k].weights for k in targets], more=_elsewhere(given, targets, balances))
        content, _ = _by_content(targets, own_counts, counts)
        _train(fitted, content, weights)
        common.discard(given)
        common.discard(counts)
        common.free(rows.sparkSession)
    common.discard(own_counts)
    _calibrate(fitted, labelled)
    return models


def _train(fitted: dict[int, Model], content: dict[int, Bayes], weights: list[np.ndarray]) -> None:
    """New views of content and of metadata."""
    for (k, model), w in zip(fitted.items(), weights, strict=True):
        model.bayes, model.weights = content[k], w


def _labelled_by_content(free: DataFrame, views: dict[int, Model]) -> DataFrame:
    """Facts of the rows that the content is sure of, with a label per target, nan for none."""
    bayes = {k: model.bayes for k, model in views.items()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = Described.read(batch)
            out = np.full((docs.n, len(TARGETS)), np.nan)
            for k, view in bayes.items():
                out[:, k] = _sure(view.scores(docs.owner, docs.buckets, docs.n) / 4)
            some = ~np.isnan(out).all(1)
            found = pa.RecordBatch.from_arrays([batch.column(2), *map(pa.array, out.T)], names=["facts", *TARGETS])
            yield found.filter(pa.array(some))

    return free.mapInArrow(run, "facts binary, " + ", ".join(f"{t} double" for t in TARGETS))


def _calibrate(fitted: dict[int, Model], labelled: DataFrame) -> None:
    """Combine the views on the labelled rows that none was trained on."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = pa.array([_held(x) for x in batch.column(0).to_pylist()], pa.bool_())
            batch = batch.filter(held)
            docs, marks = Described.read(batch), _marks(batch)
            for k, model in fitted.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.full(docs.n, k, np.int32)),
                        pa.array(model.features(docs).tolist(), pa.list_(pa.float64())),
                        pa.array(marks[:, k]),
                    ],
                    names=["doc_id", "k", "x", "y"],
                )

    seen = labelled.mapInArrow(run, "doc_id long, k int, x array<double>, y double").toArrow().sort_by("doc_id")
    ks, y = seen["k"].to_numpy(), seen["y"].to_numpy()
    x = seen["x"].combine_chunks().flatten().to_numpy().reshape(-1, 5)
    for k, model in fitted.items():
        used = (ks == k) & ~np.isnan(y)
        (model.combined,) = logistic([(x[used], y[used])], ridge=0.1)


def scored(docs: DataFrame, models: dict[str, Model], columns: dict[str, str] = COLUMNS) -> DataFrame:
    """Per row: doc_id, mark of the text and metadata, p_quality, p_toxic, keep."""
    return scored_described(described(docs, columns), models)


def scored_described(rows: DataFrame, models: dict[str, Model]) -> DataFrame:
    """The same from `described` rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = Described.read(batch)
            quality, toxic = (models[t].probabilities(docs) for t in TARGETS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(quality), pa.array(toxic), pa.array(decisions(quality, toxic))],
                names=["doc_id", "p_quality", "p_toxic", "keep"],
            )

    common.ship(rows.sparkSession)
    return rows.mapInArrow(run, "doc_id long, p_quality double, p_toxic double, keep boolean")


def decisions(quality: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    return (quality >= 0.5) & (toxic <= 0.5)


def classified(docs: DataFrame, labels: DataFrame, columns: dict[str, str] = COLUMNS) -> DataFrame:
    """`scored` by the models fitted on the same documents, each text read once."""
    rows = described(docs, columns)
    return scored_described(rows, fit_described(rows, labels))


def accepted(docs: DataFrame, labels: DataFrame, columns: dict[str, str] = COLUMNS) -> DataFrame:
    """The documents that the classifier keeps, as they are; each row is scored where it is read."""
    models = fit(docs, labels, columns)
    names = [columns.get(k) for k in ("text", "source", "lang")]
    at = [docs.columns.index(n) if n in docs.columns else None for n in names]

    def run(batch: pa.RecordBatch):
        nothing = [None] * batch.num_rows
        values = [batch.column(i).to_pylist() if i is not None else nothing for i in at]
        keep = [np.empty(0, bool)]
        for sets, facts in describe(*values):
            docs = Described.of(sets, facts.astype(float))
            keep.append(decisions(*(models[t].probabilities(docs) for t in TARGETS)))
        yield batch.filter(pa.array(np.concatenate(keep)))

    return common.in_batches(docs, run, docs.schema, rows=512)
