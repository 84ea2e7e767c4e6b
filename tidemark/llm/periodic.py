"""Runs of words that repeat with a period, found by internal pattern matching.

A run is a stretch of words with smallest period q (words q apart are the same), at least
`max(LEAST, TIMES * q)` long, that no neighbouring word extends keeping period q.  A word
is dropped from the collapsed text if a run contains it after the run's first q words.

A run of period q, 2^k <= q < 2^(k+1), holds one of the text's dyadic blocks, 2^k words
from a multiple of 2^k on, that starts in its first 2^k words; and it holds that block
again q words later, a place in the window of 2^k starts next to the block.  So:

1. A suffix array of the words of each text, by doubling: after round k every place knows
   its interval of suffixes that begin with the same 2^k words.  Only places whose words
   occur again in the text are sorted further.
2. A wavelet tree over the suffix array, with places as values.  In a block's interval it
   counts the places before the window and up to its end, and names the first of them
   (range successor) and the following ones.
3. Occurrences of a block in so short a window form a progression.  One or two are tried as
   they are.  Of three or more, which overlap, only one can lie a period away: both the
   block and its copy lie in stretches with the progression's difference as period, and
   these must end equally far from each.
4. Each candidate is extended both ways by comparing intervals, longest blocks first.

Blocks of one word need no tree: their window is the next word.

Texts are worked on in groups of about GROUP words, a longer one alone; memory is that of
the group's words, with one integer a word and level (4 bytes times log2 of the words).
No text is cut and nothing is shuffled.

Null and empty texts have no words and no runs.  Rows repeat as they come, each with its own
result; ids may be null or repeat.  Columns of the result win over clashing ones of the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.llm import common

LEAST = 6  # words of a run, whatever its period
TIMES = 4  # periods of a run
GROUP = 1 << 16  # words looked at together


class WaveletTree:
    """Counts and order statistics of values in intervals of a sequence, many at a time."""

    def __init__(self, values: np.ndarray, bits: int):
        self.zeros, self.totals = [], []
        for bit in reversed(range(bits)):
            low = (values >> bit) & 1 == 0
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(low, out=before[1:])
            self.zeros.append(before)
            self.totals.append(int(before[-1]))
            values = np.concatenate((values[low], values[~low]))
        self.bits = bits

    def below(self, lo: np.ndarray, hi: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many of `[lo, hi)` are less than the limit."""
        found = np.zeros(len(lo), np.int32)
        over = limit >> self.bits > 0
        if over.any():
            limit = np.where(over, 0, limit)
        first, last = lo, hi
        for level, (before, total) in enumerate(zip(self.zeros, self.totals, strict=True)):
            a, b = before[first], before[last]
            one = (limit >> (self.bits - 1 - level)) & 1 == 1
            found += np.where(one, b - a, 0)
            first = np.where(one, total + first - a, a)
            last = np.where(one, total + last - b, b)
        return np.where(over, hi - lo, found)

    def nth(self, lo: np.ndarray, hi: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The value of rank n, from 0, in `[lo, hi)`; with n = below(x), the successor of x."""
        found = np.zeros(len(lo), np.int32)
        for before, total in zip(self.zeros, self.totals, strict=True):
            a, b = before[lo], before[hi]
            one = n >= b - a
            n = np.where(one, n - (b - a), n)
            lo, hi = np.where(one, total + lo - a, a), np.where(one, total + hi - b, b)
            found = (found << 1) | one
        return found


class Texts:
    """Several texts' words behind one another, as numbers; equal words have equal numbers."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        self.words, self.sizes = words, sizes
        self.starts = np.cumsum(sizes) - sizes
        n = len(words)
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        self.place = np.arange(n) - self.starts[self.text]  # within its text
        self.left = self.sizes[self.text] - self.place  # words up to the text's end
        self.ranks: list[np.ndarray] = []  # by level: the first of the interval of each place
        self.repeated: list[np.ndarray] = []  # by level: interval sizes of more than one
        self._sort()

    def _sort(self) -> None:
        """Ranks by the first 2^k words, for each k up to a quarter of the longest text."""
        n = len(self.words)
        order = np.argsort((self.text << 32) | self.words, kind="stable").astype(np.int32)
        key = ((self.text << 32) | self.words)[order]
        rank, size = np.empty(n, np.int32), np.empty(n, np.int32)
        slots = np.arange(n, dtype=np.int32)  # where the places still to sort stand
        longest = int(self.sizes.max(initial=0))
        block = 1
        while True:
            fresh = np.empty(len(slots), bool)
            fresh[:1] = True
            np.not_equal(key[1:], key[:-1], out=fresh[1:])
            heads = np.flatnonzero(fresh)
            sizes = np.diff(heads, append=len(slots))
            here = order[slots]
            rank[here] = np.repeat(slots[heads], sizes)
            size[here] = np.repeat(sizes, sizes)
            self.ranks.append(rank.copy())
            again = np.repeat(sizes > 1, sizes)
            slots, here = slots[again], here[again]
            self.repeated.append(np.zeros(n, np.int32))
            self.repeated[-1][here] = size[here]
            if not len(slots) or TIMES * 2 * block > longest:
                break
            # A suffix that ends after these words comes before all that go on.
            ends = self.left[here] <= block
            key = np.where(ends, -1, rank[np.minimum(here + block, n - 1)]).astype(np.int64) + 1
            key |= rank[here].astype(np.int64) << 32
            sorting = np.argsort(key, kind="stable")
            order[slots] = here[sorting]
            key = key[sorting]
            block *= 2
        self.order = order

    def same_ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from places a and b of one text on are the same (a < b)."""
        n = len(self.words)
        a, b = a.copy(), b.copy()
        begun = b.copy()
        for level in reversed(range(len(self.ranks))):
            rank = self.ranks[level]
            going = np.arange(len(a))
            while len(going):
                here, there = a[going], b[going]
                inside = there < n
                same = inside & (rank[here] == rank[np.where(inside, there, 0)])
                going = going[same]
                a[going] += 1 << level
                b[going] += 1 << level
                if level < len(self.ranks) - 1:
                    break
        return b - begun

    def same_behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before places a and b of one text are the same (a < b)."""
        a, b = a.copy(), b.copy()
        begun = a.copy()
        for level in reversed(range(len(self.ranks))):
            rank, step = self.ranks[level], 1 << level
            going = np.arange(len(a))
            while len(going):
                here, there = a[going] - step, b[going] - step
                inside = here >= 0
                same = inside & (rank[np.where(inside, here, 0)] == rank[np.maximum(there, 0)])
                going = going[same]
                a[going] -= step
                b[going] -= step
                if level < len(self.ranks) - 1:
                    break
        return begun - a

    def _candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and periods: each run has one of its places, with its period, among them."""
        if len(self.ranks) < 2:
            return
        # Only suffixes whose first two words come again are ever asked for.
        ours = self.repeated[1][self.order] > 0
        shift = np.zeros(len(ours) + 1, np.int32)
        np.cumsum(ours, out=shift[1:])
        kept = self.order[ours]
        if not len(kept):
            return
        bits = max(1, int(self.place[kept].max()).bit_length())
        tree = WaveletTree(self.place[kept].astype(np.int32), bits)
        for level in range(1, len(self.ranks)):
            block = 1 << level
            at = np.flatnonzero((self.repeated[level] > 0) & (self.place & (block - 1) == 0))
            # A run leaves room for this many words from its first block on.
            at = at[self.left[at] > (TIMES - 1) * block]
            lo = shift[self.ranks[level][at]]
            hi = lo + self.repeated[level][at]
            place = self.place[at].astype(np.int32)
            first = tree.below(lo, hi, place + block)
            count = tree.below(lo, hi, place + 2 * block) - first
            some = count > 0
            at, lo, hi, place, first, count = (x[some] for x in (at, lo, hi, place, first, count))
            one = tree.nth(lo, hi, first) - place
            few = count < 3
            yield at[few], one[few]
            two = count == 2
            yield at[two], tree.nth(lo[two], hi[two], first[two] + 1) - place[two]
            many = ~few
            at, one = at[many], one[many]
            step = tree.nth(lo[many], hi[many], first[many] + 1) - place[many] - one
            copy = at + one
            end = at + self.same_ahead(at, at + step)
            copy_end = copy + self.same_ahead(copy, copy + step)
            period = copy_end - end
            fits = (period >= block) & (period < 2 * block)
            yield at[fits], period[fits]

    def runs(self) -> np.ndarray:
        """Rows (text, start, length, period), by text, start and period."""
        alike = np.flatnonzero((self.words[1:] == self.words[:-1]) & (self.text[1:] == self.text[:-1]))
        gap = np.flatnonzero(np.diff(alike, prepend=-2) != 1)
        ends = np.append(gap[1:], len(alike))
        starts, lengths = alike[gap], ends - gap + 1
        found = [np.stack((starts, lengths, np.ones_like(starts)), 1)]
        for at, period in self._candidates():
            at, period = at.astype(np.int64), period.astype(np.int64)
            # The block comes twice more in a run: cheaper to see than how far it goes.
            room = self.left[at] > 2 * period
            at, period = at[room], period[room]
            rank = self.ranks[0]
            twice = (rank[at] == rank[at + period]) & (rank[at] == rank[at + 2 * period])
            at, period = at[twice], period[twice]
            start = at - self.same_behind(at, at + period)
            end = at + period + self.same_ahead(at, at + period)
            found.append(np.stack((start, end - start, period), 1))
        rows = np.concatenate(found)
        rows = rows[rows[:, 1] >= np.maximum(LEAST, TIMES * rows[:, 2])]
        # A stretch has multiples of its period as periods too: the least is its own.
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        if len(rows):
            rows = rows[np.append(True, (np.diff(rows[:, :2], axis=0) != 0).any(axis=1))]
        text = self.text[rows[:, 0]]
        rows = np.stack((text, rows[:, 0] - self.starts[text], rows[:, 1], rows[:, 2]), 1)
        return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def numbered(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal ones for equal words."""
    known = {word: i for i, word in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


@dataclass
class Found:
    """One text's runs (start, length, period), by start and period, and the words that stay."""

    words: list[bytes]
    runs: list[tuple[int, int, int]]

    def kept(self) -> list[bytes]:
        if not self.runs:
            return self.words
        change = np.zeros(len(self.words) + 1, np.int64)
        for start, length, period in self.runs:
            change[start + period] += 1
            change[start + length] -= 1
        stay = np.cumsum(change[:-1]) == 0
        return [self.words[i] for i in np.flatnonzero(stay)]

    def strongest(self) -> tuple[int, int, int] | None:
        """The run that repeats most often; ties go to the first, then to the shortest period."""
        return min(self.runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def examined(texts: Iterable[bytes | None]) -> Iterator[Found]:
    """The runs of each text, in the order of the texts."""
    held: list[list[bytes]] = []
    size = 0

    def flush() -> Iterator[Found]:
        sizes = np.array([len(w) for w in held], np.int64)
        rows = Texts(numbered([w for words in held for w in words]), sizes).runs()
        bounds = np.searchsorted(rows[:, 0], np.arange(len(held) + 1))
        for i, words in enumerate(held):
            runs = [tuple(map(int, r)) for r in rows[bounds[i] : bounds[i + 1], 1:]]
            yield Found(words, runs)

    for text in texts:
        words = (text or b"").split()  # bytes split at 0x20 and 0x09-0x0D only
        if held and size + len(words) > GROUP:
            yield from flush()
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield from flush()


RESULT = (
    "n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, collapsed string, "
    "runs array<struct<start:long,length:long,period:long>>"
)


def _result(found: Found, wanted: set[str]) -> dict:
    start, length, period = found.strongest() or (None, None, None)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found.runs)
    collapsed = b" ".join(found.kept())
    row = {
        "n_runs": len(found.runs),
        "start": start,
        "length": length,
        "period": period,
        "exponent_milli": None if period is None else 1000 * length // period,
        "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(collapsed).hexdigest(),
    }
    if "collapsed" in wanted:
        row["collapsed"] = collapsed.decode(errors="replace")
    if "runs" in wanted:
        row["runs"] = [{"start": s, "length": n, "period": p} for s, n, p in found.runs]
    return row


def collapsed(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", columns: tuple[str, ...] | None = None
) -> DataFrame:
    """The columns to keep, and the runs and the collapsed text of each row.

    `columns` are some of RESULT, by default all; leave out `collapsed` and `runs` where
    digests and the strongest run (all null without a run) are enough.
    """
    shape = StructType.fromDDL(RESULT)
    names = list(columns or shape.names)
    kept = [name for name in keep if name not in names]
    # Numbered names: Python functions over rows take no names with dots.
    taken = docs.select(
        *[F.col(f"`{name}`").alias(f"_{i}") for i, name in enumerate(kept)], F.col(f"`{text}`").cast("binary").alias("text")
    )
    made = StructType([*taken.schema.fields[:-1], *[StructField(n, shape[n].dataType) for n in names]])
    run = pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")]))
    types = {"runs": run, **{n: pa.int64() if shape[n].dataType.typeName() == "long" else pa.string() for n in shape.names[:-1]}}

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        results = [_result(f, set(names)) for f in examined(batch.column(len(kept)).to_pylist())]
        found = [pa.array([r[n] for r in results], types[n]) for n in names]
        yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *found], names=made.names)

    return common.in_batches(taken, work, made, rows=256).toDF(*kept, *names)
