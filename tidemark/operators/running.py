"""Running aggregates in record order that no single key can overload."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.durations import floor_div

# Records of one key that a single task may sort.
HOT = 1 << 22

# The block of a key that is not cut; a record's block is a floor and never so low.
_UNCUT = -(1 << 63)

# How a record (first) and a partial result (second) enter each aggregate.
_RECORDS = {"sum": F.sum, "max": F.max, "min": F.min}
_PARTIALS = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}


def _combine(how: str, earlier: Column, later: Column) -> Column:
    if how in ("sum", "count"):
        return F.when(earlier.isNull(), later).when(later.isNull(), earlier).otherwise(earlier + later)
    return F.greatest(earlier, later) if how == "max" else F.least(earlier, later)


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int = HOT) -> DataFrame:
    """Keys with more than ``limit`` records: at most one per ``limit`` records of ``df``.

    Store it with ``session.written`` before use, so that its size is known.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__records"))
    return counted.where(F.col("__records") > limit).drop("__records")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, tuple[str, str | None]],
    *,
    block_on: str,
    widths: Sequence[int] = (1 << 20,),
    hot: DataFrame | None = None,
    start: DataFrame | None = None,
) -> DataFrame:
    """Add ``measures`` (name -> (sum|count|max|min, column)) running over each key.

    A window over the whole key would put all of its records in one task, and
    one key may hold a third of a table.  So each key is cut into blocks of
    ``block_on`` values (a whole-number column of ``order``, e.g. the offset):

    1. totals per (key, block), formed before the shuffle;
    2. what lies before each block: a window over the totals only;
    3. a window inside each block, to which step 2 is added.

    No task sees more of a key than one block's records, or than its block
    totals.  Where a key has too many blocks for step 2 (sparse offsets), give
    several ``widths``, each a multiple of the one before, and the totals are
    blocked again.  ``order`` must be unique; a null in it, as for text files, which have
    no offsets, is an error.

    With many rare keys, most blocks of most keys hold a single record, and the
    totals are as long as the table.  Then pass ``hot_keys`` as ``hot``: only
    those keys are cut, the others are small enough for one window each.

    ``start`` holds values per key from before the first record.
    """
    keys, order = list(keys), list(order)
    for name in order:
        missing = F.raise_error(F.lit(f"{name} is null: these records have no order"))
        df = df.withColumn(name, F.coalesce(name, missing.cast(df.schema[name].dataType)))
    at = order.index(block_on)
    lead = [f"__lead{i}" for i in range(at)]
    blocks = [f"__block{i}" for i in range(len(widths))]
    groups = [[*keys, *lead, *blocks[i:]] for i in range(len(widths))]
    before = {name: f"__before_{name}" for name in measures}

    # A record's block; a key that isn't cut is one group, named by no block of any record.
    place = {name: F.col(column) for name, column in zip(lead, order)}
    place |= {b: floor_div(F.col(block_on), w) for b, w in zip(blocks, widths)}
    if hot is None:
        cut = df.withColumns(place)
        in_blocks = cut
    else:
        marked = df.join(hot.select(*keys, F.lit(True).alias("__hot")), keys, "left")
        uncut = {name: F.lit(0).cast(df.schema[column].dataType) for name, column in zip(lead, order)}
        uncut |= {b: F.lit(_UNCUT) for b in blocks}
        cut = marked.withColumns({n: F.when(F.col("__hot"), c).otherwise(uncut[n]) for n, c in place.items()})
        in_blocks = cut.where(F.col("__hot"))

    def of_records(how: str, column: str | None) -> Column:
        return F.count(F.lit(1)) if how == "count" else _RECORDS[how](column)

    totals = [
        in_blocks.groupBy(*groups[0]).agg(*[of_records(*m).alias(n) for n, m in measures.items()])
    ]
    for group in groups[1:]:
        partials = [_PARTIALS[how](n).alias(n) for n, (how, _) in measures.items()]
        totals.append(totals[-1].groupBy(*group).agg(*partials))

    base = None
    for level in reversed(range(len(widths))):
        top = level + 1 == len(widths)
        within = keys if top else groups[level + 1]
        earlier = (
            Window.partitionBy(*within)
            .orderBy(*([*lead, blocks[level]] if top else [blocks[level]]))
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        found = totals[level].select(
            *groups[level],
            *[_PARTIALS[how](n).over(earlier).alias(before[n]) for n, (how, _) in measures.items()],
        )
        carried = start if top else base
        if carried is not None:
            names = {n: n for n in measures} if top else before
            carried = carried.select(*within, *[F.col(names[n]).alias(f"__from_{n}") for n in measures])
            found = found.join(carried, within, "left").select(
                *groups[level],
                *[
                    _combine(how, F.col(f"__from_{n}"), F.col(before[n])).alias(before[n])
                    for n, (how, _) in measures.items()
                ],
            )
        base = found

    # A block with nothing before it needs no row.
    known = [F.col(before[n]).isNotNull() for n in measures]
    base = base.where(reduce(lambda a, b: a | b, known))
    if hot is not None and start is not None:
        rest = start.join(hot, keys, "left_anti")
        base = base.unionByName(
            rest.select(
                *keys,
                *[uncut[name].alias(name) for name in [*lead, *blocks]],
                *[F.col(n).alias(before[n]) for n in measures],
            )
        )

    inside = (
        Window.partitionBy(*groups[0])
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = cut.withColumns(
        {f"__in_{n}": of_records(*m).over(inside) for n, m in measures.items()}
    )
    joined = local.join(base, groups[0], "left")
    return joined.select(
        *[c for c in df.columns if c not in measures],
        *[
            _combine(how, F.col(before[n]), F.col(f"__in_{n}")).alias(n)
            for n, (how, _) in measures.items()
        ],
    )


def running_in_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, tuple[str, str | None]],
    *,
    blocks: Sequence[str],
    parts: int,
) -> DataFrame:
    """``running`` over records that lie in blocks already: no record is moved.

    ``blocks`` are columns that cut the order into stretches, and ``df`` is laid out by
    ``repartition(parts, *blocks)``, so that a task has whole blocks with the records of all
    keys.  What is shuffled are totals per (key, block): to their keys, where a window adds up
    what lies before each block, and back to the blocks, as a row before the key's first
    record.  No task sees more than its blocks, or than a key's block totals.
    """
    keys, order, blocks = list(keys), list(order), list(blocks)
    for name in order:
        missing = F.raise_error(F.lit(f"{name} is null: these records have no order"))
        df = df.withColumn(name, F.coalesce(name, missing.cast(df.schema[name].dataType)))

    def entering(how: str, column: str | None) -> Column:
        return F.lit(1).cast("bigint") if how == "count" else F.col(column)

    entered = {n: f"__in_{n}" for n in measures}
    records = df.select(
        *[c for c in df.columns if c not in measures],
        F.lit(True).alias("__record"),
        *[entering(*m).alias(entered[n]) for n, m in measures.items()],
    )
    folds = {n: _PARTIALS[how] for n, (how, _) in measures.items()}
    totals = records.groupBy(*blocks, *keys).agg(*[fold(entered[n]).alias(n) for n, fold in folds.items()])
    earlier = Window.partitionBy(*keys).orderBy(*blocks).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *keys,
        *blocks,
        F.lit(False).alias("__record"),
        *[fold(n).over(earlier).alias(entered[n]) for n, fold in folds.items()],
    )
    known = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in entered.values()])
    laid = before.where(known).repartition(parts, *blocks)
    inside = (
        Window.partitionBy(*blocks, *keys)
        .orderBy("__record", *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    both = records.unionByName(laid, allowMissingColumns=True)
    found = both.withColumns({n: fold(entered[n]).over(inside) for n, fold in folds.items()})
    return found.where("__record").select(*[c for c in df.columns if c not in [*measures, *blocks]], *measures)
