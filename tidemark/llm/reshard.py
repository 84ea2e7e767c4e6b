"""Reshard documents by a minimum-cost flow from old shard sizes to new capacities.

Equal texts are a group, and a group lies whole in one shard.  A shard's files hold ranges of
blocks, by the hash of the text (`lay_out`).  To reshard:

1. Block sizes per old shard are summed, where the documents lie; the flow says how many
   bytes of each old shard go to each new one so that the fewest move.
2. Blocks are dealt out in order to fill it, first to the shard they are in.  A block on a
   boundary, if it is more than TOLERANCE of a capacity, is split by more bits of the hash: only
   its file is read for that.  At last it is one group, which goes whole; only a group larger
   than a whole capacity is split, by a hash of doc_id.
3. Files with blocks that leave are read, and their documents written to the files of the
   new shards.  All other files stay as they are, unread.

What the driver holds is bounded by shards and blocks.  Slots are the places in a shard's files,
one file after the other.

Size is the UTF-8 bytes of the text plus 1; a null text has none and counts as equal to an empty
one.  Rows may repeat and ids may be null; every row gets a slot of its own.  Columns `shard_no`
and `slot` of the input give way to the result's; all others, whatever their names, are kept.
Tables may be empty.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tidemark import session

BLOCKS = 4096  # blocks of a shard, and parts of a block that is split
LEVELS = 5  # times that a block can be split: four by the text's hash, one by the id's
PARTS = 32  # files of a shard, at least
FILE = 64 << 20  # bytes of text in a file, about
TOLERANCE = 0.0005  # of a capacity: what a shard may be off so that blocks stay whole


def minimum_cost_flow(
    supply: dict[int, int], capacity: dict[int, int], cost: Callable[[int, int], int]
) -> dict[tuple[int, int], int]:
    """Bytes from each old shard to each new one; successive cheapest paths with potentials."""
    olds, news = sorted(supply), sorted(capacity)
    left, room = dict(supply), dict(capacity)
    flow: dict[tuple[int, int], int] = {}
    price = {("o", o): 0 for o in olds} | {("n", n): 0 for n in news}
    while any(left.values()):
        distance = {("o", o): 0 for o in olds if left[o]}
        queue = [(0, node) for node in distance]
        came: dict[tuple, tuple] = {}
        heapq.heapify(queue)
        while queue:
            d, node = heapq.heappop(queue)
            if d > distance[node]:
                continue
            side, i = node
            if side == "o":
                steps = ((("n", n), cost(i, n)) for n in news)
            else:
                steps = ((("o", o), -cost(o, i)) for o in olds if flow.get((o, i)))
            for after, c in steps:
                total = d + c + price[node] - price[after]
                if total < distance.get(after, total + 1):
                    distance[after], came[after] = total, node
                    heapq.heappush(queue, (total, after))
        ends = [("n", n) for n in news if room[n] and ("n", n) in distance]
        if not ends:
            raise ValueError("the capacities do not hold all bytes")
        end = min(ends, key=lambda e: distance[e] + price[e])
        for node in price:
            price[node] += min(distance.get(node, distance[end]), distance[end])
        path = [end]
        while path[-1] in came:
            path.append(came[path[-1]])
        start = path[-1][1]
        amount = min(left[start], room[end[1]])
        for after, before in zip(path, path[1:], strict=False):
            if before[0] == "n":
                amount = min(amount, flow[(after[1], before[1])])
        for after, before in zip(path, path[1:], strict=False):
            if before[0] == "o":
                flow[(before[1], after[1])] = flow.get((before[1], after[1]), 0) + amount
            else:
                flow[(after[1], before[1])] -= amount
        left[start] -= amount
        room[end[1]] -= amount
    return {k: v for k, v in flow.items() if v}


def deal(
    blocks: Iterable[tuple[int, int]], quotas: list[list[int]], tolerance: float
) -> tuple[dict[int, int], dict[int, list[list[int]]]]:
    """Deal out blocks (number, bytes) in order to quotas [shard, bytes].

    Returns the shard of each whole block, and the quotas of each block to be split.
    """
    whole: dict[int, int] = {}
    cut: dict[int, list[list[int]]] = {}
    quotas = [list(q) for q in quotas]
    i = 0
    for number, size in blocks:
        while i < len(quotas) - 1 and quotas[i][1] <= 0:
            i += 1
        if size <= quotas[i][1] or i == len(quotas) - 1:
            whole[number] = quotas[i][0]
            quotas[i][1] -= size
        elif size <= tolerance:
            # The quota that is short or over passes the difference on to the next.
            fits = 2 * quotas[i][1] >= size
            if fits:
                quotas[i + 1][1] -= size - quotas[i][1]
                quotas[i][1] = 0
                whole[number] = quotas[i][0]
            else:
                quotas[i + 1][1] += quotas[i][1]
                quotas[i][1] = 0
                whole[number] = quotas[i + 1][0]
                quotas[i + 1][1] -= size
        else:
            parts = []
            while size and i < len(quotas):
                take = size if i == len(quotas) - 1 else min(size, max(0, quotas[i][1]))
                if take:
                    parts.append([quotas[i][0], take])
                quotas[i][1] -= take
                size -= take
                if size:
                    i += 1
            cut[number] = parts
    return whole, cut


def _bits(hashed: Column, level: int) -> Column:
    """Twelve bits of a hash, the highest first."""
    return F.shiftrightunsigned(hashed, 52 - 12 * level).bitwiseAND(F.lit(BLOCKS - 1)).cast("int")


@dataclass
class Layout:
    """Shards on disk: folders `place=N`, N = shard * parts + part, of rows packed in `row`."""

    spark: SparkSession
    folder: str
    schema: StructType
    parts: int
    id_col: str
    text_col: str

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder)

    def part(self, block: int) -> int:
        return block * self.parts // BLOCKS


def _text(text_col: str, row: str = "row.") -> Column:
    return F.coalesce(F.col(f"{row}`{text_col}`"), F.lit(""))


def lay_out(
    docs: DataFrame, shard: Column, folder: str, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None
) -> Layout:
    """Write documents to shards, of which equal texts must have the same.

    A shard has `parts` ranges of blocks, a file or more each; by default as many as make
    files of about FILE bytes, and PARTS at least.
    """
    size = F.octet_length(_text(text_col, ""))
    if parts is None:
        sums = docs.groupBy(shard.alias("shard")).agg(F.sum(size.cast("long")).alias("bytes"))
        most = sums.agg(F.max("bytes")).first()[0] or 0
        parts = min(BLOCKS, max(PARTS, most // FILE))
    block = _bits(F.xxhash64(_text(text_col, "")), 0)
    part = F.floor(block * parts / BLOCKS)
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        (shard * parts + part).cast("int").alias("place"),
    )
    # One group may hold a third of all rows: adaptive execution cuts what goes to one task.
    packed.hint("rebalance", "place").write.partitionBy("place").parquet(folder)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).schema
    return Layout(docs.sparkSession, folder, row.add("place", IntegerType()), parts, id_col, text_col)


@dataclass
class Moves:
    """What is to move: by level, (old shard, block, block within it, ...) and its new shard."""

    flow: dict[tuple[int, int], int] = field(default_factory=dict)
    levels: list[list[tuple[int, ...]]] = field(default_factory=list)
    places: list[int] = field(default_factory=list)


def _placed(layout: Layout, table: DataFrame) -> DataFrame:
    """Rows with their old shard, size and blocks by level."""
    text = _text(layout.text_col)
    by_text, by_id = F.xxhash64(text), F.xxhash64(F.col(f"row.`{layout.id_col}`"), text)
    blocks = [_bits(by_text, level).alias(f"b{level}") for level in range(LEVELS - 1)]
    return table.select(
        "*",
        F.floor(F.col("place") / layout.parts).cast("int").alias("old"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        *blocks,
        _bits(by_id, 0).alias(f"b{LEVELS - 1}"),
    )


def planned(layout: Layout, shards: int) -> Moves:
    """The moves to shards of equal sizes that move the fewest bytes."""
    spark = layout.spark

    def sums(table: DataFrame, level: int) -> DataFrame:
        keys = ["old", *[f"b{i}" for i in range(level + 1)]]
        return _placed(layout, table).groupBy(*keys).agg(F.sum("size").alias("size"))

    first = sums(layout.read(), 0).collect()
    supply: dict[int, int] = {}
    for r in first:
        supply[r["old"]] = supply.get(r["old"], 0) + r["size"]
    total = sum(supply.values())
    capacity = {n: total // shards + (n < total % shards) for n in range(shards)}
    moves = Moves(minimum_cost_flow(supply, capacity, lambda o, n: int(o != n)))
    quotas: dict[tuple[int, ...], list[list[int]]] = {}
    for o in supply:
        own = sorted((n != o, n, v) for (source, n), v in moves.flow.items() if source == o)
        quotas[(o,)] = [[n, v] for _, n, v in own]
    places = set()
    for level in range(LEVELS):
        if not quotas:
            break
        if level:
            asked = spark.createDataFrame(list(quotas), ", ".join(["old int", *[f"b{i} int" for i in range(level)]]))
            held = sorted({k[0] * layout.parts + layout.part(k[1]) for k in quotas})
            few = sums(layout.read().where(F.col("place").isin(held)), level)
            rows = few.join(F.broadcast(asked), asked.columns, "left_semi").collect()
        else:
            rows = first
        grouped: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for r in rows:
            grouped.setdefault(tuple(r)[: level + 1], []).append(tuple(r)[level + 1 :])
        # Up to the last bits of the text's hash blocks may be cut; then only what no shard holds.
        allowed = TOLERANCE * total / shards if level < LEVELS - 2 else total / shards
        found, after = [], {}
        for k, q in quotas.items():
            whole, cut = deal(sorted(grouped[k]), q, allowed if level < LEVELS - 1 else float("inf"))
            found += [(*k, number, shard) for number, shard in whole.items() if shard != k[0]]
            after |= {(*k, number): parts for number, parts in cut.items()}
        places |= {k[0] * layout.parts + layout.part(k[1]) for k in found}
        moves.levels.append(found)
        quotas = after
    moves.places = sorted(places)
    return moves


def resharded(layout: Layout, shards: int = 8) -> DataFrame:
    """Write the documents that move to the new shards; the files as a table, with shard_no and slot."""
    spark = layout.spark
    folder = session.run_dir(spark, "shards")
    moves = planned(layout, shards)
    touched = layout.read().where(F.col("place").isin(moves.places))
    placed = _placed(layout, touched)
    to = []
    for level, found in enumerate(moves.levels):
        if found:
            names = ["old", *[f"b{i}" for i in range(level + 1)]]
            mapping = spark.createDataFrame(found, ", ".join([*[f"{n} int" for n in names], f"s{level} int"]))
            # At most a row for each block of each shard.
            placed = placed.join(F.broadcast(mapping), names, "left")
            to.append(f"s{level}")
    new = placed.select("row", F.coalesce(*to, "old").alias("shard_no"))
    new.hint("rebalance", "shard_no").write.partitionBy("shard_no").parquet(folder)

    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("line")]
    stay = layout.read().where(~F.col("place").isin(moves.places))
    stay = stay.select("row", F.floor(F.col("place") / layout.parts).cast("int").alias("shard_no"), *where)
    moved = spark.read.schema(new.schema).parquet(folder).select("row", "shard_no", *where)
    table = stay.unionAll(moved)
    # One row per file; a shard's files follow each other by name.
    counts = session.written(table.groupBy("shard_no", "file").count(), "shard-files")
    before = Window.partitionBy("shard_no").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("file", "shard_no", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    kept = [F.col(f"row.`{c}`") for c in layout.schema["row"].dataType.names if c not in ("shard_no", "slot")]
    return table.join(base, ["file", "shard_no"]).select(*kept, "shard_no", (F.col("base") + F.col("line")).alias("slot"))
