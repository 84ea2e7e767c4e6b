"""Block and allow rules on hosts and paths, matched by a sort-merge range join.

A host is written with its labels in reverse order, each followed by a dot: `a.net` is
`net.a.`.  Then a rule's host and all its subdomains are the keys that begin with the rule's
key: an interval, from the key up to the same key with its last dot raised by one.  Such
intervals lie inside or beside one another.  `stacks` sorts points and the ends of
intervals, and sweeps over them with a stack of the intervals now open:

1. Points, openings and closings are dealt to tasks by ranges of their keys, evenly.
2. An interval that is open where a range begins is opened there again; for each range
   that is at most the depth of the nesting.
3. A window over each range counts openings less closings: the height of the stack.  Slot h
   of the stack holds the interval opened last at height h.

It runs twice: over the distinct hosts of the urls, which gives each host the rules' hosts
above it, and over (rule's host, path), where a path's prefixes are intervals in the same way.
Urls are reduced to distinct ones before anything is dealt by key, so a host or an address
that holds a third of all rows is one point.  Keys are bytes, so no text sorts differently.

Of the rules that fit, the longest text (host and path) wins, then the longer host; of equal
rules, block wins.  Rules without host or path (null) are left out.  A null url, or one without
`://`, has an empty host and path.  Rows may repeat; each is judged.  Columns `host`, `path`,
`rule` and `verdict` of the input are replaced by the result's.  Tables may be empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common

OUT = ("host", "path", "rule", "verdict")
CLOSE, OPEN, POINT = 0, 1, 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# No byte of UTF-8 text is this one: it comes after all that go on, and parts texts.
TOP = "X'FF'"


def host_of(url: Column) -> Column:
    """From after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    return F.translate(_part(url, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From after the host up to `?`, `#` or the end."""
    return _part(url, 2)


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


def host_key(host: Column) -> Column:
    """The labels in reverse order, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def host_interval(host: Column) -> tuple[Column, Column]:
    """The keys of a host and all its subdomains: from the first, up to the second."""
    key = host_key(host)
    # The byte after a dot is a slash, and no host has one.
    return key.cast("binary"), F.concat(key.substr(F.lit(1), F.length(key) - 1), F.lit("/")).cast("binary")


def path_key(host: Column, path: Column) -> Column:
    """A path below a rule's host."""
    return F.concat(host_key(host).cast("binary"), F.expr(TOP), path.cast("binary"))


def path_interval(host: Column, path: Column) -> tuple[Column, Column]:
    """The keys of all paths that begin with this one."""
    key = path_key(host, path)
    return key, F.concat(key, F.expr(TOP))


def stacks(points: DataFrame, intervals: DataFrame, name: str) -> DataFrame:
    """The intervals around each point, the widest first.

    `points` has distinct keys `key`; `intervals` has `lo`, `hi` and `id`, each pair of ends
    once, and any two lie inside or beside one another; ends and keys are binary.  Returns
    (key, stack) of the points inside an interval.
    """
    spark = points.sparkSession
    empty = F.lit(None)
    ends = intervals.select(
        F.explode(
            F.array(
                F.struct(F.col("lo").alias("key"), F.lit(OPEN).alias("kind")),
                F.struct(F.col("hi").alias("key"), F.lit(CLOSE).alias("kind")),
            )
        ).alias("end"),
        "hi",
        "id",
    ).select("end.*", "hi", "id")
    id_type = intervals.schema["id"].dataType
    events = points.select(
        "key", F.lit(POINT).alias("kind"), empty.cast("binary").alias("hi"), empty.cast(id_type).alias("id")
    ).unionAll(ends)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = common.store(
        events.repartitionByRange(ranges, "key").withColumn("range", F.spark_partition_id()), f"{name}-events"
    )
    opened, closed = F.when(F.col("kind") == OPEN, F.col("range")), F.when(F.col("kind") == CLOSE, F.col("range"))
    spans = (
        dealt.where(F.col("kind") != POINT)
        .groupBy("id", "hi")
        .agg(
            F.min(opened).alias("first"),
            F.min(closed).alias("last"),
            F.min(F.when(F.col("kind") == OPEN, F.col("key"))).alias("key"),
        )
        .where("last > first")
    )
    again = spans.select(
        "key", F.lit(OPEN).alias("kind"), "hi", "id", F.explode(F.sequence(F.col("first") + 1, "last")).alias("range")
    )
    # What closes at a key is closed first; of what opens there, the widest opens first.
    sweep = Window.partitionBy("range").orderBy("key", "kind", F.desc("hi"))
    so_far = sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.when(F.col("kind") == OPEN, 1).when(F.col("kind") == CLOSE, -1).otherwise(0)
    heights = common.store(
        dealt.unionByName(again).withColumn("height", F.sum(step).over(so_far)), f"{name}-heights"
    )
    most = heights.where(F.col("kind") == OPEN).agg(F.max("height")).first()[0] or 0
    if not most:
        return points.select("key", F.array().cast(f"array<{id_type.simpleString()}>").alias("stack")).limit(0)
    slots = [
        F.last(F.when((F.col("kind") == OPEN) & (F.col("height") == h), F.col("id")), ignorenulls=True).over(so_far)
        for h in range(1, most + 1)
    ]
    swept = heights.select("key", "kind", "height", F.array(*slots).alias("slots"))
    return swept.where((F.col("kind") == POINT) & (F.col("height") > 0)).select(
        "key", F.slice("slots", F.lit(1), F.col("height").cast("int")).alias("stack")
    )


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Each row with its host, path, the rule that wins (null: none) and the verdict.

    `rules` has `host`, `path` and `verdict` (`block` or `allow`); a rule fits its host and
    all subdomains, where the url's path begins with the rule's.  Where none fits, the
    verdict is `default`.
    """
    kept = [c for c in pages.columns if c not in OUT]
    whole = F.struct(*[F.col(f"`{c}`") for c in kept])
    seen = pages.select(whole.alias("row"), F.col(f"`{url}`").alias("__url"))
    seen = seen.select("row", host_of(F.col("__url")).alias("host"), path_of(F.col("__url")).alias("path"))
    listed = common.store(
        rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
        .where("host IS NOT NULL AND path IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict")),  # block comes after allow
        "url-rules",
    )
    urls = common.store(seen.select("host", "path").distinct(), "urls")

    lo, hi = host_interval(F.col("host"))
    wide = listed.select("host").distinct().select(lo.alias("lo"), hi.alias("hi"), F.col("host").alias("id"))
    hosts = urls.select("host").distinct().withColumn("key", host_key(F.col("host")).cast("binary"))
    above = common.store(
        stacks(hosts.select("key"), wide, "url-hosts")
        .join(hosts, "key")
        .select("host", F.explode("stack").alias("rule_host")),
        "url-hosts-above",
    )

    lo, hi = path_interval(F.col("host"), F.col("path"))
    deep = listed.select(
        lo.alias("lo"), hi.alias("hi"), F.struct("path", "verdict").alias("id")
    )
    below = common.store(
        urls.join(above, "host").withColumn("key", path_key(F.col("rule_host"), F.col("path"))), "urls-below"
    )
    fitting = stacks(below.select("key").distinct(), deep, "url-paths").select(
        "key", F.element_at("stack", -1).alias("fit")
    )
    text = F.concat("rule_host", "fit.path")
    best = F.struct(F.length(text).alias("n"), F.length("rule_host").alias("h"), text.alias("rule"), "fit.verdict")
    verdicts = (
        below.join(fitting, "key").groupBy("host", "path").agg(F.max(best).alias("best"))
    )
    return (
        seen.join(common.store(verdicts, "url-verdicts"), ["host", "path"], "left")
        .select(
            "row.*",
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        )
    )
