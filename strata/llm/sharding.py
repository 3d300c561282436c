"""Sharding by a minimax contiguous partition of ordered atomic groups.

Documents with equal texts form a group that is never split.  Groups are ordered by (smallest doc_id, text digest) and
cut into ``shards`` runs whose largest byte total is as small as any contiguous partition allows: a binary search over
the capacity, each candidate checked greedily, then cuts under that capacity as even as the groups permit.

Prefix sums come from one range-partitioned sort (per-partition sums give the offsets), so no group and no shard is
gathered anywhere.  The driver sees only bounded samples of the group ends (``buckets`` per round).  A greedy walk over
known ends proves a capacity feasible; a walk that may also cut inside a still unknown stretch proves one infeasible.
Rounds fetch more ends where the two can differ until both agree, so the result is exact.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir


def walk(known: list[int], unseen: dict[int, int], shards: int, cap: int, hopeful: bool) -> list[int] | None:
    """Greedy cuts under ``cap``: the last known end within reach, or, when ``hopeful``, the last place within reach
    where an unseen end may lie.  None when ``shards`` runs do not reach the total (the last known end)."""
    cuts, at, total = [], 0, known[-1]
    for _ in range(shards):
        i = bisect.bisect_right(known, at + cap) - 1
        to = known[i]
        if hopeful and to in unseen:
            to = max(to, min(at + cap, unseen[to] - 1))
        cuts.append(to)
        if to >= total:
            return cuts
        at = to
    return None


def least_capacity(known, unseen, shards: int, low: int, high: int, hopeful: bool) -> int:
    """Smallest capacity in [low, high] whose walk succeeds; ``high`` is known to."""
    while low < high:
        mid = (low + high) // 2
        if walk(known, unseen, shards, mid, hopeful):
            high = mid
        else:
            low = mid + 1
    return low


def even_cuts(known: list[int], shards: int, cap: int) -> list[int]:
    """``shards`` - 1 cuts at known ends, no run above ``cap``, each as near as possible to the mean of what is left."""
    total, need = known[-1], [known[-1]]
    for _ in range(shards):  # need[r]: smallest end from which r runs reach the total
        need.append(known[bisect.bisect_left(known, need[-1] - cap)])
    cuts, at = [], 0
    for left in range(shards - 1, 0, -1):
        goal = at + (total - at) / (left + 1)
        low = bisect.bisect_left(known, max(at, need[left]))
        high = bisect.bisect_right(known, at + cap) - 1
        i = min(max(bisect.bisect_left(known, goal), low), high)
        if i > low and goal - known[i - 1] <= known[i] - goal:
            i -= 1
        at = known[i]
        cuts.append(at)
    return cuts


def minimax_cuts(fetch: Callable[[list[tuple[int, int]], int], list[tuple[int, int, int]]], total: int, largest: int,
                 shards: int, buckets: int = 8192) -> tuple[int, list[int]]:
    """(least capacity, cuts).  ``fetch(windows, width)`` gives (first, last, count) of the group ends strictly inside
    each window (a, b), by cells of ``width``."""
    if total <= 0:
        return 0, [0] * (shards - 1)
    known, unseen = [0, total], {0: total}
    low, high = max(largest, -(-total // shards)), total
    while True:
        high = least_capacity(known, unseen, shards, low, high, False)
        low = least_capacity(known, unseen, shards, low, high, True)
        if low == high:
            return high, even_cuts(known, shards, high)
        # the j-th greedy cut lies between these two for every capacity left
        lows, at = [], 0
        for _ in range(shards):
            at = known[bisect.bisect_right(known, at + low) - 1]
            lows.append(at)
        highs = walk(known, unseen, shards, high, True)
        highs += [total] * (shards - len(highs))
        wide: list[list[int]] = []
        for a, b in sorted((lo, hi) for lo, hi in unseen.items()
                           if any(hi > x and lo <= y for x, y in zip(lows, highs))):
            if wide and wide[-1][1] >= a:
                wide[-1][1] = max(b, wide[-1][1])
            else:
                wide.append([a, b])
        while len(wide) > 2 * shards:  # merge the closest windows: predicates stay short
            i = min(range(1, len(wide)), key=lambda n: wide[n][0] - wide[n - 1][1])
            wide[i - 1][1] = wide[i][1]
            del wide[i]
        windows = [(a, b) for a, b in wide]
        got = fetch(windows, max(1, sum(b - a for a, b in windows) // buckets))
        unseen = {a: b for a, b in unseen.items() if not any(x <= a and b <= y for x, y in windows)}
        unseen |= {first: last for first, last, n in got if n > 2}
        known = sorted({*known, *(e for first, last, _ in got for e in (first, last))})


def _ends_by_cell(ends: DataFrame):
    def fetch(windows, width):
        win = F.lit(None).cast("int")
        for i, (a, b) in enumerate(windows):
            win = F.when((F.col("end") > a) & (F.col("end") < b), F.lit(i)).otherwise(win)
        x = ends.select("end", win.alias("w")).filter(F.col("w").isNotNull())
        x = x.groupBy("w", F.floor(F.col("end") / F.lit(width)).alias("cell"))
        return [(r["a"], r["b"], r["n"]) for r in x.agg(F.min("end").alias("a"), F.max("end").alias("b"),
                                                        F.countDistinct("end").alias("n")).collect()]
    return fetch


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null)``.

    ``size`` is the UTF-8 length plus 1, a null text counts as empty (and as a copy of the empty text).  ``slot`` numbers
    a shard's documents from 0 without gaps, in order of (group, doc_id); null ids come first.  Repeated rows are
    separate documents of one group.  A group larger than the mean makes its shard as large as itself; the other
    shards stay even.  An empty table gives no rows."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    x = docs.select(F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                    F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key"))
    groups = x.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("bytes"))
    order = ["first_id", "key", "doc_id"]
    # one materialised sort: rows numbered and summed inside partitions, offsets from the partition totals
    rows = (x.join(groups, "key").repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("pid", F.spark_partition_id()).withColumn("mid", F.monotonically_increasing_id())
            ).checkpoint(eager=True)
    parts = rows.groupBy("pid").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"),
                                    F.max("bytes").alias("largest"))
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = parts.select("pid", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    top = parts.agg(F.coalesce(F.sum("b"), F.lit(0)).alias("total"),
                    F.coalesce(F.max("largest"), F.lit(0)).alias("largest")).first()
    inner = Window.partitionBy("pid").orderBy("mid").rowsBetween(Window.unboundedPreceding, 0)
    rows = (rows.withColumn("run", F.sum("size").over(inner)).withColumn("at", F.row_number().over(inner) - 1)
            .join(offsets, "pid")
            .select("doc_id", "size", "text_crc32", "key", (F.col("b0") + F.col("run")).alias("end"),
                    (F.col("n0") + F.col("at")).alias("rank")))
    group_ends = rows.groupBy("key").agg(F.max("end").alias("end")).select("end").checkpoint(eager=True)
    _, cuts = minimax_cuts(_ends_by_cell(group_ends), int(top["total"]), int(top["largest"]), shards)

    shard: Column = F.lit(0)
    for c in cuts:
        shard = shard + (F.col("end") > F.lit(c)).cast("int")
    rows = rows.withColumn("shard", shard)
    starts = rows.groupBy("shard").agg(F.min("rank").alias("r0"))  # one row per shard
    return rows.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("r0")).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
