"""Contiguous shards of near-equal bytes over atomic groups of equal texts.

The groups are put in the order of their text digest. The smallest capacity that lets a
greedy walk over that order end within the given number of shards is found by binary
search, and the order is cut where that walk cuts.

The walk never sees the groups themselves. It runs over cells: the sums of all groups whose
digest starts with the same hex digits. Cells in which a cut could fall for any capacity
still possible are divided by further digits, until every such cell is one group; then the
search is exact. With the capacity known, each cut goes to the group boundary nearest to an
equal part of what is left, as far as the capacity lets it, so the last shard is not left
short. The driver holds 65,536 cells at first and those inside the (at most
shards - 1) stretches around the cuts afterwards, whatever the number of groups.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

FIRST_DIGITS, MORE_DIGITS = 4, 2


def text_group(text: Column) -> Column:
    """Digest of a text; equal texts are one group, null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")))


class Walk:
    """Greedy walk over cells that may not be divided: (prefix, size, groups, largest group)."""

    def __init__(self, cells):
        self.cells = cells
        self.ends = list(accumulate((c[1] for c in cells), initial=0))

    def last_end(self, start, capacity):
        """The last cell boundary that a shard from boundary ``start`` on can reach."""
        return bisect_right(self.ends, self.ends[start] + capacity) - 1

    def greedy(self, capacity):
        """The boundary behind each shard, or None where a single cell is too large."""
        at, cuts = 0, []
        while at < len(self.cells):
            to = self.last_end(at, capacity)
            if to <= at:
                return None
            cuts.append(to)
            at = to
        return cuts

    def fits(self, capacity, shards):
        cuts = self.greedy(capacity)
        return cuts is not None and len(cuts) <= shards

    def smallest(self, low, high, shards):
        """Smallest capacity in [low, high] that fits; high must fit."""
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if self.fits(mid, shards) else (mid + 1, high)
        return high

    def unsettled(self, low, high, shards):
        """Cells of several groups in which a greedy cut may fall for a capacity in [low, high]."""
        found, first, last = set(), 0, 0
        for _ in range(shards - 1):
            # the earliest place steps back to the start of the cell it falls in, the latest on to its end
            first = min(self.last_end(first, low), len(self.cells))
            last = min(self.last_end(last, high) + 1, len(self.cells))
            found.update(n for n in range(first, min(last + 1, len(self.cells))) if self.cells[n][2] > 1)
        return found

    def even(self, capacity, shards):
        """Boundaries near equal parts of what is left, no shard above the capacity, and the cells divided to say so."""
        back = Walk(self.cells[::-1])
        left_over = back.greedy(capacity) or []
        earliest = [len(self.cells) - n for n in left_over]  # where the last 1, 2, ... shards start at the earliest
        found = {len(self.cells) - 1 - n for n in back.unsettled(capacity, capacity, shards)}
        cuts, at = [], 0
        for left in range(shards, 1, -1):
            aim = self.ends[at] + (self.ends[-1] - self.ends[at]) / left
            near = bisect_right(self.ends, aim) - 1
            if near < len(self.cells):
                found |= {near} if self.cells[near][2] > 1 else set()
                near += self.ends[near + 1] - aim < aim - self.ends[near]
            floor = earliest[left - 2] if left - 2 < len(earliest) else 0
            at = max(at, min(max(near, floor), self.last_end(at, capacity)))
            cuts.append(at)
        return cuts, found


def cut_points(groups: DataFrame, shards: int) -> list[str]:
    """First digest of every shard but the first, in order; fewer where fewer shards suffice.

    groups: (digest, bytes), a row per group. No rows: no cuts.
    """
    spark = groups.sparkSession

    def cells(rows, digits):
        sums = rows.groupBy(F.substring("digest", 1, digits).alias("cell")).agg(
            F.sum("bytes").alias("size"), F.count("*").alias("groups"), F.max("bytes").alias("most"))
        return [tuple(r) for r in sums.collect()]

    def divided(walk, numbers):
        """The walk with these cells taken apart by further digits."""
        fine = []
        for digits in sorted({len(walk.cells[n][0]) for n in numbers}):
            names = [(walk.cells[n][0],) for n in numbers if len(walk.cells[n][0]) == digits]
            named = F.broadcast(spark.createDataFrame(names, "above string"))
            fine += cells(groups.join(named, F.substring("digest", 1, digits) == named["above"]), digits + MORE_DIGITS)
        return Walk(sorted([c for n, c in enumerate(walk.cells) if n not in numbers] + fine))

    walk = Walk(sorted(cells(groups, FIRST_DIGITS)))
    if not walk.cells:
        return []
    total = walk.ends[-1]
    low = max(-(-total // shards), max(c[3] for c in walk.cells))
    while True:
        high = walk.smallest(low, total // shards + max(c[1] for c in walk.cells) + 1, shards)
        open_cells = walk.unsettled(low, high, shards)
        if not open_cells:
            break
        walk = divided(walk, open_cells)
    while True:
        cuts, open_cells = walk.even(high, shards)
        if not open_cells:
            break
        walk = divided(walk, open_cells)
    return [walk.cells[n][0] for n in cuts if 0 < n < len(walk.cells)]


def shard_documents(docs: DataFrame, shards: int, *, doc_id: str = "doc_id", text: str = "text", overhead: int = 8) -> DataFrame:
    """A row per document: doc_id, size, text_crc32, digest, shard, slot.

    size is the UTF-8 length of the text plus ``overhead``; a null text is an empty one.
    Equal texts share a shard. Slots count from 0 in every shard without gaps; their order
    follows the scan. Null and repeated ids, repeated rows and other columns change
    nothing: every row gets its own slot. No rows: no rows.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(whole) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"), text_group(F.col(text)).alias("digest"))
    narrow = stored(narrow, "shard-rows")
    groups = stored(narrow.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    cuts = cut_points(groups, shards)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("digest") >= cut).cast("int")
    placed = narrow.withColumn("shard", shard.cast("int")).sortWithinPartitions("shard")
    placed = stored(placed.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "shard-places")
    # rows of a shard lie together in a partition: their count and first place give every slot
    runs = placed.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    starts = stored(offsets(runs), "shard-runs")
    return (placed.join(starts, ["shard", "part"]).withColumn("slot", F.col("start") + F.col("at") - F.col("first"))
            .select("doc_id", "size", "text_crc32", "digest", "shard", "slot"))


def offsets(runs: DataFrame) -> DataFrame:
    """Runs with ``start``: the rows of the shard in earlier partitions (a row per shard and partition, not per document)."""
    from pyspark.sql import Window

    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return runs.select("shard", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
