"""What both near-duplicate operators share: blocks of candidates, links inside a block, classes of linked items.

Candidates come as groups of rows. A group is cut into chunks of at most ``chunk`` rows, and a
block is a pair of chunks; so a group of any size is many blocks of bounded size, and every
pair of rows meets in one block of its group. A block gives counts and one edge per item, never
its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def chunked(rows: DataFrame, sizes: DataFrame, group: str, item: str, chunk: int) -> DataFrame:
    """rows with ``low``, ``high`` (the block's chunks) and ``own`` (the row's chunk), once per block that the row belongs to.

    sizes: (group, n), the row count of every group that has pairs; rows of others go.
    """
    n = F.ceil(F.col("n") / chunk).cast("int")
    out = rows.join(sizes.withColumn("chunks", n).drop("n"), group).withColumn("own", F.pmod(F.xxhash64(item), F.col("chunks")).cast("int"))
    out = out.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return out.withColumn("low", F.least("own", "with")).withColumn("high", F.greatest("own", "with")).drop("with", "chunks")


def per_block(rows: DataFrame, keys: list[str], work: Callable[[list], Iterator[tuple]], schema: str, columns: list) -> DataFrame:
    """work over the rows of each block, keys first in a row; blocks are sorted and streamed, so a task holds one at a time.

    columns: (name, Arrow type) of what work yields.
    """
    width = len(keys)

    def run(batches):
        import pyarrow as pa

        target = pa.schema(columns)
        flat = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        out = []
        for _, block in groupby(flat, key=lambda r: r[:width]):
            out.extend(work(list(block)))
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), target)], schema=target)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), target)], schema=target)

    dealt = rows.select(*keys, *[c for c in rows.columns if c not in keys]).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, schema)


def linked(ids: np.ndarray, sizes: np.ndarray, links: np.ndarray) -> Iterator[tuple]:
    """(id, root, n) of every item with a link: n is how many others it has, by their sizes; root the smallest id of its set in this block."""
    n = len(ids)
    counts = links @ sizes
    order = np.argsort(ids, kind="stable")
    root = np.arange(n)
    seen = np.zeros(n, bool)
    for first in order:
        if seen[first] or not counts[first]:
            continue
        reach = [first]
        seen[first] = True
        while reach:
            at = reach.pop()
            root[at] = first
            more = np.flatnonzero(links[at] & ~seen)
            seen[more] = True
            reach.extend(more)
    for k in np.flatnonzero(counts):
        yield int(ids[k]), int(ids[root[k]]), int(counts[k])


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of ids to (id, root): the smallest id that each id with an edge reaches.

    Every round ties an id's larger neighbours to its smallest neighbour, then its smaller
    ones; the rounds end when nothing changes, with every id tied to its root. Rounds are
    written to the shared folder, and nothing but a count and a checksum reaches the driver.
    """
    pair = lambda df: df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    state = lambda df: tuple(df.agg(F.count("*"), F.coalesce(F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))), F.lit(0))).first())
    edges = stored(pair(edges), "edges")
    before = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = stored(pair(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.withColumnRenamed("m", "b"))
        edges = stored(pair(small), "edges")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
