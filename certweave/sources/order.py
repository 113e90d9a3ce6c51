"""The order of records in their files, whatever splits a scan is made of.

A row's position is the number of bytes of the lines before it, those of files with a smaller path
included, each line with its separator. A scan knows a split's rows in order: their running
length is added as they are read. A narrow pass over the same scan sums the lengths per split, and
the sums of the splits before give each split its offset. So positions depend on the files alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from certweave.session import scratch_path

POSITION = "_position"
MOST_SORTED = 100_000  # rows that every task may hold as its own first ones
CELLS = 4096
MOST_BROADCAST = 1_000_000  # rows of about 100 bytes, one per split


def _running(parts: DataFrame, separator: int) -> DataFrame:
    """parts with ``_before``: the bytes of the rows that stand before a row in its split.

    Arrow batches are handed through; only lengths are looked at. A task reads the rows of a split one behind another.
    """
    def add(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        last, held = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            files, starts = batch.column("file"), batch.column("start").to_numpy()
            codes = pc.dictionary_encode(files).indices.to_numpy()
            lengths = pc.binary_length(batch.column("value")).to_numpy().astype(np.int64) + separator
            cuts = np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])) + 1
            before = np.cumsum(lengths) - lengths
            for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
                here = files[int(low)].as_py(), int(starts[low])
                before[low:high] += (held if here == last else 0) - before[low]
                last, held = here, int(before[high - 1] + lengths[high - 1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], [*batch.schema.names, "_before"])

    plain = parts.withColumn("value", F.col("value").cast("binary"))
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(add, f"{shape}, _before long").withColumn("value", F.col("value").cast("string"))


def splits(parts: DataFrame, separator: int | Column, **about: Column) -> DataFrame:
    """(file, start, offset, ..), a row per split: the bytes of all lines before it. ``about``: further aggregates by split.

    parts: (value, file, start) of a scan; ``_at`` orders the rows of a split for the aggregates.
    """
    bytes_ = F.sum(F.octet_length("value").cast("long") + separator).alias("bytes")
    found = parts.withColumn("_at", F.monotonically_increasing_id()).groupBy("file", "start").agg(bytes_, *[c.alias(n) for n, c in about.items()])
    path = scratch_path(parts.sparkSession, "splits")
    found.write.parquet(path)
    found = parts.sparkSession.read.schema(found.schema).parquet(path)
    files = found.groupBy("file").agg(F.sum("bytes").alias("all"))
    # a row per file is summed in one task; the rows of a file's splits apart from that
    bases = files.select("file", (F.sum("all").over(W.orderBy("file")) - F.col("all")).alias("base"))
    inside = F.sum("bytes").over(W.partitionBy("file").orderBy("start")) - F.col("bytes")
    return found.withColumn("inside", inside).join(bases, "file").select("file", "start", (F.col("base") + F.col("inside")).alias("offset"), *about)


def positioned(parts: DataFrame, separator: int, offsets: DataFrame) -> DataFrame:
    """parts with the position of each row and what else ``splits`` said about its split."""
    side = offsets.withColumnRenamed("file", "_file").withColumnRenamed("start", "_start")
    if offsets.count() <= MOST_BROADCAST:  # else the planner's choice
        side = F.broadcast(side)
    rows = _running(parts, separator).join(side, (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start")), "left")
    # a split that the narrow pass has not seen: files changed between both reads
    offset = F.coalesce("offset", F.raise_error(F.lit("files changed while they were read")).cast("long"))
    return rows.withColumn(POSITION, offset + F.col("_before")).drop("_before", "offset", "_file", "_start")


def nth_smallest(values: DataFrame, n: int) -> int | None:
    """The n-th smallest of the whole numbers in the only column, from 1 on, repeats counted; null if there are fewer.

    The range is cut into cells that are counted, and the cell of the n-th into cells again, until it
    holds one number. A pass brings ``CELLS`` counts to the driver, never values.
    """
    name = values.columns[0]
    v = F.col(name).cast("decimal(20,0)")
    low, high, rows = values.agg(F.min(v), F.max(v), F.count(name)).first()
    if rows < n or n < 1:
        return None
    low, high = int(low), int(high)
    while low < high:
        width = -(-(high - low + 1) // CELLS)
        cell = F.call_function("div", v - F.lit(low).cast("decimal(20,0)"), F.lit(width).cast("decimal(20,0)"))
        counts = values.where((v >= low) & (v <= high)).groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(counts, key=lambda r: r.cell):
            if n <= r.n:
                break
            n -= r.n
        low, high = low + r.cell * width, min(high, low + (r.cell + 1) * width - 1)
    return low


def first_rows(rows: DataFrame, n: int, key: str, most: int = MOST_SORTED) -> DataFrame:
    """The n rows with the smallest ``key``, a whole number that no two rows share.

    Up to ``most`` rows every task sorts its own and hands on its first n. A larger n is met by a bound on
    the key, found by counting: no task gets more rows than it had.
    """
    if n <= most:
        return rows.orderBy(key).limit(n)
    bound = nth_smallest(rows.select(key), n)
    return rows if bound is None else rows.where(F.col(key) <= bound)
