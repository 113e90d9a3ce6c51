"""Helpers the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from certweave.session import scratch_path

# White space between words: space and U+0009 to U+000D, nothing else.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
IN_PARTITION = (1 << 33) - 1


def words(text: Column) -> Column:
    """The words of a text in order; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def n_words(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACE_RUN))).cast("long")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared scratch folder and read again: a cut of the lineage that outlives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, order: list[str], position: str) -> DataFrame:
    """Rows with their 0-based place in the order of all rows.

    A range partitioning sorts; the place inside a partition is counted while it is
    written and the partitions' row counts give the offsets, so no task sees more than
    its own partition.
    """
    spark = df.sparkSession
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = stored(cut.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    sizes = sorted((r[0], r[1]) for r in cut.groupBy("_part").count().collect())  # a row per partition
    offset, rows = 0, []
    for part, n in sizes:
        rows.append((part, offset))
        offset += n
    starts = spark.createDataFrame(rows, "_part int, _start long")
    at = F.col("_start") + F.col("_at").bitwiseAND(F.lit(IN_PARTITION))
    return cut.join(starts, "_part").withColumn(position, at).drop("_part", "_at", "_start")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library to the Python workers through Spark, once per application; they need not have it installed."""
    import tempfile
    import zipfile
    from pathlib import Path

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="certweave-")) / "certweave_library.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(top.rglob("*.py")):
            z.write(file, str(file.relative_to(top.parent)))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
