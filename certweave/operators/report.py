"""Counts of a conversion run, per source file and in total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certweave.operators.clean import WARNING_COUNTERS
from certweave.operators.convert import REPAIR_COUNTERS
from certweave.operators.filters import SKIPPED

DISPOSITIONS = [
    "processed", "omitted_inactive", "omitted_outside_region", "omitted_invalid_ogrn", "omitted_blocklist",
]  # and "skipped", the damaged ones, behind them


def conversion_report(converted: DataFrame) -> DataFrame:
    """One row per source file and one total row (``source_file`` = ``<total>``).

    One pass with partial aggregation gives a row per file; only those rows are added up
    once more for the total.
    """
    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    counts = [F.count_if(F.col("disposition") == d).alias(d) for d in [*DISPOSITIONS, SKIPPED]]
    counters = [*REPAIR_COUNTERS, *WARNING_COUNTERS]
    per_file = converted.groupBy("_source_file").agg(*counts, *[total(F.col(c)).alias(c) for c in counters])
    columns = [*DISPOSITIONS, SKIPPED, *counters]
    return (
        per_file.rollup("_source_file").agg(*[total(F.col(c)).alias(c) for c in columns], F.grouping("_source_file").alias("_all"))
        .select(F.when(F.col("_all") == 1, "<total>").otherwise(F.col("_source_file")).alias("source_file"), *columns)
    )
