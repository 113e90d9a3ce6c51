"""Which records are written, and why the others are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from certweave.functions import text as X
from certweave.functions.nested import effective_root, with_computed
from certweave.operators.repair import EXCLUDED_STATUSES

# Fixed values of the register.
OUTSIDE_REGION = "образовательные учреждения, находящиеся за пределами Российской Федерации"
BLOCKED_IDS = ["c68f57a6-e846-f050-fba2-011a5f71ab8c"]

WRITTEN = "processed"
SKIPPED = "skipped"


def is_inactive() -> Column:
    return F.coalesce(F.col("StatusName").isin(EXCLUDED_STATUSES), F.lit(False))


def is_outside_region() -> Column:
    return F.col("RegionName").eqNullSafe(F.lit(OUTSIDE_REGION))


def has_invalid_ogrn() -> Column:
    return X.digits_only(effective_root("EduOrgOGRN")).isNull()


def is_blocked(ids: list[str]) -> Column:
    return F.coalesce(X.uid_token(F.col("Id")).isin([i.lower() for i in ids]), F.lit(False))


def disposition(
    *,
    inactive: bool = True,
    outside_region: bool = True,
    invalid_ogrn: bool = False,
    blocked_ids: list[str] | None = None,
) -> Column:
    """The first reason that applies, or ``processed``. One record counts in one place only."""
    never = F.lit(False)
    return (
        F.when(is_inactive() if inactive else never, "omitted_inactive")
        .when(is_outside_region() if outside_region else never, "omitted_outside_region")
        .when(has_invalid_ogrn() if invalid_ogrn else never, "omitted_invalid_ogrn")
        .when(is_blocked(BLOCKED_IDS if blocked_ids is None else blocked_ids), "omitted_blocklist")
        .otherwise(WRITTEN)
    )


def omit_blocked(df: DataFrame, blocked: DataFrame) -> DataFrame:
    """Records whose id is not in a table of ids (column ``id``); for lists too long for a literal."""
    ids = blocked.select(X.uid_token(F.col("id")).alias("_token")).where("_token is not null").distinct()
    return df.withColumn("_token", X.uid_token(F.col("Id"))).join(ids, "_token", "left_anti").drop("_token")


def omit_invalid_ogrn(df: DataFrame) -> DataFrame:
    """Only records whose effective OGRN is digits."""
    return with_computed(df, "_keep", ~has_invalid_ogrn()).where("_keep").drop("_keep")


def limit_per_file(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of every source file, in file order.

    A file can be most of the data, so no window runs over a whole file: each
    (file, block) first keeps its own ``n`` smallest by a bounded top-n, and only
    those survivors meet in the per-file ranking.
    """
    blocks = 4096
    pre = W.partitionBy("_source_file", "_block").orderBy("_record_seq")
    final = W.partitionBy("_source_file").orderBy("_record_seq")
    return (
        df.withColumn("_block", F.pmod(F.xxhash64("_record_seq"), F.lit(blocks)))
        .withColumn("_rank", F.row_number().over(pre)).where(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(final)).where(F.col("_rank") <= n)
        .drop("_block", "_rank")
    )
