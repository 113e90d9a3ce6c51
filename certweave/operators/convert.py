"""The conversion of records: repair steps in their order, then the disposition."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certweave.functions.nested import with_computed
from certweave.operators import backfill, filters, repair
from certweave.operators.clean import WARNING_COUNTERS

REPAIR_COUNTERS = [
    "stripped_supplements_by_status",
    "coherent_supplement_inn", "coherent_supplement_ogrn",
    "branch_supplement_inn", "branch_supplement_ogrn",
    "coherent_root_inn", "coherent_root_ogrn",
    "eduorg_inn_from_supplement", "eduorg_inn_from_root",
    "eduorg_ogrn_from_supplement", "eduorg_ogrn_from_root",
    "override_records", "override_eduorg_inn", "override_root_inn",
    "shell_cards", "shell_inn", "shell_ogrn", "shell_kpp",
    "level_from_name", "stripped_stub_programs",
    "levels_renamed", "levels_cleared", "levels_unknown",
]


@dataclass(frozen=True)
class Options:
    """Switches of a conversion run; the defaults are the usual run."""

    omit_inactive: bool = True
    omit_outside_region: bool = True
    omit_invalid_ogrn: bool = False
    fill_ids: bool = True
    level_from_name: bool = True
    levels: repair.LevelMap | DataFrame | None = field(default_factory=repair.LevelMap)
    blocked_ids: tuple[str, ...] | None = None


def convert_records(df: DataFrame, overrides: DataFrame | None = None, options: Options = Options()) -> DataFrame:
    """Typed records with repairs applied, a ``disposition`` column and all counters.

    A record the scan could not read (``_corrupt_record``) is ``skipped`` and never written.

    Repairs run before the decision on purpose: their counters include records
    that are left out afterwards. The only join is the optional override table.
    """
    if options.omit_inactive:
        df = repair.strip_supplements(df)
    if options.fill_ids:
        df = repair.backfill_root_ids(repair.fill_coherent_ids(df))
    if overrides is not None:
        df = repair.override_inn_by_ogrn(df, overrides)
    if options.fill_ids:
        df = repair.fill_degenerate_shells(df)
    if options.level_from_name:
        df = repair.level_from_name(df)
    df = repair.strip_stub_programs(df)
    if options.levels is not None:
        df = repair.map_levels(df, options.levels) if isinstance(options.levels, repair.LevelMap) else backfill.map_levels_by(df, options.levels)
    df = repair.mark_branches(df)
    reason = filters.disposition(
        inactive=options.omit_inactive,
        outside_region=options.omit_outside_region,
        invalid_ogrn=options.omit_invalid_ogrn,
        blocked_ids=None if options.blocked_ids is None else list(options.blocked_ids),
    )
    if "_corrupt_record" in df.columns:
        reason = F.when(F.col("_corrupt_record").isNotNull(), filters.SKIPPED).otherwise(reason)
    # only the OGRN test reads a repaired value; the others may be pushed down to the scan
    df = with_computed(df, "disposition", reason) if options.omit_invalid_ogrn else df.withColumn("disposition", reason)
    absent = [c for c in [*REPAIR_COUNTERS, *WARNING_COUNTERS] if c not in df.columns]
    return df.withColumns({c: F.lit(0) for c in absent}) if absent else df


def written_records(converted: DataFrame) -> DataFrame:
    """Only the records that are written, without the bookkeeping columns."""
    return converted.where(F.col("disposition") == filters.WRITTEN).drop(
        "disposition", *REPAIR_COUNTERS, *WARNING_COUNTERS)
