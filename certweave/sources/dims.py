"""Small look-up tables from JSON files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certweave.functions import text as X

OVERRIDES = "ogrn string, inn string"


def parse_overrides(blobs: DataFrame) -> DataFrame:
    """(ogrn, inn) from JSON objects (column ``value``): keys starting with ``_`` are notes, the last duplicate counts."""
    entries = F.map_entries(F.from_json("value", "map<string,string>"))
    pairs = blobs.select(F.posexplode(entries).alias("pos", "e")).where(~F.col("e.key").startswith("_"))
    clean = pairs.select("pos", X.digits_only(F.col("e.key")).alias("ogrn"), X.digits_only(F.col("e.value")).alias("inn"))
    return clean.where("ogrn is not null and inn is not null").groupBy("ogrn").agg(F.max_by("inn", "pos").alias("inn"))


def load_overrides(spark: SparkSession, path: str) -> DataFrame:
    """The OGRN -> INN table; a missing or unreadable file gives an empty one."""
    try:
        return parse_overrides(spark.read.text(path, wholetext=True))
    except AnalysisException:
        return spark.createDataFrame([], OVERRIDES)


def parse_levels(blobs: DataFrame) -> DataFrame:
    """(level, target, role) rows from the level map's JSON.

    ``role``: ``rename``, ``clear`` or ``canonical``. The first entry of a source
    counts; blank sources and targets that are no text are skipped.
    """
    shape = "canonical_edu_level_names_fz273 array<string>, entries array<struct<source_registry_level_name variant, target_edu_level_name variant>>"
    doc = blobs.select(F.from_json("value", shape).alias("d")).where("d.canonical_edu_level_names_fz273 is not null and d.entries is not null")
    source = F.expr("try_variant_get(e.source_registry_level_name, '$', 'string')")
    target = F.expr("try_variant_get(e.target_edu_level_name, '$', 'string')")
    kind = F.schema_of_variant(F.col("e.target_edu_level_name"))
    rows = doc.select(F.posexplode("d.entries").alias("pos", "e")).where(
        (F.schema_of_variant(F.col("e.source_registry_level_name")) == "STRING") & ~X.is_blank(source))
    # a duplicate is judged against entries that were taken, so unusable ones go first
    usable = rows.where(kind.isNull() | kind.isin("VOID", "STRING"))
    named = usable.select("pos", source.alias("level"), X.nonblank(F.when(kind == "STRING", target)).alias("target"))
    first = named.groupBy("level").agg(F.min_by(F.struct("target"), "pos").alias("x")).select("level", "x.target")
    explicit = first.withColumn("role", F.when(F.col("target").isNull(), "clear").otherwise("rename"))
    canonical = doc.select(F.explode("d.canonical_edu_level_names_fz273").alias("level")).distinct().select(
        "level", F.col("level").alias("target"), F.lit("canonical").alias("role"))
    return explicit.unionByName(canonical)


def load_levels(spark: SparkSession, path: str) -> DataFrame | None:
    """The level map of a file as rows of :func:`parse_levels`, for ``backfill.map_levels_by``.

    ``None`` (no mapping) when the file is missing or has the wrong form.
    """
    try:
        found = parse_levels(spark.read.text(path, wholetext=True))
    except AnalysisException:
        return None
    return None if found.isEmpty() else found
