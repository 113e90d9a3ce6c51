"""A stored graph that grows import by import.

A store is a folder of versions; each holds the node tables, one per kind, and the edges. An import merges a
snapshot with the latest version and writes the next one, so readers of a version are never disturbed and a
lost import leaves the store as it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certweave.operators import graph as G

NODE_TABLES = ["Certificate", "Supplement", "EducationalProgram", "EducationalLevel", "Region", "ActualEducationOrganization", "Decision"]
EDGES = "edges"


PLACES = ["_record_seq", "pos"]  # where a node's row stands in its snapshot


def rows(records: DataFrame) -> dict[str, DataFrame]:
    """The rows of one snapshot's records, not yet merged: nodes by kind with the columns of ``PLACES`` they have, and edges."""
    return {
        "Certificate": G.certificate_nodes(records),
        "Supplement": G.supplement_nodes(records),
        "EducationalProgram": G.program_nodes(records),
        "EducationalLevel": G.level_nodes(records),
        "Region": G.region_nodes(records),
        "ActualEducationOrganization": G.organization_nodes(records),
        "Decision": G.decision_nodes(records),
        EDGES: G.edge_rows(records),
    }


def _order(table: DataFrame) -> list[str]:
    return [c for c in PLACES if c in table.columns]


def snapshot(records: DataFrame) -> dict[str, DataFrame]:
    """The tables of one snapshot's records: nodes by kind, one row per uri, and distinct edges."""
    return {name: t.distinct() if name == EDGES else G.merge_nodes(t, _order(t)) if _order(t) else t for name, t in rows(records).items()}


def merged(stored: dict[str, DataFrame], new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stored tables with a snapshot on top: a new value that is not null replaces, what the snapshot lacks stays, edges come together.

    ``new`` may be merged tables or ``rows``, whose later places win; rows take one aggregate for both.
    Merging the same snapshot again changes nothing. A column that only one side has is null on the other.
    """
    out = {}
    for name in [*NODE_TABLES, EDGES]:
        if name == EDGES:
            out[name] = stored[name].unionByName(new[name], allowMissingColumns=True).distinct()
        else:
            both = stored[name].withColumn("_import", F.lit(0)).unionByName(new[name].withColumn("_import", F.lit(1)), allowMissingColumns=True)
            out[name] = G.merge_nodes(both, ["_import", *_order(new[name])])
    return out


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    """Versions whose import came to its end."""
    try:
        return spark.read.parquet(f"{path}/versions")
    except Exception as missing:  # noqa: BLE001 - a new store
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise


def latest_version(spark: SparkSession, path: str) -> int | None:
    found = _versions(spark, path)
    return None if found is None else found.agg(F.max("version")).first()[0]


def read_store(spark: SparkSession, path: str, version: int | None = None) -> dict[str, DataFrame]:
    """Tables of a version, the latest without one."""
    at = latest_version(spark, path) if version is None else version
    return {name: spark.read.parquet(f"{path}/version={at}/{name}") for name in [*NODE_TABLES, EDGES]}


def import_snapshot(spark: SparkSession, path: str, records: DataFrame) -> int:
    """Merge the records' graph into the store; the number of the new version. A version counts once all its tables are written."""
    last = latest_version(spark, path)
    tables = snapshot(records) if last is None else merged(read_store(spark, path, last), rows(records))
    version = 1 if last is None else last + 1
    for name, table in tables.items():
        # a version that an import left unfinished is written over
        table.write.mode("overwrite").parquet(f"{path}/version={version}/{name}")
    spark.range(1).select(F.lit(version).alias("version")).write.mode("append").parquet(f"{path}/versions")
    return version
