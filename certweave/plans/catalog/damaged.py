"""Damaged input: XML elements that cannot be read, and null items in every list of a record."""

from __future__ import annotations

from pyspark.sql import functions as F

from certweave import schema as S
from certweave.functions import nested as N
from certweave.operators import backfill, clean, convert, graph, relational
from certweave.plans import register_view as V
from certweave.plans.catalog.global_pass import ORACLES as PASSED
from certweave.plans.catalog.global_pass import _written
from certweave.plans.catalog.graphs import ORACLES as GRAPHS
from certweave.plans.catalog.repairs import overrides, prog_rows
from certweave.plans.catalog.sources import _xml_text
from certweave.plans.catalog.sqltext import DISPOSITION
from certweave.plans.catalog.tables import ORACLES as TABLES
from certweave.session import scratch_path
from certweave.sources import readers, sinks


def with_null_items(records):
    """A null before the supplements, before the programmes of each and before the decisions."""
    shape = S.record_type()
    null = lambda t: F.array(F.lit(None).cast(t))
    programmes = lambda s: F.concat(null(S.program_type()), N.programs_of(s))
    return records.withColumns({
        N.SUPPLEMENTS: F.concat(null(S.supplement_type()), F.transform(N.supplements(), lambda s: s.withField(N.PROGRAMS, programmes(s)))),
        "Decisions": F.concat(null(shape["Decisions"].dataType.elementType), F.col("Decisions"))})


def convert_with_broken(spark, sf):
    """The conversion of an XML text in which every tenth element has lost a closing tag: what becomes of each kind of record."""
    path, stored = scratch_path(spark, "broken"), scratch_path(spark, "read")
    lines = _xml_text(V.records(spark, sf))
    number = F.regexp_extract("value", "<RegNumber>РН-([0-9]+)</RegNumber>", 1).cast("long")
    damaged = lines.select(F.when(number % 10 == 3, F.replace("value", F.lit("</RegNumber>"), F.lit("</Wrong>"))).otherwise(F.col("value")).alias("value"))
    sinks.packed_text(damaged.write).text(path)
    clean.clean_records(readers.read_xml(spark, path)).write.option("compression", "zstd").parquet(stored)
    done = convert.convert_records(spark.read.parquet(stored), overrides(spark))
    return done.groupBy("disposition").agg(F.count(F.lit(1)).alias("n"))


def null_items_programs(spark, sf):
    return relational.programs(with_null_items(V.records(spark, sf)))


def null_items_supplements(spark, sf):
    return relational.supplements(with_null_items(V.records(spark, sf)))


def null_items_decisions(spark, sf):
    return relational.decisions(with_null_items(V.records(spark, sf)))


def null_items_edges(spark, sf):
    return graph.edges(with_null_items(V.records(spark, sf)), ["hasSupplement", "hasDecision", "offersEducationLevel", "inRegion", "hasActualEducationOrganization"])


def null_items_rejected(spark, sf):
    """Records that load do so with null items, too."""
    return relational.loadable_records(with_null_items(V.records(spark, sf))).select(F.col("_record_seq").alias("k"), "Id")


def null_items_backfill(spark, sf):
    df = backfill.neighbor_backfill(with_null_items(_written(spark, sf)))
    return prog_rows(df).select("k", "sup_id", "slot", N.effective(F.col("p"), "EduLevelName").alias("level"))


QUERIES = {f.__name__: f for f in (
    convert_with_broken, null_items_programs, null_items_supplements, null_items_decisions, null_items_edges, null_items_rejected, null_items_backfill)}
ORACLES = {
    "convert_with_broken": V.oracle_views("cert") + f""", t as (select case when k % 10 = 3 then 'skipped' else {DISPOSITION} end as disposition from cert)
        select disposition, count(*) as n from t group by 1""",
    "null_items_programs": f"select * replace (program_slot + 1 as program_slot) from ({TABLES['tbl_programs']}) t",
    "null_items_supplements": TABLES["tbl_supplements"],
    "null_items_decisions": TABLES["tbl_decisions"],
    "null_items_edges": " union all ".join(f"select * from ({GRAPHS[f'edges_{p}']}) t" for p in ("hasSupplement", "hasDecision", "offersEducationLevel", "inRegion", "hasActualEducationOrganization")),
    "null_items_rejected": TABLES["reject_record"],
    "null_items_backfill": f"select * replace (slot + 1 as slot) from ({PASSED['neighbor_backfill']}) t",
}
