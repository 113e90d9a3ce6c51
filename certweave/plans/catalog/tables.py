"""Relational tables, their keys and record rejection."""

from __future__ import annotations

from pyspark.sql import functions as F

from certweave import schema as S
from certweave.operators import relational as R
from certweave.plans import register_view as V
from certweave.plans.catalog.repairs import seq
from certweave.plans.catalog.sqltext import blank
from certweave.session import scratch_path


def tbl_certificates(spark, sf):
    return R.certificates(V.records(spark, sf))


def tbl_supplements(spark, sf):
    return R.supplements(V.records(spark, sf))


def tbl_decisions(spark, sf):
    return R.decisions(V.records(spark, sf))


def tbl_programs(spark, sf):
    return R.programs(V.records(spark, sf))


def tbl_organizations(spark, sf):
    return R.organizations(V.records(spark, sf))


def adapt_scalar(spark, sf):
    rows = V.order_rows(spark, sf).select(
        "k", F.expr("case k % 5 when 0 then '1' when 1 then ' 0 ' when 2 then 'да' when 3 then null else '2' end").alias("t"),
        F.expr("k % 3").alias("n"), F.expr("k % 2 = 0").alias("b"), F.expr("named_struct('a', k, 'b', d)").alias("o"), "d")
    return rows.select(
        "k", R.adapt_scalar(F.col("t"), "string", "BOOLEAN").alias("from_text"), R.adapt_scalar(F.col("n"), "bigint", "BOOLEAN").alias("from_number"),
        R.adapt_scalar(F.col("b"), "boolean", "BOOLEAN", integer_booleans=True).alias("as_int"),
        R.adapt_scalar(F.col("o"), "struct<a:bigint,b:string>", "TEXT").alias("nested"), R.adapt_scalar(F.col("d"), "string", "DATE").alias("day"))


def check_keys(spark, sf):
    return R.key_violations(R.tables(V.stored_records(spark, sf)))


def reject_record(spark, sf):
    return R.loadable_records(V.records(spark, sf).select("Id", "_record_seq", "Supplements", "Decisions")).select(seq(), "Id")


def check_keys_after_reject(spark, sf):
    """No violation is left among the records that load."""
    path = scratch_path(spark, "loadable")
    R.loadable_records(V.stored_records(spark, sf)).write.parquet(path)
    return R.key_violations(R.tables(spark.read.parquet(path)))


QUERIES = {f.__name__: f for f in (
    tbl_certificates, tbl_supplements, tbl_decisions, tbl_programs, tbl_organizations, adapt_scalar, check_keys, reject_record, check_keys_after_reject)}


def _cols(fields, prefix="", table="") -> str:
    return ", ".join(f"{table}{prefix}{f} as {R.column_name(f)}" for f in fields if f != "Id")


_VIEWS = V.oracle_views("cert", "sup", "prog", "dec")
TABLES = f""",
t1 as (select Id as certificate_id, {_cols(S.CERTIFICATE_FIELDS)} from cert),
t2 as (select c.Id as certificate_id, s.Id as supplement_id, {_cols(S.SUPPLEMENT_FIELDS, table='s.')} from sup s join cert c using (k)),
t3 as (select c.Id as certificate_id, d.Id as decision_id, {_cols(S.DECISION_FIELDS, table='d.')} from dec d join cert c using (k) where not {blank('d.Id')}),
t4 as (select c.Id as certificate_id, s.Id as supplement_id, p.j as program_slot, p.Id as program_id, {_cols(S.PROGRAM_FIELDS, table='p.')}
  from prog p join sup s using (k, i) join cert c on c.k = p.k),
t5 as (select Id as certificate_id, 'certificate' as ae_scope, cast(null as varchar) as supplement_id, r_Id as aeo_id, {_cols(S.ORGANIZATION_FIELDS, 'r_')}
  from cert where Id is not null and r_Id is not null
  union all select c.Id, 'supplement', s.Id, s.a_Id, {_cols(S.ORGANIZATION_FIELDS, 'a_', table='s.')} from sup s join cert c using (k)
  where c.Id is not null and s.Id is not null and s.a_Id is not null)
"""
_ALL = {"certificates": ("t1", ["certificate_id"]), "supplements": ("t2", ["certificate_id", "supplement_id"]), "decisions": ("t3", ["certificate_id", "decision_id"]),
        "educational_programs": ("t4", ["certificate_id", "supplement_id", "program_slot"]),
        "actual_education_organizations": ("t5", ["certificate_id", "ae_scope", "supplement_id", "aeo_id"])}


def _violations() -> str:
    parts = []
    for name, (t, keys) in _ALL.items():
        required = [k for k in keys if not (name.startswith("actual") and k == "supplement_id")]
        null = " or ".join(f"{k} is null" for k in required)
        parts.append(f"select '{name}' as table_name, 'null_key' as violation, count(*) filter (where {null}) as n from {t}")
        parts.append(f"select '{name}', 'duplicate_key', count(*) from (select 1 from {t} where not ({null}) group by {', '.join(keys)} having count(*) > 1)")
    for child, cols, parent in R.FOREIGN_KEYS:
        have = " and ".join(f"{c} is not null" for c in cols)
        match = " and ".join(f"p.{c} = x.{c}" for c in cols)
        suffix = "_pair" if len(cols) > 1 else ""
        parts.append(f"select '{child}', 'orphan_of_{parent}{suffix}', count(*) from {_ALL[child][0]} x where {have} and not exists (select 1 from {_ALL[parent][0]} p where {match})")
    return " union all ".join(parts)


GOOD = f""", bad as (select k from sup group by k having count(*) filter (where Id is null) > 0 or count(distinct Id) < count(*)
  union select k from dec where not {blank('Id')} group by k having count(distinct Id) < count(*)),
good as (select k, Id, row_number() over (partition by Id order by k) as rn from cert where Id is not null and k not in (select k from bad))
"""
ORACLES = {
    "tbl_certificates": _VIEWS + TABLES + "select * from t1",
    "tbl_supplements": _VIEWS + TABLES + "select * from t2",
    "tbl_decisions": _VIEWS + TABLES + "select * from t3",
    "tbl_programs": _VIEWS + TABLES + "select * from t4",
    "tbl_organizations": _VIEWS + TABLES + "select * from t5",
    "adapt_scalar": V.oracle_views() + """ select k, case when k % 5 = 0 then true when k % 5 = 1 then false end as from_text,
        case k % 3 when 1 then true when 0 then false end as from_number, cast(k % 2 = 0 as integer) as as_int,
        '{"a":'||k||',"b":"'||d||'"}' as nested, d as day from base""",
    "check_keys": _VIEWS + TABLES + _violations(),
    "reject_record": _VIEWS + GOOD + "select k, Id from good where rn = 1",
}
ORACLES["check_keys_after_reject"] = f"select table_name, violation, cast(0 as bigint) as n from ({ORACLES['check_keys']}) v"
