"""Record repair, filters and the conversion report over the register view."""

from __future__ import annotations

from pyspark.sql import functions as F

from certweave.functions import nested as N
from certweave.operators import convert, filters, repair, report
from certweave.plans import register_view as V
from certweave.plans.catalog.sqltext import (
    DIFFERENT, DISPOSITION, EXCLUDED, KNOWN_LEVELS, OVERRIDE_INN, OVERRIDE_OGRN, SAME, blank, digits, repair_steps)

def seq():
    return F.col("_record_seq").alias("k")


def overrides(spark):
    return spark.sql(f"select '{OVERRIDE_OGRN}' as ogrn, '{OVERRIDE_INN}' as inn")


def sup_rows(df, *more):
    """(k, pos, s) with the supplement position as a bigint-free int."""
    return df.select(seq(), *more, F.inline(N.placed(N.supplements())).alias("pos", "s"))


def prog_rows(df):
    return sup_rows(df).select("k", "pos", F.col("s.Id").alias("sup_id"), F.inline(N.placed(N.programs_of(F.col("s")))).alias("slot", "p"))


def cert_ids(df, *counters):
    root = F.col(N.ROOT)
    return df.select(
        seq(), N.effective_root("EduOrgINN").alias("eduorg_inn"), N.effective_root("EduOrgOGRN").alias("eduorg_ogrn"),
        N.effective(root, "INN").alias("root_inn"), N.effective(root, "OGRN").alias("root_ogrn"), *counters)


def strip_supplements(spark, sf):
    out = repair.strip_supplements(V.records(spark, sf))
    return out.select(seq(), F.col("stripped_supplements_by_status").alias("stripped"), F.size(N.SUPPLEMENTS).alias("kept"))


def effective_value(spark, sf):
    df = repair.fill_coherent_ids(V.records(spark, sf))
    s = F.col("s")
    return sup_rows(df).select("k", "pos", N.effective(s[N.ROOT], "INN").alias("inn"), N.effective(s[N.ROOT], "OGRN").alias("ogrn"))


def same_org(spark, sf):
    root, s = F.col(N.ROOT), F.col("s")
    return sup_rows(V.records(spark, sf), N.ROOT).select(
        "k", "pos", N.same_org(root, s[N.ROOT]).alias("same"), N.different_org(root, s[N.ROOT]).alias("different"))


def fill_coherent_ids(spark, sf):
    names = ["coherent_supplement_inn", "coherent_supplement_ogrn", "branch_supplement_inn", "branch_supplement_ogrn", "coherent_root_inn", "coherent_root_ogrn"]
    return cert_ids(repair.fill_coherent_ids(V.records(spark, sf)), *names)


def backfill_root_ids(spark, sf):
    names = ["eduorg_inn_from_supplement", "eduorg_inn_from_root", "eduorg_ogrn_from_supplement", "eduorg_ogrn_from_root"]
    return cert_ids(repair.backfill_root_ids(repair.fill_coherent_ids(V.records(spark, sf))), *names)


def _overridden(spark, sf):
    filled = repair.backfill_root_ids(repair.fill_coherent_ids(V.records(spark, sf)))
    return repair.override_inn_by_ogrn(filled, overrides(spark))


def override_inn_by_ogrn(spark, sf):
    return cert_ids(_overridden(spark, sf), *repair.OVERRIDE_COUNTERS)


def fill_degenerate_shell(spark, sf):
    a = F.col("s")[N.ROOT]
    return sup_rows(repair.fill_degenerate_shells(_overridden(spark, sf))).select(
        "k", "pos", *[N.effective(a, f).alias(f.lower()) for f in ("INN", "OGRN", "KPP")])


def level_from_name(spark, sf):
    df = repair.level_from_name(V.records(spark, sf))
    return prog_rows(df).select("k", "pos", "slot", N.effective(F.col("p"), "EduLevelName").alias("level"))


def strip_stub_programs(spark, sf):
    df = repair.strip_stub_programs(repair.level_from_name(V.records(spark, sf)))
    return df.select(seq(), "stripped_stub_programs", F.size(N.all_programs()).alias("programs"))


def map_levels(spark, sf):
    df = repair.map_levels(repair.strip_stub_programs(repair.level_from_name(V.records(spark, sf))))
    p = F.col("p")
    return prog_rows(df).select("k", "pos", "slot", N.effective(p, "EduLevelName").alias("level"), p["EduLevelName"].alias("original"))


def mark_branches(spark, sf):
    df = repair.mark_branches(V.records(spark, sf))
    return sup_rows(df, F.col("_derived.HasBranchSupplements").alias("has_branch")).select(
        "k", "pos", "has_branch", F.col("s._derived.IsBranchSupplement").alias("is_branch"))


def omit_inactive(spark, sf):
    return V.records(spark, sf).where(~filters.is_inactive()).select(seq(), "StatusName")


def omit_region(spark, sf):
    return V.records(spark, sf).where(~filters.is_outside_region()).select(seq(), "RegionName")


def omit_invalid_ogrn(spark, sf):
    df = repair.backfill_root_ids(repair.fill_coherent_ids(V.records(spark, sf)))
    return filters.omit_invalid_ogrn(df).select(seq(), N.effective_root("EduOrgOGRN").alias("ogrn"))


def omit_blocklist(spark, sf):
    blocked = spark.read.parquet(f"{sf}/orders.parquet").where("o_orderkey % 7 = 0").select(F.concat(F.lit("C"), F.col("o_orderkey")).alias("id"))
    return filters.omit_blocked(V.records(spark, sf), blocked).select(seq(), "Id")


def disposition(spark, sf):
    d = filters.disposition(blocked_ids=["C10", "c11", "C15"])
    return V.records(spark, sf).groupBy(d.alias("disposition")).agg(F.count(F.lit(1)).alias("n"))


def limit_written(spark, sf):
    df = V.records(spark, sf).where(filters.disposition() == filters.WRITTEN).select("_source_file", "_record_seq", "Id")
    return filters.limit_per_file(df, 20).select(seq(), "_source_file", "Id")


def repaired_supplements(spark, sf):
    """Supplement cards after the whole conversion, of written records."""
    df = convert.written_records(convert.convert_records(V.records(spark, sf), overrides(spark)))
    a, s = F.col("s")[N.ROOT], F.col("s")
    return sup_rows(df).select("k", s["Id"].alias("sup_id"), s["_derived"]["IsBranchSupplement"].alias("is_branch"),
                               *[N.effective(a, f).alias(f.lower()) for f in ("INN", "OGRN", "KPP")])


def conversion_report(spark, sf):
    return report.conversion_report(convert.convert_records(V.records(spark, sf), overrides(spark)))


QUERIES = {f.__name__: f for f in (
    strip_supplements, effective_value, same_org, fill_coherent_ids, backfill_root_ids, override_inn_by_ogrn, fill_degenerate_shell,
    level_from_name, strip_stub_programs, map_levels, mark_branches, omit_inactive, omit_region, omit_invalid_ogrn, omit_blocklist,
    disposition, limit_written, repaired_supplements, conversion_report)}

_STEPS = repair_steps()
_STRIPPED = repair_steps(strip=True)


def _per_record(counters: dict[str, str], source: str) -> str:
    return ", ".join(f"cast(count(*) filter (where {c}) as integer) as {n}" for n, c in counters.items()) + f" from {source} group by k"


_SUP_COUNTS = {f"{a}_supplement_{f.lower()}": f"kin = '{b}' and d_{f} is not null" for a, b in (("coherent", "same"), ("branch", "different")) for f in ("INN", "OGRN")}
_SHELL = {
    "shell_cards": f"shell and (don_INN is not null or don_OGRN is not null or (don_KPP is not null and {blank('a_KPP')}))",
    "shell_inn": "shell and don_INN is not null", "shell_ogrn": "shell and don_OGRN is not null",
    "shell_kpp": f"shell and don_KPP is not null and {blank('a_KPP')}",
}
_CERT_FLAGS = {
    "coherent_root_inn": "rd_INN is not null", "coherent_root_ogrn": "rd_OGRN is not null",
    "eduorg_inn_from_supplement": "ed_INN is not null and f_INN is not null", "eduorg_inn_from_root": "ed_INN is not null and f_INN is null",
    "eduorg_ogrn_from_supplement": "ed_OGRN is not null and f_OGRN is not null", "eduorg_ogrn_from_root": "ed_OGRN is not null and f_OGRN is null",
    "override_records": "o_cert or o_root", "override_eduorg_inn": "o_cert", "override_root_inn": "o_root",
}


def _flags(*names: str) -> str:
    return ", ".join(f"cast(coalesce({_CERT_FLAGS[n]}, false) as integer) as {n}" for n in names)


_BLOCKING = DISPOSITION.replace("else 'processed'", "when lower(Id) in ('c10', 'c11', 'c15') then 'omitted_blocklist' else 'processed'")


def _report_sql() -> str:
    """Long form by counter, then one column per counter and a total row."""
    pieces = []
    for n, c in _CERT_FLAGS.items():
        pieces.append(f"select k, '{n}' as counter from final where {c}")
    for n, c in _SUP_COUNTS.items():
        pieces.append(f"select k, '{n}' from sup1 where {c}")
    for n, c in _SHELL.items():
        pieces.append(f"select k, '{n}' from sup2 where {c}")
    pieces.append(f"select k, 'stripped_supplements_by_status' from sup where trim(StatusName) in {EXCLUDED}")
    pieces.append("select k, 'level_from_name' from prog1 where d_level is not null")
    pieces.append("select k, 'stripped_stub_programs' from prog1s where stub")
    pieces.append("select k, 'levels_renamed' from prog3 where renamed")
    pieces.append("select k, 'levels_cleared' from prog3 where cleared")
    pieces.append(f"select k, 'levels_unknown' from prog3 where lv not in {KNOWN_LEVELS}")
    pieces.append(f"select k, {DISPOSITION} from cert")
    names = [*report.DISPOSITIONS, "skipped", *convert.REPAIR_COUNTERS, "bad_dates", "bad_booleans", "non_digit_ids"]
    cols = ", ".join(f"count(*) filter (where counter = '{n}') as {n}" for n in names)
    return (_STRIPPED + f", hits as ({' union all '.join(pieces)}), named as (select c.source_file, h.counter from hits h join cert c using (k)) "
            f"select coalesce(source_file, '<total>') as source_file, {cols} from named group by rollup(source_file)")


ORACLES = {
    "strip_supplements": V.oracle_views("cert", "sup") + f""" select c.k, cast(count(*) filter (where trim(s.StatusName) in {EXCLUDED}) as integer) as stripped,
        cast(count(s.k) filter (where not coalesce(trim(s.StatusName) in {EXCLUDED}, false)) as integer) as kept from cert c left join sup s using (k) group by c.k""",
    "effective_value": _STEPS + "select k, i as pos, coalesce(d_INN, a_INN) as inn, coalesce(d_OGRN, a_OGRN) as ogrn from sup1",
    "same_org": V.oracle_views("cert", "sup") + f" select k, i as pos, coalesce({SAME}, false) as same, coalesce({DIFFERENT}, false) as different from sup s join cert c using (k)",
    "fill_coherent_ids": _STEPS + f""", n as (select k, {_per_record(_SUP_COUNTS, 'sup1')})
        select k, EduOrgINN as eduorg_inn, EduOrgOGRN as eduorg_ogrn, coalesce(rd_INN, r_INN) as root_inn, coalesce(rd_OGRN, r_OGRN) as root_ogrn,
        {', '.join(f'coalesce({c}, 0) as {c}' for c in _SUP_COUNTS)}, {_flags('coherent_root_inn', 'coherent_root_ogrn')} from cert1 left join n using (k)""",
    "backfill_root_ids": _STEPS + f"""select k, coalesce(ed_INN, EduOrgINN) as eduorg_inn, coalesce(ed_OGRN, EduOrgOGRN) as eduorg_ogrn,
        coalesce(rd_INN, r_INN) as root_inn, coalesce(rd_OGRN, r_OGRN) as root_ogrn,
        {_flags('eduorg_inn_from_supplement', 'eduorg_inn_from_root', 'eduorg_ogrn_from_supplement', 'eduorg_ogrn_from_root')} from cert2""",
    "override_inn_by_ogrn": _STEPS + f"""select k, x_INN as eduorg_inn, x_OGRN as eduorg_ogrn, xr_INN as root_inn, xr_OGRN as root_ogrn,
        {_flags('override_records', 'override_eduorg_inn', 'override_root_inn')} from final""",
    "fill_degenerate_shell": _STEPS + "select k, i as pos, coalesce(d3_INN, a_INN) as inn, coalesce(d3_OGRN, a_OGRN) as ogrn, coalesce(d3_KPP, a_KPP) as kpp from sup3",
    "level_from_name": _STEPS + "select k, i as pos, j as slot, coalesce(d_level, EduLevelName) as level from prog1",
    "strip_stub_programs": _STEPS + """select c.k, cast(count(*) filter (where stub) as integer) as stripped_stub_programs,
        cast(count(*) filter (where not stub) as integer) as programs from cert c left join prog1s p using (k) group by c.k""",
    "map_levels": _STEPS + "select k, i as pos, cast(slot as integer) as slot, level3 as level, case when not cleared then EduLevelName end as original from prog3",
    "mark_branches": _STEPS + """select k, i as pos, bool_or(is_branch) over (partition by k) as has_branch, is_branch from sup4""",
    "omit_inactive": V.oracle_views("cert") + f" select k, StatusName from cert where not coalesce(StatusName in {EXCLUDED}, false)",
    "omit_region": V.oracle_views("cert") + " select k, RegionName from cert where RegionName <> 'образовательные учреждения, находящиеся за пределами Российской Федерации'",
    "omit_invalid_ogrn": _STEPS + f"select k, coalesce(ed_OGRN, EduOrgOGRN) as ogrn from cert2 where {digits('coalesce(ed_OGRN, EduOrgOGRN)')} is not null",
    "omit_blocklist": V.oracle_views("cert") + " select k, Id from cert where Id is null or lower(trim(Id)) not in (select 'c'||o_orderkey from orders where o_orderkey % 7 = 0)",
    "disposition": V.oracle_views("cert") + f", t as (select {_BLOCKING} as disposition from cert) select disposition, count(*) as n from t group by 1",
    "limit_written": V.oracle_views("cert") + f""", t as (select *, row_number() over (partition by source_file order by k) as rn from cert where {DISPOSITION} = 'processed')
        select k, source_file as _source_file, Id from t where rn <= 20""",
    "repaired_supplements": _STRIPPED + f"""select s.k, s.Id as sup_id, s.is_branch, coalesce(d3_INN, a_INN) as inn, coalesce(d3_OGRN, a_OGRN) as ogrn,
        coalesce(d3_KPP, a_KPP) as kpp from sup4 s join cert c using (k) where {DISPOSITION.replace('StatusName', 'c.StatusName')} = 'processed'""",
    "conversion_report": _report_sql(),
}
