"""The global level pass, display texts and the graph projection."""

from __future__ import annotations

from pyspark.sql import functions as F

from certweave.functions import display as D
from certweave.functions import nested as N
from certweave.operators import backfill, convert, projection, repair
from certweave.plans import register_view as V
from certweave.plans.catalog.repairs import overrides, prog_rows, seq, sup_rows
from certweave.plans.catalog.sqltext import DISPOSITION, blank, code_key, nb, repair_steps
from certweave.session import scratch_path


def _written(spark, sf):
    return convert.written_records(convert.convert_records(V.records(spark, sf), overrides(spark)))


def _stored_written(spark, sf):
    """The same, written once: the level pass goes over them twice, and the repairs cost more than reading them."""
    path = scratch_path(spark, "written")
    _written(spark, sf).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def level_histogram_by_code(spark, sf):
    return backfill.level_histogram_by_code(backfill.program_rows(_written(spark, sf), per_file=True)).withColumnRenamed("count", "n")


def majority_level(spark, sf):
    return backfill.majority_level(backfill.level_histogram_by_code(backfill.program_rows(_written(spark, sf)))).drop("scope")


def neighbor_backfill(spark, sf):
    df = backfill.neighbor_backfill(_written(spark, sf))
    return prog_rows(df).select("k", "sup_id", "slot", N.effective(F.col("p"), "EduLevelName").alias("level"))


def neighbor_backfill_per_file(spark, sf):
    """Per source file, with the levels brought back by joins instead of a map."""
    df = backfill.neighbor_backfill(_stored_written(spark, sf), per_file=True)
    return prog_rows(df).select("k", "sup_id", "slot", N.effective(F.col("p"), "EduLevelName").alias("level"))


def neighbor_backfill_rows(spark, sf):
    """The join form for program rows kept as a table."""
    programs = backfill.program_rows(V.records(spark, sf))
    usual = backfill.majority_level(backfill.level_histogram_by_code(programs))
    return backfill.fill_rows(programs, usual).groupBy("code", "filled_level").agg(F.count(F.lit(1)).alias("n"))


def display_name(spark, sf):
    r, root = V.records(spark, sf), F.col(N.ROOT)
    return r.select(seq(), D.display_name(F.col("EduOrgFullName"), F.col("EduOrgShortName")).alias("own"),
                    D.display_name(root["FullName"], root["ShortName"]).alias("card"))


def shorten_region(spark, sf):
    return V.records(spark, sf).select(seq(), D.shorten_region(F.col("RegionName")).alias("region_short"))


def shorten_level(spark, sf):
    p = F.col("p")
    return prog_rows(V.records(spark, sf)).select(
        "k", "pos", "slot", D.shorten_level(p["EduLevelName"], p["ProgrammCode"]).alias("with_code"), D.shorten_level(p["EduLevelName"]).alias("plain"))


def control_organ_short(spark, sf):
    return V.records(spark, sf).select(seq(), D.control_organ_short(F.col("ControlOrgan")).alias("short"))


def control_organ_region(spark, sf):
    return V.records(spark, sf).select(seq(), D.control_organ_region(F.col("ControlOrgan")).alias("region"))


def derive_founder(spark, sf):
    r = V.records(spark, sf)
    levels = F.transform(N.all_programs(), lambda p: p["EduLevelName"])
    key = D.founder_key(F.col("IsFederal"), F.col(N.ROOT)["FormName"], F.col("RegionName"), levels)
    return r.select(seq(), key.alias("founder_key")).withColumn("founder_label", D.founder_label(F.col("founder_key")))


def _text(programs):
    part = lambda p, f: F.coalesce(p[f], F.lit(""))
    return F.array_join(F.transform(programs, lambda p: F.concat_ws(":", part(p, "code"), part(p, "ugs_code"), part(p, "edu_level"), part(p, "edu_level_short"))), "|")


def collect_programs(spark, sf):
    s = F.col("s")
    rows = sup_rows(V.records(spark, sf))
    return rows.select("k", "pos", F.array_join(projection.level_list(s), "|").alias("levels"),
                       _text(projection.distinct_programs(projection.program_entries(s))).alias("programs"))


def _projected(spark, sf):
    return projection.with_graph(repair.mark_branches(V.records(spark, sf)))


def head_projection(spark, sf):
    g = F.col("_graph")
    return _projected(spark, sf).select(seq(), F.array_join(g["edu_levels"], "|").alias("levels"), _text(g["programs"]).alias("programs"))


def branch_projection(spark, sf):
    b = F.col("b")
    return _projected(spark, sf).select(seq(), F.posexplode("_graph.branches").alias("branch", "b")).select(
        "k", "branch", b["ogrn"].alias("ogrn"), b["inn"].alias("inn"), b["display_name"].alias("display_name"),
        F.array_join(b["edu_levels"], "|").alias("levels"), _text(b["programs"]).alias("programs"))


def graph_projection(spark, sf):
    g = F.col("_graph")
    return _projected(spark, sf).select(
        seq(), *[g["org"][f].alias(f) for f in ("ogrn", "inn", "display_name", "founder_key", "founder_label")],
        *[g[f].alias(f) for f in ("region", "region_short", "control_organ", "control_organ_short")],
        F.array_join(g["edu_levels_short"], "|").alias("levels_short"), F.size(g["branches"]).alias("branches"))


def converted_projection(spark, sf):
    """The whole run: convert, global pass, projection."""
    df = projection.with_graph(backfill.neighbor_backfill(_stored_written(spark, sf)))
    g = F.col("_graph")
    return df.select(seq(), g["org"]["inn"].alias("inn"), g["org"]["ogrn"].alias("ogrn"), g["org"]["founder_key"].alias("founder_key"),
                     F.array_join(g["edu_levels"], "|").alias("levels"), F.col("levels_from_neighbors").alias("filled"))


QUERIES = {f.__name__: f for f in (
    level_histogram_by_code, majority_level, neighbor_backfill, neighbor_backfill_per_file, neighbor_backfill_rows, display_name,
    shorten_region, shorten_level, control_organ_short, control_organ_region, derive_founder, collect_programs, head_projection,
    branch_projection, graph_projection, converted_projection)}

_PROGS = repair_steps(strip=True) + f""", live as (select p.*, c.source_file, {code_key('p.ProgrammCode')} as code, {nb('p.level3')} as level,
  s.Id as sup_id, s.is_branch from prog3 p join cert c using (k) join sup4 s using (k, i) where {DISPOSITION.replace('StatusName', 'c.StatusName').replace('RegionName', 'c.RegionName')} = 'processed'),
hist as (select {{scope}} as scope, code, level, count(*) as n from live where code is not null and level is not null group by all),
major as (select scope, code, arg_min(level, (-n, level)) as usual from hist group by all),
filled as (select l.*, case when {blank('l.level3')} then coalesce(m.usual, l.level3) else l.level3 end as level4,
  {blank('l.level3')} and m.usual is not null as from_neighbors from live l left join major m on m.scope = {{scope}} and m.code = l.code)
"""


def _progs(scope: str) -> str:
    return _PROGS.replace("{scope}", scope)


def _re(pattern: str) -> str:
    """A Java pattern of the library in RE2 spelling."""
    return pattern.replace("(?iU)", "(?i)").replace("\\w", "[\\p{L}\\p{N}_]").replace("[[\\p{L}\\p{N}_]\\-]", "[\\p{L}\\p{N}_\\-]").replace("\\b", "")


def _display(full: str, short: str) -> str:
    bare = f"trim(regexp_replace(trim({short}), '{_re(D.LEGAL_ABBREVIATION)}', ''))"
    last = lambda x: f"(regexp_extract_all({x}, '{D.INNERMOST_QUOTES}', 1))[-1]"
    a = f"trim(coalesce({last(bare)}, trim(trim({bare}, '«»'))))"
    q = f"trim({last(f'trim({full})')})"
    u = f"trim(trim(trim(regexp_replace(trim({full}), '{_re(D.LEGAL_WRAPPER)}', '')), '«»'))"
    return (f"(case when {a} <> '' and length({a}) <= 60 then {a} when coalesce({full}, '') = '' then nullif(substr(trim({short}), 1, 60), '') "
            f"when length({q}) between 3 and 80 then {q} when {u} <> '' and {u} <> trim({full}) then substr({u}, 1, 80) else substr(trim({full}), 1, 60) end)")


def _region(x: str) -> str:
    y = f"trim(regexp_replace(regexp_replace(trim({x}), '{_re(D.REGION_SUFFIX)}', ''), '{_re(D.REGION_PREFIX)}', ''))"
    return f"coalesce(nullif({y}, ''), {x})"


_SHORTS = "case {x} " + " ".join(f"when '{k}' then '{v}'" for k, v in D.LEVEL_SHORT.items()) + " end"
_KINDS = "case split_part({c}, '.', 2) " + " ".join(f"when '{k}' then '{v}'" for k, v in D.POSTGRADUATE_BY_SEGMENT.items()) + " end"


def _level(x: str, c: str | None = None) -> str:
    known = _SHORTS.format(x=x)
    if c:
        kind = f"case when len(string_split({c}, '.')) = 3 then {_KINDS.format(c=c)} end"
        known = f"case when {known} = 'ПКВК' then coalesce({kind}, 'ПКВК') else {known} end"
    p = f"trim(regexp_replace({x}, '{_re(D.LEVEL_PREFIX)}', ''))"
    e = f"trim(regexp_replace({x}, '{_re(D.LEVEL_SUFFIX)}', ''))"
    return (f"(case when {x} <> '' then case when ({known}) is not null then ({known}) when {p} <> {x} then upper(substr(substr({p},1,20),1,1))||lower(substr(substr({p},1,20),2)) "
            f"when {e} <> {x} then substr({e},1,20) else substr({x},1,20) end end)")


_ORGAN_REGION = _re(D.ORGAN_REGION)


def _organ_region(x: str) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({x}, '{_ORGAN_REGION}', {g}), '')" for g in (1, 2, 3)) + ")"


def _organ(x: str) -> str:
    whens = ""
    for pattern, name, regional in D.CONTROL_ORGANS:
        text = f"'{name}'||coalesce(' '||{_organ_region(f'trim({x})')}, '')" if regional else f"'{name}'"
        whens += f" when regexp_matches({x}, '(?i){_re(pattern)}') then {text}"
    return f"(case when coalesce({x}, '') = ''  then null{whens} else substr(trim({x}), 1, 40) end)"


_HIGHER = "(" + ", ".join(f"'{x}'" for x in D.HIGHER_LEVELS) + ")"


def _founder(higher: str) -> str:
    form, place = "lower(coalesce(r_FormName, ''))", "coalesce(nullif(RegionName, ''), 'неизвестный регион')"
    return (f"(case when coalesce(IsFederal, false) then case when {higher} then 'federal:nauka' else 'federal:prosv' end "
            f"when {form} like '%муниципальное%' then 'municipal:'||{place} when {form} like '%государственное%' then 'regional:'||{place} "
            f"when {form} like '%частное%' or {form} like '%автономная некоммерческая%' or {form} like '%некоммерческое партнёрство%' then 'private' else 'unknown' end)")


_FOUNDER_LABEL = ("case when founder_key = 'federal:nauka' then 'Минобрнауки России' when founder_key = 'federal:prosv' then 'Минпросвещения России' "
                  "when founder_key like 'municipal:%' then 'Муниципальный, '||substr(founder_key, 11) when founder_key like 'regional:%' then 'Субъект РФ, '||substr(founder_key, 10) "
                  "when founder_key = 'private' then 'Частный учредитель' else 'Учредитель неизвестен' end as founder_label")

# programme entries of the unrepaired view: one row per (owner, code, level), the first of each
_UGS = "case when regexp_matches(UGSCode, '^[0-9]{2}\\.[0-9]{2}\\.[0-9]{2}$') then UGSCode else substr(ProgrammCode, 1, 2)||'.00.00' end"


def _collected(owner: str, rows: str) -> str:
    """CTEs ``lv`` and ``pg``: levels and programme entries per owner, joined in order of appearance."""
    short = _level("lvl", "ProgrammCode")
    return f"""lv0 as (select {owner}, EduLevelName as lvl, min(i * 10 + j) as o from {rows} where EduLevelName <> '' group by all),
lv as (select {owner}, string_agg(lvl, '|' order by o) as levels, string_agg({_level('lvl')}, '|' order by o) as shorts,
  bool_or({_level('lvl')} <> lvl) as differs from lv0 group by {owner}),
pg0 as (select {owner}, ProgrammCode, coalesce(EduLevelName, '') as lvl, arg_min({_UGS}, i * 10 + j) as ugs, min(i * 10 + j) as o from {rows}
  where regexp_matches(ProgrammCode, '^[0-9]{{2}}\\.[0-9]{{2}}\\.[0-9]{{2}}$') group by all),
pg as (select {owner}, string_agg(ProgrammCode||':'||ugs||':'||lvl||':'||coalesce(nullif({short}, lvl), ''), '|' order by o) as programs from pg0 group by {owner})"""


_MARKED = repair_steps()
_BKEY = "coalesce(nullif(s.a_OGRN, ''), nullif(s.a_Id, ''), 'own '||i)"
ORACLES = {
    "level_histogram_by_code": _progs("source_file") + "select * from hist",
    "majority_level": _progs("'<all>'") + "select code, usual as level from major",
    "neighbor_backfill": _progs("'<all>'") + "select k, sup_id, cast(slot as integer) as slot, level4 as level from filled",
    "neighbor_backfill_per_file": _progs("l.source_file").replace("select l.source_file as scope", "select source_file as scope")
        + "select k, sup_id, cast(slot as integer) as slot, level4 as level from filled",
    "neighbor_backfill_rows": V.oracle_views("prog") + f""", t as (select {code_key('ProgrammCode')} as code, {nb('EduLevelName')} as level from prog),
        h as (select code, level, count(*) as n from t where code is not null and level is not null group by all),
        m as (select code, arg_min(level, (-n, level)) as usual from h group by 1)
        select t.code, case when t.level is null then usual end as filled_level, count(*) as n from t left join m using (code) group by all""",
    "display_name": V.oracle_views("cert") + f" select k, {_display('EduOrgFullName', 'EduOrgShortName')} as own, {_display('r_FullName', 'r_ShortName')} as card from cert",
    "shorten_region": V.oracle_views("cert") + f" select k, {_region('RegionName')} as region_short from cert",
    "shorten_level": V.oracle_views("prog") + f" select k, i as pos, j as slot, {_level('EduLevelName', 'ProgrammCode')} as with_code, {_level('EduLevelName')} as plain from prog",
    "control_organ_short": V.oracle_views("cert") + f" select k, {_organ('ControlOrgan')} as short from cert",
    "control_organ_region": V.oracle_views("cert") + f" select k, {_organ_region('ControlOrgan')} as region from cert",
    "derive_founder": V.oracle_views("cert", "prog") + f""", h as (select k, bool_or(EduLevelName in {_HIGHER}) as higher from prog group by k),
        t as (select k, {_founder('coalesce(higher, false)')} as founder_key from cert left join h using (k)) select *, {_FOUNDER_LABEL} from t""",
    "collect_programs": V.oracle_views("sup", "prog") + f", {_collected('k, i', 'prog')} select k, i as pos, coalesce(levels, '') as levels, coalesce(programs, '') as programs from sup left join lv using (k, i) left join pg using (k, i)",
    "head_projection": _MARKED + f""", hp as (select p.* from prog p join sup4 s using (k, i) where not is_branch), {_collected('k', 'hp')}
        select k, coalesce(levels, '') as levels, coalesce(programs, '') as programs from cert left join lv using (k) left join pg using (k)""",
    "branch_projection": _MARKED + f""", bs as (select s.*, {_BKEY} as bkey from sup4 s where is_branch), bp as (select p.*, b.bkey from prog p join bs b using (k, i)),
        {_collected('k, bkey', 'bp')},
        bh as (select k, bkey, min(i) as first, arg_min(struct_pack(o := a_OGRN, n := a_INN, d := {_display('a_FullName', 'a_ShortName')}), i) as f from bs group by k, bkey)
        select k, cast(row_number() over (partition by k order by first) - 1 as integer) as branch, f.o as ogrn, f.n as inn, f.d as display_name,
        coalesce(levels, '') as levels, coalesce(programs, '') as programs from bh left join lv using (k, bkey) left join pg using (k, bkey)""",
    "graph_projection": _MARKED + f""", hp as (select p.* from prog p join sup4 s using (k, i) where not is_branch), {_collected('k', 'hp')},
        hi as (select k, bool_or(EduLevelName in {_HIGHER}) as higher from hp group by k),
        nb as (select k, cast(count(distinct {_BKEY}) as integer) as branches from sup4 s where is_branch group by k),
        t as (select k, nullif(EduOrgOGRN, '') as ogrn, nullif(EduOrgINN, '') as inn,
          nullif({_display("coalesce(nullif(r_FullName, ''), nullif(EduOrgFullName, ''))", "coalesce(nullif(r_ShortName, ''), nullif(EduOrgShortName, ''))")}, '') as display_name,
          {_founder('coalesce(higher, false)')} as founder_key, RegionName as region, nullif({_region('RegionName')}, RegionName) as region_short,
          ControlOrgan as control_organ, nullif({_organ('ControlOrgan')}, ControlOrgan) as control_organ_short, case when differs then shorts end as levels_short,
          coalesce(branches, 0) as branches from cert left join lv using (k) left join hi using (k) left join nb using (k))
        select *, {_FOUNDER_LABEL} from t""",
    "converted_projection": _progs("'<all>'") + f""", hp as (select k, i, j, level4 as EduLevelName from filled where not is_branch),
        lv0 as (select k, EduLevelName as lvl, min(i * 10 + j) as o from hp where EduLevelName <> '' group by all),
        lv as (select k, string_agg(lvl, '|' order by o) as levels, bool_or(lvl in {_HIGHER}) as higher from lv0 group by k),
        fn as (select k, cast(count(*) filter (where from_neighbors) as integer) as filled from filled group by k)
        select k, nullif(x_INN, '') as inn, nullif(x_OGRN, '') as ogrn, {_founder('coalesce(higher, false)')} as founder_key, coalesce(levels, '') as levels,
        coalesce(filled, 0) as filled from final left join lv using (k) left join fn using (k) where {DISPOSITION} = 'processed'""",
}
