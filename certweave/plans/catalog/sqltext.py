"""DuckDB text for the check side: small scalar pieces and the repair steps over the flat views."""

from __future__ import annotations

from certweave.plans import register_view as V


def nb(x: str) -> str:
    return f"nullif(trim({x}), '')"


def blank(x: str) -> str:
    return f"(coalesce(trim({x}), '') = '')"


def tok(x: str) -> str:
    return f"lower(nullif(trim({x}), ''))"


def digits(x: str) -> str:
    bare = f"regexp_replace({x}, '[\\s\\-]', '', 'g')"
    return f"(case when regexp_matches({bare}, '^[0-9]+$') then {bare} end)"


def label(x: str) -> str:
    return f"coalesce(nullif(trim({x}), ''), '<null>')"


def code(x: str) -> str:
    bare = f"regexp_replace({x}, '[\\s\\-]', '', 'g')"
    return (f"(case when regexp_matches({x}, '^[0-9]{{2}}\\.[0-9]{{2}}\\.[0-9]{{2}}$') then {x} "
            f"when regexp_matches({bare}, '^[0-9]{{6}}$') then substr({bare},1,2)||'.'||substr({bare},3,2)||'.'||substr({bare},5,2) "
            f"else {x} end)")


def code_key(x: str) -> str:
    c = code(f"trim({x})")
    return f"(case when regexp_matches({c}, '^[0-9]{{2}}\\.[0-9]{{2}}\\.[0-9]{{2}}$') then {c} end)"


EXCLUDED = "('Недействующее', 'Прекращено', 'Лишен аккредитации')"
SAME = (f"({tok('s.a_Id')} = {tok('c.r_Id')} and coalesce({tok('s.a_HeadEduOrgId')} = {tok('c.r_HeadEduOrgId')}, true))")
DIFFERENT = f"({tok('s.a_Id')} <> {tok('c.r_Id')})"
NAMED_LEVELS = ("('Начальное общее образование', 'Основное общее образование', 'Среднее общее образование', 'Дошкольное образование', "
                "'Общее образование', 'Среднее (полное) общее образование', 'Не определен')")
LEVEL_TARGET = ("case {x} when 'ВО - бакалавриат' then 'Высшее образование - бакалавриат' when 'Общее образование' then 'Основное общее образование' "
                "when 'ВО - подготовка кадров высшей квалификации' then 'Высшее образование - подготовка кадров высшей квалификации' "
                "when 'Начальное профессиональное образование' then 'Среднее профессиональное образование' "
                "when 'Профессиональное образование' then 'Среднее профессиональное образование' "
                "when 'Профессиональное обучение' then 'Среднее профессиональное образование' "
                "when 'Среднее (полное) общее образование' then 'Среднее общее образование' "
                "when 'Среднее профессиональное образование (базовая подготовка)' then 'Среднее профессиональное образование' end")
KNOWN_LEVELS = ("('ВО - бакалавриат', 'Общее образование', 'Не определен', 'Дошкольное образование', 'Начальное общее образование', "
                "'Основное общее образование', 'Среднее общее образование', 'Среднее профессиональное образование', "
                "'Высшее образование - бакалавриат', 'Высшее образование - специалитет', 'Высшее образование - магистратура', "
                "'Высшее образование - подготовка кадров высшей квалификации', 'Дополнительное профессиональное образование', "
                "'ВО - подготовка кадров высшей квалификации', 'Начальное профессиональное образование', 'Профессиональное образование', "
                "'Профессиональное обучение', 'Среднее (полное) общее образование', 'Среднее профессиональное образование (базовая подготовка)')")
OVERRIDE_OGRN, OVERRIDE_INN = "1026700630615", "6712005793"


def repair_steps(strip: bool = False) -> str:
    """``WITH`` text up to the repaired flat views.

    sup0 supplements in play; sup1 after the coherent fill (d_INN, d_OGRN); cert1 root card filled
    (rd_*); cert2 certificate ids filled (ed_*); cert3 after the override; sup3 after the shells;
    prog1 level from name; prog2 without stubs; prog3 levels mapped; sup4 with branch marks.
    """
    keep = f"where not coalesce(trim(StatusName) in {EXCLUDED}, false)" if strip else ""
    donor = lambda f: f"coalesce({digits('c.r_' + f)}, {digits('c.EduOrg' + f)})"
    e1 = lambda f: digits(f"coalesce(d_{f}, a_{f})")
    root1 = lambda f: f"coalesce(rd_{f}, r_{f})"
    cert2 = lambda f: f"coalesce(ed_{f}, EduOrg{f})"
    return V.oracle_views("cert", "sup", "prog", "dec") + f""",
sup0 as (select * from sup {keep}),
sup1 as (select s.*, case when {SAME} then 'same' when {DIFFERENT} then 'different' end as kin,
  case when ({SAME} or {DIFFERENT}) and {blank('s.a_INN')} then {donor('INN')} end as d_INN,
  case when ({SAME} or {DIFFERENT}) and {blank('s.a_OGRN')} then {donor('OGRN')} end as d_OGRN
  from sup0 s join cert c using (k)),
first1 as (select k, arg_min({e1('INN')}, i) filter (where {e1('INN')} is not null) as f_INN,
  arg_min({e1('OGRN')}, i) filter (where {e1('OGRN')} is not null) as f_OGRN from sup1 where kin = 'same' group by k),
cert1 as (select c.*, f_INN, f_OGRN,
  case when has_root and {blank('r_INN')} then coalesce(f_INN, {digits('EduOrgINN')}) end as rd_INN,
  case when has_root and {blank('r_OGRN')} then coalesce(f_OGRN, {digits('EduOrgOGRN')}) end as rd_OGRN
  from cert c left join first1 using (k)),
cert2 as (select *,
  case when has_root and {digits('EduOrgINN')} is null then coalesce(f_INN, {digits(root1('INN'))}) end as ed_INN,
  case when has_root and {digits('EduOrgOGRN')} is null then coalesce(f_OGRN, {digits(root1('OGRN'))}) end as ed_OGRN
  from cert1),
cert2k as (select *, {digits(cert2('OGRN'))} as co, {digits(root1('OGRN'))} as ro from cert2),
cert3 as (select *, case when coalesce(co <> ro, false) then false else coalesce(coalesce(co, ro) = '{OVERRIDE_OGRN}', false) end as hit,
  hit and {digits(cert2('INN'))} is null as o_cert, hit and has_root and {digits(root1('INN'))} is null as o_root,
  case when o_cert then '{OVERRIDE_INN}' else ed_INN end as e3_INN, case when o_root then '{OVERRIDE_INN}' else rd_INN end as r3_INN
  from cert2k),
final as (select *, coalesce(e3_INN, EduOrgINN) as x_INN, coalesce(ed_OGRN, EduOrgOGRN) as x_OGRN,
  coalesce(r3_INN, r_INN) as xr_INN, coalesce(rd_OGRN, r_OGRN) as xr_OGRN from cert3),
sup2 as (select s.*, s.has_card and {digits('coalesce(s.d_INN, s.a_INN)')} is null and {digits('coalesce(s.d_OGRN, s.a_OGRN)')} is null as shell,
  coalesce({digits('c.xr_INN')}, {digits('c.x_INN')}) as don_INN, coalesce({digits('c.xr_OGRN')}, {digits('c.x_OGRN')}) as don_OGRN,
  coalesce({digits('c.r_KPP')}, {digits('c.EduOrgKPP')}) as don_KPP from sup1 s join final c using (k)),
sup3 as (select *, coalesce(case when shell then don_INN end, d_INN) as d3_INN, coalesce(case when shell then don_OGRN end, d_OGRN) as d3_OGRN,
  case when shell and {blank('a_KPP')} then don_KPP end as d3_KPP from sup2),
sup4 as (select s.*, coalesce(s.IsForBranch, false) or (c.r_Id is not null and s.has_card and s.a_Id is distinct from c.r_Id) as is_branch
  from sup3 s join cert c using (k)),
prog0 as (select p.* from prog p semi join sup0 using (k, i)),
prog1 as (select *, case when {blank('EduLevelName')} and trim(ProgrammName) in {NAMED_LEVELS} then trim(ProgrammName) end as d_level from prog0),
prog1s as (select *, {code_key('ProgrammCode')} is null and {blank('ProgrammName')} and {blank('coalesce(d_level, EduLevelName)')} as stub,
  {nb('coalesce(d_level, EduLevelName)')} as lv from prog1),
prog2 as (select *, row_number() over (partition by k, i order by j) - 1 as slot from prog1s where not stub),
prog3 as (select *, coalesce(lv = 'Не определен', false) as cleared, coalesce({LEVEL_TARGET.format(x='lv')} <> lv, false) as renamed,
  case when lv = 'Не определен' then null when {LEVEL_TARGET.format(x='lv')} is not null then {LEVEL_TARGET.format(x='lv')}
    else coalesce(d_level, EduLevelName) end as level3 from prog2)
"""


DISPOSITION = (f"case when coalesce(StatusName in {EXCLUDED}, false) then 'omitted_inactive' "
               "when RegionName = 'образовательные учреждения, находящиеся за пределами Российской Федерации' then 'omitted_outside_region' "
               "else 'processed' end")
