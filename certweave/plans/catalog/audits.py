"""Audits, profiling, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from certweave import schema as S
from certweave.operators import audit as A
from certweave.operators import sampling as P
from certweave.functions import nested as N
from certweave.plans import register_view as V
from certweave.plans.catalog.jsonsql import as_is, record_json
from certweave.plans.catalog.repairs import seq
from certweave.plans.catalog.sqltext import DIFFERENT, SAME, blank, digits, label, nb, tok
from certweave.session import scratch_path
from certweave.sources import readers, sinks

_R = V.records


def audit_status(spark, sf):
    return A.audit_status(_R(spark, sf))


def audit_region(spark, sf):
    return A.audit_region(_R(spark, sf))


def status_vocab(spark, sf):
    return A.status_vocab(_R(spark, sf))


def _status_lines(spark, sf):
    """Order rows as JSON text in which a status is present, null, blank or absent."""
    rows = V.order_rows(spark, sf)
    status = ("case k % 5 when 0 then '' when 1 then '\"StatusName\":null,' when 2 then '\"StatusName\":\" \",' "
              "else '\"StatusName\":\"Действующее\",' end")
    sup = "case (k + {i}) % 4 when 0 then '{{}}' when 1 then '{{\"StatusName\":null}}' when 2 then '{{\"StatusName\":\"\"}}' else '{{\"StatusName\":\"x\"}}' end"
    text = f"'{{' || {status} || '\"Id\":\"c' || k || '\",\"Supplements\":[' || {sup.format(i=0)} || ',' || {sup.format(i=1)} || ']}}'"
    return rows.select("k", F.expr(text).alias("value"))


def null_status_records(spark, sf):
    out = A.null_status(_status_lines(spark, sf))
    return out.select("k", "root_kind", F.array_join("supplement_kinds", "|").alias("supplement_kinds"))


def audit_null_status(spark, sf):
    return A.audit_null_status(_status_lines(spark, sf))


def null_status_examples(spark, sf):
    hits = A.null_status(_status_lines(spark, sf)).where("root_kind is not null")
    return A.first_per_group(hits.select("root_kind", "k"), ["root_kind"], ["k"], 5)


def identity_counters(spark, sf):
    return A.identity_counters(_R(spark, sf))


def identity_samples(spark, sf):
    return A.identity_samples(_R(spark, sf), 10).select("field", "rank", "certificate_id")


def identity_borrowable(spark, sf):
    return A.identity_borrowable(_R(spark, sf))


def identity_issue_ids(spark, sf):
    return A.identity_issue_ids(_R(spark, sf))


def audit_branches(spark, sf):
    return A.audit_branches(_R(spark, sf))


def branch_hits(spark, sf):
    card = F.col("supplement_card")
    return A.branch_hits(_R(spark, sf)).select(
        F.col("_record_seq").alias("k"), "record_kind", "certificate_id", "supplement_index", "root_aeo_id", "supplement_aeo_id", "EduOrgINN",
        card["INN"].alias("card_inn"), card["FullName"].alias("card_name"), F.col("supplement_meta.IsForBranch").alias("for_branch"))


def branch_flags(spark, sf):
    return A.branch_flag_histogram(A.branch_hits(_R(spark, sf)))


def branch_inn_gap(spark, sf):
    return A.branch_inn_gap(_R(spark, sf)).select(
        F.col("_record_seq").alias("k"), "supplement_index", "supplement_aeo_id", "donor_inn_digits", "donor_ogrn_digits", "root_AEO_FullName")


def branch_inn_gap_without_filial(spark, sf):
    return A.branch_inn_gap(_R(spark, sf), True).select(F.col("_record_seq").alias("k"), "supplement_index", F.col("supplement_card.FullName").alias("name"))


def audit_inn_gap(spark, sf):
    return A.audit_inn_gap(A.branch_inn_gap(_R(spark, sf)))


def inn_gap_flags(spark, sf):
    return A.gap_flag_histogram(A.branch_inn_gap(_R(spark, sf)))


def level_histogram(spark, sf):
    return A.level_histogram(_R(spark, sf))


def school_subtotal(spark, sf):
    return A.school_subtotal(_R(spark, sf))


def classify_certificates(spark, sf):
    return A.classify_certificates(_R(spark, sf)).select(seq(), "certificate_class")


def empty_level_programs(spark, sf):
    return A.empty_level_programs(_R(spark, sf)).withColumnRenamed("_record_seq", "k")


def level_vocab(spark, sf):
    return A.level_vocab(_R(spark, sf))


def programs_dictionary(spark, sf):
    return A.programs_dictionary(_R(spark, sf)).drop("_derived")


def programs_dictionary_qualified(spark, sf):
    return A.programs_dictionary(_R(spark, sf), require_qualification=True).drop("_derived")


def code_sort_key(spark, sf):
    p = F.col("p")
    rows = A.program_rows(_R(spark, sf)).select(p["ProgrammCode"].alias("code")).distinct()
    return rows.withColumn("x", A.code_sort_key(F.col("code"))).select("code", "x.*")


def dictionary_invariant(spark, sf):
    r = _R(spark, sf)
    return A.dictionary_invariant(r, A.programs_dictionary(r).where("ProgrammCode <> '14.03.00'"), ["14.03.00", "03.06.01", "09.02.07"])


def scan_placeholders(spark, sf):
    return A.scan_placeholders(_R(spark, sf))


def _prop_lines(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    mark = "case event_id % 6 when 0 then '-' when 1 then '000' when 2 then 'Н/Д' when 3 then 'none' else 'x' end"
    text = f"'{{\"props\":' || props || ',\"note\":\"' || {mark} || '\",\"deep\":[{{\"a\":\"' || {mark} || '\"}}],\"_skip\":\"-\"}}'"
    return events.select("event_id", F.expr(text).alias("value"))


def scan_json_placeholders(spark, sf):
    return A.scan_json_placeholders(_prop_lines(spark, sf))


def compare_card_ids(spark, sf):
    return A.compare_card_ids(_R(spark, sf))


def differing_card_samples(spark, sf):
    return A.differing_card_samples(_R(spark, sf), [5, 20]).select("sample_size", seq(), "Id")


def differing_card_ids(spark, sf):
    return A.differing_card_ids(_R(spark, sf)).select(seq(), "Id")


def unknown_tags(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    tag = "case event_id % 4 when 0 then 'Id' when 1 then 'EduOrgINN' when 2 then 'Tag' || (event_id % 20) else 'k' end"
    lines = events.select(F.expr(f"'{{\"' || {tag} || '\":1,\"StatusName\":2}}'").alias("value"))
    return A.unknown_tags(A.json_keys(lines))


def unknown_xml_tags(spark, sf):
    """Elements written in the order of k, some with tags that the schema lacks, at several levels."""
    path = scratch_path(spark, "tags")
    rows = V.order_rows(spark, sf).repartitionByRange("k").sortWithinPartitions("k")
    rows.select(F.expr(_TAGGED).alias("value")).write.text(path)
    return A.unknown_xml_tags(readers.read_elements(spark, path))


_TAGGED = ("'<Certificate><Id>c' || k || '</Id><Supplements><Supplement><Id/>' || case when k % 7 = 2 then '<x:Odd' || (k % 5) || ' a=\"1\">1</x:Odd' || (k % 5) || '>' else '' end || "
           "'<EducationalPrograms><EducationalProgram>' || case when k % 11 = 3 then '<Deep/>' else '<Id>p</Id>' end || '</EducationalProgram></EducationalPrograms></Supplement></Supplements>' || "
           "case when k % 13 = 4 then '<Odd1/><Last><Id>1</Id><Inner/></Last>' else '' end || '</Certificate>'")
_CONFORM = ("case k % 10 when 0 then '{\"Id\":\"c' || k || '\",\"IsFederal\":true,\"Supplements\":[{\"Id\":\"s\"}]}' when 1 then '[1,2]' when 2 then '{\"IsFederal\":true}' "
            "when 3 then '{\"Id\":\"c\",\"IsFederal\":\"да\"}' when 4 then '{\"Id\":\"c\",\"Supplements\":[1]}' when 5 then 'not json' "
            "when 8 then '{\"Id\":\"c\",\"Supplements\":[{\"Id\":7,\"IsForBranch\":true,\"EducationalPrograms\":[{\"Id\":\"p\",\"ProgrammCode\":[1]},3],\"ActualEducationOrganization\":{\"INN\":5}},{\"Id\":8}]}' "
            "when 9 then '{\"Id\":\"c\",\"ActualEducationOrganization\":{\"Id\":\"a\",\"OGRN\":true},\"Decisions\":[{\"Id\":{}}]}' "
            "when 6 then '{\"Id\":\"c\",\"RegNumber\":5,\"Decisions\":{}}' else '{\"Id\":\"c\",\"Extra\":[1]}' end")


def schema_conformance(spark, sf):
    lines = V.order_rows(spark, sf).select("k", F.expr(_CONFORM).alias("value"))
    return A.schema_violations(lines).select("k", "violation")


def sample_n(spark, sf):
    return P.sample_n(spark.read.parquet(f"{sf}/customer.parquet"), 100, "c_custkey", 42).select("c_custkey", "c_name")


def sample_sizes(spark, sf):
    return P.sample_sizes(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), [5, 20, 100], "doc_id", 1000)


LEVELS = ["ВО - бакалавриат", "Общее образование", "Среднее общее образование", "Среднее профессиональное образование", "Дошкольное образование"]


def sample_per_level(spark, sf):
    return P.sample_per_level(_R(spark, sf), LEVELS, 7).withColumnRenamed("_record_seq", "k")


def sample_per_level_uniform(spark, sf):
    return P.sample_per_level(_R(spark, sf), LEVELS, 7, uniform=True).withColumnRenamed("_record_seq", "k").select("level", "k")


def fill_score(spark, sf):
    r = _R(spark, sf)
    return r.select(seq(), P.fill_score(r).alias("score"))


def first_program_of_level(spark, sf):
    x = P.first_program_of_level(F.lit("Общее образование"))
    return _R(spark, sf).select(seq(), x.alias("x")).where("x is not null").select("k", "x.*")


def sample_names(spark, sf):
    names = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_name").alias("name"))
    return P.sample_names(names, 25, 3)


def write_records(spark, sf):
    """The compact JSON text of every record."""
    return sinks.json_lines(_R(spark, sf)).select(seq(), "value")


QUERIES = {f.__name__: f for f in (
    audit_status, audit_region, status_vocab, null_status_records, audit_null_status, null_status_examples, identity_counters,
    identity_samples, identity_borrowable, identity_issue_ids, audit_branches, branch_hits, branch_flags, branch_inn_gap,
    branch_inn_gap_without_filial, audit_inn_gap, inn_gap_flags, level_histogram, school_subtotal, classify_certificates,
    empty_level_programs, level_vocab, programs_dictionary, programs_dictionary_qualified, code_sort_key, dictionary_invariant,
    scan_placeholders, scan_json_placeholders, compare_card_ids, differing_card_ids, differing_card_samples, unknown_tags, unknown_xml_tags, schema_conformance, sample_n,
    sample_sizes, sample_per_level, sample_per_level_uniform, fill_score, first_program_of_level, sample_names, write_records)}

_VIEWS = V.oracle_views("cert", "sup", "prog", "dec")
_SCHOOL = "(" + ", ".join(f"'{x}'" for x in A.SCHOOL_LEVELS) + ")"
_KIND = f"case when {tok('s.a_Id')} = {tok('c.r_Id')} then 'same_Id' when {tok('s.a_Id')} <> {tok('c.r_Id')} then 'different_Id' else 'incomparable_Id' end"
_CARDS = f""", cards as (select s.*, {_KIND} as kind, coalesce({SAME}, false) as same, coalesce({DIFFERENT}, false) as diff from sup s join cert c using (k) where s.has_card),
pl as (select c.k, p.i, p.j, {nb('p.EduLevelName')} as lv, p.k is not null as is_prog from cert c left join prog p using (k)),
cls as (select k, case when not bool_or(is_prog) then 'no_educational_programs' when count(lv) = 0 then 'all_program_levels_empty'
  when bool_or(lv in {_SCHOOL}) and bool_or(lv not in {_SCHOOL}) then 'mixed_school_and_other' when bool_or(lv in {_SCHOOL}) then 'school_levels_only'
  else 'non_school_levels_only' end as certificate_class from pl group by k),
idv as (select k, Id, 'EduOrgINN' as field, EduOrgINN as v, 0 as pos from cert union all select k, Id, 'EduOrgOGRN', EduOrgOGRN, 1 from cert
  union all select k, Id, 'root_INN', r_INN, 2 from cert union all select k, Id, 'root_OGRN', r_OGRN, 3 from cert
  union all select s.k, c.Id, 'supplement_INN', s.a_INN, 4 + s.i * 2 from cards s join cert c using (k) union all select s.k, c.Id, 'supplement_OGRN', s.a_OGRN, 5 + s.i * 2 from cards s join cert c using (k))
"""
_BASE = _VIEWS + _CARDS
_DON = {f: f"coalesce({digits('c.r_' + f)}, {digits('c.EduOrg' + f)})" for f in ("INN", "OGRN")}
_GAP = _BASE + f""", gap as (select c.k, s.i as supplement_index, s.a_Id as supplement_aeo_id, {_DON['INN']} as donor_inn_digits, {_DON['OGRN']} as donor_ogrn_digits,
  c.r_FullName as root_AEO_FullName, s.a_FullName, s.a_OGRN, s.a_HeadEduOrgId, s.IsForBranch, {digits('c.r_INN')} as rinn, {digits('c.EduOrgINN')} as einn
  from cards s join cert c using (k) where s.diff and {blank('s.a_INN')} and {_DON['INN']} is not null)
"""


def _borrow() -> str:
    out = []
    for f in ("INN", "OGRN"):
        low = f.lower()
        lacking = f"same and {blank('a_' + f)}"
        donor = f"({digits('c.r_' + f)} is not null or {digits('c.EduOrg' + f)} is not null)"
        out.append(f"(select count(*) from cards where {lacking}) as same_org_cards_missing_{low}")
        out.append(f"(select count(*) from cards s join cert c using (k) where {lacking.replace('a_', 's.a_')} and {donor}) as same_org_cards_missing_{low}_with_donor")
        giving = f"exists (select 1 from cards s where s.k = c.k and s.same and {digits('s.a_' + f)} is not null)"
        out.append(f"(select count(*) from cert c where {blank('c.r_' + f)} and ({giving} or {digits('c.EduOrg' + f)} is not null)) as root_missing_{low}_with_donor")
    return ", ".join(out)


_BAD = lambda x: f"({digits(x)} is null)"
_DICT_FIELDS = ", ".join(A.DICTIONARY_FIELDS)
_QUAL = "rtrim(regexp_replace(rtrim(Qualification), '\\.$', ''))"


def _dictionary(more: str = "") -> str:
    fields = _DICT_FIELDS.replace("Qualification", "q as Qualification")
    group = _DICT_FIELDS.replace("Qualification", "q")
    return _VIEWS + f", t as (select *, {_QUAL} as q from prog where not {blank('UGSName')}) select arg_min_null(Id, k * 100 + i * 10 + j) as Id, {fields} from t where true {more} group by {group}"


_STATUS = {"missing": "k % 5 = 0", "json_null": "k % 5 = 1", "empty_string": "k % 5 = 2"}
_SUPKIND = "case (k + {i}) % 4 when 0 then 'missing' when 1 then 'json_null' when 2 then 'empty_string' end"
_ROOTKIND = "case k % 5 when 0 then 'missing' when 1 then 'json_null' when 2 then 'empty_string' end"
_SUPS = f"{_SUPKIND.format(i=0)} as s0, {_SUPKIND.format(i=1)} as s1"


def _placeholders() -> str:
    parts = []
    for prefix, fields, src, alias in (("/", S.CERTIFICATE_FIELDS, "cert", ""), ("/ActualEducationOrganization/", S.ORGANIZATION_FIELDS, "cert", "r_"),
                                       ("/Supplements/*/", S.SUPPLEMENT_FIELDS, "sup", ""), ("/Supplements/*/ActualEducationOrganization/", S.ORGANIZATION_FIELDS, "sup", "a_"),
                                       ("/Supplements/*/EducationalPrograms/*/", S.PROGRAM_FIELDS, "prog", ""), ("/Decisions/*/", S.DECISION_FIELDS, "dec", "")):
        for f in fields:
            if f not in S.BOOL_FIELDS:
                parts.append(f"select '{prefix}{f}' as path, cast({alias}{f} as varchar) as literal from {src}")
    return " union all ".join(parts)


_CLASS = ("case when regexp_matches(literal, '^0+$') then 'only_zeros' when literal in ('-', '—', '–') then 'dash_only' "
          "when lower(literal) in ('н/д', 'нд', 'нет данных', 'null', 'none') then 'empty_marker' end")
_TOTALS = ("select cls, path, cast(sum(n) as bigint) as total, count(*) as literals, arg_min(literal, (-n, literal)) as example from "
           f"(select {_CLASS} as cls, path, literal, count(*) as n from leaves where {_CLASS} is not null group by all) group by cls, path")
_EVMARK = "case event_id % 6 when 0 then '-' when 1 then '000' when 2 then 'Н/Д' when 3 then 'none' else 'x' end"


def _score(fields, prefix="") -> str:
    return " + ".join(f"cast({prefix}{f} is not null as integer)" if f in S.BOOL_FIELDS else f"cast(coalesce(trim({prefix}{f}), '') <> '' as integer)" for f in fields)


_SCORE = f""", sc as (select c.k, cast({_score(S.CERTIFICATE_FIELDS)} + {_score(S.ORGANIZATION_FIELDS, 'r_')}
  + coalesce((select sum({_score(S.SUPPLEMENT_FIELDS, 's.')} + {_score(S.ORGANIZATION_FIELDS, 's.a_')}) from sup s where s.k = c.k), 0)
  + coalesce((select sum({_score(S.PROGRAM_FIELDS, 'p.')}) from prog p where p.k = c.k), 0)
  + coalesce((select sum({_score(S.DECISION_FIELDS, 'd.')}) from dec d where d.k = c.k), 0) as integer) as score from cert c)"""
_LV = "(" + ", ".join(f"'{x}'" for x in LEVELS) + ")"
_FOUND = f", fl as (select distinct k, trim(EduLevelName) as level from prog where trim(EduLevelName) in {_LV})"
_FIRSTP = ", ".join(f"{f}" if f in S.BOOL_FIELDS else f"case when not {blank(f)} then {f} end as {f}" for f in P.MAPPING_FIELDS[1:])
_OTHERS = "coalesce(" + ", ".join(f"cast({f} as varchar)" if f in S.BOOL_FIELDS else nb(f) for f in P.MAPPING_FIELDS[1:]) + ")"

ORACLES = {
    "audit_status": _VIEWS + f"select 'StatusName' as field, {label('StatusName')} as label, count(*) as n from cert group by all union all select 'TypeName', {label('TypeName')}, count(*) from cert group by all",
    "audit_region": _VIEWS + f"select 'RegionName' as field, {label('RegionName')} as label, count(*) as n, {label('RegionName')} like 'образовательные учреждения, находящиеся за пределами%' as outside from cert group by all",
    "status_vocab": _VIEWS + f""", t as (select 'root' as place, {label('StatusName')} as label, nullif(trim(Id), '') as cid, k * 10 as o from cert
        union all select 'supplement', {label('s.StatusName')}, nullif(trim(c.Id), ''), s.k * 10 + s.i + 1 from sup s join cert c using (k))
        select label, count(*) filter (where place = 'root') as root_count, count(*) filter (where place = 'supplement') as supplement_count,
        arg_min(cid, o) filter (where place = 'root' and cid is not null) as root_example,
        arg_min(cid, o) filter (where place = 'supplement' and cid is not null) as supplement_example from t group by label""",
    "null_status_records": V.oracle_views() + f", t as (select k, {_ROOTKIND} as root_kind, {_SUPS} from base) select k, root_kind, concat_ws('|', s0, s1) as supplement_kinds from t",
    "audit_null_status": V.oracle_views() + f""", t as (select k, {_ROOTKIND} as rk, {_SUPS} from base) select count(*) as records,
        {', '.join(f"count(*) filter (where rk = '{x}') as root_{x}" for x in _STATUS)},
        {', '.join(f"count(*) filter (where s0 = '{x}') + count(*) filter (where s1 = '{x}') as supplement_{x}" for x in _STATUS)},
        count(*) filter (where s0 is not null or s1 is not null) as records_with_supplement_hit,
        count(*) filter (where rk is not null or s0 is not null or s1 is not null) as records_with_any from t""",
    "null_status_examples": V.oracle_views() + f", t as (select {_ROOTKIND} as root_kind, k from base), r as (select *, cast(row_number() over (partition by root_kind order by k) as integer) as rank from t where root_kind is not null) select * from r where rank <= 5",
    "identity_counters": _BASE + f"""select field, count(*) as total, count(*) filter (where {blank('v')}) as missing_or_empty, count(*) filter (where not {blank('v')}) as nonempty,
        count(*) filter (where {digits('v')} is not null) as digits_only, count(*) filter (where not {blank('v')} and {digits('v')} is null) as not_digits_only,
        count(*) filter (where {blank('v')}) as would_drop_if_nonempty_required, count(*) filter (where {digits('v')} is null) as would_drop_if_digits_required from idv group by field""",
    "identity_samples": _BASE + f""", t as (select field, cast(row_number() over (partition by field order by k, pos) as integer) as rank, trim(coalesce(Id, '')) as certificate_id from idv
        where not {blank('v')} and {digits('v')} is null) select * from t where rank <= 10""",
    "identity_borrowable": _BASE + "select " + _borrow(),
    "identity_issue_ids": _BASE + f""", iss as (select k, {_BAD('a_INN')} or {_BAD('a_OGRN')} as own from cards), bad as (select k from cert where {_BAD('EduOrgINN')} or {_BAD('EduOrgOGRN')} or {_BAD('r_INN')} or {_BAD('r_OGRN')}
        union select k from iss where own) select kind as bucket, count(*) as cards, count(*) filter (where {_BAD('a_INN')} or {_BAD('a_OGRN')}) as cards_with_own_issue
        from cards where k in (select k from bad) group by kind""",
    "audit_branches": _BASE + """select (select count(*) from cert) as records, (select count(*) from cert where has_root) as with_root_card, count(distinct k) as with_supplement_card,
        count(distinct k) filter (where kind = 'different_Id') as with_branch, count(*) filter (where kind = 'same_Id') as same_id_cards,
        count(*) filter (where kind = 'different_Id') as branch_cards, count(*) filter (where kind = 'incomparable_Id') as incomparable_cards from cards""",
    "branch_hits": _BASE + """select s.k, 'branch_supplement_diff_aeo_id_v1' as record_kind, c.Id as certificate_id, s.i as supplement_index, c.r_Id as root_aeo_id, s.a_Id as supplement_aeo_id,
        c.EduOrgINN, s.a_INN as card_inn, s.a_FullName as card_name, s.IsForBranch as for_branch from cards s join cert c using (k) where s.diff""",
    "branch_flags": _BASE + "select coalesce(cast(IsForBranch as varchar), 'null') as is_for_branch, count(*) as n from cards where diff group by 1",
    "branch_inn_gap": _GAP + "select k, supplement_index, supplement_aeo_id, donor_inn_digits, donor_ogrn_digits, root_AEO_FullName from gap",
    "branch_inn_gap_without_filial": _GAP + "select k, supplement_index, a_FullName as name from gap where coalesce(lower(a_FullName) not like '%филиал%', true)",
    "audit_inn_gap": _GAP + f"""select count(*) as total, cast(0 as bigint) as wrong_kind, cast(0 as bigint) as donor_inn_mismatch,
        count(*) filter (where {blank('a_OGRN')} and donor_ogrn_digits is not null) as ogrn_missing_with_donor, count(*) filter (where {blank('a_OGRN')} and donor_ogrn_digits is null) as ogrn_missing_without_donor,
        count(*) filter (where not {blank('a_HeadEduOrgId')}) as head_id_set, count(*) filter (where rinn is not null) as inn_from_root,
        count(*) filter (where rinn is null and einn is not null) as inn_from_eduorg_only from gap""",
    "inn_gap_flags": _GAP + "select case when IsForBranch is null then '<null>' when IsForBranch then '1' else '0' end as label, count(*) as n from gap group by 1",
    "level_histogram": _VIEWS + f"select coalesce({nb('EduLevelName')}, '<пустой EduLevelName>') as level, count(*) as n, coalesce({nb('EduLevelName')}, '') in {_SCHOOL} as is_school from prog group by all",
    "school_subtotal": _VIEWS + f"select count(*) as programs, count(*) filter (where trim(EduLevelName) in {_SCHOOL}) as school_programs, count(*) filter (where {blank('EduLevelName')}) as empty_level_programs from prog",
    "classify_certificates": _BASE + "select k, certificate_class from cls",
    "empty_level_programs": _BASE + f"""select c.Id as certificate_id, c.k, certificate_class, p.i as supplement_index, s.Id as supplement_id, p.j as program_index, p.Id as program_Id,
        p.ProgrammName as program_ProgrammName, p.ProgrammCode as program_ProgrammCode from prog p join sup s using (k, i) join cert c using (k) join cls using (k) where {blank('p.EduLevelName')}""",
    "level_vocab": _VIEWS + f"select {nb('EduLevelName')} as level, count(*) as n from prog where not {blank('EduLevelName')} group by 1",
    "programs_dictionary": _dictionary(),
    "programs_dictionary_qualified": _dictionary(f"and not {blank('q')}"),
    "code_sort_key": _VIEWS + """, t as (select distinct ProgrammCode as code from prog), u as (select code, coalesce(trim(code), '') as x from t),
        w as (select *, regexp_matches(x, '^[0-9]{2}\\.[0-9]{2}\\.[0-9]{2}$') as d from u)
        select code, cast(case when x = '' then 2 when d then 0 else 1 end as integer) as rank, case when d then cast(substr(x,1,2) as integer) else 0 end as a,
        case when d then cast(substr(x,4,2) as integer) else 0 end as b, case when d then cast(substr(x,7,2) as integer) else 0 end as c, case when d then '' else x end as text from w""",
    "dictionary_invariant": _VIEWS + f"select distinct trim(ProgrammCode) as code from prog where not {blank('UGSName')} and trim(ProgrammCode) = '14.03.00'",
    "scan_placeholders": _VIEWS + f", leaves as ({_placeholders()}) {_TOTALS}",
    "scan_json_placeholders": f"with leaves as (select '/note' as path, {_EVMARK} as literal from events union all select '/deep/*/a', {_EVMARK} from events) {_TOTALS}",
    "compare_card_ids": _VIEWS + """, t as (select c.k, nullif(trim(c.r_Id), '') as rid, list(nullif(trim(s.a_Id), '')) filter (where nullif(trim(s.a_Id), '') is not null) as ids from cert c left join sup s using (k) group by all),
        u as (select rid, coalesce(len(ids), 0) as n, len(list_distinct(ids)) as dn, len(list_filter(ids, lambda x: x <> rid)) as off from t)
        select count(*) as records, count(rid) as with_root_id, count(*) filter (where n > 0) as with_supplement_id, count(*) filter (where rid is not null and n > 0) as both_present,
        count(*) filter (where rid is not null and n > 0 and off = 0) as all_match_root, count(*) filter (where rid is not null and n > 0 and off > 0) as mismatch_root,
        count(*) filter (where rid is null and n > 0) as no_root, count(*) filter (where rid is null and n > 0 and dn = 1) as no_root_all_same,
        count(*) filter (where rid is null and n > 0 and dn > 1) as no_root_differ from u""",
    "differing_card_ids": _VIEWS + """, t as (select c.k, c.Id, nullif(trim(c.r_Id), '') as rid, nullif(trim(s.a_Id), '') as aid from cert c join sup s using (k) where nullif(trim(s.a_Id), '') is not null)
        select k, Id from t group by k, Id having case when max(rid) is not null then bool_or(aid <> rid) else count(distinct aid) > 1 end""",
    "differing_card_samples": _VIEWS + """, t as (select c.k, c.Id, nullif(trim(c.r_Id), '') as rid, nullif(trim(s.a_Id), '') as aid from cert c join sup s using (k) where nullif(trim(s.a_Id), '') is not null),
        f as (select k, Id, row_number() over (order by k) as n from (select k, Id from t group by k, Id having case when max(rid) is not null then bool_or(aid <> rid) else count(distinct aid) > 1 end))
        select cast(s.n as integer) as sample_size, k, Id from f join (values (5), (20)) s(n) on f.n <= s.n""",
    "unknown_tags": "select distinct case event_id % 4 when 2 then 'Tag'||(event_id % 20) else 'k' end as tag from events where event_id % 4 >= 2",
    "schema_conformance": V.oracle_views() + """, v(m, violation) as (values (1, 'not_an_object'), (2, 'no_Id'), (3, 'type_of_IsFederal'), (4, 'type_of_Supplements'), (5, 'not_an_object'), (6, 'type_of_RegNumber'), (6, 'type_of_Decisions'),
            (8, 'type_of_Supplements.Id'), (8, 'type_of_Supplements.EducationalPrograms'), (8, 'type_of_Supplements.EducationalPrograms.ProgrammCode'),
            (8, 'type_of_Supplements.ActualEducationOrganization.INN'), (9, 'type_of_ActualEducationOrganization.OGRN'), (9, 'type_of_Decisions.Id'))
        select k, violation from base join v on k % 10 = m""",
    "sample_n": "select c_custkey, c_name from customer order by md5('42|'||c_custkey), c_custkey limit 100",
    "sample_sizes": " union all ".join(f"select * from (select doc_id, lang, {n} as sample_size from documents order by md5('{1000 + n}|'||doc_id), doc_id limit {n}) s{n}" for n in (5, 20, 100)),
    "sample_per_level": _VIEWS + _SCORE + _FOUND + """, r as (select level, k, score, row_number() over (partition by level order by score desc, md5('7|'||level||'|'||k), k) as rn from fl join sc using (k))
        select level, k, score from r where rn = 1""",
    "sample_per_level_uniform": _VIEWS + _FOUND + ", r as (select level, k, row_number() over (partition by level order by md5('7|'||level||'|'||k), k) as rn from fl) select level, k from r where rn = 1",
    "fill_score": _VIEWS + _SCORE + " select * from sc",
    "first_program_of_level": _VIEWS + f""", r as (select *, row_number() over (partition by k order by i, j) as rn from prog where trim(EduLevelName) = 'Общее образование')
        select k, case when {_OTHERS} is null then EduLevelName end as EduLevelName, {_FIRSTP} from r where rn = 1""",
    "sample_names": "select name from (select distinct p_name as name from part) t order by md5('3|'||name), name limit 25",
}
_KEYS = _score(S.CERTIFICATE_FIELDS, "c.")
ORACLES["write_records"] = _VIEWS + record_json(as_is) + " select k, value from whole"

ORACLES["unknown_xml_tags"] = V.oracle_views() + """, t as (select k, 1 as place, 'Odd'||(k % 5) as tag, 'Certificate/Supplements/Supplement/Odd'||(k % 5) as path from base where k % 7 = 2
    union all select k, 2, 'Deep', 'Certificate/Supplements/Supplement/EducationalPrograms/EducationalProgram/Deep' from base where k % 11 = 3
    union all select k, 3, unnest(['Odd1', 'Last', 'Inner']), unnest(['Certificate/Odd1', 'Certificate/Last', 'Certificate/Last/Inner']) from base where k % 13 = 4)
    select tag, arg_min(path, k * 10 + place) as path from t group by tag"""
