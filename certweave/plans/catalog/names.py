"""Organisation names and dictionaries of suggested names."""

from __future__ import annotations

from pyspark.sql import functions as F

from certweave.functions import orgnames as O
from certweave.operators import names as D
from certweave.plans import register_view as V
from certweave.plans.catalog import namesql
from certweave.plans.catalog.sqltext import blank


def name_fields(spark, sf):
    return D.name_fields(V.records(spark, sf)).withColumnRenamed("_record_seq", "k")


def _texts(spark, sf):
    """Register names with odd typography, and whole document texts."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", F.expr("'«' || substr(text, 1, 5) || '» „' || text || '“ № ' || doc_id || ' –№5'").alias("t"))


def quotes_to_ascii(spark, sf):
    return _texts(spark, sf).select("doc_id", O.quotes_to_ascii(F.col("t")).alias("value"))


def trim_in_quotes(spark, sf):
    q = F.concat(F.lit('" '), F.substring("text", 1, 40), F.lit('  " x "'), F.col("text"), F.lit(' "'))
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", O.trim_in_quotes(q).alias("value"))


def strip_double_quotes(spark, sf):
    q = F.concat(F.lit('""'), F.replace(F.col("text"), F.lit(" "), F.lit('"" ""')), F.lit('"""'))
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", O.strip_double_quotes(q).alias("value"))


def dash_number_space(spark, sf):
    return _texts(spark, sf).select("doc_id", O.number_sign_spacing(O.dashes_to_hyphen(F.col("t"))).alias("value"))


def mask_numbers(spark, sf):
    return _texts(spark, sf).select("doc_id", O.mask_numbers(F.col("t")).alias("value"))


def _distinct(spark, sf):
    return D.name_fields(V.records(spark, sf)).select("name").distinct()


def legal_form_prefix(spark, sf):
    n = F.col("name")
    return _distinct(spark, sf).withColumn("hit", O.legal_form_prefix(n)).select("name", "hit.form", "hit.rest")


def split_name_tail(spark, sf):
    return _distinct(spark, sf).withColumn("p", O.split_name_tail(F.col("name"))).select("name", F.col("p.name").alias("head"), "p.tail")


def caps_kind(spark, sf):
    return _distinct(spark, sf).select("name", O.caps_kind(F.col("name")).alias("kind"))


def title_case(spark, sf):
    return _distinct(spark, sf).select("name", O.title_case(F.col("name")).alias("shown"))


def initials_spacing(spark, sf):
    return _distinct(spark, sf).select("name", O.initials_spacing(F.col("name")).alias("value"))


def normalize_display_name(spark, sf):
    return D.normalized_names(D.name_fields(V.records(spark, sf))).select("name", "display_name")


def name_fingerprint(spark, sf):
    return D.normalized_names(D.name_fields(V.records(spark, sf))).select("name", "fingerprint")


def name_changed(spark, sf):
    return D.normalized_names(D.name_fields(V.records(spark, sf))).groupBy("changed").agg(F.count(F.lit(1)).alias("n"))


def normalize_names_in_record(spark, sf):
    return D.change_counts(D.name_fields(V.records(spark, sf)))


def normalized_records(spark, sf):
    """Records with their names rewritten, as a row of the names."""
    done = D.normalize_in_records(V.records(spark, sf))
    card = lambda s: F.array(s["ActualEducationOrganization"]["FullName"], s["ActualEducationOrganization"]["ShortName"])
    cards = F.transform(F.flatten(F.transform("Supplements", card)), lambda x: F.coalesce(x, F.lit("-")))
    return done.select(F.col("_record_seq").alias("k"), F.col("EduOrgFullName").alias("full_name"), F.col("EduOrgShortName").alias("short_name"),
                       F.col("ActualEducationOrganization.FullName").alias("root_full"), F.col("ActualEducationOrganization.ShortName").alias("root_short"),
                       F.array_join(cards, "|").alias("cards"))


def collect_unique_names(spark, sf):
    return D.collect_unique_names(D.name_fields(V.records(spark, sf)), "full")


def collect_first_names(spark, sf):
    return D.collect_unique_names(D.name_fields(V.records(spark, sf)), "short", limit=50)


# Dictionaries over part: the raw name is a part name in varying case, so keys repeat a lot.
_RAW = "case when p_partkey % 3 = 0 then upper(p_name) else p_name end || ' №' || (p_partkey % 200)"


def _flat(spark, sf, suggestion: str, where: str = "true"):
    part = spark.read.parquet(f"{sf}/part.parquet").where(where)
    return part.select(F.expr(_RAW).alias("raw"), F.expr(suggestion).alias("suggested_display"),
                       F.expr("case when p_partkey % 4 = 0 then ' ' else 'because ' || p_brand end").alias("reason_short"),
                       F.expr("case when p_partkey % 5 = 0 then 'orig ' || p_name end").alias("original_raw"), F.col("p_partkey").alias("seq"))


_SA = "case when p_partkey % 7 = 0 then null else 'A ' || (p_partkey % 50) end"
_SB = "case when p_partkey % 8 = 0 then 'A ' || (p_partkey % 50) else 'B ' || (p_partkey % 40) end"
_SC = "case p_partkey % 3 when 0 then 'A ' || (p_partkey % 50) when 1 then 'C' else 'B ' || (p_partkey % 40) end"
_WA, _WB, _WC = "p_partkey % 10 < 7", "p_partkey % 10 > 2", "p_partkey % 10 <> 5"


def merge_dictionary(spark, sf):
    existing = D.lift_flat_entries(_flat(spark, sf, _SA, _WA), "m1")
    merged = D.merge_dictionary(existing, _flat(spark, sf, _SB, _WB), "m2")
    m = F.col("by_model")
    pick = lambda k, f: F.try_element_at(m, F.lit(k))[f]
    return merged.select("key", "raw", "original_raw", pick("m1", "suggested_display").alias("m1"), pick("m2", "suggested_display").alias("m2"),
                         pick("m1", "reason_short").alias("r1"), pick("m2", "reason_short").alias("r2"), "place.is_new", "place.seq")


def names_done(spark, sf):
    return D.names_done(D.lift_flat_entries(_flat(spark, sf, _SA, _WA), "m1"), "m1", mask=True)


def names_missing(spark, sf):
    return D.names_missing(D.lift_flat_entries(_flat(spark, sf, _SA, _WA), "m1"), "m1")


def names_to_ask(spark, sf):
    names = _flat(spark, sf, _SB, _WB).select(F.col("raw").alias("name")).distinct()
    return D.names_to_ask(names, D.lift_flat_entries(_flat(spark, sf, _SA, _WA), "m1"), "m1")


def align_batch(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    batch, pos = F.expr("p_partkey div 20").alias("batch"), F.expr("p_partkey % 20").alias("pos")
    sent = part.select(batch, pos, F.expr("'n' || p_partkey").alias("sent"), F.expr("case when p_partkey % 2 = 0 then 'n' || p_partkey else p_name end").alias("original"))
    answers = part.where("p_partkey % 11 <> 0").select(
        batch, pos, F.expr("case p_partkey % 6 when 0 then 'n' || (p_partkey + 1) when 1 then 'other' when 2 then null else 'n' || p_partkey end").alias("raw"),
        F.expr("case when p_partkey % 9 = 0 then null else 'S ' || p_partkey end").alias("suggested_display"), F.col("p_brand").alias("reason_short"))
    return D.align_batch(sent, answers)


def _three(spark, sf):
    return [D.keyed_suggestions(D.lift_flat_entries(_flat(spark, sf, s, w), "m"), None) for s, w in ((_SA, _WA), (_SB, _WB), (_SC, _WC))]


def diff_pairwise(spark, sf):
    a, _, c = _three(spark, sf)
    return D.diff_pairwise(a, c)


def diff_samples(spark, sf):
    a, _, c = _three(spark, sf)
    return D.diff_samples(a, c, 10).select("relation", "rank", "key", "suggested_a", "suggested_b")


def triple_samples(spark, sf):
    return D.triple_samples(*_three(spark, sf), 10)


def diff_triple(spark, sf):
    return D.diff_triple(*_three(spark, sf))


QUERIES = {f.__name__: f for f in (
    name_fields, quotes_to_ascii, trim_in_quotes, strip_double_quotes, dash_number_space, mask_numbers, legal_form_prefix, split_name_tail,
    caps_kind, title_case, initials_spacing, normalize_display_name, name_fingerprint, name_changed, normalize_names_in_record, normalized_records,
    collect_unique_names, collect_first_names, merge_dictionary, names_done, names_missing, names_to_ask, align_batch, diff_pairwise,
    diff_samples, triple_samples, diff_triple)}

_T = "with t as (select doc_id, '«'||substr(text, 1, 5)||'» „'||text||'“ № '||doc_id||' –№5' as t from documents) "
_WS = "[\\s\\p{Z}\\x{85}\\x0b\\x{1c}-\\x{1f}]"
_NAMES = V.oracle_views("cert", "sup") + f""", nf as (
  select k, 0 as o, Id, 'Certificate.EduOrgFullName' as field, EduOrgFullName as name from cert union all select k, 1, Id, 'Certificate.EduOrgShortName', EduOrgShortName from cert
  union all select k, 2, Id, 'root_ActualEducationOrganization.FullName', r_FullName from cert union all select k, 3, Id, 'root_ActualEducationOrganization.ShortName', r_ShortName from cert
  union all select s.k, 4 + s.i * 2, c.Id, 'supplement_ActualEducationOrganization.FullName', s.a_FullName from sup s join cert c using (k)
  union all select s.k, 5 + s.i * 2, c.Id, 'supplement_ActualEducationOrganization.ShortName', s.a_ShortName from sup s join cert c using (k)),
nz as (select *, cast(row_number() over (partition by k order by o) - 1 as integer) as pos from nf where not {blank('name')}), dn as (select distinct name from nz)
"""


def _alt(forms) -> str:
    return "(?i)^(" + "|".join(sorted(forms, key=len, reverse=True)) + ")(\\s|$)"


_AB, _FN = _alt(O.FORM_ABBREVIATIONS), _alt(O.FORM_NAMES)
_TAIL = "(?i)\\s+(филиал([^\\p{L}\\p{N}_]|$)|структурн[\\p{L}]*\\s+подразделен|представительств|обособленн[\\p{L}]+\\s+подразделен)"
_FNAMES = "case lower(regexp_extract(name, '{r}', 1)) ".format(r=_FN) + " ".join(f"when '{f.lower()}' then '{f}'" for f in O.FORM_NAMES) + " end"


def _dict(suggestion: str, where: str) -> str:
    return (f"select {_RAW} as raw, {suggestion} as sd, case when p_partkey % 4 = 0 then null else 'because '||p_brand end as rs, "
            f"case when p_partkey % 5 = 0 then 'orig '||p_name end as original_raw, p_partkey as seq from part where {where}")


_DICTS = (f"with a as ({_dict(_SA, _WA)}), b as ({_dict(_SB, _WB)}), c as ({_dict(_SC, _WC)}), "
          + ", ".join(f"k{x} as (select lower(raw) as key, arg_max(struct_pack(r := raw, s := sd), seq) as v from {x} group by 1)" for x in "abc"))
_PAIR = _DICTS + """, p as (select coalesce(x.key, y.key) as key, x.v.r as ra, y.v.r as rb, x.v.s as sa, y.v.s as sb from ka x full join kc y on x.key = y.key),
q as (select *, case when rb is null then 'only_a' when ra is null then 'only_b' when sa = sb then 'same' else 'different' end as relation from p) """

_UNWRAPPED = "'\"\"'||replace(text, ' ', '\"\" \"\"')||'\"\"\"'"
for _ in range(6):  # the texts are stable after two passes
    _UNWRAPPED = f"regexp_replace({_UNWRAPPED}, '\"\"([^\"]*?)\"\"', '\\1', 'g')"

_SHOWN = _NAMES + ", " + namesql.displayed("dn", _AB, _FN, _FNAMES, _TAIL) + " "
_KINDS = _NAMES + ", nt as (select name as t from dn), " + namesql.kinds("nt", "kd") + " "

ORACLES = {
    "caps_kind": _NAMES + ", nt as (select name as t from dn), " + namesql.kinds("nt", "kd").replace(namesql.initials_spacing("t"), "t") + " select t as name, kind from kd",
    "initials_spacing": _NAMES + f"select name, {namesql.initials_spacing('name')} as value from dn",
    "title_case": _KINDS + f"select t as name, {namesql.title('x', 'true')} as shown from kd",
    "normalize_display_name": _SHOWN + "select name, display_name from shown",
    "name_fingerprint": _SHOWN + f"select name, lower({namesql.collapse("replace(display_name, '\"', '')")}) as fingerprint from shown",
    "name_changed": _SHOWN + f"select display_name <> {namesql.collapse('name')} as changed, count(*) as n from shown group by 1",
    "normalize_names_in_record": _SHOWN + "select field, count(*) as n from nz join shown using (name) where display_name <> name group by 1",
    "normalized_records": _SHOWN + """, n as (select k, field, o, coalesce(s.display_name, nf.name) as v from nf left join shown s using (name))
        select k, max(v) filter (where o = 0) as full_name, max(v) filter (where o = 1) as short_name, max(v) filter (where o = 2) as root_full, max(v) filter (where o = 3) as root_short,
        coalesce(string_agg(coalesce(v, '-'), '|' order by o) filter (where o >= 4), '') as cards from n group by k""",
    "strip_double_quotes": f"select doc_id, regexp_replace({_UNWRAPPED}, '\"\"+', '', 'g') as value from documents",
    "name_fields": _NAMES + "select Id, k, pos, field, name from nz",
    "quotes_to_ascii": _T + "select doc_id, translate(t, '“”„«»‘’', '\"\"\"\"\"''''') as value from t",
    "trim_in_quotes": f"""select doc_id, regexp_replace('" '||substr(text, 1, 40)||'  " x "'||text||' "', '"{_WS}*([^"]*?){_WS}*"', '"\\1"', 'g') as value from documents""",
    "dash_number_space": _T + f"select doc_id, regexp_replace(translate(t, '–—', '--'), '№{_WS}*([0-9])', '№ \\1', 'g') as value from t",
    "mask_numbers": _T + f"""select doc_id, trim(regexp_replace(regexp_replace(trim(regexp_replace(t, '{_WS}+', ' ', 'g')), '№+\\s*[0-9]+', '№ ⟨N⟩', 'g'), '{_WS}+', ' ', 'g')) as value from t""",
    "legal_form_prefix": _NAMES + f"""select name, case when regexp_matches(name, '{_AB}') then upper(regexp_extract(name, '{_AB}', 1)) when regexp_matches(name, '{_FN}') then {_FNAMES} end as form,
        case when regexp_matches(name, '{_AB}') then ltrim(substr(name, length(regexp_extract(name, '{_AB}', 1)) + 1))
        when regexp_matches(name, '{_FN}') then ltrim(substr(name, length(regexp_extract(name, '{_FN}', 1)) + 1)) end as rest from dn""",
    "split_name_tail": _NAMES + f"""select name, case when regexp_matches(trim(name), '{_TAIL}') then trim(regexp_extract(trim(name), '^(.*?){_TAIL}', 1)) else trim(name) end as head,
        case when regexp_matches(trim(name), '{_TAIL}') then trim(substr(trim(name), length(regexp_extract(trim(name), '^(.*?){_TAIL}', 1)) + 1)) else '' end as tail from dn""",
    "collect_unique_names": _NAMES + "select distinct trim(name) as name from nz where field like '%FullName'",
    "collect_first_names": _NAMES + "select name from (select trim(name) as name, min(k * 100 + pos) as o from nz where field like '%ShortName' group by 1) order by o limit 50",
    "merge_dictionary": _DICTS + """, e as (select lower(raw) as key, arg_min(struct_pack(r := raw, o := original_raw, s := sd, rs := rs), seq) as e, min(seq) as q from a group by 1),
        n as (select lower(raw) as key, arg_min(raw, seq) as r, arg_min(original_raw, seq) filter (where original_raw is not null) as o, arg_max(struct_pack(s := sd, rs := rs), seq) as v, min(seq) as q from b group by 1)
        select coalesce(e.key, n.key) as key, coalesce(e.e.r, n.r) as raw, coalesce(e.e.o, n.o) as original_raw, e.e.s as m1, n.v.s as m2,
        case when e.e.s is not null then e.e.rs end as r1, n.v.rs as r2, e.q is null as is_new, coalesce(e.q, n.q) as seq from e full join n on e.key = n.key""",
    "names_done": _DICTS + " select distinct lower(regexp_replace(raw, '№+\\s*[0-9]+', '№ ⟨N⟩', 'g')) as key from a where sd is not null",
    "names_missing": _DICTS + " select raw from a where sd is null",
    "names_to_ask": _DICTS + " select distinct raw as name from b where lower(raw) not in (select lower(raw) from a where sd is not null)",
    "align_batch": """with s as (select p_partkey // 20 as batch, p_partkey % 20 as pos, 'n'||p_partkey as sent, case when p_partkey % 2 = 0 then 'n'||p_partkey else p_name end as original from part),
        a as (select p_partkey // 20 as batch, p_partkey % 20 as pos, case p_partkey % 6 when 0 then 'n'||(p_partkey + 1) when 1 then 'other' when 2 then null else 'n'||p_partkey end as raw,
          case when p_partkey % 9 = 0 then null else 'S '||p_partkey end as sd, p_brand as rs from part where p_partkey % 11 <> 0),
        r as (select batch, raw, arg_max(struct_pack(raw := raw, sd := sd, rs := rs), pos) as v from a where raw is not null group by 1, 2),
        j as (select s.*, coalesce(r.v, case when a.batch is not null then struct_pack(raw := a.raw, sd := a.sd, rs := a.rs) end) as v from s left join r on r.batch = s.batch and r.raw = s.sent left join a on a.batch = s.batch and a.pos = s.pos)
        select batch, pos, v.raw as raw, v.sd as suggested_display, v.rs as reason_short, case when original <> sent then original end as original_raw from j where v.raw is not null and v.sd is not null""",
    "diff_pairwise": _PAIR + """select count(*) filter (where relation <> 'only_b') as entries_a, count(*) filter (where relation <> 'only_a') as entries_b, count(*) filter (where relation = 'only_a') as only_in_a,
        count(*) filter (where relation = 'only_b') as only_in_b, count(*) filter (where relation in ('same', 'different')) as common_raw, count(*) filter (where relation = 'same') as common_same,
        count(*) filter (where relation = 'different') as common_different from q""",
    "diff_samples": _PAIR + ", r as (select *, cast(row_number() over (partition by relation order by key) as integer) as rank from q where relation <> 'same') select relation, rank, key, sa as suggested_a, sb as suggested_b from r where rank <= 10",
    "triple_samples": _DICTS + """, t as (select x.key, x.v.s as sa, y.v.s as sb, z.v.s as sc from ka x join kb y on x.key = y.key join kc z on x.key = z.key),
        r as (select *, case when sa <> sb and sa <> sc and sb <> sc then 'all_different' when sa = sb and sb <> sc then 'a_equals_b_not_c' end as relation from t),
        n as (select *, cast(row_number() over (partition by relation order by key) as integer) as rank from r where relation is not null)
        select key, sa as suggested_a, sb as suggested_b, sc as suggested_c, relation, rank from n where rank <= 10""",
    "diff_triple": _DICTS + """, t as (select x.v.s as sa, y.v.s as sb, z.v.s as sc from ka x join kb y on x.key = y.key join kc z on x.key = z.key), f as (select *, sa is not null and sb is not null and sc is not null as ok from t)
        select count(*) as keys_in_all_three, count(*) filter (where ok and sa = sb and sb = sc) as all_same, count(*) filter (where ok and sa = sb and sb <> sc) as a_equals_b_not_c,
        count(*) filter (where ok and sa = sc and sa <> sb) as a_equals_c_not_b, count(*) filter (where ok and sb = sc and sa <> sb) as b_equals_c_not_a,
        count(*) filter (where ok and sa <> sb and sa <> sc and sb <> sc) as all_different from f""",
}
