"""Scalar rules over text columns of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certweave.functions import text as X
from certweave.plans import register_view as V
from certweave.plans.catalog.sqltext import code, code_key, digits

BOOL = "case k % 9 when 0 then '1' when 1 then ' 0 ' when 2 then 'Да' when 3 then 'НЕТ' when 4 then 'true' when 5 then 'возможно' when 6 then '' when 7 then null else 'y' end"
DATE = ("case k % 13 when 0 then d when 1 then d||'T10:00:00+03:00' when 2 then d||' 00:00:00+04' when 3 then d||' 10:00:00.123+0300' "
        "when 4 then substr(d,9,2)||'.'||substr(d,6,2)||'.'||substr(d,1,4) when 5 then substr(d,9,2)||'/'||substr(d,6,2)||'/'||substr(d,1,4) "
        "when 6 then substr(d,9,2)||'-'||substr(d,6,2)||'-'||substr(d,1,4) when 7 then 'вчера' when 8 then d||'Z' when 9 then '31.02.2020' "
        "when 10 then '  '||d||' ' when 11 then null else '1.2.2019' end")
IDNUM = "case k % 6 when 0 then '00'||k when 1 then '7 200 '||k when 2 then '7200-'||k when 3 then '12-3X4' when 4 then ' ' else null end"
CODE = "case k % 8 when 0 then '0'||(k % 10)||'1501' when 1 then '03 15 0'||(k % 10) when 2 then '03-15-0'||(k % 10) when 3 then '12345' when 4 then 'спецкод' when 5 then '09.02.0'||(k % 10) when 6 then '--' else null end"
MARK = "case k % 12 when 0 then '-' when 1 then '—' when 2 then 'Н/Д' when 3 then 'нет данных' when 4 then 'NULL' when 5 then ' a  b ' when 6 then '' when 7 then null when 8 then '000' when 9 then 'нд' when 10 then '0' else 'значение '||k end"
QUAL = "case k % 7 when 0 then 'Бакалавр. ' when 1 then 'Юрист . ' when 2 then 'Юрист' when 3 then '..' when 4 then ' ' when 5 then null else 'Специалист'||k||'.' end"

BASE = V.oracle_views()


def _rows(spark, sf: str, rule: str, name: str = "raw") -> DataFrame:
    return V.order_rows(spark, sf).select("k", F.expr(f"cast(({rule}) as string)").alias(name))


def clean_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    dirty = F.concat(F.expr("chr(160)"), F.replace(F.col("text"), F.lit(" "), F.expr("concat(chr(160), ' ')")), F.expr("chr(7)"))
    return docs.select("doc_id", X.clean_text(dirty).alias("cleaned"))


def clean_markers(spark, sf):
    return _rows(spark, sf, MARK).select("k", X.clean_text(F.col("raw")).alias("cleaned"))


def clean_conversations(spark, sf):
    t = spark.read.parquet(f"{sf}/conversations.parquet")
    return t.select("conv_id", "turn", "role", X.clean_text(F.col("text")).alias("cleaned"))


def cast_bool(spark, sf):
    r = F.col("raw")
    return _rows(spark, sf, BOOL).select("k", X.cast_bool(r).alias("value"), X.is_bad_bool(r).alias("bad"))


def strip_timezone(spark, sf):
    return _rows(spark, sf, DATE).select("k", X.strip_timezone(F.col("raw")).alias("value"))


def parse_date(spark, sf):
    r = F.col("raw")
    return _rows(spark, sf, DATE).select("k", X.parse_date(r).alias("value"), F.coalesce(X.is_bad_date(r), F.lit(False)).alias("bad"))


def cast_id_number(spark, sf):
    r = F.col("raw")
    return _rows(spark, sf, IDNUM).select("k", X.cast_id_number(r).alias("value"), X.is_bad_id_number(r).alias("bad"))


def digits_only(spark, sf):
    rec = V.records(spark, sf)
    return rec.select(F.col("_record_seq").alias("k"), X.digits_only(F.col("EduOrgINN")).alias("inn"), X.digits_only(F.col("EduOrgOGRN")).alias("ogrn"))


def normalize_triplet_code(spark, sf):
    return _rows(spark, sf, CODE).select("k", X.triplet_code(F.col("raw")).alias("value"))


def programm_code_key(spark, sf):
    return _rows(spark, sf, CODE).select("k", X.programm_code_key(F.col("raw")).alias("value"))


def normalize_scalar(spark, sf):
    rules = {"IsFederal": BOOL, "IssueDate": DATE, "INN": IDNUM, "UGSCode": CODE, "Note": MARK, "Qualification": MARK}
    rows = V.order_rows(spark, sf).select("k", *[F.expr(f"cast(({r}) as string)").alias(f) for f, r in rules.items()])
    return rows.select("k", *[X.normalize_scalar(f, F.col(f)).alias(f.lower()) for f in rules])


def uid_token(spark, sf):
    return _rows(spark, sf, "case k % 4 when 0 then ' AEO-'||k||' ' when 1 then '  ' when 2 then null else 'Id'||k end").select(
        "k", X.uid_token(F.col("raw")).alias("value"))


def json_safe(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", X.json_safe(F.concat(F.expr("chr(7)"), F.replace(F.col("text"), F.lit("e"), F.expr("concat(chr(1), 'e')")))).alias("value"))


def classify_placeholder(spark, sf):
    return _rows(spark, sf, MARK).select("k", X.classify_placeholder(F.col("raw")).alias("cls"))


def null_label(spark, sf):
    return _rows(spark, sf, MARK).select("k", X.null_label(F.col("raw")).alias("label"))


def meta_label(spark, sf):
    rows = V.order_rows(spark, sf).select(
        "k", F.expr(f"cast(({MARK}) as string)").alias("t"), F.expr("case when k % 3 = 0 then null else k % 2 = 0 end").alias("b"),
        F.expr("case when k % 5 = 0 then null else cast(k as double) / 2 end").alias("n"))
    return rows.select("k", X.meta_label_text(F.col("t")).alias("text_label"), X.meta_label_bool(F.col("b")).alias("bool_label"),
                       X.meta_label_number(F.col("n")).alias("number_label"))


def canonical_qualification(spark, sf):
    return _rows(spark, sf, QUAL).select("k", X.canonical_qualification(F.col("raw")).alias("value"))


QUERIES = {f.__name__: f for f in (
    clean_text, clean_markers, clean_conversations, cast_bool, strip_timezone, parse_date, cast_id_number, digits_only,
    normalize_triplet_code, programm_code_key, normalize_scalar, uid_token, json_safe, classify_placeholder, null_label,
    meta_label, canonical_qualification)}

MARKERS = "('', '-', '—', '–', 'н/д', 'нд', 'нет данных', 'null', 'none')"
TRUE, FALSE = "('1', 'true', 'да', 'y', 'yes')", "('0', 'false', 'нет', 'n', 'no')"
CONTROLS = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f\\x{80}-\\x{9f}]"


def _clean(x: str) -> str:
    y = f"regexp_replace({x}, '[\\x{{A0}}\\x{{202F}}\\x{{2007}}\\x{{200B}}\\x{{FEFF}}]', ' ', 'g')"
    y = f"regexp_replace({y}, '{CONTROLS}', '', 'g')"
    y = f"trim(regexp_replace({y}, '[\\s\\p{{Z}}]+', ' ', 'g'))"
    return f"(case when lower({y}) not in {MARKERS} then {y} end)"


def _bool(x: str) -> str:
    return f"(case when lower(trim({x})) in {TRUE} then true when lower(trim({x})) in {FALSE} then false end)"


def _no_zone(x: str) -> str:
    y = f"trim(regexp_replace({x}, '(?i)(Z|[+-][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}})?)$', ''))"
    return f"(case when {y} like '%:%' then rtrim(regexp_replace({y}, '[+-]([0-9]{{4}}|[0-9]{{2}})$', '')) else {y} end)"


def _date_parts(x: str) -> tuple[str, str]:
    fraction = "([0-9]{2}:[0-9]{2}(:[0-9]{2})?)\\.[0-9]+"
    y = _no_zone(f"regexp_replace(nullif(trim({x}), ''), '{fraction}', '\\1', 'g')")
    iso = (f"strftime(try_strptime({y}, ['%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%d.%m.%Y', '%d/%m/%Y', '%d-%m-%Y']), '%Y-%m-%d')")
    return y, iso


def _date(x: str) -> str:
    y, iso = _date_parts(x)
    return f"coalesce({iso}, {y})"


_Y, _ISO = _date_parts("raw")


def _from(rule: str) -> str:
    return f"{BASE}, t as (select k, cast(({rule}) as varchar) as raw from base) "


_DIRTY = "chr(160)||replace(text, ' ', chr(160)||' ')||chr(7)"
_BARE = "regexp_replace(raw, '[\\s\\-]', '', 'g')"
ORACLES = {
    "clean_text": f"select doc_id, {_clean(_DIRTY)} as cleaned from documents",
    "clean_markers": _from(MARK) + f"select k, {_clean('raw')} as cleaned from t",
    "clean_conversations": f"select conv_id, turn, role, {_clean('text')} as cleaned from conversations",
    "cast_bool": _from(BOOL) + f"select k, {_bool('raw')} as value, raw is not null and {_bool('raw')} is null as bad from t",
    "strip_timezone": _from(DATE) + f"select k, {_no_zone('raw')} as value from t",
    "parse_date": _from(DATE) + f"select k, coalesce({_ISO}, {_Y}) as value, {_Y} is not null and {_ISO} is null as bad from t",
    "cast_id_number": _from(IDNUM) + f"select k, {digits('raw')} as value, coalesce({_BARE} <> '', false) and {digits('raw')} is null as bad from t",
    "digits_only": V.oracle_views("cert") + f" select k, {digits('EduOrgINN')} as inn, {digits('EduOrgOGRN')} as ogrn from cert",
    "normalize_triplet_code": _from(CODE) + f"select k, {code('raw')} as value from t",
    "programm_code_key": _from(CODE) + f"select k, {code_key('raw')} as value from t",
    "normalize_scalar": BASE + f""", t as (select k, {_clean(f'({BOOL})')} as b, {_clean(f'({DATE})')} as d1, {_clean(f'({IDNUM})')} as n,
        {_clean(f'({CODE})')} as u, {_clean(f'({MARK})')} as m from base)
        select k, {_bool('b')} as isfederal, {_date('d1')} as issuedate, {digits('n')} as inn, {code('u')} as ugscode, m as note,
        nullif(m, '0') as qualification from t""",
    "uid_token": _from("case k % 4 when 0 then ' AEO-'||k||' ' when 1 then '  ' when 2 then null else 'Id'||k end")
        + "select k, lower(nullif(trim(raw), '')) as value from t",
    "json_safe": f"select doc_id, regexp_replace(chr(7)||replace(text, 'e', chr(1)||'e'), '{CONTROLS}', '', 'g') as value from documents",
    "classify_placeholder": _from(MARK) + "select k, case when regexp_matches(raw, '^0+$') then 'only_zeros' when raw in ('-', '—', '–') then 'dash_only' "
        "when lower(raw) in ('н/д', 'нд', 'нет данных', 'null', 'none') then 'empty_marker' end as cls from t",
    "null_label": _from(MARK) + "select k, coalesce(nullif(trim(raw), ''), '<null>') as label from t",
    "meta_label": BASE + f""", t as (select k, ({MARK}) as t, case when k % 3 = 0 then null else k % 2 = 0 end as b,
        case when k % 5 = 0 then null else cast(k as double) / 2 end as n from base)
        select k, case when t is null then '<null>' when trim(t) = '' then '<empty>' else trim(t) end as text_label,
        case when b is null then '<null>' when b then '1' else '0' end as bool_label,
        case when n is null then '<null>' when n = floor(n) then cast(cast(n as bigint) as varchar) else cast(n as varchar) end as number_label from t""",
    "canonical_qualification": _from(QUAL) + "select k, rtrim(regexp_replace(rtrim(raw), '\\.$', '')) as value from t",
}
