"""Data-quality audits. Each is one or few aggregations with partial sums; nothing is collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from certweave import schema as S
from certweave.functions import nested as N
from certweave.functions import text as X
from certweave.sources import readers
from certweave.operators.filters import OUTSIDE_REGION

# Fixed values of the register.
SCHOOL_LEVELS = [
    "Начальное общее образование",
    "Основное общее образование",
    "Среднее общее образование",
    "Дошкольное образование",
    "Общее образование",
    "Среднее (полное) общее образование",
    "Не определен",
]
EMPTY_LEVEL_LABEL = "<пустой EduLevelName>"
BRANCH_HIT_KIND, BRANCH_HIT_RULE = "branch_supplement_diff_aeo_id_v1", "diff_aeo_id"
INN_GAP_KIND = "branch_supplement_aeo_inn_gap_v1"
SLIM_CARD_FIELDS = ["Id", "FullName", "ShortName", "INN", "OGRN", "KPP", "HeadEduOrgId", "IsBranch", "RegionName"]
SUPPLEMENT_META_FIELDS = ["IsForBranch", "StatusName", "Number", "SerialNumber", "FormNumber"]
ANCHOR_CODES = ["09.02.07"]

ROOT = N.ROOT


def _n(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def histogram(df: DataFrame, *fields: str) -> DataFrame:
    """(field, label, n) for several text fields in one pass over the rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), X.null_label(F.col(f)).alias("label")) for f in fields]))
    return df.select(pairs.alias("x")).groupBy("x.field", "x.label").agg(F.count(F.lit(1)).alias("n"))


def audit_status(records: DataFrame) -> DataFrame:
    return histogram(records, "StatusName", "TypeName").orderBy("field", F.desc("n"), "label")


def audit_region(records: DataFrame) -> DataFrame:
    out = histogram(records, "RegionName").withColumn("outside", F.col("label") == OUTSIDE_REGION)
    return out.orderBy(F.desc("n"), "label")


def supplement_rows(records: DataFrame) -> DataFrame:
    """(record columns, sup_pos, s)."""
    return records.select("*", F.inline(N.placed(N.supplements())).alias("sup_pos", "s"))


def program_rows(records: DataFrame) -> DataFrame:
    rows = supplement_rows(records)
    return rows.select("Id", "_record_seq", "sup_pos", F.col("s.Id").alias("sup_id"),
                       F.inline(N.placed(N.programs_of(F.col("s")))).alias("slot", "p"))


def status_vocab(records: DataFrame) -> DataFrame:
    """Per status name: uses at the root and in supplements, and the first certificate showing it in each place."""
    cid = X.nonblank(F.col("Id"))
    sups = F.transform(N.supplements(), lambda s, i: F.struct(
        F.lit("supplement").alias("place"), X.null_label(s["StatusName"]).alias("label"), i.alias("pos")))
    root = F.struct(F.lit("root").alias("place"), X.null_label(F.col("StatusName")).alias("label"), F.lit(-1).alias("pos"))
    rows = records.select(cid.alias("cid"), "_record_seq", F.explode(F.concat(F.array(root), sups)).alias("x"))
    order = F.struct("_record_seq", F.col("x.pos"))

    def first(place: str) -> Column:
        return F.min_by("cid", F.when((F.col("x.place") == place) & F.col("cid").isNotNull(), order))

    return rows.groupBy(F.col("x.label").alias("label")).agg(
        _n(F.col("x.place") == "root").alias("root_count"),
        _n(F.col("x.place") == "supplement").alias("supplement_count"),
        first("root").alias("root_example"),
        first("supplement").alias("supplement_example"),
    ).orderBy(F.col("label") == "<null>", "label")


def nullish_kind(raw: Column, path: str) -> Column:
    """``missing`` / ``json_null`` / ``empty_string`` for a key of raw JSON text, null when it has a value."""
    value = F.get_json_object(raw, f"$.{path}")
    present = F.array_contains(F.json_object_keys(raw), path)
    return (
        F.when(~F.coalesce(present, F.lit(False)), "missing")
        .when(value.isNull(), "json_null")
        .when(X.strip(value) == "", "empty_string")
    )


def null_status(lines: DataFrame) -> DataFrame:
    """Per JSON line (column ``value``): kind of the root status and kinds of the supplements' statuses."""
    sups = F.from_json(F.get_json_object(F.col("value"), "$.Supplements"), T.ArrayType(T.StringType()))
    return lines.select(
        "*",
        nullish_kind(F.col("value"), "StatusName").alias("root_kind"),
        F.filter(F.transform(F.coalesce(sups, F.array().cast("array<string>")), lambda s: nullish_kind(s, "StatusName")),
                 lambda k: k.isNotNull()).alias("supplement_kinds"),
    )


def audit_null_status(lines: DataFrame) -> DataFrame:
    """Totals of :func:`null_status`."""
    rows = null_status(lines)
    size = F.size("supplement_kinds")
    kinds = ["missing", "json_null", "empty_string"]

    def in_supplements(kind: str) -> Column:
        hits = N.count_where(F.col("supplement_kinds"), lambda x: x == kind)
        return F.coalesce(F.sum(hits), F.lit(0)).cast("bigint")

    return rows.agg(
        F.count(F.lit(1)).alias("records"),
        *[_n(F.col("root_kind") == k).alias(f"root_{k}") for k in kinds],
        *[in_supplements(k).alias(f"supplement_{k}") for k in kinds],
        _n(size > 0).alias("records_with_supplement_hit"),
        _n(F.col("root_kind").isNotNull() | (size > 0)).alias("records_with_any"),
    )


IDENTITY_FIELDS = ["EduOrgINN", "EduOrgOGRN", "root_INN", "root_OGRN", "supplement_INN", "supplement_OGRN"]


def _identity_values() -> Column:
    """Array of (field, value) a record contributes to the identity audit."""
    def pair(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("field"), value.alias("value"))

    own = F.array(pair("EduOrgINN", F.col("EduOrgINN")), pair("EduOrgOGRN", F.col("EduOrgOGRN")),
                  pair("root_INN", F.col(ROOT)["INN"]), pair("root_OGRN", F.col(ROOT)["OGRN"]))
    cards = F.filter(F.transform(N.supplements(), lambda s: s[ROOT]), lambda a: a.isNotNull())
    sup = F.flatten(F.transform(cards, lambda a: F.array(pair("supplement_INN", a["INN"]), pair("supplement_OGRN", a["OGRN"]))))
    return F.concat(own, sup)


def identity_counters(records: DataFrame) -> DataFrame:
    """Per identity field: filled, missing, digits only, and what a stricter rule would drop."""
    v = F.col("x.value")
    empty, digits = X.is_blank(v), X.digits_only(v).isNotNull()
    return records.select(F.explode(_identity_values()).alias("x")).groupBy(F.col("x.field").alias("field")).agg(
        F.count(F.lit(1)).alias("total"),
        _n(empty).alias("missing_or_empty"),
        _n(~empty).alias("nonempty"),
        _n(digits).alias("digits_only"),
        _n(~empty & ~digits).alias("not_digits_only"),
        _n(empty).alias("would_drop_if_nonempty_required"),
        _n(~digits).alias("would_drop_if_digits_required"),
    )


def identity_samples(records: DataFrame, most: int) -> DataFrame:
    """Per identity field the first ``most`` certificates whose value is not digits only: (field, rank, certificate_id)."""
    v = F.col("x.value")
    rows = records.select(X.strip(F.coalesce("Id", F.lit(""))).alias("certificate_id"), "_record_seq", F.posexplode(_identity_values()).alias("pos", "x"))
    bad = rows.where(~X.is_blank(v) & X.digits_only(v).isNull()).select(F.col("x.field").alias("field"), "_record_seq", "pos", "certificate_id")
    return first_per_group(bad, ["field"], ["_record_seq", "pos"], most)


def first_per_group(df: DataFrame, group: list[str], order: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each group, with ``rank``.

    Groups may be few and huge, so rows are ranked within (group, block) first and
    only the survivors of each block are ranked together.
    """
    from pyspark.sql import Window as W

    blocks = df.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(1024)))
    pre = W.partitionBy(*group, "_block").orderBy(*order)
    full = W.partitionBy(*group).orderBy(*order)
    return (
        blocks.withColumn("rank", F.row_number().over(pre)).where(F.col("rank") <= most)
        .withColumn("rank", F.row_number().over(full)).where(F.col("rank") <= most).drop("_block")
    )


def identity_borrowable(records: DataFrame) -> DataFrame:
    """How many missing ids have a donor inside their own record. Original values only."""
    root = F.col(ROOT)
    out = []
    cards = F.filter(F.transform(N.supplements(), lambda s: s[ROOT]), lambda a: F.coalesce(N.same_org(root, a), F.lit(False)))
    df = records.withColumn("_same", cards)
    same = F.col("_same")
    for k in ("INN", "OGRN"):
        own = X.digits_only(F.col(f"EduOrg{k}")).isNotNull()
        root_donor = X.digits_only(root[k]).isNotNull() | own
        lacking = N.count_where(same, lambda a, k=k: X.is_blank(a[k]))
        giving = N.count_where(same, lambda a, k=k: X.digits_only(a[k]).isNotNull()) > 0
        out += [
            F.sum(lacking).cast("bigint").alias(f"same_org_cards_missing_{k.lower()}"),
            F.sum(F.when(root_donor, lacking).otherwise(0)).cast("bigint").alias(f"same_org_cards_missing_{k.lower()}_with_donor"),
            _n(X.is_blank(root[k]) & (giving | own)).alias(f"root_missing_{k.lower()}_with_donor"),
        ]
    return df.agg(*out)


def _id_issue(v: Column) -> Column:
    return X.digits_only(v).isNull()


def identity_issue_ids(records: DataFrame) -> DataFrame:
    """In records with any identity problem: supplement cards by id relation, all and with a problem of their own."""
    root = F.col(ROOT)
    cards = F.filter(F.transform(N.supplements(), lambda s: s[ROOT]), lambda a: a.isNotNull())
    card_issue = lambda a: _id_issue(a["INN"]) | _id_issue(a["OGRN"])
    any_issue = (
        _id_issue(F.col("EduOrgINN")) | _id_issue(F.col("EduOrgOGRN")) | _id_issue(root["INN"]) | _id_issue(root["OGRN"])
        | F.exists(cards, card_issue)
    )
    rows = records.where(any_issue).select(F.explode(cards).alias("a"), ROOT)
    return rows.groupBy(N.id_relation(root, F.col("a")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("cards"), _n(card_issue(F.col("a"))).alias("cards_with_own_issue"))


def audit_branches(records: DataFrame) -> DataFrame:
    """Records and supplement cards by their id relation to the root card."""
    root = F.col(ROOT)
    cards = F.filter(F.transform(N.supplements(), lambda s: s[ROOT]), lambda a: a.isNotNull())
    df = records.withColumn("_kinds", F.transform(cards, lambda a: N.id_relation(root, a)))

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(N.count_where(F.col("_kinds"), lambda x: x == kind)), F.lit(0)).cast("bigint")

    return df.agg(
        F.count(F.lit(1)).alias("records"),
        _n(root.isNotNull()).alias("with_root_card"),
        _n(F.size("_kinds") > 0).alias("with_supplement_card"),
        _n(F.array_contains("_kinds", "different_Id")).alias("with_branch"),
        total("same_Id").alias("same_id_cards"),
        total("different_Id").alias("branch_cards"),
        total("incomparable_Id").alias("incomparable_cards"),
    )


def slim_card(card: Column) -> Column:
    return F.struct(*[card[f].alias(f) for f in SLIM_CARD_FIELDS])


def branch_hits(records: DataFrame) -> DataFrame:
    """One flat row per supplement whose card has another id than the root card."""
    root, s = F.col(ROOT), F.col("s")
    return supplement_rows(records).where(N.different_org(root, s[ROOT])).select(
        F.lit(BRANCH_HIT_KIND).alias("record_kind"), F.lit(BRANCH_HIT_RULE).alias("rule_id"),
        F.col("Id").alias("certificate_id"), F.col("sup_pos").alias("supplement_index"),
        root["Id"].alias("root_aeo_id"), s[ROOT]["Id"].alias("supplement_aeo_id"),
        "EduOrgINN", "EduOrgOGRN",
        F.col("EduOrgFullName").alias("certificate_EduOrgFullName"), F.col("EduOrgShortName").alias("certificate_EduOrgShortName"),
        slim_card(root).alias("root_card"), slim_card(s[ROOT]).alias("supplement_card"),
        F.struct(*[s[f].alias(f) for f in SUPPLEMENT_META_FIELDS]).alias("supplement_meta"), "_record_seq",
    )


def branch_flag_histogram(hits: DataFrame) -> DataFrame:
    flag = F.col("supplement_meta.IsForBranch")
    return hits.groupBy(F.when(flag.isNull(), "null").otherwise(flag.cast("string")).alias("is_for_branch")).agg(F.count(F.lit(1)).alias("n"))


def branch_inn_gap(records: DataFrame, without_filial_in_name: bool = False) -> DataFrame:
    """Supplement cards of another organisation id that lack an INN although a donor exists."""
    root, s = F.col(ROOT), F.col("s")
    card = s[ROOT]
    rows = records.withColumns({"_inn": N.donor(root, "INN"), "_ogrn": N.donor(root, "OGRN")})
    hit = N.different_org(root, card) & N.missing(card, "INN") & F.col("_inn").isNotNull()
    if without_filial_in_name:
        hit = hit & ~F.coalesce(card["FullName"].rlike("(?iu)филиал"), F.lit(False))
    return supplement_rows(rows).where(hit).select(
        F.lit(INN_GAP_KIND).alias("record_kind"), F.col("Id").alias("certificate_id"), F.col("sup_pos").alias("supplement_index"),
        root["Id"].alias("root_aeo_id"), card["Id"].alias("supplement_aeo_id"),
        F.col("_inn").alias("donor_inn_digits"), F.col("_ogrn").alias("donor_ogrn_digits"), "EduOrgINN", "EduOrgOGRN",
        F.col("EduOrgFullName").alias("certificate_EduOrgFullName"), F.col("EduOrgShortName").alias("certificate_EduOrgShortName"),
        root["FullName"].alias("root_AEO_FullName"), root["ShortName"].alias("root_AEO_ShortName"),
        slim_card(root).alias("root_card"), slim_card(card).alias("supplement_card"),
        F.struct(*[s[f].alias(f) for f in SUPPLEMENT_META_FIELDS]).alias("supplement_meta"), "_record_seq",
    )


def audit_inn_gap(gap: DataFrame) -> DataFrame:
    """Checks over the rows of :func:`branch_inn_gap`, recomputing the donors from the slim cards."""
    right = F.coalesce(F.col("record_kind") == INN_GAP_KIND, F.lit(False))
    root, card = F.col("root_card"), F.col("supplement_card")
    donor = lambda k: F.coalesce(X.digits_only(root[k]), X.digits_only(F.col(f"EduOrg{k}")))
    noted = X.drop_space_and_hyphen(F.col("donor_inn_digits"))
    no_ogrn = card.isNotNull() & X.is_blank(card["OGRN"])
    return gap.agg(
        F.count(F.lit(1)).alias("total"),
        _n(~right).alias("wrong_kind"),
        _n(right & (noted != donor("INN"))).alias("donor_inn_mismatch"),
        _n(right & no_ogrn & donor("OGRN").isNotNull()).alias("ogrn_missing_with_donor"),
        _n(right & no_ogrn & donor("OGRN").isNull()).alias("ogrn_missing_without_donor"),
        _n(right & ~X.is_blank(card["HeadEduOrgId"])).alias("head_id_set"),
        _n(right & X.digits_only(root["INN"]).isNotNull()).alias("inn_from_root"),
        _n(right & root.isNotNull() & X.digits_only(root["INN"]).isNull() & X.digits_only(F.col("EduOrgINN")).isNotNull()).alias("inn_from_eduorg_only"),
    )


def gap_flag_histogram(gap: DataFrame) -> DataFrame:
    """``IsForBranch`` labels of gap rows; rows without the meta struct count as absent."""
    meta = F.col("supplement_meta")
    label = F.when(meta.isNull(), "<key absent>").otherwise(X.meta_label_bool(meta["IsForBranch"]))
    return gap.where(F.col("record_kind") == INN_GAP_KIND).groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


def _level(p: Column) -> Column:
    return X.nonblank(p["EduLevelName"])


def level_histogram(records: DataFrame) -> DataFrame:
    """Programmes per level, blanks under their own label, with the school sector marked."""
    level = _level(F.col("p"))
    return program_rows(records).groupBy(F.coalesce(level, F.lit(EMPTY_LEVEL_LABEL)).alias("level")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("is_school", F.col("level").isin(SCHOOL_LEVELS))


def school_subtotal(records: DataFrame) -> DataFrame:
    h = level_histogram(records)
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("bigint")
    return h.agg(total(F.lit(True)).alias("programs"), total(F.col("is_school")).alias("school_programs"),
                 total(F.col("level") == EMPTY_LEVEL_LABEL).alias("empty_level_programs"))


def certificate_class() -> Column:
    """Class of a record by the sectors of its programme levels."""
    levels = F.transform(N.all_programs(), _level)
    named = F.filter(levels, lambda x: x.isNotNull())
    school = F.exists(named, lambda x: x.isin(SCHOOL_LEVELS))
    other = F.exists(named, lambda x: ~x.isin(SCHOOL_LEVELS))
    return (
        F.when(F.size(levels) == 0, "no_educational_programs")
        .when(F.size(named) == 0, "all_program_levels_empty")
        .when(school & other, "mixed_school_and_other")
        .when(school, "school_levels_only")
        .otherwise("non_school_levels_only")
    )


def classify_certificates(records: DataFrame) -> DataFrame:
    return records.withColumn("certificate_class", certificate_class())


def empty_level_programs(records: DataFrame) -> DataFrame:
    """Every programme without a level, with its place and the class of its record."""
    rows = classify_certificates(records).select(
        "Id", "_record_seq", "certificate_class", F.inline(N.placed(N.supplements())).alias("supplement_index", "s"))
    rows = rows.select("Id", "_record_seq", "certificate_class", "supplement_index", F.col("s.Id").alias("supplement_id"),
                       F.inline(N.placed(N.programs_of(F.col("s")))).alias("program_index", "p"))
    return rows.where(_level(F.col("p")).isNull()).select(
        F.col("Id").alias("certificate_id"), "_record_seq", "certificate_class", "supplement_index", "supplement_id", "program_index",
        *[F.col("p")[f].alias(f"program_{f}") for f in ("Id", "ProgrammName", "ProgrammCode")])


def level_vocab(records: DataFrame) -> DataFrame:
    """Distinct non-blank level names with their counts."""
    return (
        program_rows(records).select(_level(F.col("p")).alias("level")).where("level is not null")
        .groupBy("level").agg(F.count(F.lit(1)).alias("n")).orderBy("level")
    )


# programme fields whose content makes a dictionary entry
DICTIONARY_FIELDS = [f for f in S.PROGRAM_FIELDS if f not in (
    "Id", "TypeName", "EduNormativePeriod", "IsAccredited", "IsCanceled", "IsSuspended")]


def code_sort_key(c: Column) -> Column:
    """Dotted codes by their three numbers, then other text, then blanks."""
    x = F.coalesce(X.strip(c), F.lit(""))
    dotted = x.rlike(X.DOTTED_CODE)
    number = lambda a: F.when(dotted, F.substring(x, a, 2).cast("int")).otherwise(0)
    return F.struct(
        F.when(x == "", 2).when(dotted, 0).otherwise(1).alias("rank"),
        number(1).alias("a"), number(4).alias("b"), number(7).alias("c"),
        F.when(dotted, "").otherwise(x).alias("text"),
    )


def _dictionary_candidates(records: DataFrame, require_qualification: bool) -> DataFrame:
    p = F.col("p")
    rows = program_rows(records).withColumn("p", p.withField("Qualification", X.canonical_qualification(p["Qualification"])))
    rows = rows.where(~X.is_blank(p["UGSName"]))
    return rows.where(~X.is_blank(p["Qualification"])) if require_qualification else rows


def programs_dictionary(records: DataFrame, require_qualification: bool = False) -> DataFrame:
    """Distinct programmes by content in dictionary order; the first occurrence gives the id.

    Grouping compares content columns with partial aggregation: a programme that
    is a large part of all rows shrinks to one row per task before the shuffle.
    """
    p = F.col("p")
    rows = _dictionary_candidates(records, require_qualification)
    order = F.struct("_record_seq", "sup_pos", "slot")
    first = rows.select(*[p[f].alias(f) for f in DICTIONARY_FIELDS], p["Id"].alias("_id"), p["_derived"].alias("_kept"), order.alias("_order")) \
        .groupBy(*DICTIONARY_FIELDS).agg(F.min_by(F.struct("_id", "_kept"), "_order").alias("_first"))
    return first.select(F.col("_first._id").alias("Id"), *DICTIONARY_FIELDS, F.col("_first._kept").alias("_derived")).orderBy(
        -F.length(F.coalesce("Qualification", F.lit(""))), code_sort_key(F.col("ProgrammCode")), code_sort_key(F.col("UGSCode")),
        F.coalesce("ProgrammName", F.lit("")), F.to_json(F.struct(*DICTIONARY_FIELDS)))


def dictionary_invariant(records: DataFrame, dictionary: DataFrame, anchors: list[str] | None = None) -> DataFrame:
    """Anchor codes that occur in the input but not in the dictionary; empty when all is well."""
    code = X.nonblank(F.col("p.ProgrammCode"))
    seen = _dictionary_candidates(records, False).select(code.alias("code")).where(F.col("code").isin(anchors or ANCHOR_CODES)).distinct()
    return seen.join(dictionary.select(X.nonblank(F.col("ProgrammCode")).alias("code")).distinct(), "code", "left_anti")


def _text_leaves(dtype: T.DataType, path: str, value: Column) -> Column:
    """Array of (path, value) of all text leaves below ``value``; members starting with ``_`` are left out."""
    empty = F.array().cast("array<struct<path:string,value:string>>")
    if isinstance(dtype, T.StringType):
        return F.array(F.struct(F.lit(path or "/").alias("path"), value.alias("value")))
    if isinstance(dtype, T.StructType):
        parts = [_text_leaves(f.dataType, f"{path}/{f.name}", value[f.name]) for f in dtype.fields if not f.name.startswith("_")]
        return F.concat(*parts) if parts else empty
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.flatten(F.transform(value, lambda x: _text_leaves(dtype.elementType, path + "/*", x))), empty)
    return empty


def scan_placeholders(records: DataFrame, min_count: int = 1) -> DataFrame:
    """Placeholder texts per (class, path): hits, distinct literals, most frequent literal (smallest on a tie)."""
    fields = [f for f in records.schema.fields if not f.name.startswith("_")]
    leaves = F.concat(*[_text_leaves(f.dataType, f"/{f.name}", F.col(f.name)) for f in fields])
    hits = F.filter(F.transform(leaves, lambda x: F.struct(
        X.classify_placeholder(x["value"]).alias("cls"), x["path"].alias("path"), x["value"].alias("literal"))), lambda x: x["cls"].isNotNull())
    return placeholder_totals(records.select(F.explode(hits).alias("x")).select("x.*"), min_count)


def placeholder_totals(hits: DataFrame, min_count: int = 1) -> DataFrame:
    """Totals of (cls, path, literal) rows; literals are counted before they are put together per path."""
    per_literal = hits.groupBy("cls", "path", "literal").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    return per_literal.groupBy("cls", "path").agg(
        F.sum("n").cast("bigint").alias("total"), F.count(F.lit(1)).alias("literals"),
        F.min_by("literal", F.struct(-F.col("n"), F.col("literal"))).alias("example"))


# Tokens of JSON text whose escaped quotes and backslashes are marked, so that a quote ends a text.
_MARK = "\uE000"
_MARKED = [(_MARK, _MARK + "e"), ("\\\\", _MARK + "b"), ('\\"', _MARK + "q")]
_TOKEN = r'"[^"]*+"|[\[\]{},:]|[^\s\[\]{},:"]++'


def _marked(json: Column) -> Column:
    for text, mark in _MARKED:
        json = F.replace(json, F.lit(text), F.lit(mark))
    return json


def _json_text(token: Column) -> Column:
    """The text that a text token stands for."""
    plain = token
    for text, mark in reversed(_MARKED):
        plain = F.replace(plain, F.lit(mark), F.lit(text))
    inside = F.substring(token, 2, 1 << 30)
    odd = token.contains("\\") | token.contains(_MARK)
    return F.when(odd, F.try_variant_get(F.try_parse_json(plain), "$", "string")).otherwise(F.substr(inside, F.lit(1), F.length(inside) - 1))


def _json_walk(json: Column) -> Column:
    """(cls, path, literal) of every placeholder in a JSON object, in one pass over its tokens.

    The state is the open brackets, each with the path of its value, and the last key. Keys that begin with an
    underscore hide what they hold.
    """
    frame = "array<struct<path:string,is_list:boolean,hidden:boolean>>"
    nothing = "array<struct<cls:string,path:string,literal:string>>"
    start = F.struct(F.array().cast(frame).alias("open"), F.lit("").alias("key"), F.lit(False).alias("wants_key"), F.array().cast(nothing).alias("found"))

    def step(state: Column, token: Column) -> Column:
        top = F.element_at(state["open"], -1)
        depth = F.size(state["open"])
        hides = F.when(depth == 0, False).otherwise(top["hidden"] | (~top["is_list"] & state["key"].startswith("_")))
        path = F.when(depth == 0, "").when(top["is_list"], F.concat(top["path"], F.lit("/*"))).otherwise(F.concat(top["path"], F.lit("/"), state["key"]))
        opens, closes, comma = token.isin("{", "["), token.isin("}", "]"), token == ","
        text = token.startswith('"')
        is_key = text & state["wants_key"]
        inner = F.struct(path.alias("path"), (token == "[").alias("is_list"), hides.alias("hidden"))
        pushed = F.when(opens, F.concat(state["open"], F.array(inner))).when(closes, F.slice(state["open"], 1, F.greatest(depth - 1, F.lit(0)))).otherwise(state["open"])
        value = _json_text(token)
        cls = F.when(text & ~is_key & ~hides, X.classify_placeholder(value))
        return F.struct(
            pushed.cast(frame).alias("open"), F.when(is_key, value).otherwise(state["key"]).alias("key"),
            F.when(token == "{", True).when(comma, ~top["is_list"]).when(text, False).otherwise(state["wants_key"]).alias("wants_key"),
            F.when(cls.isNotNull(), F.concat(state["found"], F.array(F.struct(cls.alias("cls"), path.alias("path"), value.alias("literal"))))).otherwise(state["found"]).cast(nothing).alias("found"))

    tokens = F.regexp_extract_all(_marked(json), F.lit(_TOKEN), F.lit(0))
    return F.aggregate(tokens, start.cast(f"struct<open:{frame},key:string,wants_key:boolean,found:{nothing}>"), lambda a, t: step(a, t).cast(
        f"struct<open:{frame},key:string,wants_key:boolean,found:{nothing}>"), lambda a: a["found"])


def scan_json_placeholders(lines: DataFrame, min_count: int = 1) -> DataFrame:
    """Like :func:`scan_placeholders` for JSON text of unknown shape (column ``value``) and any depth; one pass, one plan."""
    objects = lines.where(F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False)))
    rows = objects.select(F.explode(_json_walk(F.col("value"))).alias("x")).select("x.cls", "x.path", "x.literal")
    return placeholder_totals(rows, min_count)


def compare_card_ids(records: DataFrame) -> DataFrame:
    """Root card id against supplement card ids; stripped, but case counts here."""
    df = records.select(
        X.nonblank(F.col(ROOT)["Id"]).alias("root_id"),
        F.filter(F.transform(N.supplements(), lambda s: X.nonblank(s[ROOT]["Id"])), lambda x: x.isNotNull()).alias("ids"))
    both = F.col("root_id").isNotNull() & (F.size("ids") > 0)
    no_root = F.col("root_id").isNull() & (F.size("ids") > 0)
    match = F.forall("ids", lambda x: x == F.col("root_id"))
    one = F.size(F.array_distinct("ids")) == 1
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        _n(F.col("root_id").isNotNull()).alias("with_root_id"),
        _n(F.size("ids") > 0).alias("with_supplement_id"),
        _n(both).alias("both_present"),
        _n(both & match).alias("all_match_root"),
        _n(both & ~match).alias("mismatch_root"),
        _n(no_root).alias("no_root"),
        _n(no_root & one).alias("no_root_all_same"),
        _n(no_root & ~one).alias("no_root_differ"),
    )


def differing_card_ids(records: DataFrame) -> DataFrame:
    """Records whose card ids differ, from the root card or among supplements."""
    root_id = X.nonblank(F.col(ROOT)["Id"])
    ids = F.filter(F.transform(N.supplements(), lambda s: X.nonblank(s[ROOT]["Id"])), lambda x: x.isNotNull())
    return records.where(
        (F.size(ids) > 0) & F.when(root_id.isNotNull(), F.exists(ids, lambda x: x != root_id)).otherwise(F.size(F.array_distinct(ids)) > 1))


def unknown_tags(keys: DataFrame) -> DataFrame:
    """Tag names (column ``tag``) outside the schema, each once."""
    known = keys.sparkSession.createDataFrame([(t,) for t in S.SCHEMA_TAGS], "tag string")
    return keys.select("tag").distinct().join(known, "tag", "left_anti")


def unknown_xml_tags(elements: DataFrame) -> DataFrame:
    """(tag, path): tag names of XML elements outside the schema, each once, with the first place it stands at."""
    rows = readers.element_paths(elements, S.SCHEMA_TAGS)
    return rows.groupBy("tag").agg(F.min_by("path", F.struct("_record_seq", "place")).alias("path"))


def json_keys(lines: DataFrame) -> DataFrame:
    """Top-level key names of JSON lines (column ``value``) as ``tag`` rows."""
    return lines.select(F.explode(F.json_object_keys("value")).alias("tag"))


def schema_violations(lines: DataFrame) -> DataFrame:
    """(line columns, violation) for JSON lines that are no record: not an object, no Id, wrong types at any level, lists of non-objects.

    Names of what is wrong below the root carry the way there, as in ``type_of_Supplements.StatusName``; each stands once per line.
    """
    v = F.try_parse_json("value")
    df = lines.withColumn("_v", v).withColumn("_kind", F.expr("schema_of_variant(_v)"))
    is_object = F.coalesce(F.col("_kind").startswith("OBJECT"), F.lit(False))

    def kind(name: str) -> Column:
        return F.expr(f"schema_of_variant(try_variant_get(_v, '$.{name}', 'variant'))")

    checks = [F.when(~is_object, "not_an_object"),
              F.when(is_object & F.coalesce(kind("Id").isin("VOID"), F.lit(True)), "no_Id")]
    for f in S.CERTIFICATE_FIELDS:
        allowed = ["VOID", "BOOLEAN" if f in S.BOOL_FIELDS else "STRING"]
        checks.append(F.when(is_object & ~kind(f).isin(allowed), f"type_of_{f}"))
    for f in ("Supplements", "Decisions"):
        ok = kind(f).isin("VOID", "ARRAY<VOID>") | kind(f).startswith("ARRAY<OBJECT")
        checks.append(F.when(is_object & ~ok, f"type_of_{f}"))
    checks.append(F.when(is_object & ~(kind(ROOT).isin("VOID") | kind(ROOT).startswith("OBJECT")), f"type_of_{ROOT}"))
    below = [_item_violations(F.col("_v"), "Supplements", lambda s: F.concat(
        _member_violations(s, "Supplements", S.SUPPLEMENT_FIELDS),
        _card_violations(s, "Supplements."),
        _item_violations(s, "EducationalPrograms", lambda p: _member_violations(p, "Supplements.EducationalPrograms", S.PROGRAM_FIELDS), "Supplements."))),
        _item_violations(F.col("_v"), "Decisions", lambda d: _member_violations(d, "Decisions", S.DECISION_FIELDS)),
        _card_violations(F.col("_v"), "")]
    found = F.array_distinct(F.concat(F.filter(F.array(*checks), lambda x: x.isNotNull()), *below))
    return df.withColumn("violation", F.explode(found)).drop("_v", "_kind")


NO_VIOLATION = "array<string>"


def _variant_kind(v: Column, name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant"))


def _member_violations(v: Column, way: str, fields: list[str]) -> Column:
    """Members of an object whose type is not that of the field; an absent member is none."""
    wrong = [F.when(~_variant_kind(v, f).isin("VOID", "BOOLEAN" if f in S.BOOL_FIELDS else "STRING"), f"type_of_{way}.{f}") for f in fields]
    return F.filter(F.array(*wrong), lambda x: x.isNotNull())


def _card_violations(v: Column, way: str) -> Column:
    return F.when(_variant_kind(v, ROOT).startswith("OBJECT"), _member_violations(
        F.try_variant_get(v, f"$.{ROOT}", "variant"), way + ROOT, S.ORGANIZATION_FIELDS)).otherwise(F.array().cast(NO_VIOLATION))


def _item_violations(v: Column, name: str, of_item: Callable[[Column], Column], way: str = "") -> Column:
    """What is wrong with the object items of a list; below the root also with the list and its other items."""
    items = F.try_variant_get(v, f"$.{name}", "array<variant>")
    nothing = F.array().cast(NO_VIOLATION)
    is_object = lambda x: F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False))
    found = F.flatten(F.transform(items, lambda x: F.when(is_object(x), of_item(x)).otherwise(nothing)))
    if not way:
        return F.coalesce(found, nothing)
    odd = (~_variant_kind(v, name).isin("VOID") & items.isNull()) | F.exists(items, lambda x: ~is_object(x))
    return F.concat(F.coalesce(found, nothing), F.when(F.coalesce(odd, F.lit(False)), F.array(F.lit(f"type_of_{way}{name}"))).otherwise(nothing))


def differing_card_samples(records: DataFrame, sizes: list[int]) -> DataFrame:
    """The first records of :func:`differing_card_ids` in record order, once for every sample size: (sample_size, _record_seq, Id)."""
    first = differing_card_ids(records).select("_record_seq", "Id").withColumn("_all", F.lit(1))
    ranked = first_per_group(first, ["_all"], ["_record_seq"], max(sizes))
    return ranked.select(F.explode(F.array(*[F.lit(n) for n in sizes])).alias("sample_size"), "_record_seq", "Id", "rank").where(
        F.col("rank") <= F.col("sample_size")).drop("rank")
