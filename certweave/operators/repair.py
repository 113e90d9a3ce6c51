"""Record-local repair. Every step is a narrow projection: no shuffle, no Python.

A step adds its counter columns next to the record, so that a report can sum
them later; a job that does not read a counter does not pay for it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certweave import schema as S
from certweave.functions import nested as N
from certweave.functions import text as X

# Fixed values of the register: statuses, level names and the level map.
EXCLUDED_STATUSES = ["Недействующее", "Прекращено", "Лишен аккредитации"]
LEVELS_NAMED_LIKE_PROGRAMS = [
    "Начальное общее образование",
    "Основное общее образование",
    "Среднее общее образование",
    "Дошкольное образование",
    "Общее образование",
    "Среднее (полное) общее образование",
    "Не определен",
]
CANONICAL_LEVELS = [
    "Дошкольное образование",
    "Начальное общее образование",
    "Основное общее образование",
    "Среднее общее образование",
    "Среднее профессиональное образование",
    "Высшее образование - бакалавриат",
    "Высшее образование - специалитет",
    "Высшее образование - магистратура",
    "Высшее образование - подготовка кадров высшей квалификации",
    "Дополнительное профессиональное образование",
]
LEVEL_TARGETS = {
    "ВО - бакалавриат": "Высшее образование - бакалавриат",
    "ВО - подготовка кадров высшей квалификации": "Высшее образование - подготовка кадров высшей квалификации",
    "Начальное профессиональное образование": "Среднее профессиональное образование",
    "Не определен": None,
    "Общее образование": "Основное общее образование",
    "Профессиональное образование": "Среднее профессиональное образование",
    "Профессиональное обучение": "Среднее профессиональное образование",
    "Среднее (полное) общее образование": "Среднее общее образование",
    "Среднее профессиональное образование (базовая подготовка)": "Среднее профессиональное образование",
}


@dataclass(frozen=True)
class LevelMap:
    """Level name -> level name; a target of ``None`` means the level is taken away."""

    targets: dict[str, str | None] = field(default_factory=lambda: dict(LEVEL_TARGETS))
    canonical: tuple[str, ...] = tuple(CANONICAL_LEVELS)

    def target(self, level: Column) -> Column:
        pairs = [F.lit(x) for k, v in self.targets.items() if v is not None for x in (k, v)]
        if not pairs:
            return F.lit(None).cast("string")
        return F.try_element_at(F.create_map(*pairs), level)

    def is_cleared(self, level: Column) -> Column:
        return F.coalesce(level.isin([k for k, v in self.targets.items() if v is None]), F.lit(False))

    def is_unknown(self, level: Column) -> Column:
        return level.isNotNull() & ~level.isin([*self.targets, *self.canonical])


def strip_supplements(df: DataFrame) -> DataFrame:
    """Drop supplements in an excluded status."""
    excluded = lambda s: F.coalesce(X.strip(s["StatusName"]).isin(EXCLUDED_STATUSES), F.lit(False))
    return df.withColumns({
        "stripped_supplements_by_status": N.count_where(N.supplements(), excluded),
        N.SUPPLEMENTS: F.filter(N.supplements(), lambda s: ~excluded(s)),
    })


ID_KEYS = ["INN", "OGRN"]


def _near_cards() -> Column:
    """Per supplement: the digits its card offers, or null when it is not the same organisation."""
    offer = lambda s: F.struct(*[X.digits_only(N.effective(s[N.ROOT], k)).alias(k) for k in ID_KEYS])
    return F.transform(N.supplements(), lambda s: F.when(N.same_org(F.col(N.ROOT), s[N.ROOT]), offer(s)))


def _first_near(key: str) -> Column:
    return N.first_value(F.transform(F.col("_near"), lambda c: c[key]))


def fill_coherent_ids(df: DataFrame) -> DataFrame:
    """Fill missing INN/OGRN: supplement cards from the root card or certificate, then the root card.

    ``_marks`` holds, per supplement, the relation of its card to the root card and
    whether a field is missing, so the filling and the counters read the same facts.
    """
    root = F.col(N.ROOT)
    keys = ID_KEYS
    facts = lambda s: F.struct(
        F.when(N.same_org(root, s[N.ROOT]), "same").when(N.different_org(root, s[N.ROOT]), "different").alias("kin"),
        *[N.missing(s[N.ROOT], k).alias(k) for k in keys],
    )
    df = df.withColumns({
        "_marks": F.transform(N.supplements(), facts),
        **{f"_donor_{k}": N.donor(root, k) for k in keys},
    })

    def fillable(m: Column, key: str, kin: str) -> Column:
        return (m["kin"] == kin) & m[key] & F.col(f"_donor_{key}").isNotNull()

    def fill(s: Column, m: Column) -> Column:
        card = s[N.ROOT]
        filled = {k: F.when(m["kin"].isNotNull() & m[k] & F.col(f"_donor_{k}").isNotNull(), F.col(f"_donor_{k}"))
                  .otherwise(card["_derived"][k]) for k in keys}
        return s.withField(N.ROOT, N.with_derived(card, S.ORGANIZATION_DERIVED, **filled))

    counters = {}
    for k in keys:
        counters[f"coherent_supplement_{k.lower()}"] = N.count_where(F.col("_marks"), lambda m, k=k: fillable(m, k, "same"))
        counters[f"branch_supplement_{k.lower()}"] = N.count_where(F.col("_marks"), lambda m, k=k: fillable(m, k, "different"))
    df = df.withColumns({N.SUPPLEMENTS: F.zip_with(N.supplements(), F.col("_marks"), fill), **counters})

    # the certificate's *original* field is the last donor of the root card
    df = df.withColumn("_near", _near_cards())
    df = df.withColumns({f"_first_{k}": F.coalesce(_first_near(k), X.digits_only(F.col(f"EduOrg{k}"))) for k in keys})
    take = {k: root.isNotNull() & N.missing(root, k) & F.col(f"_first_{k}").isNotNull() for k in keys}
    return df.withColumns({
        N.ROOT: N.with_derived(root, S.ORGANIZATION_DERIVED, **{
            k: F.when(take[k], F.col(f"_first_{k}")).otherwise(root["_derived"][k]) for k in keys}),
        **{f"coherent_root_{k.lower()}": take[k].cast("int") for k in keys},
    }).drop("_marks", "_near", *[f"_donor_{k}" for k in keys], *[f"_first_{k}" for k in keys])


def backfill_root_ids(df: DataFrame) -> DataFrame:
    """Fill EduOrgINN/EduOrgOGRN that hold no digits from the nearest card; needs a root card."""
    root = F.col(N.ROOT)
    keys = ID_KEYS
    df = df.withColumn("_near", _near_cards()).withColumns({
        **{f"_near_{k}": _first_near(k) for k in keys},
        **{f"_own_{k}": X.digits_only(N.effective(root, k)) for k in keys},
        **{f"_need_{k}": root.isNotNull() & X.digits_only(N.effective_root(f"EduOrg{k}")).isNull() for k in keys},
    })
    values = {f"EduOrg{k}": F.when(F.col(f"_need_{k}"), F.coalesce(f"_near_{k}", f"_own_{k}", F.col("_derived")[f"EduOrg{k}"]))
              .otherwise(F.col("_derived")[f"EduOrg{k}"]) for k in keys}
    counters = {}
    for k in keys:
        counters[f"eduorg_{k.lower()}_from_supplement"] = (F.col(f"_need_{k}") & F.col(f"_near_{k}").isNotNull()).cast("int")
        counters[f"eduorg_{k.lower()}_from_root"] = (
            F.col(f"_need_{k}") & F.col(f"_near_{k}").isNull() & F.col(f"_own_{k}").isNotNull()).cast("int")
    return df.withColumns({"_derived": N.derived(F.col("_derived"), S.CERTIFICATE_DERIVED, **values), **counters}).drop(
        "_near", *[f"_{p}_{k}" for p in ("near", "own", "need") for k in keys])


OVERRIDE_COUNTERS = ["override_records", "override_eduorg_inn", "override_root_inn"]


def override_inn_by_ogrn(df: DataFrame, overrides: DataFrame) -> DataFrame:
    """Fill a missing INN from a table (ogrn, inn) with unique ``ogrn``; nothing is overwritten.

    No broadcast hint: the planner broadcasts the table when its size allows and
    otherwise joins by shuffle. Records without a key get one of their own that finds
    no partner, so that they do not all meet in one task.
    """
    root = F.col(N.ROOT)
    cert_ogrn = X.digits_only(N.effective_root("EduOrgOGRN"))
    root_ogrn = X.digits_only(N.effective(root, "OGRN"))
    key = F.when(~F.coalesce(cert_ogrn != root_ogrn, F.lit(False)), F.coalesce(cert_ogrn, root_ogrn))
    alone = F.concat(F.lit("-"), F.col("_record_seq").cast("string")) if "_record_seq" in df.columns else F.concat(F.lit("-"), F.xxhash64("Id").cast("string"))
    joined = df.withColumn("_key", F.coalesce(key, alone)).join(
        overrides.select(F.col("ogrn").alias("_key"), F.col("inn").alias("_inn")), "_key", "left")
    found = F.col("_inn").isNotNull()
    to_cert = found & X.digits_only(N.effective_root("EduOrgINN")).isNull()
    to_root = found & root.isNotNull() & X.digits_only(N.effective(root, "INN")).isNull()
    return joined.withColumns({
        "_derived": N.derived(F.col("_derived"), S.CERTIFICATE_DERIVED,
                              EduOrgINN=F.when(to_cert, F.col("_inn")).otherwise(F.col("_derived")["EduOrgINN"])),
        N.ROOT: N.with_derived(root, S.ORGANIZATION_DERIVED,
                               INN=F.when(to_root, F.col("_inn")).otherwise(root["_derived"]["INN"])),
        "override_records": (to_cert | to_root).cast("int"),
        "override_eduorg_inn": to_cert.cast("int"),
        "override_root_inn": to_root.cast("int"),
    }).drop("_key", "_inn")


def fill_degenerate_shells(df: DataFrame) -> DataFrame:
    """A supplement card with neither INN nor OGRN in digits takes all three ids from the donors."""
    root = F.col(N.ROOT)
    keys = ["INN", "OGRN", "KPP"]
    df = df.withColumns({f"_donor_{k}": N.donor(root, k) for k in keys})

    def is_shell(card: Column) -> Column:
        return (card.isNotNull() & X.digits_only(N.effective(card, "INN")).isNull()
                & X.digits_only(N.effective(card, "OGRN")).isNull())

    def takes(card: Column, key: str) -> Column:
        has = F.col(f"_donor_{key}").isNotNull()
        return has & N.missing(card, key) if key == "KPP" else has

    def fill(s: Column) -> Column:
        card = s[N.ROOT]
        values = {k: F.when(is_shell(card) & takes(card, k), F.col(f"_donor_{k}")).otherwise(card["_derived"][k]) for k in keys}
        return s.withField(N.ROOT, N.with_derived(card, S.ORGANIZATION_DERIVED, **values))

    counters = {f"shell_{k.lower()}": N.count_where(
        N.supplements(), lambda s, k=k: is_shell(s[N.ROOT]) & takes(s[N.ROOT], k)) for k in keys}
    counters["shell_cards"] = N.count_where(
        N.supplements(), lambda s: is_shell(s[N.ROOT]) & (takes(s[N.ROOT], "INN") | takes(s[N.ROOT], "OGRN") | takes(s[N.ROOT], "KPP")))
    return df.withColumns({N.SUPPLEMENTS: F.transform(N.supplements(), fill), **counters}).drop(*[f"_donor_{k}" for k in keys])


def _level_missing(p: Column) -> Column:
    return X.is_blank(N.effective(p, "EduLevelName"))


def level_from_name(df: DataFrame) -> DataFrame:
    """A programme without a level whose name is a level name takes that name as its level."""
    name = lambda p: X.strip(p["ProgrammName"])
    implied = lambda p: _level_missing(p) & F.coalesce(name(p).isin(LEVELS_NAMED_LIKE_PROGRAMS), F.lit(False))
    rule = lambda p: N.with_derived(p, S.PROGRAM_DERIVED, EduLevelName=F.when(
        implied(p), name(p)).otherwise(p["_derived"]["EduLevelName"]))
    return df.withColumns({
        N.SUPPLEMENTS: N.each_program(lambda ps: F.transform(ps, rule)),
        "level_from_name": N.count_where(N.all_programs(), implied),
    })


def is_stub_program(p: Column) -> Column:
    return X.programm_code_key(p["ProgrammCode"]).isNull() & X.is_blank(p["ProgrammName"]) & _level_missing(p)


def strip_stub_programs(df: DataFrame) -> DataFrame:
    """Drop programmes without a code, a name and a level."""
    return df.withColumns({
        N.SUPPLEMENTS: N.each_program(lambda ps: F.filter(ps, lambda p: ~is_stub_program(p))),
        "stripped_stub_programs": N.count_where(N.all_programs(), is_stub_program),
    })


def map_levels(df: DataFrame, levels: LevelMap = LevelMap()) -> DataFrame:
    """Bring level names to the canonical list; explicit entries win over canonical identity."""
    raw = lambda p: X.nonblank(N.effective(p, "EduLevelName"))
    cleared = lambda p: levels.is_cleared(raw(p))
    renamed = lambda p: F.coalesce(levels.target(raw(p)) != raw(p), F.lit(False))

    def rule(p: Column) -> Column:
        value = F.when(cleared(p), F.lit(None)).when(renamed(p), levels.target(raw(p))).otherwise(p["_derived"]["EduLevelName"])
        kept = p.withField("EduLevelName", F.when(~cleared(p), p["EduLevelName"]))
        return kept.withField("_derived", N.derived(p["_derived"], S.PROGRAM_DERIVED, EduLevelName=value))

    return df.withColumns({
        N.SUPPLEMENTS: N.each_program(lambda ps: F.transform(ps, rule)),
        "levels_renamed": N.count_where(N.all_programs(), renamed),
        "levels_cleared": N.count_where(N.all_programs(), cleared),
        "levels_unknown": N.count_where(N.all_programs(), lambda p: levels.is_unknown(raw(p))),
    })


def mark_branches(df: DataFrame) -> DataFrame:
    """``IsBranchSupplement`` / ``HasBranchSupplements``. Ids are compared as written here."""
    root_id = F.col(N.ROOT)["Id"]

    def is_branch(s: Column) -> Column:
        other_card = root_id.isNotNull() & s[N.ROOT].isNotNull() & ~s[N.ROOT]["Id"].eqNullSafe(root_id)
        return F.coalesce(s["IsForBranch"], F.lit(False)) | other_card

    df = df.withColumn(N.SUPPLEMENTS, F.transform(
        N.supplements(), lambda s: N.with_derived(s, S.SUPPLEMENT_DERIVED, IsBranchSupplement=is_branch(s))))
    has = F.exists(N.supplements(), lambda s: s["_derived"]["IsBranchSupplement"])
    return df.withColumn("_derived", N.derived(F.col("_derived"), S.CERTIFICATE_DERIVED, HasBranchSupplements=has))
