"""Records to five keyed tables. Exploding is narrow; only key checks shuffle."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certweave import schema as S
from certweave.functions import nested as N
from certweave.functions import text as X

KEYS = {
    "certificates": ["certificate_id"],
    "supplements": ["certificate_id", "supplement_id"],
    "decisions": ["certificate_id", "decision_id"],
    "educational_programs": ["certificate_id", "supplement_id", "program_slot"],
    "actual_education_organizations": ["certificate_id", "ae_scope", "supplement_id", "aeo_id"],
}
NULLABLE_KEY_COLUMNS = {"actual_education_organizations": ["supplement_id"]}
# child table -> (columns, parent table); a null child value needs no parent
FOREIGN_KEYS = [
    ("supplements", ["certificate_id"], "certificates"),
    ("decisions", ["certificate_id"], "certificates"),
    ("educational_programs", ["certificate_id", "supplement_id"], "supplements"),
    ("actual_education_organizations", ["certificate_id"], "certificates"),
    ("actual_education_organizations", ["certificate_id", "supplement_id"], "supplements"),
]
WRITE_ORDER = list(KEYS)


def column_name(field: str) -> str:
    """``EduOrgINN`` -> ``edu_org_inn``; runs of capitals stay together."""
    return re.sub(r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", field).lower()


def _fields(obj: Column | None, names: list[str], effective: dict[str, str] | None) -> list[Column]:
    out = []
    for n in names:
        c = F.col(n) if obj is None else obj[n]
        if effective and n in effective:
            c = F.coalesce((F.col("_derived") if obj is None else obj["_derived"])[n], c)
        out.append(c.alias(column_name(n)))
    return out


def certificates(records: DataFrame, use_effective: bool = False) -> DataFrame:
    eff = S.CERTIFICATE_DERIVED if use_effective else None
    return records.select(F.col("Id").alias("certificate_id"), *_fields(None, S.CERTIFICATE_FIELDS[1:], eff))


def _supplement_rows(records: DataFrame) -> DataFrame:
    return records.select(F.col("Id").alias("certificate_id"), F.explode(N.items(N.supplements())).alias("s"))


def supplements(records: DataFrame) -> DataFrame:
    s = F.col("s")
    return _supplement_rows(records).select(
        "certificate_id", s["Id"].alias("supplement_id"), *_fields(s, S.SUPPLEMENT_FIELDS[1:], None))


def decisions(records: DataFrame) -> DataFrame:
    """Only items with a non-blank id; the record itself is kept either way."""
    named = F.filter(F.col("Decisions"), lambda d: ~X.is_blank(d["Id"]))
    d = F.col("d")
    return records.select(F.col("Id").alias("certificate_id"), F.explode(named).alias("d")).select(
        "certificate_id", d["Id"].alias("decision_id"), *_fields(d, S.DECISION_FIELDS[1:], None))


def programs(records: DataFrame, use_effective: bool = False) -> DataFrame:
    """``program_slot`` is the position in the supplement's array: programme ids can repeat."""
    p = F.col("p")
    eff = S.PROGRAM_DERIVED if use_effective else None
    rows = _supplement_rows(records).select(
        "certificate_id", F.col("s.Id").alias("supplement_id"),
        F.inline(N.placed(N.programs_of(F.col("s")))).alias("program_slot", "p"))
    return rows.select("certificate_id", "supplement_id", "program_slot", p["Id"].alias("program_id"),
                       *_fields(p, S.PROGRAM_FIELDS[1:], eff))


def organizations(records: DataFrame, use_effective: bool = False) -> DataFrame:
    """Root and supplement cards with an id; one explode over both, so records are read once."""
    cards = F.concat(
        F.array(F.struct(F.lit("certificate").alias("ae_scope"), F.lit(None).cast("string").alias("supplement_id"),
                         F.col(N.ROOT).alias("a"))),
        F.transform(F.filter(N.supplements(), lambda s: s["Id"].isNotNull()), lambda s: F.struct(
            F.lit("supplement").alias("ae_scope"), s["Id"].alias("supplement_id"), s[N.ROOT].alias("a"))),
    )
    wanted = F.filter(cards, lambda c: c["a"]["Id"].isNotNull())
    a = F.col("x.a")
    eff = S.ORGANIZATION_DERIVED if use_effective else None
    return records.where(~X.is_blank(F.col("Id"))).select(
        X.strip(F.col("Id")).alias("certificate_id"), F.explode(wanted).alias("x")).select(
        "certificate_id", "x.ae_scope", "x.supplement_id", a["Id"].alias("aeo_id"),
        *_fields(a, S.ORGANIZATION_FIELDS[1:], eff))


def tables(records: DataFrame, use_effective: bool = False) -> dict[str, DataFrame]:
    return {
        "certificates": certificates(records, use_effective),
        "supplements": supplements(records),
        "decisions": decisions(records),
        "educational_programs": programs(records, use_effective),
        "actual_education_organizations": organizations(records, use_effective),
    }


def adapt_scalar(c: Column, dtype: str, sql_type: str, integer_booleans: bool = False) -> Column:
    """A value of the given Spark type as the target column type wants it."""
    if sql_type == "BOOLEAN":
        if dtype == "boolean":
            b = c
        elif dtype == "string":
            b = F.when(X.strip(c) == "1", F.lit(True)).when(X.strip(c) == "0", F.lit(False))
        else:
            b = F.when(c == 1, F.lit(True)).when(c == 0, F.lit(False))
        return b.cast("int") if integer_booleans else b
    if dtype.startswith(("struct", "array", "map")):
        return F.to_json(c)
    return c.cast("string") if sql_type in ("DATE", "TEXT") else c


def key_violations(tabs: dict[str, DataFrame]) -> DataFrame:
    """(table_name, violation, n): duplicate keys, null key members, missing parents.

    A table is read once for its own key: rows per key are counted with partial
    sums, so a hot key is one row per task. Nulls compare equal there, which is
    what a nullable key member needs.
    """
    parts = []

    def rows(name: str, found: DataFrame, *violations: str) -> None:
        pairs = F.explode(F.array(*[F.struct(F.lit(v).alias("violation"), F.coalesce(F.col(v), F.lit(0)).cast("bigint").alias("n")) for v in violations]))
        parts.append(found.select(F.lit(name).alias("table_name"), pairs.alias("x")).select("table_name", "x.*"))

    for name, keys in KEYS.items():
        required = [k for k in keys if k not in NULLABLE_KEY_COLUMNS.get(name, [])]
        any_null = F.lit(False)
        for k in required:
            any_null = any_null | F.col(k).isNull()
        per_key = tabs[name].groupBy(*keys).count()
        rows(name, per_key.agg(
            F.sum(F.when(any_null, F.col("count"))).alias("null_key"), F.count_if(~any_null & (F.col("count") > 1)).alias("duplicate_key")),
            "null_key", "duplicate_key")
    for child, cols, parent in FOREIGN_KEYS:
        per_key = tabs[child].select(*cols).where(" and ".join(f"{c} is not null" for c in cols)).groupBy(*cols).count()
        orphans = per_key.join(tabs[parent].select(*cols).distinct(), cols, "left_anti")
        violation = "orphan_of_" + parent + ("_pair" if len(cols) > 1 else "")
        rows(child, orphans.agg(F.sum("count").alias(violation)), violation)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def is_loadable() -> Column:
    """True when no row of the record itself would break a key."""
    def unique(ids: Column) -> Column:
        return F.size(ids) == F.size(F.array_distinct(ids))

    sup_ids = F.transform(N.items(N.supplements()), lambda s: s["Id"])
    dec_ids = F.transform(F.filter(F.col("Decisions"), lambda d: ~X.is_blank(d["Id"])), lambda d: d["Id"])
    return F.col("Id").isNotNull() & ~F.exists(sup_ids, lambda x: x.isNull()) & unique(sup_ids) & F.coalesce(unique(dec_ids), F.lit(True))


def loadable_records(records: DataFrame) -> DataFrame:
    """Records that load as a whole; of repeated ids the first loadable one stays.

    Only ids that really repeat matter: their first sequence numbers form a small
    table, and records join it without being shuffled as long as AQE can
    broadcast it. A repeated id never gathers whole records in one place.
    """
    good = records.where(is_loadable())
    repeated = good.groupBy("Id").agg(F.min("_record_seq").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return good.join(repeated, "Id", "left").where("_first is null or _first = _record_seq").drop("_first")
