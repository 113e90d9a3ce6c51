"""Helpers for rules that look into a nested record.

A record keeps originals and derived values apart: ``x._derived.K`` holds what a
repair step filled in, ``x.K`` stays as delivered. Reading goes through
``effective``; writing replaces the small ``_derived`` struct only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certweave import schema as S
from certweave.functions.text import digits_only, is_blank, uid_token

ROOT = S.ORGANIZATION
SUPPLEMENTS = "Supplements"
PROGRAMS = "EducationalPrograms"


def effective(obj: Column, key: str) -> Column:
    return F.coalesce(obj["_derived"][key], obj[key])


def effective_root(key: str) -> Column:
    """Effective value of a certificate field (certificate fields are top-level columns)."""
    return F.coalesce(F.col("_derived")[key], F.col(key)) if key in S.CERTIFICATE_DERIVED else F.col(key)


def derived(obj_derived: Column, members: dict[str, str], **values: Column) -> Column:
    """The ``_derived`` struct with some members replaced; works when it was null before."""
    return F.struct(*[(values[m] if m in values else obj_derived[m]).cast(t).alias(m) for m, t in members.items()])


def with_derived(obj: Column, members: dict[str, str], **values: Column) -> Column:
    """``obj`` with derived members set; a null ``obj`` stays null."""
    return obj.withField("_derived", derived(obj["_derived"], members, **values))


def missing(card: Column, key: str) -> Column:
    return is_blank(effective(card, key))


def same_org(root: Column, card: Column) -> Column:
    """Both ids set and equal, and the head ids do not contradict each other."""
    rh, sh = uid_token(root["HeadEduOrgId"]), uid_token(card["HeadEduOrgId"])
    heads_agree = F.coalesce(rh == sh, F.lit(True))
    return F.coalesce((uid_token(root["Id"]) == uid_token(card["Id"])) & heads_agree, F.lit(False))


def different_org(root: Column, card: Column) -> Column:
    """Both ids set and unequal; head ids play no part."""
    return F.coalesce(uid_token(root["Id"]) != uid_token(card["Id"]), F.lit(False))


def id_relation(root: Column, card: Column) -> Column:
    """``same_Id`` / ``different_Id`` / ``incomparable_Id`` by the id alone."""
    rid, sid = uid_token(root["Id"]), uid_token(card["Id"])
    return F.when(rid == sid, "same_Id").when(rid != sid, "different_Id").otherwise("incomparable_Id")


def donor(root: Column, key: str) -> Column:
    """Digits a supplement card may borrow: root card first, then the certificate's own field."""
    return F.coalesce(digits_only(effective(root, key)), digits_only(effective_root(f"EduOrg{key}")))


def supplements() -> Column:
    return F.coalesce(F.col(SUPPLEMENTS), F.array().cast(S.record_type()[SUPPLEMENTS].dataType))


def programs_of(sup: Column) -> Column:
    return F.coalesce(sup[PROGRAMS], F.array().cast(S.supplement_type()[PROGRAMS].dataType))


def items(array: Column) -> Column:
    """An array as input of ``explode``: its non-null items.

    Handing ``explode`` a plain column lets the optimizer infer a ``size(...) > 0``
    filter and push it down through every repair step, copying the expression of
    the step each time. An expression input keeps the plan as it was written.
    """
    return F.filter(array, lambda x: x.isNotNull())


def placed(array: Column) -> Column:
    """An array as input of ``inline``: (place, item) of its non-null items. Null items keep their places; nobody else takes them."""
    at = F.transform(array, lambda x, i: F.struct(i.alias("place"), x.alias("item")))
    return F.filter(at, lambda x: x["item"].isNotNull())


def all_programs() -> Column:
    return F.flatten(F.transform(supplements(), programs_of))


def each_program(rule: Callable[[Column], Column]) -> Column:
    """``Supplements`` with ``rule`` applied to every programme array."""
    return F.transform(supplements(), lambda s: s.withField(PROGRAMS, rule(programs_of(s))))


def count_where(items: Column, condition: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(items, lambda x: F.coalesce(condition(x), F.lit(False))))


def first_value(items: Column) -> Column:
    """First non-null item of an array, or null."""
    return F.try_element_at(F.filter(items, lambda x: x.isNotNull()), F.lit(1))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Name an intermediate array expression inside a lambda so that it is evaluated once."""
    return F.transform(F.array(value), body)[0]


def with_computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters do not look through.

    A filter on a value that came out of several repair steps would be pushed
    below all of them, with each step's expression copied into it. A one-item
    ``explode`` keeps the value as it is; it costs one row copy.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def settled(df: DataFrame) -> DataFrame:
    """The same rows; filters on them stay above. For queries right behind a long projection that is not stored first."""
    return df.select(F.inline(F.array(F.struct("*"))))
