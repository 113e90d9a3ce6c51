"""DuckDB text of a record's whole JSON: every level, empty members left out."""

from __future__ import annotations

from collections.abc import Callable

from certweave import schema as S
from certweave.plans.catalog.sqltext import blank, code, digits

Rule = Callable[[str, str], str]
# Texts that mean no value.
PLACEHOLDERS = "('', '-', '—', '–', 'н/д', 'нд', 'нет данных', 'null', 'none')"


def as_is(field: str, x: str) -> str:
    return x if field in S.BOOL_FIELDS else f"(case when not {blank(x)} then {x} end)"


def cleaned(field: str, x: str) -> str:
    """The field's value after cleaning and typing."""
    if field in S.BOOL_FIELDS:
        return x
    text = f"(case when lower(trim({x})) not in {PLACEHOLDERS} then trim({x}) end)"
    if field in S.ID_NUMBER_FIELDS:
        return digits(text)
    return code(text) if field in S.CODE_FIELDS else text


def _object(parts: list[str]) -> str:
    inner = f"array_to_string([{', '.join(parts)}], ',')"  # nulls are left out
    return f"(case when {inner} <> '' then '{{' || {inner} || '}}' end)"


def _member(name: str, json: str) -> str:
    return f"'\"{name}\":' || {json}"


def _scalars(fields: list[str], prefix: str, rule: Rule) -> list[str]:
    return [_member(f, f"cast(to_json({rule(f, prefix + f)}) as varchar)") for f in fields]


def _derived(members: dict[str, str]) -> list[str]:
    return [_member("_derived", _object([_member(n, f"cast({x} as varchar)") for n, x in members.items()]))] if members else []


def record_json(rule: Rule, *, branches: bool = False) -> str:
    """CTEs behind the views ``cert``, ``sup``, ``prog``, ``dec`` that end in ``whole`` (k, value).

    branches: with the branch marks, from the views ``is_branch`` of ``marked`` (k, i).
    """
    card = lambda prefix: _object(_scalars(S.ORGANIZATION_FIELDS, prefix, rule))
    has = lambda flag, json: f"(case when {flag} then {json} end)"
    programme = _object(_scalars(S.PROGRAM_FIELDS, "", rule))
    sup = _scalars(S.SUPPLEMENT_FIELDS, "s.", rule) + [
        _member(S.ORGANIZATION, has("s.has_card", card("s.a_"))), _member("EducationalPrograms", "('[' || p.items || ']')"),
        *_derived({"IsBranchSupplement": "s.is_branch"} if branches else {})]
    cert = _scalars(S.CERTIFICATE_FIELDS, "c.", rule) + [
        _member(S.ORGANIZATION, has("c.has_root", card("c.r_"))), _member("Supplements", "('[' || s.items || ']')"), _member("Decisions", "('[' || d.items || ']')"),
        *_derived({"HasBranchSupplements": "coalesce(s.any_branch, false)"} if branches else {})]
    marked = "bool_or(s.is_branch)" if branches else "null"
    return f""",
        pj as (select k, i, string_agg({programme}, ',' order by j) as items from prog group by k, i),
        sj as (select s.k, string_agg({_object(sup)}, ',' order by s.i) as items, {marked} as any_branch from {'marked' if branches else 'sup'} s left join pj p on p.k = s.k and p.i = s.i group by s.k),
        dj as (select k, string_agg({_object(_scalars(S.DECISION_FIELDS, '', rule))}, ',' order by x) as items from dec group by k),
        whole as (select c.k, {_object(cert)} as value from cert c left join sj s on s.k = c.k left join dj d on d.k = c.k)"""
