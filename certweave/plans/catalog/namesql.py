"""DuckDB text of the word-level name rules, as steps over tables of texts."""

from __future__ import annotations

from certweave.functions import orgnames as O

_INITIALISM = "^([А-ЯЁA-Za-z]\\.){2,}$"
_CORE = "^([А-ЯЁA-Z]\\.)+[А-ЯЁA-Z]?\\.?$"
_ROMAN = "(?i)^[IVXLCDM]{1,8}$"
_PARTS = "(?s)^([^\\p{L}]*)(.*?)([^\\p{L}]*)$"
_SMALL = ", ".join(f"'{w}'" for w in O.SMALL_WORDS)


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def initials_spacing(x: str) -> str:
    two = f"regexp_replace({collapse(x)}, '([А-ЯЁA-Za-z])\\s*\\.\\s*([А-ЯЁA-Za-z])\\s*\\.', '\\1.\\2.', 'g')"
    return collapse(f"regexp_replace({two}, '([А-ЯЁA-Z]\\.[А-ЯЁA-Z]\\.)([А-ЯЁA-Z][а-яё]{{2,}}|[А-ЯЁA-Z]{{4,}})', '\\1 \\2', 'g')")


def _upper(w: str) -> str:
    return f"({w} = upper({w}) and {w} <> lower({w}))"


def _first_up(x: str) -> str:
    pattern = "(?s)^([^\\p{L}]*)(\\p{L})(.*)$"
    part = lambda g: f"regexp_extract({x}, '{pattern}', {g})"
    return f"case when regexp_matches({x}, '{pattern}') then {part(1)}||upper({part(2)})||{part(3)} else {x} end"


def _capitalized(x: str) -> str:
    return f"upper(substr({x}, 1, 1))||lower(substr({x}, 2))"


def _title_word(p: str, first: str, stays: str) -> str:
    core = f"regexp_extract({p}, '{_PARTS}', 2)"
    recased = (f"case when lower({core}) in ({_SMALL}) then case when {first} then {_capitalized(core)} else lower({core}) end "
               f"when regexp_matches({core}, '^\\p{{L}}+$') and {_upper(core)} then case when {stays} and length({core}) <= {O.SHORT_CAPS} then {core} else {_capitalized(core)} end "
               f"else {_first_up(core)} end")
    same = f"regexp_matches({p}, '{_INITIALISM}') or regexp_matches({p}, '\\p{{Nd}}') or {core} = '' or regexp_matches({core}, '{_CORE}') or regexp_matches({core}, '{_ROMAN}')"
    return f"case when {same} then {p} else regexp_extract({p}, '{_PARTS}', 1)||({recased})||regexp_extract({p}, '{_PARTS}', 3) end"


def title(x: str, stays: str) -> str:
    """x: initials spaced already."""
    word = f"array_to_string(list_transform(string_split(w, '-'), lambda p, j: {_title_word('p', '(i = 1 and j = 1)', stays)}), '-')"
    return f"case when {x} = '' then {x} else array_to_string(list_transform(string_split({x}, ' '), lambda w, i: {word}), ' ') end"


def kinds(source: str, name: str) -> str:
    """CTEs that end in ``name`` (t, x, kind): the text, its initials spaced, how much is in capitals."""
    words = f"string_split({collapse('x')}, ' ')"
    return f"""{name}_x as (select t, {initials_spacing('t')} as x from {source}),
    {name}_w as (select t, x, list_filter(list_transform(list_filter({words}, lambda w: not regexp_matches(w, '{_INITIALISM}')), lambda w: regexp_extract(w, '{_PARTS}', 2)),
        lambda w: w <> '' and not regexp_matches(w, '\\p{{Nd}}')) as cs, len(list_filter({words}, lambda w: regexp_matches(w, '{_INITIALISM}'))) as initials from {name}_x),
    {name}_e as (select *, len(list_filter(cs, lambda w: not {_upper('w')})) = 0 as every from {name}_w),
    {name} as (select t, x, case when len(list_filter(cs, lambda w: not regexp_matches(w, '^\\p{{L}}+$'))) > 0 then 'none' when len(cs) >= 2 and every then 'all'
        when len(cs) >= 2 and len(list_filter(cs, lambda w: {_upper('w')} and length(w) >= {O.SHORT_CAPS})) > 0 then 'mixed'
        when len(cs) = 1 and initials >= 1 and every and length(cs[1]) > {O.SHORT_CAPS} then 'all' else 'none' end as kind from {name}_e)"""


def readable(source: str, name: str) -> str:
    """CTEs that end in ``name`` (t, r): every text of ``source`` (t) in readable capitals."""
    return kinds(source, f"{name}_k") + f""",
    {name} as (select t, case when kind = 'none' then {_first_up('x')} else {title('x', "kind = 'all'")} end as r from {name}_k)"""


def displayed(names: str, ab: str, fn: str, canonical: str, tail: str) -> str:
    """CTEs that end in ``shown`` (name, display_name) for the table ``names`` (name).

    ab, fn: patterns of a leading abbreviation and form name; canonical: SQL of the form
    name's spelling over ``regexp_extract(name, fn, 1)``; tail: pattern of a name's tail.
    """
    straight = "translate(trim(name), '“”„«»‘’', '\"\"\"\"\"''''')"
    inside = f"regexp_replace({straight}, '\"\\s*([^\"]*?)\\s*\"', '\"\\1\"', 'g')"
    for _ in range(3):
        inside = f"regexp_replace({inside}, '\"\"([^\"]*?)\"\"', '\\1', 'g')"
    typed = collapse(f"regexp_replace(translate(regexp_replace({inside}, '\"\"+', '', 'g'), '–—', '--'), '№\\s*([0-9])', '№ \\1', 'g')")
    quoted = "(?s)^(.*?)\\s*\"([^\"]*)\"\\s*(.*)$"
    part = lambda g: f"trim(regexp_extract(x, '{quoted}', {g}))"
    hint = ("(?i)(^|\\s)(сош|средн[\\p{L}]+\\s+общеобразовательн[\\p{L}]+\\s+школ|школ|лице|гимнази|колледж|техникум|училищ|детск[\\p{L}]+\\s+сад|апк|по([^\\p{L}\\p{N}_]|$))")
    behind = lambda c, r: f"ltrim(substr({c}, length(regexp_extract({c}, '{r}', 1)) + 1))"
    spelled = lambda c: canonical.replace("(name,", f"({c},")
    cut = lambda c: f"trim(regexp_extract({c}, '^(.*?){tail}', 1))"
    return f"""typed as (select name, {collapse(typed)} as x from {names}),
    hits as (select *, regexp_matches(x, '{quoted}') and {part(2)} <> '' as quoted, regexp_matches(x, '{ab}') as ab, regexp_matches(x, '{fn}') as fn,
        trim(case when regexp_matches(x, '{ab}') then {behind('x', ab)} when regexp_matches(x, '{fn}') then {behind('x', fn)} else '' end) as rest from typed),
    reading as (select name, x, case when quoted then 'form' when ab or fn then 'form' when regexp_matches(x, '{hint}') and not contains(x, '"') then 'name_only' else 'plain' end as shape,
        case when quoted then {part(1)} when ab then upper(regexp_extract(x, '{ab}', 1)) when fn then {spelled('x')} else '' end as form,
        case when quoted then {collapse(part(2))} when ab or fn then case when regexp_matches(rest, '{tail}') then {cut('rest')} else rest end else x end as nm,
        case when quoted then {part(3)} when (ab or fn) and regexp_matches(rest, '{tail}') then trim(substr(rest, length(regexp_extract(rest, '^(.*?){tail}', 1)) + 1)) else '' end as tail from hits),
    forms as (select *, regexp_matches(form, '{ab}') as fab, regexp_matches(form, '{fn}') as ffn, {behind('form', ab)} as rab, {behind('form', fn)} as rfn from reading),
    picked as (select *, case when fab and (rab = '' or not ffn) then upper(regexp_extract(form, '{ab}', 1)) when ffn then {spelled('form')} end as pform,
        case when fab and (rab = '' or not ffn) then rab when ffn then rfn end as prest from forms),
    texts as (select distinct t from (select nm as t from picked union all select tail from picked union all select prest from picked where prest <> '')),
    {readable('texts', 'rd')},
    once as (select p.*, a.r as n1, b.r as t1, c.r as f1 from picked p join rd a on a.t = p.nm join rd b on b.t = p.tail left join rd c on c.t = p.prest),
    again as (select distinct n1 as t from once where shape = 'name_only'),
    {readable('again', 'rda')},
    parts as (select name, shape, case when pform is null then {_first_up('form')} when prest = '' then pform else pform||' '||f1 end as f, case when shape = 'name_only' then a.r else n1 end as n, t1 as t
        from once left join rda a on a.t = n1),
    whole as (select *, array_to_string(list_filter([f, case when n <> '' then '"'||n||'"' else '' end, t], lambda w: w <> ''), ' ') as w from parts),
    done as (select name, case when shape = 'plain' then n when n <> '' and t = '' then w else {collapse('w')} end as d from whole),
    shown as (select name, case when d <> '' then d else trim(name) end as display_name from done)"""
