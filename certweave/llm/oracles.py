"""DuckDB text of the queries that SQL can express."""

from __future__ import annotations

from . import licences

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


def _pick(step: int, gap: str, left: str, taken: list[int]) -> str:
    """One more document of each source behind its cut: the best by gap, then key."""
    gone = "".join(f" and not exists (select 1 from p{n} g where g.source is not distinct from k.source and g.key = k.key)" for n in taken)
    return f"""
    p{step} as (select source, key, size, rest from (
        select k.source, k.key, k.size, l.rest, row_number() over (partition by k.source order by {gap}, k.key) as place
        from keys k join cuts c on c.source is not distinct from k.source join {left} l on l.source is not distinct from k.source
        where k.key >= c.cut and k.size > 0 and {gap} >= 0 and {gap} < l.rest{gone}) where place = 1),
    l{step} as (select l.source, coalesce(p.rest - p.size, l.rest) as rest from {left} l left join p{step} p on p.source is not distinct from l.source)"""


OP1 = rf"""
    with recursive docs as (select doc_id, source, {_WORDS} as size, md5(concat_ws('|', '42', cast(doc_id as varchar), text)) as key from documents),
    keys as (select source, key, sum(size) as size from docs group by 1, 2),
    sources as (select source, cast(sum(size) as double) as size, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0 when 1 then 2.0 else 1.0 end as w
        from keys group by source),
    levels as (select 0 as step, cast(0 as double) as level
        union all select step + 1, greatest(level, coalesce(((select sum(size) from sources) - sum(case when 3 * size < w * level then 3 * size else 0 end))
            / nullif(sum(case when 3 * size < w * level then 0 else w end), 0), level)) from levels, sources where step < 60 group by step, level),
    todo as (select source, size, least(3 * size, w * level) as target from sources, (select max(level) as level from levels)),
    rests as (select source, size, target, case when size > 0 then floor(target / size) else 0 end as whole,
        target - (case when size > 0 then floor(target / size) else 0 end) * size as rest from todo),
    running as (select k.source, k.key, k.size, r.rest, sum(k.size) over (partition by k.source order by k.key) as upto
        from keys k join rests r on r.source is not distinct from k.source where r.rest > 0),
    cuts as (select source, min(key) as cut, arg_min(rest - upto + size, key) as rest from running where upto > rest group by source),
    {_pick(1, 'case when k.size <= l.rest then l.rest - k.size end', 'cuts', [])},
    {_pick(2, 'case when k.size <= l.rest then l.rest - k.size end', 'l1', [1])},
    {_pick(3, 'abs(k.size - l.rest)', 'l2', [1, 2])},
    picks as (select source, key from p1 union all select source, key from p2 union all select source, key from p3)
    select d.doc_id, cast(d.size as bigint) as size, cast(r.size as bigint) as source_size, r.target,
        cast(d.size * (r.whole + case when d.key < c.cut or p.key is not null then 1 else 0 end) as bigint) as taken
    from docs d join rests r on r.source is not distinct from d.source left join cuts c on c.source is not distinct from d.source
        left join picks p on p.source is not distinct from d.source and p.key = d.key"""


def _judged(address: str, rules: list[tuple[str, str]]) -> tuple[str, str]:
    names, verdicts = "", ""
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        host, slash, rest = rule.partition("/")
        fits = f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{slash + rest}') then "
        names, verdicts = names + fits + f"'{rule}' ", verdicts + fits + f"'{verdict}' "
    return f"case {names}end", f"case {verdicts}end"


def op2(rules: list[tuple[str, str]], order: int = 4) -> str:
    rule, verdict = _judged("address", rules)
    steps = ""
    for n in range(order + 1):
        shorter = f"(select tail, pa, pr from s{n - 1})" if n else "(select '' as tail, cast(1 as double) / 256 as pa, cast(1 as double) / 256 as pr)"
        part = lambda c: (f"case when x.n{c} = 0 then b.p{c} else (t.{c} + x.k{c} * b.p{c}) / (x.n{c} + x.k{c}) end")
        steps += f"""
    t{n} as (select right(gram, {n + 1}) as tail, left(right(gram, {n + 1}), {n}) as before, cast(sum(a) as double) as a, cast(sum(r) as double) as r from grams group by 1, 2),
    x{n} as (select before, sum(a) as na, sum(r) as nr, cast(count(*) filter (a > 0) as double) as ka, cast(count(*) filter (r > 0) as double) as kr from t{n} group by 1),
    s{n} as (select t.tail, {part('a')} as pa, {part('r')} as pr from t{n} t join x{n} x on x.before = t.before join {shorter} b on b.tail = right(t.tail, {n})),"""
    return rf"""
    with pg as (select page_id, coalesce(url, '') as address from pages),
    parts as (select distinct address, translate(regexp_extract(address, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(address, '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path, regexp_extract(address, '(?s)^.*?://[^/?#]*(.*)$', 1) as rest from pg),
    urls as (select address, host, path, {rule} as rule, {verdict} as ruled, left(md5(address), 1) in ('0', '1', '2') as held,
        case when contains(address, '://') then host || rest else address end as body from parts),
    places as (select address, ruled, held, substr(repeat(chr(2), {order}) || body || chr(3), i, {order + 1}) as gram
        from (select *, unnest(range(1, length(body) + 2)) as i from urls)),
    grams as (select gram, count(*) filter (ruled = 'allow' and not held) as a, count(*) filter (ruled = 'block' and not held) as r from places group by 1),{steps}
    scores as (select tail as gram, cast(round((ln(pa) - ln(pr)) * 1000000) as bigint) as score from s{order}),
    scored as (select address, cast(floor(cast(sum(score) as double) / count(*)) as bigint) as score from places join scores using (gram) group by 1),
    bins as (select greatest(-20000, least(20000, floor(s.score / 1000.0))) as bin, count(*) filter (ruled = 'allow') as a, count(*) filter (ruled = 'block') as b
        from scored s join urls using (address) where held and ruled is not null group by 1),
    sums as (select bin, coalesce(floor((bin + lag(bin) over (order by bin)) / 2.0), bin) as middle, (sum(a) over () - coalesce(sum(a) over before, 0)) / nullif(cast(sum(a) over () as double), 0)
        + coalesce(sum(b) over before, 0) / nullif(cast(sum(b) over () as double), 0) as good from bins window before as (order by bin rows between unbounded preceding and 1 preceding)),
    least_ as (select coalesce((select cast(middle * 1000 as bigint) from sums where good is not null order by good desc, bin limit 1), 0) as cutoff)
    select page_id, host, path, rule, coalesce(ruled, case when score >= cutoff then 'allow' else 'block' end) as verdict, score
    from pg join urls using (address) join scored using (address), least_"""


def _canonical(text: str) -> str:
    quoted = lambda s: s.replace("'", "''")
    out = f"regexp_replace(lower(coalesce({text}, '')), '{licences.COPYRIGHT_LINE}', '', 'g')"
    out = f"' ' || trim(regexp_replace({out}, '{licences.NO_LETTER}', ' ', 'g')) || ' '"
    for spelled, as_ in licences.SPELLINGS:
        out = f"replace({out}, ' {quoted(spelled)} ', ' {quoted(as_)} ')"
    return f"trim({out})"


def op3() -> str:
    known = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licences.KNOWN)
    return f"""
    with known as (select md5({_canonical('text')}) as digest, min(licence) as licence from (values {known}) t(licence, text) group by 1),
    docs as (select row_number() over () as n, doc_id, text, md5({_canonical('text')}) as digest from documents),
    lines as (select n, md5({_canonical('line')}) as digest from (select n, unnest(string_split(coalesce(text, ''), chr(10))) as line from docs)),
    found as (select n, string_agg(distinct licence, ',' order by licence) as notices, count(*) as n_notices from lines join known using (digest) where digest <> md5('') group by n)
    select doc_id, d.digest, k.licence, coalesce(notices, '') as notices, coalesce(n_notices, 0) as n_notices
    from docs d left join found using (n) left join known k on k.digest = d.digest and d.digest <> md5('')"""


OP11 = r"""
    with plain as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
    select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size, doc_id = min(doc_id) over same as kept, sha256(t) as text_sha256
    from plain window same as (partition by t)"""


OP12 = r"""
    with docs as (select row_number() over () as n, coalesce(lang, '') as lang, coalesce(source, '') as source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words from documents),
    counts as (select n, lang, source, term, count(*) as c from (select n, lang, source, unnest(words) as term from docs) group by all),
    kept as (select lang, term, sum(c) as c from counts group by 1, 2 having count(*) >= 30),
    cells as (select x.lang, x.source, x.term, sum(x.c) as c from counts x join kept using (lang, term) group by all),
    langs as (select lang, count(*) as v, sum(c) as n from kept group by 1),
    groups as (select lang, source, coalesce(v, 0) as v, coalesce((select sum(c) from cells x where x.lang = g.lang and x.source = g.source), 0) as n
        from (select distinct lang, source from docs) g left join langs using (lang)),
    shares as (select g.lang, g.source, k.term, coalesce(x.c, 0) as c,
        1 + (1000000000 * cast(coalesce(x.c, 0) + 5 as hugeint)) // cast(g.n + 5 * g.v as hugeint) as p,
        1 + (1000000000 * cast(k.c + 5 as hugeint)) // cast(l.n + 5 * l.v as hugeint) as q
        from groups g join kept k on k.lang = g.lang join langs l on l.lang = g.lang left join cells x on x.lang = g.lang and x.source = g.source and x.term = k.term),
    pairs as (select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(f.value, 0) as bigint) as value
        from groups a join groups b on a.lang = b.lang and a.source <> b.source
        left join (select x.lang, x.source as s1, y.source as s2, sum(abs(x.p - y.p)) as value from shares x join shares y using (lang, term) group by all) f
            on f.lang = a.lang and f.s1 = a.source and f.s2 = b.source),
    terms as (select lang, source, 'term' as part, term as item, cast(p - q as bigint) as value from shares where c > 0 and p > q)
    select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank from pairs
    union all (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank from terms
        qualify rank <= 50)"""
