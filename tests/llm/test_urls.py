import math
from collections import Counter, defaultdict

from certweave.llm import urls

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://A.Example.ORG/es/1?q=1": ("a.example.org", "/es/1", "example.org/es/"), "https://org/": ("org", "/", "org/"), "x://borg/": ("borg", "/", None),
        "https://example.org/en/12#x": ("example.org", "/en/12", "example.org/en/1"), "https://example.org": ("example.org", "", None), "http://x.com/fr": ("x.com", "/fr", None),
        "http://x.com/fr/": ("x.com", "/fr/", "com/fr/"), "no scheme": ("", "", None), "a://b.com?u=c://d.org/": ("b.com", "", None), "a://É.com/de/\n/x": ("É.com", "/de/\n/x", "com/de/"), "": ("", "", None)}
    pages = spark.createDataFrame([(n, u, "x") for n, u in enumerate(cases)] + [(99, None, "y"), (99, None, "y")], "page_id long, url string, host string")
    rows = urls.judge(pages, RULES).collect()
    assert len(rows) == len(cases) + 2
    for r in rows:
        host, path, rule = cases[r.url] if r.url is not None else ("", "", None)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert rule is None or r.verdict == next(v for v, name in RULES if name == rule)
    assert urls.judge(pages.limit(0), RULES).count() == 0


def witten_bell(texts, order):
    counts, kinds = Counter(), defaultdict(set)
    for t in texts:
        p = urls.START * order + t + urls.END
        for i in range(order, len(p)):
            for n in range(order + 1):
                counts[p[i - n:i], p[i]] += 1
                kinds[p[i - n:i]].add(p[i])

    total = Counter()
    for (c, _), n in counts.items():
        total[c] += n

    def share(context, ch):
        p = 1 / 256
        for n in range(len(context) + 1):
            c = context[len(context) - n:]
            if total[c]:
                p = (counts[c, ch] + len(kinds[c]) * p) / (total[c] + len(kinds[c]))
        return p

    return share


def test_gram_scores_match_a_plain_model(spark):
    good, bad = ["abcab", "abd", "xyz"], ["bbbb", "cab"]
    order, rows = 3, Counter()
    for side, texts in ((0, good), (1, bad)):
        for t in texts:
            p = urls.START * order + t + urls.END
            for i in range(order, len(p)):
                rows[p[i - order:i + 1], side] += 1
    grams = {g for g, _ in rows} | {"zzzz", "abca"}
    table = spark.createDataFrame([(g, rows[g, 0], rows[g, 1]) for g in grams], "gram string, accepted long, rejected long")
    a, r = witten_bell(good, order), witten_bell(bad, order)
    for got in urls.gram_scores(table, order).collect():
        want = math.log(a(got.gram[:-1], got.gram[-1])) - math.log(r(got.gram[:-1], got.gram[-1]))
        assert abs(got.score - 1e6 * want) <= 1


def test_learns_from_rules(spark):
    rows = [(n, f"http://h{n % 7}.net/{'good' if n % 2 else 'evil'}/{n}") for n in range(60)]
    rows += [(100 + n, f"http://h{n % 7}.org/good/{n}") for n in range(60)] + [(200 + n, f"http://h{n % 7}.com/de/evil/{n}") for n in range(60)]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), RULES).where("rule is null").collect()
    right = sum((r.verdict == "allow") == ("good" in r.url) for r in got)
    assert len(got) == 60 and right >= 57
