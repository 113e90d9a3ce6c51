import random
import re

import numpy as np

from certweave.llm import jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text):
    w = WORD.findall(text or "")
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(doc_id, class, links) of every row, from all pairs."""
    sets = [grams(t) for _, t, *_ in rows]
    n, linked = len(rows), [[] for _ in rows]
    for a in range(n):
        for b in range(n):
            if a != b and sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                linked[a].append(b)
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in linked[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        ids = [rows[b][0] for b in seen if rows[b][0] is not None]
        out.append((rows[a][0], min(ids) if ids else None, len(linked[a])))
    return sorted(out, key=str)


def planted():
    r = random.Random(7)
    text = lambda n: [f"w{r.randrange(400)}" for _ in range(n)]
    rows, n = [], 0
    for length, copies in [(60, 25), (120, 6), (300, 3), (30, 8)]:
        first = text(length)
        for k in range(copies):
            near = list(first)
            for _ in range(r.choice([0, 0, 1, 2, 3])):
                near[r.randrange(length)] = "changed"
            rows.append((n, " ".join(near), None, None))
            n += 1
    rows += [(500 + k, " ".join(text(80)), None, None) for k in range(40)]
    return rows


def test_against_all_pairs(documents):
    rows = planted()
    for chunk in (jaccard.CHUNK, 4):  # whole groups, and groups cut into blocks
        got = sorted((tuple(r) for r in jaccard.near_duplicates(documents(rows), chunk=chunk).collect()), key=str)
        assert got == brute(rows)


def test_one_of_each_class_stays(documents):
    rows = planted()
    kept = jaccard.without_near_duplicates(documents(rows))
    assert kept.columns == documents([]).columns and sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _ in brute(rows)})


def test_shingles_are_those_of_the_words():
    r = random.Random(2)
    for text in ["", " ", "a", "a b", "a b c d e", "a b c d e f", "é " * 9, "a\u00a0b c\x0bd e\x1cf g h"] + [" ".join(r.choice("abc") for _ in range(n)) for n in (20, 3000)]:
        assert len(jaccard.shingles(text)) == len(grams(text))
    assert len(jaccard.shingles("a b")) == 1 and not np.array_equal(jaccard.shingles("a b"), jaccard.shingles("b a"))


def test_prefixes_shorten_to_the_target():
    depth = jaccard.prefix_length(0.8, jaccard.TREES, jaccard.TARGET)
    assert jaccard.recall(0.8, jaccard.TREES, depth) >= jaccard.TARGET > jaccard.recall(0.8, jaccard.TREES, depth + 1)


def test_odd_rows(odd, nothing, documents):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted((tuple(r) for r in jaccard.near_duplicates(odd).collect()), key=str) == brute(rows)
    kept = [(r.doc_id, r.text) for r in jaccard.without_near_duplicates(odd).collect()]
    assert len(kept) == 8 and kept.count((5, "same same same")) == 1 and (6, "same same same") not in kept
    assert jaccard.near_duplicates(nothing).count() == 0 and jaccard.without_near_duplicates(nothing).count() == 0


def test_prefixes_are_shortened_where_that_adds_least():
    few, target = 24, jaccard.TARGET
    found = lambda d: 1 - np.prod(1 - 0.8 ** np.asarray(d, float))
    r = np.random.default_rng(3)
    for matched in (0, 1, 7, 24):
        for shortest, levels in ((5, 2), (4, 4), (5, 1)):
            sizes = np.cumsum(r.integers(1, 50, (matched, levels)), axis=1)
            d = jaccard.depths(sizes, shortest, 0.8, few, target)
            assert found([*d, *[shortest] * (few - matched)]) >= target and len(d) == matched
            assert (d >= shortest).all() and (d < shortest + levels).all()
            if levels == 2 and matched == 24:
                growth = sizes[:, 1] - sizes[:, 0]
                short, long = growth[d == 5], growth[d == 6]
                assert len(long) and short.max() <= long.min()
                assert found([*d[d == 5][1:], *d[d == 6], 6]) < target  # no prefix is shorter than it has to be


def test_judged_nodes_hold_what_the_prefixes_meet(spark):
    """Every document meets all others that share the prefix it stopped at, and blocks split by trees count a pair once."""
    r = np.random.default_rng(1)
    trees, shortest, longest = 3, 2, 4
    labels = {n: r.integers(0, 3, (trees, longest)).astype("<u2") for n in range(120)}
    reps = spark.createDataFrame([(n, bytearray(x.tobytes())) for n, x in labels.items()], "id long, label binary")
    got = {(x.id, x.tree): x.key for x in jaccard.judged_nodes(reps, trees=trees, shortest=shortest, longest=longest, least=0.8, target=0.9).collect()}
    prefix = lambda n, t, d: tuple(labels[n][t, :d])
    size = lambda n, t, d: sum(prefix(m, t, d) == prefix(n, t, d) for m in labels)
    for n in labels:
        mine = [t for t in range(trees) if size(n, t, shortest) > 1]
        depth = jaccard.depths(np.array([[size(n, t, d) for d in (4, 3, 2)] for t in mine]).reshape(-1, 3), shortest, 0.8, trees, 0.9)
        assert {t for x, t in got if x == n} == set(mine)
        for t, d in zip(mine, depth):
            assert all(got[m, t] == got[n, t] for m in labels if prefix(m, t, d) == prefix(n, t, d))
    for (n, t), key in got.items():  # and a node is one prefix
        assert all(prefix(m, t, shortest) == prefix(n, t, shortest) for (m, u), k in got.items() if u == t and k == key)
