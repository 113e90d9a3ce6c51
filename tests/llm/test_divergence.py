import random
import re
from collections import Counter, defaultdict

import numpy as np

from certweave.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {n: n + 32 for n in range(65, 91)}


def plain(rows, least_docs, top):
    """rows: (lang, source, text)."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = [w.translate(FOLD) for w in TERM.findall(text or "")]
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        sources = [g[1] for g in counts if g[0] == lang]

        def shares(c):
            whole = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // whole for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, n + 1) for n, (item, value) in enumerate(found[:most])]
    return sorted(out)


def found(docs, **how):
    return sorted(map(tuple, divergence.audit(docs, **how).select("lang", "source", "part", "item", "value", "rank").collect()))


def test_documents_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    for least in (30, 3):
        assert found(docs, least_docs=least) == plain(rows, least, 50)


def test_walks_of_sparse_matrices():
    """Corrections of two trees against sums over all columns of the tile."""
    rng = np.random.default_rng(5)
    for filled in (0, 1, 40, 3000, 60_000):
        trees, dense = [], []
        for _ in range(2):
            base = rng.integers(0, 1000, divergence.SIDE)
            cells = np.unique(rng.integers(0, divergence.SIDE, (filled, 2)), axis=0)
            shares = rng.integers(0, 5000, len(cells))
            whole = np.repeat(base[:, None], divergence.SIDE, axis=1)
            whole[cells[:, 0], cells[:, 1]] = shares
            trees.append(divergence.Tree(cells[:, 0], cells[:, 1], shares, base))
            dense.append((whole, base))
        def far(a, b):
            return np.array([np.abs(x[None] - b[0]).sum(axis=1) for x in a[0]]) - divergence.SIDE * np.abs(a[1][:, None] - b[1][None])
        assert (divergence.corrections(trees[0], trees[1], False) == far(dense[0], dense[1])).all()
        assert (np.triu(divergence.corrections(trees[0], trees[0], True), 1) == np.triu(far(dense[0], dense[0]), 1)).all()


def test_more_groups_and_terms_than_a_tile(spark, monkeypatch):
    rng = random.Random(2)
    rows = [("x", f"s{rng.randrange(300)}", " ".join(f"{chr(97 + w % 26)}{chr(97 + w // 26 % 26)}" for w in (int(rng.expovariate(0.01)) for _ in range(30)))) for _ in range(900)]
    rows += [("y", "only", "a b c"), ("z", "none", "1 2 3"), ("z", "nothing", None)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert found(docs, least_docs=2, top=7) == plain(rows, 2, 7)


def test_hand_on_early(spark, monkeypatch, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(40)
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    plain_docs = docs.selectExpr("lang", "source", "cast(text as binary) as text")
    want = Counter()
    for lang, source, text in rows:
        want.update((lang, source, w.translate(FOLD)) for w in TERM.findall(text or ""))
    assert {(r.lang, r.source, r.term): r.n for r in divergence.term_counts(plain_docs).collect()} == dict(want)


def test_odd_rows(odd, nothing):
    rows = [(r.lang, r.source, r.text) for r in odd.collect()]
    for least in (1, 2, 30):
        assert found(odd, least_docs=least) == plain(rows, least, 50)
    assert found(nothing) == []
