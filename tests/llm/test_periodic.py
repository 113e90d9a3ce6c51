import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from certweave.llm import catalog, periodic


def plain_runs(w, least_words=6, repeats=4):
    """Every run by trying each period at each place."""
    n, found = len(w), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least_words, repeats * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted((s, n_, q) for (s, n_), q in found.items())


def plain_report(doc_id, text, plant):
    w = [x for x in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if x]
    n = len(w)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = sorted(plain_runs(w), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, n, len(runs), *top, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.lists(st.integers(0, 5), max_size=60))
def test_extension_is_the_longest_common_one(x, y):
    whole = np.array([*x, -1, *y, -2])
    grammar = periodic.Grammar(whole)
    pairs = [(a, b) for a in range(len(whole)) for b in range(a + 1, len(whole))]
    got = grammar.extension(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    for (a, b), n in zip(pairs, got):
        m = 0
        while b + m < len(whole) and whole[a + m] == whole[b + m]:
            m += 1
        assert n == m


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=5))
def test_runs_of_small_alphabets(texts):
    got = periodic.runs_of([np.array(t, np.int64) for t in texts])
    assert [list(map(tuple, r.tolist())) for r in got] == [sorted(plain_runs(t), key=lambda r: (r[0], r[2])) for t in texts]


def test_runs_of_nested_repeats():
    rng = random.Random(3)
    for _ in range(60):
        unit = [rng.randrange(4) for _ in range(rng.randrange(1, 9))]
        inner = unit * rng.randrange(1, 7)
        whole = [rng.randrange(4) for _ in range(rng.randrange(6))] + (inner + [9] * rng.randrange(9)) * rng.randrange(1, 7) + [rng.randrange(4)]
        assert list(map(tuple, periodic.runs_of([np.array(whole)])[0].tolist())) == sorted(plain_runs(whole), key=lambda r: (r[0], r[2]))


def test_a_grammar_is_small():
    """A periodic sequence ends as one symbol after few levels."""
    grammar = periodic.Grammar(np.array([1, 2, 3, 1, 2] * 20_000 + [-1]))
    assert len(grammar.top) == 2 and len(grammar.levels) < 60


@pytest.mark.parametrize("plant", [False, True])
def test_documents_against_brute_force(spark, small, plant):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("length(text) < 30000")
    got = {r.doc_id: tuple(r) for r in periodic.periodic_runs(docs, plant=plant).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.doc_id] == plain_report(r.doc_id, r.text, plant)


def test_query_plants_runs(spark, small):
    rows = catalog.op13_periodic_runs(spark, small).collect()
    assert sum(r.n_runs > 0 for r in rows) >= len(rows) // 20


def test_odd_rows(spark, documents, odd, nothing):
    got = sorted(map(tuple, periodic.periodic_runs(odd, plant=True).collect()), key=str)
    assert len(got) == 10
    assert [g for g in got if g[0] != 4] == sorted((plain_report(r.doc_id, r.text, True) for r in odd.where("doc_id is null or doc_id <> 4").collect()), key=str)
    assert periodic.periodic_runs(nothing).count() == 0
    turns = documents([(1, "a b " * 50_000, None, None), (2, "x " * 200_000, None, None), (3, "one\x85two " * 8, None, None), (4, "a b " * 8, None, None)])
    got = {r.doc_id: r for r in periodic.periodic_runs(turns).collect()}
    assert (got[1].n_runs, got[1].start, got[1].length, got[1].period, got[1].exponent_milli) == (1, 0, 100_000, 2, 50_000_000)
    assert (got[2].length, got[2].period) == (200_000, 1) and (got[3].period, got[3].length, got[4].length) == (1, 8, 8)
    with pytest.raises(ValueError):
        periodic.periodic_runs(nothing, least_repeats=2)
