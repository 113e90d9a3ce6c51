import re

from certweave.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes, weights, epochs):
    """Targets by the plain loop: clamp whoever is above, share the rest again."""
    total, out = sum(sizes.values()), {}
    free = dict(weights)
    while free:
        left, shares = total - sum(out.values()), sum(free.values())
        above = [s for s in free if left * free[s] / shares > epochs * sizes[s]]
        for s in above:
            out[s] = epochs * sizes[s]
            del free[s]
        if not above:
            out |= {s: left * w / shares for s, w in free.items()}
            break
    return out


def test_targets_and_taken_words(spark, documents):
    rows = [(n, " ".join(["w"] * (3 + n * 7 % 40)), "en", s) for n, s in enumerate(["a"] * 60 + ["b"] * 4 + ["c"] * 90 + [None] * 30 + ["é"] * 25)]
    got = mixing.mix(documents(rows)).collect()
    sizes, taken = {}, {}
    for (_, text, _, source), r in zip(sorted(rows), sorted(got, key=lambda r: r.doc_id)):
        assert r.size == len(WORD.findall(text)) and 0 <= r.times <= 3
        sizes[source] = sizes.get(source, 0) + r.size
        taken[source] = taken.get(source, 0) + r.size * r.times
    order = ["a", "b", "c", "é", None]
    want = filled(sizes, dict(zip(order, [5, 2, 1, 5, 2])), 3)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    for s in order:
        assert abs(taken[s] - want[s]) <= 2
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(documents(rows[::-1])).collect()), key=str)


def test_clamped_sources(spark):
    table = spark.createDataFrame([("a", 10, 50.0), ("b", 20, 50.0), ("c", 1000, 1.0), ("d", 0, 9.0), ("e", 100, 0.0)], "source string, source_size long, weight double")
    got = {r.source: r.target for r in mixing.fill(table, 3.0).collect()}
    assert got == {"a": 30, "b": 60, "c": 1040, "d": 0, "e": 0}


def test_given_weights_and_repeats(spark, documents):
    docs = documents([(n, "one two", "en", "ab"[n % 2]) for n in range(40)])
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "source string, weight double")
    mixed = mixing.mix(docs, weights)
    assert mixing.repeated(mixed).groupBy("source").count().orderBy("source").collect() == [("a", 30), ("b", 10)]


def test_odd_rows(odd, nothing):
    got = mixing.mix(odd)
    assert got.columns == ["doc_id", "text", "lang", "source", "kept", "size", "source_size", "target", "times"]
    rows = got.collect()
    assert len(rows) == 10 and all(r.size == 0 for r in rows if r.text is None or not r.text.strip())
    assert {r.size * r.times for r in rows if r.doc_id == 5} in ({0}, {3}, {6}, {9})
    assert mixing.mix(nothing).count() == 0
