import math

import numpy as np

from certweave.llm import embeddings


def brute(rows):
    good = {n: np.array(v, float) / np.linalg.norm(np.array(v, float)) for n, (_, v) in enumerate(rows)
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    linked = {n: [m for m in good if m != n and len(good[m]) == len(good[n]) and good[n] @ good[m] >= 0.95] if n in good else [] for n in range(len(rows))}
    out = []
    for n, (key, _) in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            for m in linked[todo.pop()]:
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        ids = [rows[m][0] for m in seen if rows[m][0] is not None]
        out.append((key, len(linked[n]), min(ids) if ids else None))
    return sorted(out, key=str)


def run(spark, rows, **how):
    table = spark.createDataFrame([(k, v, 1, "x") for k, v in rows], "vec_id long, embedding array<float>, label int, digest string")
    return sorted((tuple(r) for r in embeddings.near_duplicates(table, **how).collect()), key=str)


def floats(x):
    return [float(np.float32(v)) for v in x]


def test_against_all_pairs(spark):
    r = np.random.default_rng(4)
    rows = []
    for k in range(12):
        centre = r.normal(size=16)
        rows += [(len(rows) + n, floats(centre + r.normal(size=16) * 0.12)) for n in range(1 + 3 * (k % 5))]
    rows += [(1000 + n, floats(r.normal(size=16))) for n in range(150)] + [(2000 + n, rows[3][1]) for n in range(20)]
    want = brute(rows)
    for chunk in (embeddings.CHUNK, 5):
        got = run(spark, rows, chunk=chunk, target=1.0)
        assert sum(n for _, n, _ in want) > 500 and got == want


def test_traversal_is_by_distance():
    r = np.random.default_rng(1)
    a, b = r.random(9), r.random(7)
    want = sorted((a[i] + b[j], i * 7 + j) for i in range(9) for j in range(7))
    assert embeddings.multi_sequence(a, b, 63) == [c for _, c in want] and embeddings.multi_sequence(a, b, 5) == [c for _, c in want[:5]]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.1]), (7, [1.0, 0.1]), (8, [2.0, 0.2]), (None, [1.0, 0.12]), (9, [-1.0, 0.0]), (10, [1.0, 0.1, 0.0]), (11, [1e30, 1e29]), (12, [1e-40, 1e-41])]
    rows = [(k, v and [None if x is None else float(np.float32(x)) for x in v]) for k, v in rows]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, [(1, None)]) == [(1, 0, 1)]


def near(r, x, cosine):
    d = r.normal(size=x.shape)
    d -= (d * x).sum(axis=1, keepdims=True) * x
    return cosine * x + math.sqrt(1 - cosine * cosine) * d / np.linalg.norm(d, axis=1, keepdims=True)


def planted(spark, r, n_rows, n_pairs, cluster=(), **how):
    """How many planted pairs at 0.955 among random vectors are met."""
    x = r.normal(size=(n_rows, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    vectors = [*near(r, x[:n_pairs], 0.955), *x, *cluster]
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    roots = {k: root for k, _, root in embeddings.near_duplicates(table, **how).collect()}
    return sum(roots[k] == roots[n_pairs + k] for k in range(n_pairs))


def test_rare_links_are_met(spark):
    assert planted(spark, np.random.default_rng(3), 6000, 16) == 16


def test_a_hot_cluster_does_not_hide_pairs(spark):
    r = np.random.default_rng(5)
    centre = r.normal(size=64)
    cluster = centre / np.linalg.norm(centre) + 0.02 * r.normal(size=(2000, 64))
    found = []
    assert planted(spark, r, 4000, 200, cluster) >= 198
    assert planted(spark, r, 4000, 200, cluster, enough=20, n_queries=500, report=found.append) >= 190
    assert len(found) == 1 and found[0]["recall_by_group"] >= 0.999 and found[0]["recall_by_item"] >= 0.999 and found[0]["groups"] >= 20
    assert found[0]["queries"] < found[0]["items"] and not found[0]["every_item_a_query"]


def test_planted_partners_stand_for_rare_links(spark):
    found = []
    r = np.random.default_rng(8)
    assert planted(spark, r, 6000, 60, n_queries=256, measured=500, report=found.append) >= 58
    assert found[0]["queries"] < 2000 and not found[0]["every_item_a_query"] and min(found[0]["planted_recall"].values()) >= 0.999
    assert len(found[0]["planted_recall"]) == 3 and 1 < found[0]["cells"] < 100


def test_planted_reaches_foresee_the_recall():
    r = np.random.default_rng(9)
    x = r.normal(size=(6000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = embeddings.Index(embeddings.codebook(x[:3000, :16], 30), embeddings.codebook(x[:3000, 16:], 30))
    reach = embeddings.planted_reaches(index, x[3000:4000], 0.95)
    cells = max(int(np.sort(at)[int(0.99 * len(at))]) for at in reach.values())
    own, partners = x[4000:], near(r, x[4000:], 0.95)
    visits, homes = (index.visits(v, k) for v, k in ((own, cells), (partners, 1)))
    assert np.mean([h[0] in v for v, h in zip(visits, homes)]) >= 0.95
    # equal vectors have no direction towards each other
    assert set(embeddings.planted_reaches(index, np.repeat(x[:1], 5, axis=0), 0.95)) == {"anywhere", "one half"}
