import math
import re
from collections import Counter

import xxhash

from certweave.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    twice = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(twice)


def buckets(text, n):
    h = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in WORD.findall(text or "")]
    two = [xxhash.xxh64(b.to_bytes(8, "little"), seed=xxhash.xxh64(a.to_bytes(8, "little"), seed=42).intdigest()).intdigest() for a, b in zip(h, h[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(x) % n for x in h + two]


def test_base_counts(spark, small, odd):
    for docs in (spark.read.parquet(f"{small}/documents.parquet"), odd):
        for r in quality.base_counts(docs).collect():
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(r.text)


def test_scores_are_the_multinomials_ratio(documents):
    texts = ["good clean words here", "good words", "bad ### bad", "clean bad text", ""]
    docs = documents([(n, t, "en", "a") for n, t in enumerate(texts)])
    sample = docs.sparkSession.createDataFrame([(0, True, False), (1, True, True), (2, False, False)], "doc_id long, trusted boolean, held boolean")
    weights = quality.fit(docs, sample, buckets=64)
    raw, good = Counter(), Counter(buckets(texts[0], 64))
    for t in texts:
        raw.update(buckets(t, 64))
    want = [round(1e6 * (math.log((good[b] + 1) / (good.total() + 64)) - math.log((raw[b] + 1) / (raw.total() + 64)))) for b in range(64)]
    assert max(abs(a - b) for a, b in zip(weights, want)) <= 1
    got = {r.doc_id: r.s for r in quality.with_words(docs).select("doc_id", quality.score(quality.F.col("_hashes"), weights).alias("s")).collect()}
    for n, t in enumerate(texts):
        b = buckets(t, 64)
        assert got[n] == (sum(weights[x] for x in b) // len(b) if b else None)


def test_separates_labelled_documents(spark, small):
    sf = small.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.judge(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").groupBy("quality").agg({"kept": "count", "*": "count"})
    judged = quality.judge(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").select("quality", "kept", "base_failed").collect()
    clean = [r.kept for r in judged if r.quality == 1 and not r.base_failed]
    poor = [r.kept for r in judged if r.quality == 0]
    assert got.count() == 2 and sum(clean) >= 0.97 * len(clean) and sum(poor) <= 0.1 * len(poor)


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(7, 1, None), (None, 1, 0), (5, None, 0), (6, 0, 1), (6, 0, 1)], "doc_id long, quality int, toxic int")
    got = quality.judge(odd, labels)
    rows = got.collect()
    assert len(rows) == 10 and got.columns.count("kept") == 1 and "size" in got.columns
    assert all(not r.kept and r.base_failed and r.score is None for r in rows if not (r.text or "").strip())
    assert quality.judge(nothing, labels).count() == 0 and quality.judge(odd, labels.limit(0)).where("kept").count() == 2


def test_counts_and_threshold_come_from_every_label(spark, documents):
    """More labels than the 20,000 once drawn, the trusted texts spread over them: scores and verdicts as plain Python finds them."""
    texts = {n * 199: " ".join(f"w{(n * n + k * (n % 7 + 1)) % 41}" for k in range(10 + n % 9)) for n in range(150)}
    texts[3] = "few words"
    docs = documents([(i, t, "en", "a") for i, t in texts.items()] + [(None, texts[0], "en", "a"), (199, texts[199], "en", "a")])
    labels = spark.range(30_000).selectExpr("id as doc_id", "if(id % 5 = 4, 0, 1) as quality").unionByName(
        spark.createDataFrame([(398, 0), (None, 1), (199, 1)], "doc_id long, quality int"))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    good = [(i, t) for i, t in rows if i is not None and i % 5 != 4 and i != 398]

    def fold(i):
        h = xxhash.xxh64(b"held", seed=xxhash.xxh64(i.to_bytes(8, "little"), seed=42).intdigest()).intdigest()
        return (h - (1 << 64) if h >> 63 else h) % 5

    def counts(ts):
        return Counter(b for t in ts for b in buckets(t, 64))

    raw = counts(t for _, t in rows)
    weights = lambda c: [round(1e6 * (math.log(c[b] + 1) - math.log(raw[b] + 1) + (math.log(raw.total() + 64) - math.log(c.total() + 64)))) for b in range(64)]
    score = lambda t, w: sum(w[b] for b in buckets(t, 64)) // len(buckets(t, 64))
    whole = weights(counts(t for _, t in good))
    without = [weights(counts(t for i, t in good if fold(i) != k)) for k in range(5)]
    fails = lambda t: base(t)[0] < 10 or 100 * base(t)[4] > 20 * base(t)[0]
    apart = sorted(score(t, without[fold(i)]) for i, t in good if not fails(t))
    least = apart[math.ceil(0.3 * len(apart)) - 1]
    got = sorted((r.doc_id or -1, r.score, r.kept) for r in quality.judge(docs, labels, lose=0.3, buckets=64).collect())
    want = sorted((i or -1, score(t, whole), not fails(t) and score(t, whole) >= least) for i, t in rows)
    assert len(apart) > 100 and {k for *_, k in want} == {True, False}
    assert [g[0] for g in got] == [w[0] for w in want] and max(abs(g[1] - w[1]) for g, w in zip(got, want)) <= 1
    assert [g[2] for g in got] == [w[2] for w in want]


def test_rank_is_exact(spark):
    scores = spark.range(30_000).selectExpr("if(id % 11 = 0, null, pmod(xxhash64(id), 9000001) - 4500000) as score")
    all_of_them = sorted(r.score for r in scores.collect() if r.score is not None)
    for share in (0.0, 0.005, 0.3, 1.0):
        assert quality.ranked(scores, share) == all_of_them[max(1, math.ceil(share * len(all_of_them))) - 1]
    assert quality.ranked(scores.limit(0), 0.005) is None


def test_work_on_every_word_is_compiled(documents):
    """Lambdas run uncompiled, and translate makes a string of every character: they made up most of the CPU time."""
    texts = ["a b a b a", "one", "", None, " \t", "é # <x>\x0b| 日本 a a"]
    docs = documents([(n, t, "en", "a") for n, t in enumerate(texts)] + [(0, texts[0], "en", "a")])
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for fold in (None, "fold"):
        rows = quality.gram_rows(docs.withColumn("fold", quality.F.col("doc_id").cast("int")), 64, fold=fold)
        assert plan(rows).count("transform(") == 1  # the hashes of the words
        got = Counter((r.fold if fold else None, r.bucket) for r in rows.collect())
        assert got == Counter((n if fold else None, b) for n, t in [*enumerate(texts), (0, texts[0])] for b in buckets(t, 64))
    counts = quality.base_counts(docs)
    assert "array_sort(" not in plan(counts) and "translate(" not in plan(counts)
    assert all((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(r.text) for r in counts.collect())


def test_weights_are_no_text_of_a_plan(documents):
    """Spelt out, the weights made megabytes of text of each plan, which the driver keeps; as a copied column they would be in each row."""
    texts = [" ".join(f"w{(n * n + k * (n % 7 + 1)) % 41}" for k in range(10 + n % 9)) for n in range(20)] + ["few words", "", None]
    docs = documents([(n, t, "en", "a") for n, t in enumerate(texts)] + [(0, texts[0], "en", "a")])
    trusted = docs.selectExpr("text", "cast(doc_id % 5 as int) as fold")
    without = [[(b * 7919 + k * 31) % 2_000_003 - 1_000_000 for b in range(quality.BUCKETS)] for k in range(quality.FOLDS)]
    apart = quality.apart_scores(trusted, without)
    score = lambda t, w: sum(w[b] for b in buckets(t, quality.BUCKETS)) // len(buckets(t, quality.BUCKETS))
    fails = lambda t: base(t)[0] < 10 or 100 * base(t)[4] > 20 * base(t)[0]
    want = [None if fails(t) else score(t, without[n % 5]) for n, t in [*enumerate(texts), (0, texts[0])]]
    assert sorted(r.score or 0 for r in apart.collect()) == sorted(w or 0 for w in want) and len({*want}) > 10
    labels = docs.sparkSession.range(20).selectExpr("id as doc_id", "1 as quality")
    for df in (apart, quality.judge(docs, labels)):
        plan = df._jdf.queryExecution()
        assert len(plan.toString()) < 100_000 and not any(f"AS {name}" in plan.executedPlan().toString() for name in quality.HELD)
