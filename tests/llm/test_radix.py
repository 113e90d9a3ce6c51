import hashlib
import re
from collections import defaultdict

from certweave.llm import radix


def plain(rows):
    groups = defaultdict(list)
    for n, (i, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append((i is None, i or 0, n, i))
    out = []
    for t, members in groups.items():
        first = min(members)
        out += [(m[3], first[3], len(members), m is first, hashlib.sha256(t.encode()).hexdigest()) for m in members]
    return sorted(out, key=str)


def found(docs, **how):
    return sorted(map(tuple, radix.exact_duplicates(docs, **how).collect()), key=str)


def test_documents_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = found(docs)
    assert got == plain(rows) and sum(not r[3] for r in got) > 0


def test_texts_that_part_late(documents):
    """Groups of equal length that share long beginnings go through several rounds."""
    stem = "x" * 700
    texts = [stem + end for end in ("a", "b", "a", "c", "b", "a")] + [stem[:-1] + "yz", stem[:5] + "q" + stem[6:] + "a", stem, stem, "a", "b", "a", "é", "ab"]
    rows = [(n, t, None, None) for n, t in enumerate(texts)]
    for first, wider in ((1, 2), (3, 3), (64, 8), (4096, 2)):
        assert found(documents(rows), first=first, wider=wider) == plain([(r[0], r[1]) for r in rows])


def test_one_copy_group_holds_most_rows(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "case when id % 3 = 0 then repeat('same  words ', 400) else concat(repeat('w', 100), id % 1500) end as text")
    assert found(docs) == plain(docs.select("doc_id", "text").collect())


def test_odd_rows(odd, nothing, documents):
    assert found(odd) == plain([(r.doc_id, r.text) for r in odd.collect()])
    assert found(nothing) == []
    assert found(documents([(None, "a", None, None), (None, "a", None, None), (2, "a ", None, None), (2, "a\t", None, None), (1, "a\x85", None, None)])) == plain(
        [(None, "a"), (None, "a"), (2, "a "), (2, "a\t"), (1, "a\x85")])
