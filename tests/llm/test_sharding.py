import hashlib
import random
import zlib

from certweave.llm import sharding


def smallest(sizes, shards):
    """Smallest capacity by dynamic programming over the ordered sizes."""
    ends = [0]
    for s in sizes:
        ends.append(ends[-1] + s)
    best = [ends[n] for n in range(len(ends))]
    for _ in range(shards - 1):
        best = [min(max(best[m], ends[n] - ends[m]) for m in range(n + 1)) for n in range(len(ends))]
    return best[-1]


def check(rows, got, shards):
    groups = {}
    for _, text, *_ in rows:
        d = hashlib.md5((text or "").encode()).hexdigest()
        groups[d] = groups.get(d, 0) + len((text or "").encode()) + 8
    loads, slots, where = {}, {}, {}
    for r in got:
        loads[r.shard] = loads.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
        where.setdefault(r.digest, set()).add(r.shard)
    assert len(got) == len(rows) and all(len(v) == 1 for v in where.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(loads.values()) == smallest([groups[d] for d in sorted(groups)], shards)
    order = [next(iter(where[d])) for d in sorted(where)]
    assert order == sorted(order) and set(order) <= set(range(shards))


def test_smallest_capacity(documents):
    r = random.Random(3)
    rows = [(n, "x" * r.choice([1, 5, 80, 400]) + str(r.randrange(60)), "en", "a") for n in range(150)] + [(n, "hot " * 40, "en", "b") for n in range(200, 260)]
    for shards in (1, 5, 24):
        check(rows, sharding.shard_documents(documents(rows), shards).collect(), shards)


def test_cells_are_divided_until_exact(spark, monkeypatch):
    r = random.Random(5)
    groups = [(hashlib.md5(str(n).encode()).hexdigest(), r.randrange(1, 500)) for n in range(400)]
    monkeypatch.setattr(sharding, "FIRST_DIGITS", 1)
    cuts = sharding.cut_points(spark.createDataFrame(groups, "digest string, bytes long"), 7)
    loads = [0] * 7
    for d, n in groups:
        loads[sum(d >= c for c in cuts)] += n
    assert max(loads) == smallest([n for _, n in sorted(groups)], 7) and min(loads) > 0.9 * sum(loads) / 7


def test_odd_rows(odd, nothing):
    got = sharding.shard_documents(odd, 24).collect()
    check([(r.doc_id, r.text) for r in odd.collect()], got, 24)
    assert all(r.size == 8 and r.text_crc32 == zlib.crc32(b"") for r in got if r.doc_id in (1, 2))
    assert sharding.shard_documents(nothing, 24).count() == 0
