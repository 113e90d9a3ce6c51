"""Join of documents whose word 5-grams have a Jaccard similarity of at least 0.8.

Candidates come from a MinHash LSH forest. Each tree labels a document with a row of minima; the labels of a
tree are a prefix trie, held as tables of its nodes, one level per prefix length, each summed from the level
below. A document starts with its longest prefix in every tree and shortens it tree by tree, those
first where the shorter prefix meets the fewest more documents (none, in most trees), until a pair at the
threshold is found with the target probability. So a crowded branch of one tree is left alone as long as the others make up for it.
Where a document stops, the node of its prefix is judged: all pairs below it are candidates. Candidates are
verified on their whole shingle sets.

Documents with equal shingle sets are one item from the start: copies are counted, never
paired. Links between different items are counted in blocks (see ``links``), each pair in
the first tree in which a judged node holds both.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .links import chunked, components, linked, per_block

TREES, LONGEST = 24, 8
STEPS = 1  # by which the longest prefix is longer than the one that reaches the target in all trees
CHUNK = 512
WORDS, LEAST = 5, 0.8
TARGET = 0.9995
BYTES = 2  # of a minimum in a label
_R = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_R, pow(_R, -1, 1 << 64))):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _POWERS[k] = np.multiply.accumulate(row)
    return _POWERS[0], _POWERS[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted different 64-bit hashes of the word n-grams; a text of fewer words is one gram; no words, none."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    inside = np.concatenate(([False], ~SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], dtype=np.uint64)))
    each = _mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    count = min(words, len(each))
    gram = np.full(len(each) - count + 1, count, np.uint64)
    for n in range(count):
        gram = _mixed(gram * np.uint64(_R) + each[n:n + len(gram)])
    return np.unique(gram)


def label(grams: np.ndarray, trees: int, depth: int) -> bytes:
    """The minima of all trees, tree by tree."""
    factors = _mixed(np.arange(1, trees * depth + 1, dtype=np.uint64)) | np.uint64(1)
    least = np.full(trees * depth, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 2048):
        np.minimum(least, np.multiply.outer(factors, grams[at:at + 2048]).min(axis=1), out=least)
    return (_mixed(least) >> np.uint64(64 - 8 * BYTES)).astype(f"<u{BYTES}").tobytes()


def recall(similarity: float, trees: int, depth: int) -> float:
    return 1 - (1 - similarity ** depth) ** trees


def prefix_length(least: float, trees: int, target: float, longest: int = LONGEST) -> int:
    """The longest prefix at which a pair at the threshold is found with the target probability; 1 if none is."""
    depth = longest
    while depth > 1 and recall(least, trees, depth) < target:
        depth -= 1
    return depth


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Shared shingles of every two sets."""
    n = len(sets)
    both = np.zeros((n, n), np.float32)
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    held = np.bincount(column, minlength=len(values))
    keep = held[column] > 1
    column, owner = column[keep], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    starts = np.concatenate(([0], np.flatnonzero(np.diff(column)) + 1, [len(column)])) if len(column) else np.zeros(1, int)
    wide = 2048
    for k in range(0, len(starts) - 1, wide):
        low, high = starts[k], starts[min(k + wide, len(starts) - 1)]
        _, local = np.unique(column[low:high], return_inverse=True)
        part = np.zeros((n, local.max() + 1), np.float32)
        part[owner[low:high], local] = 1
        both += part @ part.T
    return both


def depths(sizes: np.ndarray, shortest: int, least: float, trees: int, target: float) -> np.ndarray:
    """How long a document's prefix is in each of the trees where it shares its shortest one with others.

    sizes: a row per such tree, how many documents share the prefix of the longest length, the next
    shorter one and so on to ``shortest``. In all other trees the shortest prefix meets nobody and is taken. Level by
    level, prefixes are shortened in the order of what that adds, ties by place, until the target is reached.
    """
    matched, levels = sizes.shape
    missed = lambda depth: np.log1p(-least ** np.asarray(depth, np.float64))
    out = np.full(matched, shortest + levels - 1)
    left = (trees - matched) * float(missed(shortest)) + float(missed(out).sum()) - np.log1p(-target)
    for level in range(1, levels):
        shorter = shortest + levels - 1 - level
        gain = float(missed(shorter) - missed(shorter + 1))
        for place in np.argsort(sizes[:, level] - sizes[:, level - 1], kind="stable"):
            if left <= 0:
                return out
            out[place] = shorter
            left += gain
    return out


def _prefix(label: str, depth: int) -> Column:
    return F.substring(label, 1, BYTES * depth)


def judged_nodes(reps: DataFrame, *, trees: int, shortest: int, longest: int, least: float, target: float) -> DataFrame:
    """(id, tree, key) of the judged nodes that hold an item with others, at most one per tree; reps: (id, label)."""
    wide = BYTES * longest
    forest = reps.select("id", F.posexplode(F.array(*[F.substring("label", t * wide + 1, wide) for t in range(trees)])).alias("tree", "label"))
    leaves = stored(forest.groupBy("tree", "label").agg(F.count("*").alias("n")), "jaccard-leaves")
    level = lambda d: leaves.groupBy("tree", _prefix("label", d).alias("prefix")).agg(F.sum("n").alias(f"n{d}"))
    sizes = leaves.withColumnRenamed("n", f"n{longest}")
    for d in range(shortest, longest):
        nodes = level(d).where(F.col(f"n{d}") > 1) if d == shortest else level(d)  # branches without company go with the shortest prefix
        sizes = sizes.withColumn("prefix", _prefix("label", d)).join(nodes, ["tree", "prefix"]).drop("prefix")
    sizes = sizes.where(F.col(f"n{shortest}") > 1)
    rows = F.array(*[F.col(f"n{d}") for d in range(longest, shortest - 1, -1)])
    places = forest.join(stored(sizes.select("tree", "label", rows.alias("sizes")), "jaccard-sizes"), ["tree", "label"])
    by_item = places.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("tree", "label", "sizes"))).alias("places"))  # a place per tree at most

    def shorten(batches):
        import pyarrow as pa

        for batch in batches:
            places = batch.column("places")
            flat, ends = places.flatten(), places.value_lengths().to_numpy().cumsum()
            each = np.array(flat.field("sizes").to_pylist(), np.int64).reshape(len(flat), -1)
            chosen = [depths(each[low:high], shortest, least, trees, target) for low, high in zip([0, *ends[:-1]], ends)]
            ids = np.repeat(batch.column("id").to_numpy(), places.value_lengths().to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(ids), flat.field("tree"), flat.field("label"), pa.array(np.concatenate(chosen) if chosen else np.zeros(0), pa.int32())], ["id", "tree", "label", "depth"])

    chosen = stored(by_item.mapInArrow(shorten, "id long, tree int, label binary, depth int"), "jaccard-depths")
    # a node is judged if a document stops there; of several above a document the one with the shortest prefix
    out = chosen.withColumn("at", F.lit(longest))
    for d in range(longest - 1, shortest - 1, -1):
        stops = chosen.where(F.col("depth") <= d).select("tree", _prefix("label", d).alias("prefix")).distinct().withColumn("stops", F.lit(True))
        out = out.withColumn("prefix", _prefix("label", d)).join(stops, ["tree", "prefix"], "left")
        out = out.withColumn("at", F.when(F.col("stops"), d).otherwise(F.col("at"))).drop("prefix", "stops")
    return out.select("id", "tree", F.xxhash64("tree", "at", F.expr(f"substring(label, 1, {BYTES} * at)")).alias("key"))


def _candidates(rows: list) -> np.ndarray:
    """Which pairs of a block this block has to judge: rows (key, low, high, tree, own, id, nodes, ...), nodes by tree, 0 for none."""
    tree, low, high = rows[0][3], rows[0][1], rows[0][2]
    own = np.array([r[4] for r in rows])
    todo = ~np.eye(len(rows), dtype=bool)
    if low != high:
        todo &= own[:, None] != own[None, :]
    nodes = np.array([r[6] for r in rows], np.int64)
    for earlier in range(tree):
        at = nodes[:, earlier]
        todo &= (at[:, None] != at[None, :]) | (at == 0)[None, :]
    return todo


def items(docs: DataFrame, *, doc_id: str, text: str, words: int, trees: int, depth: int) -> DataFrame:
    """(doc_id, text_hash, digest, n, label) of every row; digest is that of the shingle set, null without shingles."""
    def run(batches):
        import pyarrow as pa

        names = ["doc_id", "text_hash", "digest", "n", "label"]
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [shingles(t.as_py(), words) for t in part.column(2)]
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                labels = [label(s, trees, depth) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(digests, pa.binary()), pa.array([len(s) for s in sets], pa.int32()), pa.array(labels, pa.binary())], names)

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    return plain.mapInArrow(run, "doc_id long, text_hash long, digest binary, n int, label binary")


def _sets(found: DataFrame, words: int) -> DataFrame:
    """found (id, text) to (id, shingles)."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([shingles(t.as_py(), words).tobytes() for t in part.column(1)], pa.binary())], ["id", "shingles"])

    return found.mapInArrow(run, "id long, shingles binary")


def classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, least: float = LEAST,
            trees: int = TREES, target: float = TARGET, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(rows, classes). rows: doc_id, text_hash, digest, a row per row of docs. classes: a row per shingle set.

    classes has digest, size (its rows), root (of its component), doc_id and text_hash of its
    first row, and links: the rows of other sets that are similar enough. Rows without
    words have a null digest and no class.
    """
    import pyarrow as pa

    ship(docs.sparkSession)
    shortest = prefix_length(least, trees, target)
    longest = shortest + STEPS
    rows = stored(items(docs, doc_id=doc_id, text=text, words=words, trees=trees, depth=longest), "jaccard-rows")
    reps = rows.where("digest is not null").groupBy("digest").agg(
        F.count("*").alias("size"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first"), F.max("label").alias("label"))
    reps = stored(reps.select(F.monotonically_increasing_id().alias("id"), "digest", "size", F.col("first.doc_id").alias("doc_id"),
                              F.col("first.text_hash").alias("text_hash"), "label"), "jaccard-items")
    found = judged_nodes(reps.select("id", "label"), trees=trees, shortest=shortest, longest=longest, least=least, target=target)
    found = stored(found, "jaccard-nodes")
    shared = stored(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "jaccard-shared")
    of = F.map_from_entries(F.collect_list(F.struct("tree", "key")))  # an entry per tree at most
    nodes = found.groupBy("id").agg(of.alias("by_tree"))
    nodes = stored(nodes.select("id", F.array(*[F.coalesce(F.try_element_at("by_tree", F.lit(t)), F.lit(0).cast("long")) for t in range(trees)]).alias("nodes")), "jaccard-item-nodes")
    blocks = chunked(found, shared, "key", "id", chunk).join(nodes, "id")

    def judge_labels(block):
        todo = _candidates(block).any(axis=1)
        return [(r[0], r[1], r[2], r[3], r[4], r[5]) for r, needed in zip(block, todo) if needed]

    keys = ["key", "low", "high"]
    shape = "key long, low int, high int, tree int, own int, id long"
    needed = per_block(blocks.select(*keys, "tree", "own", "id", "nodes"), keys, judge_labels, shape,
                       [("key", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("tree", pa.int32()), ("own", pa.int32()), ("id", pa.int64())])
    needed = stored(needed, "jaccard-blocks")
    wanted = reps.join(needed.select("id").distinct(), "id").select("id", F.col("doc_id").alias("of"), F.col("text_hash").alias("hash"))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    texts = texts.join(wanted, (F.col("text_hash") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("of"))).select("id", "text")
    sets = stored(_sets(texts, words).dropDuplicates(["id"]), "jaccard-sets")
    full = needed.join(sets, "id").join(nodes, "id").join(reps.select("id", "size"), "id").select(*keys, "tree", "own", "id", "nodes", "size", "shingles")

    def judge(block):
        todo = _candidates(block)
        sets_ = [np.frombuffer(r[8], np.uint64) for r in block]
        length = np.array([len(s) for s in sets_], np.float64)
        both = _overlaps(sets_).astype(np.float64)
        similar = todo & (both >= least * (length[:, None] + length[None, :] - both) - 1e-9)
        return linked(np.array([r[5] for r in block], np.int64), np.array([r[7] for r in block], np.int64), similar)

    links = stored(per_block(full, keys, judge, "id long, root long, n long", [("id", pa.int64()), ("root", pa.int64()), ("n", pa.int64())]), "jaccard-links")
    roots = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("id").agg(F.sum("n").alias("links"))
    out = reps.drop("label").join(counts, "id", "left").join(roots, "id", "left")
    out = out.select("digest", "size", F.coalesce("root", "id").alias("root"), "doc_id", "text_hash", F.coalesce("links", F.lit(0)).cast("long").alias("links"))
    return rows.select("doc_id", "text_hash", "digest"), stored(out, "jaccard-classes")


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, class_id, n_links), a row per row of docs.

    class_id: the smallest doc_id that chains of links reach, its own included. n_links: how
    many other rows are similar enough, copies each counted. Rows without words link with
    nothing and are their own class. Repeated rows link with each other; null ids take part,
    a class without any other id has none. Other columns are ignored.
    """
    rows, table = classes(docs, **how)
    smallest = table.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    table = stored(table.join(smallest, "root").select("digest", "class_id", (F.col("links") + F.col("size") - 1).alias("n_links")), "jaccard-result")
    alone = rows.where("digest is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return rows.where("digest is not null").join(table, "digest").select("doc_id", "class_id", "n_links").unionByName(alone)


def without_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of docs, all columns kept, less all but one of each class: that of the smallest doc_id (null last), then text hash.

    Rows without words all stay. Rows equal in id and text count as one document.
    """
    rows, table = classes(docs, doc_id=doc_id, text=text, **how)
    first = table.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first"))
    chosen = first.select(F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"))
    copies = rows.where("digest is not null").join(chosen, (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    chosen = stored(copies.groupBy("_id", "_hash").agg(F.count("*").alias("_copies")), "jaccard-kept")
    marked = docs.withColumn("_text_hash", F.xxhash64(text))
    kept = marked.join(chosen, (F.col("_text_hash") == F.col("_hash")) & F.col(doc_id).cast("long").eqNullSafe(F.col("_id")))
    once, again = kept.where("_copies = 1"), kept.where("_copies > 1").dropDuplicates(["_id", "_hash"])
    blank = docs.where(~F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return once.select(*docs.columns).unionByName(again.select(*docs.columns)).unionByName(blank.select(*docs.columns))
