"""Source divergence audit over a K2-quadtree of the group-term count matrix.

Every language has a matrix of its (language, source) groups by its kept terms, nearly all
zeros at scale. The matrix is a quadtree: tiles of SIDE x SIDE counts that hold anything are
rows of a table, all others do not exist; a tile is divided by two on both sides until
its quadrants are empty or leaves.

A group's share of a term it never has is the same for all such terms. So two groups' distance
over an empty quadrant is its width times the difference of these two shares. The whole
matrix is priced so in one step, and the two groups' trees are then walked together: where either
holds something the walk goes down, and the leaves put right what the price had wrong. Walks are
of two blocks of groups over one tile's columns, so a unit of work is bounded.

Arithmetic is exact: whole numbers, products in decimals.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, ship, stored

SIDE, LEAF = 256, 16
LEAST_DOCS, ADDED, UNIT, TOP = 30, 5, 1_000_000_000, 50
HELD = 400_000  # terms a task counts before it hands on what it has
# A term is a run of ASCII letters and code points from U+0080 on; only A-Z are lower-cased.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(data: bytes) -> list[bytes]:
    return data.translate(FOLDED).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of docs (lang, source, text as binary): occurrences, and documents that have the term."""
    def count(batches):
        import pyarrow as pa

        names = ["lang", "source", "term", "n", "docs"]
        total, once, held = {}, {}, 0

        def handed_on():
            for (lang, source), c in total.items():
                found, n, docs_ = list(c), list(c.values()), list(map(once[lang, source].__getitem__, c))
                for at in range(0, len(found), 50_000):
                    part = slice(at, at + 50_000)
                    yield pa.RecordBatch.from_arrays([*(pa.repeat(pa.scalar(x, pa.string()), len(found[part])) for x in (lang, source)),
                                                      pa.array(found[part], pa.binary()), pa.array(n[part], pa.int64()), pa.array(docs_[part], pa.int64())], names)

        for batch in batches:
            for lang, source, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = terms(whole.as_py() or b"")
                group = lang, source
                if group not in total:
                    total[group], once[group] = Counter(), Counter()
                before = len(total[group])
                total[group].update(words)
                once[group].update(set(words))
                held += len(total[group]) - before
                if held >= HELD:
                    yield from handed_on()
                    total, once, held = {}, {}, 0
        yield from handed_on()

    found = docs.select("lang", "source", "text").mapInArrow(count, "lang string, source string, term binary, n long, docs long")
    found = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return found.withColumn("term", F.col("term").cast("string"))


def share(count: Column, whole: Column, kinds: Column) -> Column:
    """1 + floor(UNIT * (count + ADDED) / (whole + ADDED * kinds)), exact; 0 without any term."""
    up = F.lit(UNIT).cast("decimal(10,0)") * (count + ADDED).cast("decimal(19,0)")
    down = (whole + ADDED * kinds).cast("decimal(19,0)")
    return F.when(kinds > 0, 1 + F.call_function("div", up, down)).otherwise(F.lit(0)).cast("long")


class Tree:
    """The quadtree of one tile: which quadrants hold something, level by level from the whole tile down to leaves, and the leaves' shares.

    base: the share of each of the tile's groups where its count is zero.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, shares: np.ndarray, base: np.ndarray, side: int = SIDE, leaf: int = LEAF):
        self.base, self.leaf = base.reshape(side // leaf, leaf), leaf
        n = side // leaf
        full = np.zeros((n, n), bool)
        full[rows // leaf, columns // leaf] = True
        self.levels = [full]
        while n > 1:
            n //= 2
            full = full.reshape(n, 2, n, 2).any(axis=(1, 3))
            self.levels.insert(0, full)
        at, _ = np.nonzero(self.levels[-1])
        self.slot = np.full(self.levels[-1].shape, -1)
        self.slot[self.levels[-1]] = np.arange(len(at))
        self.leaves = np.repeat(self.base[at][:, :, None], leaf, axis=2)
        self.leaves[self.slot[rows // leaf, columns // leaf], rows % leaf, columns % leaf] = shares

    def leaf_shares(self, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The shares of leaves, empty ones too: (leaf, group, term)."""
        out = np.repeat(self.base[row][:, :, None], self.leaf, axis=2)
        slot = self.slot[row, column]
        out[slot >= 0] = self.leaves[slot[slot >= 0]]
        return out


def corrections(a: Tree, b: Tree, same: bool) -> np.ndarray:
    """For every group of a and every group of b: what the tile's columns add to the distance beyond the price of empty columns.

    Both trees are walked together from the tile down; a quadrant that is empty in both is left at once. same: a is b, and
    only the leaves on and above the diagonal are walked.
    """
    n, leaf = len(a.base), a.leaf
    out = np.zeros((n, n, leaf, leaf), np.int64)
    first = second = column = np.zeros(1, np.int64)
    for level, (full_a, full_b) in enumerate(zip(a.levels, b.levels)):
        if level:
            step = np.indices((2, 2, 2)).reshape(3, -1)
            first, second, column = ((2 * x[:, None] + s[None]).ravel() for x, s in zip((first, second, column), step))
        go = full_a[first, column] | full_b[second, column]
        if same:
            go &= first <= second
        first, second, column = first[go], second[go], column[go]
    gap = np.abs(a.base[:, None, :, None] - b.base[None, :, None, :])
    for at in range(0, len(first), 256):
        x, y, c = first[at:at + 256], second[at:at + 256], column[at:at + 256]
        far = np.abs(a.leaf_shares(x, c)[:, :, None, :] - b.leaf_shares(y, c)[:, None, :, :]).sum(axis=3)
        np.add.at(out, (x, y), far - leaf * gap[x, y])
    return out.transpose(0, 2, 1, 3).reshape(n * leaf, n * leaf)


def _fields(structs, at: int, *names: str) -> list[np.ndarray]:
    """The named fields of the structs that list column ``structs`` has in row ``at``; none for null."""
    values = structs[at].values
    return [np.zeros(0, np.int64) if values is None else values.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names]


def _walk(batches):
    """Rows (lang, low, high, kinds, tile, low_groups, high_groups, low_cells, high_cells) to (lang, a, b, value), a < b places of groups.

    A row without a tile is priced; a row of a tile gives corrections.
    """
    import pyarrow as pa

    names = ["lang", "a", "b", "value"]
    for batch in batches:
        lang, low, high, tile, kinds = (batch.column(c).to_pylist() for c in ("lang", "low", "high", "tile", "kinds"))
        for at in range(batch.num_rows):
            same = low[at] == high[at]
            base, count, trees = [], [], []
            for side in ("low", "high"):
                row, p = _fields(batch.column(f"{side}_groups"), at, "row", "p")
                padded = np.zeros(SIDE, np.int64)
                padded[row] = p
                base.append(padded)
                count.append(len(row))
            if tile[at] is None:
                value = kinds[at] * np.abs(base[0][:, None] - base[1][None])
                emit = np.ones_like(value, bool)
            else:
                trees = [Tree(*_fields(batch.column(f"{side}_cells"), at, "row", "column", "p"), b) for side, b in zip(("low", "high"), base)]
                value = corrections(trees[0], trees[0] if same else trees[1], same)
                emit = value != 0
            emit = emit[:count[0], :count[1]]
            if same:
                emit = np.triu(emit, 1)
            x, y = np.nonzero(emit)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang[at], pa.string()), len(x)), pa.array(SIDE * low[at] + x), pa.array(SIDE * high[at] + y), pa.array(value[x, y])], names)


def pair_distances(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """(lang, a, b, value) for every two groups a < b of a language; value: the sum of |p - q| over its kept terms.

    groups: (lang, place, kinds, p), place from 0 in a language, p the share of a term it does not have. cells: (lang,
    place, column, p) of the counts that are not zero.
    """
    inside = lambda c: F.pmod(c, F.lit(SIDE)).cast("int")
    block_of = lambda c: F.floor(F.col(c) / SIDE).cast("long")
    blocks = stored(groups.groupBy("lang", block_of("place").alias("block")).agg(
        F.max("kinds").alias("kinds"), F.sort_array(F.collect_list(F.struct(inside(F.col("place")).alias("row"), "p"))).alias("groups")), "divergence-blocks")  # SIDE groups each at most
    count = blocks.groupBy("lang").agg(F.count("*").alias("blocks"), F.max("kinds").alias("kinds"))
    tiles = cells.groupBy("lang", block_of("place").alias("block"), block_of("column").alias("tile")).agg(
        F.collect_list(F.struct(inside(F.col("place")).alias("row"), inside(F.col("column")).alias("column"), "p")).alias("cells"))  # SIDE x SIDE cells each at most
    met = stored(tiles, "divergence-tiles").join(count, "lang").withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    met = met.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    of = lambda side: F.max(F.when(F.col("block") == F.col(side), F.col("cells"))).alias(f"{side}_cells")  # noqa: E731  one tile each at most
    met = met.groupBy("lang", "tile", "low", "high", "kinds").agg(of("low"), of("high"))
    whole = blocks.join(count.drop("kinds"), "lang").select("lang", F.col("block").alias("low"), F.explode(F.expr("sequence(block, blocks - 1)")).alias("high"), "kinds")
    whole = whole.select("lang", F.lit(None).cast("long").alias("tile"), "low", "high", "kinds").withColumn("low_cells", F.lit(None)).withColumn("high_cells", F.lit(None))
    work = met.select("lang", "tile", "low", "high", "kinds", "low_cells", "high_cells").unionByName(whole)
    for side in ("low", "high"):
        work = work.join(blocks.select("lang", F.col("block").alias(side), F.col("groups").alias(f"{side}_groups")), ["lang", side])
    walked = work.mapInArrow(_walk, "lang string, a long, b long, value long")
    return walked.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each (language, source) group is from the others, and what its language's other texts have less of.

    A language keeps the terms that at least ``least_docs`` of its documents have. Each group, and the
    language, gives a kept term the share p (see ``share``). Part ``pair``: each other source of the
    language with the sum of |p - q| over the kept terms, 0 without any. Part ``term``: kept terms
    that the group has and gives more than the language does, with the difference, the ``top`` largest only.
    rank: from 1 within group and part, by value descending, then item in UTF-8 order. Null texts, languages and
    sources count as empty; a group without terms has pairs only, and a language's only
    group none. Other columns are ignored; repeated rows count each.
    """
    ship(docs.sparkSession)
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    plain = docs.select(empty(lang).alias("lang"), empty(source).alias("source"), F.col(text).cast("binary").alias("text"))
    counts = stored(term_counts(plain), "divergence-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all")).where(F.col("docs") >= least_docs)
    kept = stored(numbered(kept.select("lang", "term", "all"), ["lang", "term"], "at"), "divergence-terms")
    langs = stored(kept.groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("all").alias("whole"), F.min("at").alias("first")), "divergence-langs")
    terms_ = kept.join(langs, "lang").select("lang", "term", (F.col("at") - F.col("first")).alias("column"), share(F.col("all"), F.col("whole"), F.col("kinds")).alias("q"))
    found = stored(counts.select("lang", "source", "term", "n").join(terms_, ["lang", "term"]), "divergence-found")
    sums = found.groupBy("lang", "source").agg(F.sum("n").alias("whole"))
    groups = plain.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs.select("lang", "kinds"), "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("whole", F.lit(0)).alias("whole"), F.coalesce("kinds", F.lit(0)).alias("kinds"))
    groups = stored(numbered(groups, ["lang", "source"], "at"), "divergence-groups")
    firsts = groups.groupBy("lang").agg(F.min("at").alias("first"))
    groups = stored(groups.join(firsts, "lang").select("lang", "source", "whole", "kinds", (F.col("at") - F.col("first")).alias("place"),
                                                       share(F.lit(0).cast("long"), F.col("whole"), F.col("kinds")).alias("p")), "divergence-placed")
    cells = found.join(groups.drop("p"), ["lang", "source"]).select(
        "lang", "source", "place", "term", "column", "q", share(F.col("n"), F.col("whole"), F.col("kinds")).alias("p"))
    cells = stored(cells, "divergence-cells")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    # only the top of each group: the window's limit is applied before the rows are dealt out
    terms_of = ranked(cells.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))).where(F.col("rank") <= top)
    pairs = stored(pair_distances(groups.select("lang", "place", "kinds", "p"), cells.select("lang", "place", "column", "p")), "divergence-pairs")
    both = pairs.unionByName(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = groups.select("lang", "place", "source")
    named = both.join(names.withColumnRenamed("place", "a"), ["lang", "a"]).join(names.select("lang", F.col("place").alias("b"), F.col("source").alias("item")), ["lang", "b"])
    out = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return out(ranked(named.select("lang", "source", "item", "value")), "pair").unionByName(out(terms_of, "term"))
