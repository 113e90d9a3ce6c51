"""Near-duplicate embeddings by an inverted multi-index.

The two halves of a unit vector have a codebook each; a vector's home is the cell of its
nearest centroid pair. Multi-sequence traversal gives the cells around a vector from near to
far. How many of them are visited is measured, not guessed: for query vectors apart from the
codebooks' points all links are found by brute force against every row, and cells are added
until the visited ones hold the target share of these links, each query item and each group of
links weighing the same. Too few links are no measurement: queries are drawn until enough are
seen, every item was one or a bound on their number is met. In the last case partners are planted:
vectors at the threshold and above it around the queries, in several directions, and cells are added until the target share
of these is met too. Candidates are then verified in double precision.

Equal vectors are one item from the start. Pairs are counted in blocks (see ``links``), each
once.
"""

from __future__ import annotations

import hashlib
import heapq
import logging
import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .links import components, linked, per_block

SAMPLE, QUERIES, ENOUGH = 20_000, 1024, 300
MOST_QUERIES, DRAW_BYTES = 8192, 64 << 20  # in one draw
MEASURED = 16_384  # queries after which partners are planted
PROBES = 2048  # of each direction
PLACES = 1 << 30
CHUNK = TILE = 1024
TARGET = 0.999
PER_CELL = 32  # items a cell should hold on average
ROUNDS = 8


def unit(vector) -> np.ndarray | None:
    """The vector with length 1 in double precision; None for null, empty and zero vectors and those with null or non-finite parts."""
    if vector is None or not len(vector) or any(x is None for x in vector):
        return None
    x = np.asarray(vector, np.float64)
    top = np.abs(x).max()
    if not np.isfinite(top) or top == 0:
        return None
    x = x / top  # no overflow or underflow in the squares
    return x / math.sqrt(float(x @ x))


def codebook(points: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """Centroids by k-means from a seeded start; no more than there are different points."""
    points = np.ascontiguousarray(points)
    different = np.unique(points, axis=0)
    size = max(1, min(size, len(different)))
    centres = different[np.random.default_rng(seed).permutation(len(different))[:size]]
    for _ in range(ROUNDS):
        near = _distances(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=size)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((points ** 2).sum(axis=1)[:, None] + (centres ** 2).sum(axis=1)[None] - 2 * points @ centres.T, 0)


def multi_sequence(first: np.ndarray, second: np.ndarray, cells: int) -> list[int]:
    """The nearest cells of the product grid, near to far, from the distances to both codebooks."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y, width = first[a], second[b], len(second)
    heap, out, pushed = [(x[0] + y[0], 0, 0)], [], {(0, 0)}
    while heap and len(out) < cells:
        _, i, j = heapq.heappop(heap)
        out.append(int(a[i]) * width + int(b[j]))
        for i2, j2 in ((i + 1, j), (i, j + 1)):
            if i2 < len(x) and j2 < len(y) and (i2, j2) not in pushed:
                pushed.add((i2, j2))
                heapq.heappush(heap, (x[i2] + y[j2], i2, j2))
    return out


class Index:
    """Two codebooks; traversals of any vectors."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second
        self.width = first.shape[1] + second.shape[1]

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return _distances(vectors[:, :half], self.first), _distances(vectors[:, half:], self.second)

    def visits(self, vectors: np.ndarray, cells: int) -> list[list[int]]:
        a, b = self.distances(vectors)
        if cells == 1:
            return [[int(n)] for n in a.argmin(axis=1) * len(self.second) + b.argmin(axis=1)]
        return [multi_sequence(p, q, cells) for p, q in zip(a, b)]


def _vectors(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def items(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, digest, width, vector) of every row: the unit vector as doubles; null digest for what links with nothing."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            units = [unit(v) for v in batch.column(1).to_pylist()]
            held = [None if u is None else u.tobytes() for u in units]
            digests = [None if h is None else hashlib.blake2b(h, digest_size=16).digest() for h in held]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array([0 if u is None else len(u) for u in units], pa.int32()), pa.array(held, pa.binary())],
                ["vec_id", "digest", "width", "vector"])

    plain = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    return plain.mapInArrow(run, "vec_id long, digest binary, width int, vector binary")


def _reach(first: np.ndarray, second: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """How many cells of the product grid are as near as each of the sums; ties count, so that many visited cells hold it."""
    return np.searchsorted(np.sort(second), sums[:, None] + 1e-9 - first[None], side="right").sum(axis=1)


def _reaches(owners: np.ndarray, cells: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of cells that owner n, with distances a[n] and b[n], visits until it is at cell cells[n]; each different pair is worked out once."""
    width = b.shape[1]
    pairs, back = np.unique(owners * (a.shape[1] * width) + cells, return_inverse=True)
    owner, cell = np.divmod(pairs, a.shape[1] * width)
    out = np.zeros(len(pairs), np.int64)
    for part in np.split(np.arange(len(pairs)), np.flatnonzero(np.diff(owner)) + 1):
        x = owner[part[0]]
        out[part] = _reach(a[x], b[x], a[x][cell[part] // width] + b[x][cell[part] % width])
    return out[back]


def planted_reaches(index: Index, vectors: np.ndarray, least: float, seed: int = 1) -> dict[str, np.ndarray]:
    """By direction, from how many visited cells on each vector and a partner planted for it meet.

    A partner's cosine is ``least`` for every second vector, that of the others lies evenly between it and 1. It is off
    in a random direction, in one that lies in one half of the vector (the other half of the index hardly helps then
    or hardly hurts), or towards another of the vectors, as the data spread.
    """
    r = np.random.default_rng(seed)
    n, half = len(vectors), index.first.shape[1]
    anywhere = r.standard_normal(vectors.shape)
    one_half = r.standard_normal(vectors.shape)
    one_half[::2, :half] = 0
    one_half[1::2, half:] = 0
    cosine = np.where(r.random(n) < 0.5, least, r.uniform(least, 1, n))[:, None]
    a, b = index.distances(vectors)
    homes = a.argmin(axis=1) * b.shape[1] + b.argmin(axis=1)
    out = {}
    for name, way in (("anywhere", anywhere), ("one half", one_half), ("towards others", np.roll(vectors, 1, axis=0))):
        way = way - (way * vectors).sum(axis=1)[:, None] * vectors
        length = np.sqrt((way ** 2).sum(axis=1))
        of = np.flatnonzero(length > 1e-9)  # no direction is left for some
        partners = cosine[of] * vectors[of] + np.sqrt(np.maximum(1 - cosine[of] ** 2, 0)) * way[of] / length[of, None]
        pa, pb = index.distances(partners)
        partner_homes = pa.argmin(axis=1) * pb.shape[1] + pb.argmin(axis=1)
        if len(of):
            out[name] = np.minimum(_reaches(of, partner_homes, a, b), _reaches(np.arange(len(of)), homes[of], pa, pb))
    return out


def query_links(reps: DataFrame, index: Index, queries: list, least: float) -> DataFrame:
    """(query, at, n): the number of links of each query that are met from the at-th visited cell of either end on.

    queries: (id, vector), a bounded number; every item is compared with all of them, a
    tile at a time.
    """
    ids, vectors = np.array([q[0] for q in queries], np.int64), _vectors([q[1] for q in queries])

    def count(batches):
        import pyarrow as pa

        sums = {}
        query_a, query_b = index.distances(vectors)
        query_homes = query_a.argmin(axis=1) * query_b.shape[1] + query_b.argmin(axis=1)
        for batch in batches:
            for first in range(0, batch.num_rows, TILE):
                part = batch.slice(first, TILE)
                own, held = part.column(0).to_numpy(), _vectors(part.column(1).to_pylist())
                a = None
                for start in range(0, len(ids), TILE):
                    row, query = np.nonzero(held @ vectors[start:start + TILE].T >= least)
                    query += start
                    keep = own[row] != ids[query]
                    row, query = row[keep], query[keep]
                    if not len(row):
                        continue
                    if a is None:
                        a, b = index.distances(held)
                        homes = a.argmin(axis=1) * b.shape[1] + b.argmin(axis=1)
                    at = np.minimum(_reaches(row, query_homes[query], a, b), _reaches(query, homes[row], query_a, query_b))
                    found, n = np.unique(np.stack([ids[query], at], axis=1), axis=0, return_counts=True)
                    for (q, k), m in zip(found.tolist(), n.tolist()):
                        sums[q, k] = sums.get((q, k), 0) + m
        yield pa.RecordBatch.from_arrays(
            [pa.array([q for q, _ in sums], pa.int64()), pa.array([k for _, k in sums], pa.int32()), pa.array(list(sums.values()), pa.int64())], ["query", "at", "n"])

    return reps.select("id", "vector").mapInArrow(count, "query long, at int, n long").groupBy("query", "at").agg(F.sum("n").alias("n"))


def cells_to_visit(reps: DataFrame, place: Column, cut: int, n: int, index: Index, least: float, target: float, n_queries: int, enough: int, measured: int | None) -> dict:
    """How many cells an item has to visit, and how that was found out.

    Queries are drawn by hash, first those apart from the codebooks' points (place below
    ``cut``), in growing draws until their links belong to ``enough`` groups (an item with d
    links counts as 1 / (d + 1) of a group), all items were drawn or ``measured`` queries were. Every query weighs the
    same in the recall by items and every group the same in the recall by groups; both have
    to reach the target. When all items were queries no known link is given up. When the bound
    ended the draws, links are rare and few are known: then the target share of planted partners
    has to be met too, in each direction (see ``planted_reaches``). Without a bound all links get known, by n x n comparisons.
    """
    turned = F.pmod(place - F.lit(cut), F.lit(PLACES))
    most = max(1, min(MOST_QUERIES, DRAW_BYTES // (8 * index.width)))
    drawn, low, size, seen, parts, probes = 0, 0, max(1, min(n_queries, most)), 0.0, [], []
    while low < PLACES and seen < enough and (measured is None or drawn < measured):
        high = min(PLACES, low + max(1, math.ceil(PLACES * size / n)))
        queries = reps.where((turned >= low) & (turned < high)).select("id", "vector").orderBy("id").collect()  # about most at most
        low, size, drawn = high, min(2 * size, most), drawn + len(queries)
        probes += queries[:max(0, min(PROBES, most) - len(probes))]
        if queries:
            links = stored(query_links(reps, index, queries, least), "vector-queries")
            total = links.groupBy("query").agg(F.sum("n").alias("total"))
            share = F.col("n") / F.col("total")
            # a row per number of cells
            part = links.join(total, "query").groupBy("at").agg(F.sum(share).alias("items"), F.sum(share / (F.col("total") + 1)).alias("groups")).collect()
            parts += [(r[0], r[1], r[2]) for r in part]
            seen += math.fsum(r[2] for r in part)
    every = low >= PLACES
    items, groups = math.fsum(r[1] for r in parts), math.fsum(r[2] for r in parts)
    cells, by_item, by_group = 1, 0.0, 0.0
    for at in sorted({r[0] for r in parts}):
        cells = at
        by_item += math.fsum(r[1] for r in parts if r[0] == at)
        by_group += math.fsum(r[2] for r in parts if r[0] == at)
        if not every and by_item >= target * items - 1e-9 and by_group >= target * groups - 1e-9:
            break
    planted = {}
    if not every and seen < enough:
        for name, at in planted_reaches(index, _vectors([q[1] for q in probes]), least).items():
            cells = max(cells, int(np.sort(at)[math.ceil(target * len(at)) - 1]))
            planted[name] = at
    planted = {name: float((at <= cells).mean()) for name, at in planted.items()}
    return {"items": n, "queries": drawn, "planted_recall": planted, "every_item_a_query": every, "linked_queries": round(items), "groups": groups, "cells": cells,
            "recall_by_item": by_item / items if items else 1.0, "recall_by_group": by_group / groups if groups else 1.0}


def _log(measure: dict) -> None:
    logging.getLogger(__name__).info("visited cells: %s", measure)


def near_duplicates(rows: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.95, target: float = TARGET,
                    sample: int = SAMPLE, n_queries: int = QUERIES, enough: int = ENOUGH, measured: int | None = MEASURED, chunk: int = CHUNK, report: Callable[[dict], None] | None = None) -> DataFrame:
    """(vec_id, n_links, component_id), a row per row.

    n_links: the other rows whose cosine is at least ``least``, copies each counted;
    component_id: the smallest vec_id that links reach. Null, empty and zero vectors and
    those with null or non-finite parts link with nothing. Vectors of different widths are
    indexed apart and do not link. Repeated rows link with each other; null ids take part, a
    component without any other id has none. The codebooks are fitted on about ``sample`` items at
    most, chosen by hash; the number of cells is measured on about ``n_queries`` others and
    on more until ``enough`` groups of links are seen. Where links are so rare that ``measured`` queries do not show
    enough, planted partners are the measure; with None the draws go on to the last item, n x n comparisons. Every item
    is indexed. ``report`` gets the measure of each width (see ``cells_to_visit``), with the
    recall reached; without one it is logged. Other columns are ignored.
    """
    ship(rows.sparkSession)
    all_rows = stored(items(rows, vec_id, embedding), "vectors")
    named = all_rows.where("digest is not null")
    reps = named.groupBy("digest").agg(F.count("*").alias("size"), F.min("vec_id").alias("vec_id"), F.max("width").alias("width"), F.max("vector").alias("vector"))
    reps = stored(reps.withColumn("id", F.monotonically_increasing_id()), "vector-items")
    found = None
    for width, n in sorted((r[0], r[1]) for r in reps.groupBy("width").count().collect()):  # a row per width
        part = _found(reps.where(F.col("width") == width), n, least, target, sample, n_queries, enough, measured, chunk, report or _log)
        found = part if found is None else found.unionByName(part)
    alone = all_rows.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if found is None:
        return alone
    found = stored(found, "vector-links")
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("id").agg(F.sum("n").alias("links"))
    table = reps.select("id", "digest", "size", "vec_id").join(counts, "id", "left").join(roots, "id", "left")
    table = stored(table.select("digest", "vec_id", F.coalesce("root", "id").alias("root"), (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "vector-classes")
    smallest = table.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    result = stored(table.join(smallest, "root").select("digest", "n_links", "component_id"), "vector-result")
    return named.select("vec_id", "digest").join(result, "digest").select("vec_id", "n_links", "component_id").unionByName(alone)


def _found(reps: DataFrame, n: int, least: float, target: float, sample: int, n_queries: int, enough: int, measured: int | None, chunk: int, report: Callable[[dict], None]) -> DataFrame:
    """(id, root, n) of the links among the items of one width."""
    import pyarrow as pa

    place = F.pmod(F.xxhash64("digest"), F.lit(PLACES))
    cut = math.ceil(PLACES * min(0.5, sample / n))  # at most half the items, so that there are others to measure on
    fit = lambda below: reps.where(place < below).select("vector", "id").orderBy("id").collect()  # noqa: E731  about sample at most
    points = fit(cut)
    if not points:  # a handful of items
        points, cut = fit(PLACES), 0
    points = _vectors([r[0] for r in points])
    half = points.shape[1] // 2
    size = max(1, min(len(points) // 8, round(math.sqrt(n / PER_CELL))))
    index = Index(codebook(points[:, :half], size), codebook(points[:, half:], size))
    measure = cells_to_visit(reps, place, cut, n, index, least, target, n_queries, enough, measured)
    cells = measure["cells"]
    report(measure)

    def visit(batches):
        for batch in batches:
            around = index.visits(_vectors(batch.column(1).to_pylist()), cells)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(around, pa.list_(pa.int32()))], ["id", "visits"])

    placed = stored(reps.select("id", "vector").mapInArrow(visit, "id long, visits array<int>"), "vector-cells")
    homes = placed.select("id", F.col("visits")[0].alias("cell"))
    probes = placed.select("id", F.explode("visits").alias("cell"))
    in_cell = probes.groupBy("cell").agg(F.ceil(F.count("*") / chunk).cast("int").alias("probing"))
    at_home = homes.groupBy("cell").agg(F.ceil(F.count("*") / chunk).cast("int").alias("living"))
    sizes = stored(in_cell.join(at_home, "cell"), "vector-cell-sizes")
    chunk_of = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
    lives = homes.join(sizes, "cell").select("cell", chunk_of("living").alias("home"), F.explode(F.sequence(F.lit(0), F.col("probing") - 1)).alias("probe"), F.lit(True).alias("lives"), "id")
    asks = probes.join(sizes, "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("living") - 1)).alias("home"), chunk_of("probing").alias("probe"), F.lit(False).alias("lives"), "id")
    full = lives.unionByName(asks).join(placed, "id").join(reps.select("id", "size", "vector"), "id")
    keys = ["cell", "home", "probe"]

    def judge(block):
        at_home, asking = [r for r in block if r[3]], [r for r in block if not r[3]]
        if not at_home or not asking:
            return
        cell = block[0][0]
        near = _vectors([r[7] for r in asking]) @ _vectors([r[7] for r in at_home]).T >= least
        p, h = np.nonzero(near)
        own, other = np.array([r[4] for r in asking], np.int64)[p], np.array([r[4] for r in at_home], np.int64)[h]
        # a pair meets here, and also at the asking item's home if the item at home visits that; the smaller cell counts it
        home_of = np.array([r[5][0] for r in asking], np.int64)[p]
        twice = np.fromiter((int(c) in set_ for c, set_ in zip(home_of, map([set(r[5]) for r in at_home].__getitem__, h))), bool, len(h))
        counts = np.where(home_of == cell, own < other, ~twice | (cell < home_of))
        p, h = p[counts & (own != other)], h[counts & (own != other)]
        everyone = {r[4]: k for k, r in enumerate(at_home)}
        rows = list(at_home)
        for r in asking:
            if r[4] not in everyone:
                everyone[r[4]] = len(rows)
                rows.append(r)
        links = np.zeros((len(rows), len(rows)), bool)
        a = np.array([everyone[r[4]] for r in asking], np.int64)[p]
        links[a, h] = links[h, a] = True
        yield from linked(np.array([r[4] for r in rows], np.int64), np.array([r[6] for r in rows], np.int64), links)

    return per_block(full.select(*keys, "lives", "id", "visits", "size", "vector"), keys, judge, "id long, root long, n long",
                     [("id", pa.int64()), ("root", pa.int64()), ("n", pa.int64())])
