"""Periodic runs of words, found on a harmonic grid and extended by queries to a run-length grammar.

A run is a stretch of words with smallest period q, at least ``least_repeats`` periods and
``least_words`` words long, that no neighbouring word extends. Such a stretch holds a
multiple i of 2q with words i, i + q and i + 2q alike, and i + 1 like i + 1 + q; so the multiples of 2q,
for every q, are candidates: n/2 times a harmonic sum. How far a candidate's period
goes to both sides is the longest common extension of i and i + q, forwards and backwards.

Extensions are answered by recompression: alternately, blocks of one symbol become a symbol
each, and pairs of neighbours from two disjoint sets of symbols do, until every text is one symbol.
What a symbol stands for is cut alike wherever it occurs, so an extension is a walk: up while two
places agree, down to the word where they part. All candidates of a batch of texts walk
together; texts are closed by symbols of their own, which nothing equals.

There is no shuffle: each text is read, checked and answered for in one task, a bounded batch
of texts at a time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

LEAST_WORDS, LEAST_REPEATS = 6, 4
BATCH_BYTES = 4 << 20
GRID = 1 << 20  # candidates looked at together
SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


class Grammar:
    """A run-length grammar of a sequence of symbols 0, 1, ..; symbols below zero occur once each, close a text and stay as they are.

    The sequence ends with a closing symbol.
    ``levels`` holds, from the sequence itself up: its symbols, the place of each one's
    parent in the level above, where each parent begins and of how many symbols it is made, and, for a level that
    pairs were made of, which symbols can be second ones.
    """

    def __init__(self, sequence: np.ndarray):
        symbols, level = np.asarray(sequence, np.int64), 0
        self.levels: list[dict] = []
        rng = np.random.default_rng(7)
        while ((symbols[1:] >= 0) & (symbols[:-1] >= 0)).any():  # until all between two closing symbols is one
            second = None
            if level % 2 == 0:
                first = np.concatenate(([True], (symbols[1:] != symbols[:-1]))) if len(symbols) else np.zeros(0, bool)
            else:
                second = self._seconds(symbols, rng)
                joined = second[1:] & ~second[:-1] & (symbols[1:] >= 0) & (symbols[:-1] >= 0)
                first = np.concatenate(([True], ~joined)) if len(symbols) else np.zeros(0, bool)
            heads = np.flatnonzero(first)
            counts = np.diff(np.append(heads, len(symbols)))
            self.levels.append({"symbols": symbols, "parent": np.cumsum(first) - 1, "heads": heads, "second": second, "counts": counts})
            head = symbols[heads]
            other = counts if second is None else np.where(counts == 2, symbols[np.minimum(heads + 1, len(symbols) - 1)] + 1, 0)
            symbols, level = self._named(head, other), level + 1
        self.top = symbols

    def __len__(self) -> int:
        """Symbols of all levels."""
        return sum(len(x["symbols"]) for x in self.levels) + len(self.top)

    @staticmethod
    def _named(head: np.ndarray, other: np.ndarray) -> np.ndarray:
        """One symbol per different (head, other); heads below zero keep their own."""
        out, plain = head.copy(), head >= 0
        if plain.any():
            width = int(other.max()) + 1
            out[plain] = np.unique(head[plain] * width + other[plain], return_inverse=True)[1]
        return out

    @staticmethod
    def _seconds(symbols: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Which places hold a symbol of the second set: the better of some random halves, turned round if that makes more pairs."""
        plain = symbols >= 0
        both = plain[1:] & plain[:-1]
        size = int(symbols.max()) + 1 if len(symbols) and symbols.max() >= 0 else 0
        best, most = np.zeros(len(symbols), bool), 0
        tries = 0
        while tries < 2 or (not most and both.any()):  # neighbours differ here, so some halves part two of them
            tries += 1
            half = rng.integers(0, 2, size).astype(bool)
            there = np.zeros(len(symbols), bool)
            there[plain] = half[symbols[plain]]
            for second in (there, plain & ~there):
                made = int(np.count_nonzero(both & second[1:] & ~second[:-1]))
                if made > most:
                    best, most = second, made
        return best

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For places a[k] < b[k] of the sequence: how many symbols from there on agree."""
        n = len(a)
        base = np.asarray(a, np.int64)
        a, b = base.copy(), np.array(b, np.int64)
        parted_at = np.full(n, -1)
        walking = np.arange(n)
        for k, level in enumerate(self.levels):
            if not len(walking):
                break
            symbols, parent, heads, counts = level["symbols"], level["parent"], level["heads"], level["counts"]
            x, y = a[walking], b[walking]
            same = symbols[x] == symbols[y]
            if level["second"] is None:
                # inside a block on either side: go to the nearer end of both blocks
                left_x = heads[parent[x]] + counts[parent[x]] - x
                left_y = heads[parent[y]] + counts[parent[y]] - y
                inside = same & ((heads[parent[x]] != x) | (heads[parent[y]] != y))
                step = np.where(inside, np.minimum(left_x, left_y), 0)
                parted = ~same | (inside & (left_x != left_y))
            else:
                step = (same & level["second"][x]).astype(np.int64)
                parted = ~same
            x, y = x + step, y + step
            a[walking], b[walking] = x, y
            parted_at[walking[parted]] = k
            walking, x, y = walking[~parted], x[~parted], y[~parted]
            a[walking], b[walking] = parent[x], parent[y]
        # a symbol of the top is followed by a closing one; from where two places parted go down to the symbols they are made of
        parted_at[walking] = len(self.levels)
        alike = self.top[a[walking]] == self.top[b[walking]]
        a[walking], b[walking] = a[walking] + alike, b[walking] + alike
        for k in range(len(self.levels) - 1, -1, -1):
            down = np.flatnonzero(parted_at > k)
            if not len(down):
                continue
            level = self.levels[k]
            symbols, heads, counts = level["symbols"], level["heads"], level["counts"]
            p, q = a[down], b[down]
            x, y = heads[p], heads[q]
            same = symbols[x] == symbols[y]
            most = np.minimum(counts[p], counts[q]) if level["second"] is None else 1
            step = np.where(same, most, 0)
            a[down], b[down] = x + step, y + step
        return a - base


def grid(texts: list[np.ndarray], repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of the candidates, about GRID of them looked at together.

    repeats is at least 4: then the multiple of 2q in a run's first 2q words has two periods of the run behind it.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths) - lengths
    words = np.concatenate([np.zeros(0, np.int64), *texts])
    most = lengths // repeats  # the longest period that fits
    owner = np.repeat(np.arange(len(lengths)), most)
    period = np.arange(len(owner)) - np.repeat(np.cumsum(most) - most, most) + 1
    points = (lengths[owner] - 1) // (2 * period)  # multiples i of 2q with i + 2q inside
    ends = np.cumsum(points)
    low = 0
    while low < len(owner):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + GRID, side="right")))
        n = points[low:high]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        q, first = np.repeat(period[low:high], n), np.repeat(starts[owner[low:high]], n)
        i = first + 2 * q * at
        alike = np.flatnonzero(words[i] == words[i + q])
        alike = alike[(words[i[alike]] == words[i[alike] + 2 * q[alike]]) & (words[i[alike] + 1] == words[i[alike] + 1 + q[alike]])]
        yield np.repeat(owner[low:high], n)[alike], (i - first)[alike], q[alike]
        low = high


def runs_of(texts: list[np.ndarray], least_words: int = LEAST_WORDS, least_repeats: int = LEAST_REPEATS) -> list[np.ndarray]:
    """For each sequence of word numbers (0, 1, ..) its runs as rows (start, length, period), by start, then period."""
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    # only texts with a candidate get a grammar: each once forwards and once backwards, closed by a symbol of its own
    with_some = np.unique(np.concatenate([np.zeros(0, np.int64), *(owner for owner, _, _ in grid(texts, least_repeats))]))
    if not len(with_some):
        return out
    some = [texts[k] for k in with_some]
    grammar = Grammar(np.concatenate([part for k, text in enumerate(some) for part in (text, [-2 * k - 2], text[::-1], [-2 * k - 3])]))
    lengths = np.array([len(t) for t in some], np.int64)
    forward = 2 * (np.cumsum(lengths + 1) - lengths - 1)
    back = forward + lengths + 1
    parts = []
    for owner, i, period in grid(some, least_repeats):
        at = forward[owner] + i
        ahead = grammar.extension(at, at + period)
        # backwards: the words before i + period and those before i
        at = back[owner] + lengths[owner] - i - period
        behind = grammar.extension(at, at + period)
        start, length = i - behind, behind + period + ahead
        rows = np.stack([with_some[owner], start, length, period], axis=1)
        parts.append(np.unique(rows[length >= np.maximum(least_words, least_repeats * period)], axis=0))
    rows = np.concatenate(parts)
    if not len(rows):
        return out
    # a stretch's smallest period is the least of those found for it
    rows = np.unique(rows, axis=0)
    fresh = np.concatenate(([True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)))
    rows = rows[fresh]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    cuts = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
    for text in np.unique(rows[:, 0]):
        out[text] = rows[cuts[text]:cuts[text + 1], 1:]
    return out


def repeated_tail(words: list, doc_id: int | None) -> list:
    """The words as the audit reads them: in one document of ten, chosen by its id, a stretch from some word on is repeated to the end.

    Fixed values: h = crc32 of the decimal id, g = floor(h / 10); if h % 10 = 0, words from
    a = g % n on repeat with period 1 + floor((n - a) / (3 + g % 8)). A null id changes nothing.
    """
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay: those no run contains after its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:-1]) == 0


def _report(doc_id, words: list[bytes], runs: np.ndarray) -> tuple:
    if not len(runs):
        empty = hashlib.sha256(b"").hexdigest()
        return doc_id, len(words), 0, None, None, None, None, empty, hashlib.sha256(b" ".join(words)).hexdigest()
    rows = [tuple(map(int, r)) for r in runs]
    start, length, period = min(rows, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    stays = kept_words(len(words), runs)
    left = b" ".join(w for w, stay in zip(words, stays.tolist()) if stay)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in rows)
    return (doc_id, len(words), len(rows), start, length, period, 1000 * length // period,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def _numbered(words: list[list[bytes]]) -> list[np.ndarray]:
    numbers = {w: k for k, w in enumerate(dict.fromkeys(chain.from_iterable(words)))}
    return [np.fromiter(map(numbers.__getitem__, text), np.int64, len(text)) for text in words]


def periodic_runs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", plant: bool = False,
                  least_words: int = LEAST_WORDS, least_repeats: int = LEAST_REPEATS) -> DataFrame:
    """A row per row of docs: doc_id, n_words, n_runs, its run of greatest length/period, and digests.

    start (a word's number), length, period and exponent_milli = floor(1000 * length / period) are
    those of the run with the greatest exact ratio, then smallest start, then period; null
    without a run. runs_sha256: of ``start,length,period`` and a line feed for every run, by start, then
    period. collapsed_sha256: of the words that no run contains after its first period,
    joined by one space. Words are separated by U+0020 and U+0009 to U+000D only and
    equal when their bytes are. Null, empty and blank texts have no words and no runs; null ids and repeated rows get
    their own row each; other columns are ignored. With ``plant``, words are first changed by
    ``repeated_tail``. A text is held whole in its task; texts are taken in batches of about 4 MB.
    ``least_repeats`` is 4 or more.
    """
    if least_repeats < 4:
        raise ValueError("least_repeats must be 4 or more: the grid is that of runs of four periods")
    ship(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in SCHEMA.split(", ")]
        types = [pa.string() if c.endswith("sha256") else pa.int64() for c in names]

        def answered(ids, words):
            rows = [_report(i, w, r) for i, w, r in zip(ids, words, runs_of(_numbered(words), least_words, least_repeats))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            ids, words, held = [], [], 0
            for i, whole in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = whole.as_py() or b""
                split = data.split()
                ids.append(i)
                words.append(repeated_tail(split, i) if plant else split)
                held += len(data)
                if held >= BATCH_BYTES:
                    yield answered(ids, words)
                    ids, words, held = [], [], 0
            if ids:
                yield answered(ids, words)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(run, SCHEMA)
