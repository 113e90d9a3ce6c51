"""Packing token pieces into sequences by multiway differencing.

A document longer than a sequence gives whole sequences first. What is left of it is cut into
pieces of at most ``piece`` tokens. Pieces are gathered in the order of the scan until some
hundred are there; Karmarkar and Karp's method divides them into as many windows as their sum
needs: the two partial partitions with the widest spread are merged, the fullest windows of one
with the emptiest of the other, until one partition is left. If a window is then fuller than
a sequence, one window more is tried.

Every task packs its own part of the input, so no token crosses the network and a lost task
is done again alone. A task leaves at most one poorly filled group, at its end.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .common import ship

LENGTH, PIECE, GATHER = 2048, 512, 1200
FREE = 4  # tokens a window of a group should have to spare on average
FIRST_WORDS, LATER_WORDS = 400_000, 200_000
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Item numbers of ``ways`` parts with near-equal sums."""
    # a partial partition: its non-empty parts (sum, items), fullest first; the others are empty
    heap = [(-size, n, [(size, [n])]) for n, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        apart = ways - len(b)  # so many parts of a meet an empty part of b
        merged = a[:apart]
        if len(a) > apart:
            meet = b[::-1]
            merged += [(s + meet[n][0], items + meet[n][1]) for n, (s, items) in enumerate(a[apart:])]
            merged += meet[len(a) - apart:]
        else:
            merged = merged + b
        merged.sort(key=lambda part: -part[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == ways else 0)
        heapq.heappush(heap, (-spread, serial, merged))
        serial += 1
    parts = [items for _, items in heap[0][2]] if heap else []
    return parts


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows within the capacity; no item may be larger. Equal sizes may trade places, no items give no windows."""
    ways = -(-sum(sizes) // capacity)
    while True:
        parts = differencing(sizes, ways) if sizes else []
        if all(sum(sizes[n] for n in part) <= capacity for part in parts):
            return parts
        ways += 1


LONE_STOP = re.compile(rb"[.,](?<=[a-z\xdf-\xf6\xf8-\xff].)(?=[\x20\n]|$)")


def split_words(text: str) -> list[bytes]:
    """Parts of a text that the tokenizer codes one by one: it drops white space before it looks at words.

    In texts of Latin-1 characters words are lower-cased and a comma or stop behind a letter
    stands alone, as the tokenizer does both itself; so fewer different words are met.
    """
    if "<|" not in text:  # part of a special token's name, which has one case
        try:
            return LONE_STOP.sub(rb" \g<0>", text.lower().encode("latin-1")).decode("latin-1").encode().split()
        except UnicodeEncodeError:
            pass
    return text.encode().split()  # bytes split at ASCII white space only


# How a byte-level vocabulary writes bytes: visible ones as themselves, the others as characters from U+0100 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _VISIBLE]
BYTE_CHARS = dict(zip(_VISIBLE, map(chr, _VISIBLE))) | dict(zip(_HIDDEN, map(chr, range(256, 512))))


def plain_word(word: bytes) -> str | None:
    """A word of small Latin-1 letters as the vocabulary writes it: one pre-token that no normalisation changes. Else None."""
    if word.isalpha():  # ASCII letters only
        return word.decode() if word.islower() else None
    text = word.decode()
    if text.isalpha() and text == text.lower() and max(text) < "\u0100":
        return word.decode("latin-1").translate(BYTE_CHARS)
    return None


# Texts that tell whether a tokenizer can be used word by word.
PROBES = ["It's A Word, and two  words.\nNew line. 12345 ... (x)", " leading and trailing ", "Ünïcode — «quote» ß éa", "a\tb\x0bc", "THE the The.", "naïve,word.Another"]


class WordTokens(dict):
    """Ids of words as little-endian unsigned 32-bit integers, worked out once per word.

    The first words met stay, later ones make room for each other.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.packed = [n.to_bytes(4, "little") for n in range(self.tokenizer.get_vocab_size())]
        self.later: list[bytes] = []
        self.by_word = all(self._by_word([t])[0] == self._whole([t])[0] for t in PROBES)
        self.clear()
        self.later = []

    def learn(self, words: set[bytes]) -> None:
        if len(self.later) > LATER_WORDS:
            for word in self.later:
                del self[word]
            self.later = []
        new = [w for w in words if w not in self]
        self.later += new[max(0, FIRST_WORDS + len(self.later) - len(self)):]
        odd, packed, tokenize = [], self.packed, self.model.tokenize
        for word in new:
            plain = plain_word(word)
            if plain is None:
                odd.append(word)
            else:
                self[word] = b"".join([packed[t.id] for t in tokenize(plain)])
        # the others pass through the whole tokenizer, many to a line; a token belongs to the word in which it starts
        for at in range(0, len(odd), 1000):
            line = odd[at:at + 1000]
            texts = [w.decode() for w in line]
            coded = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            ids = np.array(coded.ids, "<u4").tobytes()
            starts = np.fromiter((a for a, _ in coded.offsets), np.int64, len(ids) // 4)
            ends = 4 * np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])).astype(np.int64)
            low = 0
            for word, high in zip(line, ends.tolist()):
                self[word] = ids[low:high]
                low = high

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts: word by word where the tokenizer codes words apart as ``split_words`` has them, else by the tokenizer alone."""
        return self._by_word(texts) if self.by_word else self._whole(texts)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _by_word(self, texts: list[str]) -> list[bytes]:
        parts = [split_words(t) for t in texts]
        self.learn(set().union(*parts))
        return [b"".join(map(self.__getitem__, p)) for p in parts]


_LOADED: dict[str, WordTokens] = {}


def pieces(doc_id, ids: bytes, length: int, piece: int) -> Iterator[tuple]:
    """(doc_id, start, length, ids, doc_tokens): whole sequences first, then the rest in cuts of ``piece``."""
    total = len(ids) // 4
    at = 0
    while total - at >= length:
        yield doc_id, at, length, ids[4 * at:4 * (at + length)], total
        at += length
    for low in range(at, total, piece):
        end = min(low + piece, total)
        yield doc_id, low, end - low, ids[4 * low:4 * end], total


def pack(docs: DataFrame, tokenizer: str, *, end_id: int = 1, length: int = LENGTH, piece: int = PIECE, gather: int = GATHER,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document's tokens are its text's ids and ``end_id``; a null or empty text has that id
    alone. Any file of the tokenizers library will do; one that drops white space and case is quicker, as words are coded once. Sequence ids name the task and count inside it. Null and repeated ids and repeated
    rows are packed row by row; other columns are ignored; no rows give no rows.
    """
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        words = _LOADED.get(tokenizer) or _LOADED.setdefault(tokenizer, WordTokens(tokenizer))
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                            ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
        serial = TaskContext.get().partitionId() << 32
        waiting, held, out = [], 0, []

        def flush():
            nonlocal serial, waiting, held
            for window in windows([p[2] for p in waiting], length):
                offset = 0
                for n in sorted(window):
                    out.append((*waiting[n], serial, offset))
                    offset += waiting[n][2]
                serial += 1
            waiting, held = [], 0

        def emit():
            nonlocal out
            columns, out = list(zip(*out)), []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                coded = words.encode([t or "" for t in part.column(1).to_pylist()])
                for key, ids in zip(part.column(0).to_pylist(), coded):
                    for p in pieces(key, ids + end_id.to_bytes(4, "little"), length, piece):
                        if p[2] == length:
                            out.append((*p, serial, 0))
                            serial += 1
                            continue
                        waiting.append(p)
                        held += p[2]
                        # enough pieces, and a sum that leaves a few tokens free in each window
                        if len(waiting) >= gather and FREE * (held // length) <= -held % length <= FREE * (held // length) + length // 4:
                            flush()
                    if len(out) >= 4000:
                        yield emit()
        flush()
        if out:
            yield emit()

    ship(docs.sparkSession)
    plain = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return plain.mapInArrow(run, SCHEMA)
