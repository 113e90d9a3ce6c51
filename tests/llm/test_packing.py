import random
import struct

import public_tokenizers
from tokenizers import Tokenizer

from certweave.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_differencing_is_near_equal():
    parts = packing.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(n for p in parts for n in p) == list(range(5)) and sorted(sum([8, 7, 6, 5, 4][n] for n in p) for p in parts) == [14, 16]
    r = random.Random(1)
    sizes = [r.randrange(1, 512) for _ in range(900)]
    parts = packing.differencing(sizes, 110)
    loads = [sum(sizes[n] for n in p) for p in parts]
    assert sorted(n for p in parts for n in p) == list(range(900)) and max(loads) - min(loads) <= 12


def test_window_count_rises():
    assert len(packing.windows([6, 6, 6], 10)) == 3 and packing.windows([], 10) == [] and packing.windows([10], 10) == [[0]]


def whole(rows):
    docs, places = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append((r.start, r.ids, r.length, r.doc_tokens))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    return docs, places


def test_every_token_once(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got, places = whole(packing.pack(docs, PATH).collect())
    coder = Tokenizer.from_file(PATH)
    tokens = 0
    for r in docs.collect():
        ids = coder.encode(r.text or "", add_special_tokens=False).ids + [1]
        parts = sorted(got[r.doc_id])
        assert b"".join(p[1] for p in parts) == struct.pack(f"<{len(ids)}I", *ids) and all(p[3] == len(ids) and len(p[1]) == 4 * p[2] for p in parts)
        tokens += len(ids)
    assert tokens > 0.95 * 2048 * len(places)


def test_words_outside_ascii(spark, documents):
    texts = ["<|endoftext|> a<|startoftext|>b", "A\u00a0B\u2003C\x1cD e\u0301 e \u0301", "ΑΣ ΑΣΑ İI", "don't I'LL  x's", "\x00 \x0b\x0c 𝔘 👩‍👩‍👧 1234", "<|STARTOFTEXT|> x", "A.B, C.. D., É, ÿ.\tß.\n1, \u212a. don't.", "K\u00b5 ª. º, º,x ,a .b a,"]
    got, _ = whole(packing.pack(documents([(n, t, None, None) for n, t in enumerate(texts)]), PATH).collect())
    coder = Tokenizer.from_file(PATH)
    for n, t in enumerate(texts):
        ids = coder.encode(t, add_special_tokens=False).ids + [1]
        assert b"".join(p[1] for p in sorted(got[n])) == struct.pack(f"<{len(ids)}I", *ids)


def test_odd_rows(odd, nothing):
    rows = packing.pack(odd, PATH).collect()
    got, _ = whole(rows)
    assert sum(r.length for r in rows if r.doc_id in (1, 2, 3)) == 3 and len(got[5]) == 2 and got[None]
    assert packing.pack(nothing, PATH).count() == 0


def test_any_tokenizer_gives_its_own_ids(spark, small):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(30).collect()] + packing.PROBES + ["", "Mixed CASE here.\n\n  indented"]
    for name, by_word in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        path = public_tokenizers.path(name)
        words, plain = packing.WordTokens(path), Tokenizer.from_file(path)
        assert words.by_word == by_word
        assert words.encode(texts) == [b"".join(n.to_bytes(4, "little") for n in plain.encode(t, add_special_tokens=False).ids) for t in texts]
