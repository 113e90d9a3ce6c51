import random
import re
import textwrap
import time

import regex

from certweave.llm import licences


def test_whole_texts_lines_and_spellings(spark, documents):
    mit = "Released under the MIT License."
    isc = dict(licences.KNOWN)["ISC"]
    docs = documents([
        (1, mit, None, None), (2, "(c) 2020 Somebody\nreleased  UNDER the «MIT» Licence\n", None, None), (3, f"prose\n{mit}\nmore\n{mit.upper()}\nLicensed under CC BY-NC 4.0.", None, None),
        (4, "Copyright 2024 A B\nAll rights reserved.\n\n" + isc.replace(",", " ,"), None, None), (5, isc[:-5], None, None), (6, "not released under the MIT License.", None, None)])
    got = {r.doc_id: (r.licence, r.notices, r.n_notices) for r in licences.scan(docs, licences.known_digests(spark)).collect()}
    assert got == {1: ("MIT", "MIT", 1), 2: ("MIT", "MIT", 1), 3: (None, "CC-BY-NC-4.0,MIT", 3), 4: ("ISC", "", 0), 5: (None, "", 0), 6: (None, "", 0)}


def test_odd_rows(spark, odd, nothing):
    known = licences.known_digests(spark)
    rows = licences.scan(odd, known).collect()
    assert len(rows) == 10 and all(r.licence is None and r.n_notices == 0 and r.digest for r in rows)
    assert licences.scan(nothing, known).count() == 0
    again = odd.unionByName(odd.limit(0)).replace("same same same", "Licensed under CC BY-NC 4.0.", "text")
    assert [r.n_notices for r in licences.scan(again, known).where("notices <> ''").collect()] == [1, 1, 1]


def test_whole_licences_runs_of_lines_and_notices_after_copyright(spark, documents):
    text = dict(licences.known_texts()[len(licences.KNOWN):])
    wrap = lambda t, mark="": "\n".join(f"{mark}{x}" for x in textwrap.wrap(t, 60))
    mit, isc = (licences.Path(licences.__file__).parent / "known_licences" / "MIT.txt").read_text(), dict(licences.KNOWN)["ISC"]
    apache = dict(licences.HEADERS)["Apache-2.0"]
    docs = documents([
        (1, mit, None, None), (2, "Licensed under the MIT License.", None, None), (3, f"prose\n\n{wrap(isc)}\n\nmore prose", None, None),
        (4, f"# Copyright 2020 X\n#\n{wrap(apache, '# ')}\n\nimport os", None, None), (5, "Copyright 2020 J. Doe. Released under the MIT License.\nx", None, None),
        (6, "Released under\nthe MIT License.\nand more", None, None), (7, f"prose\n{wrap(isc)[:-9]}\nmore", None, None),
        (8, "Copyright (c) 2016 Y. All rights reserved.\n\n" + text["BSD-3-Clause"], None, None)])
    got = {r.doc_id: (r.licence, r.notices) for r in licences.scan(docs, licences.known_digests(spark)).collect()}
    assert got[1][0] == "MIT" and got[2] == ("MIT", "MIT") and got[3] == (None, "ISC") and "Apache-2.0" in got[4][1]
    assert got[5] == (None, "MIT") and got[6] == (None, "MIT") and got[7] == (None, "") and got[8][0] == "BSD-3-Clause"


def plain_scan(text, known):
    """Digests of the lines and of every run of lines, each pair of ends tried."""
    canon = lambda t: plain_canonical(t)
    lines = []
    for line in (text or "").split("\n"):
        lines += re.split(r"(?<=[.;])[ \t]+", line) if re.match(licences.COPYRIGHT_START, line) else [line]
    lines = [c for c in map(canon, lines) if c]
    whole = canon(text or "")
    found = [known[x] for x in lines if x in known]
    for i in range(len(lines)):
        for j in range(i + 2, min(len(lines), i + 60) + 1):
            run = plain_spelled(" ".join(lines[i:j]))
            if run in known and run != whole:
                found.append(known[run])
    return known.get(whole) if whole else None, ",".join(sorted(set(found))), len(found)


def plain_spelled(words):
    out = f" {words} "
    for spelled, as_ in licences.SPELLINGS:
        out = out.replace(f" {spelled} ", f" {as_} ")
    return out.strip(" ")


def plain_canonical(text):
    out = regex.sub(licences.COPYRIGHT_LINE, "", text.lower())
    return plain_spelled(regex.sub(r"[^\p{L}\p{N}]+", " ", out).strip(" "))


def test_runs_and_whole_texts_against_every_pair_of_ends(spark, documents):
    """All known texts, whole, wrapped at any word, under titles, inside other lines."""
    rng = random.Random(4)
    texts = licences.known_texts()
    known = {}
    for name, t in sorted(texts, reverse=True):
        known[plain_canonical(t)] = name
    short = [t for _, t in texts if len(t) < 900]
    wrapped = lambda t: "".join(w + rng.choice([" ", " ", " ", "\n"]) for w in t.split())
    rows = short[::9] + [wrapped(rng.choice(short)) for _ in range(30)]
    rows += ["\n".join(["intro line", "this is no licence", wrapped(rng.choice(short)), "Copyright 2020 X. " + rng.choice(short), "the end"]) for _ in range(30)]
    got = {r.doc_id: (r.licence, r.notices, r.n_notices) for r in licences.scan(documents([(n, t, None, None) for n, t in enumerate(rows)]), licences.known_digests(spark)).collect()}
    for n, t in enumerate(rows):
        assert got[n] == plain_scan(t, known), t[:300]
    assert sum(bool(g[1]) for g in got.values()) > 25


def test_many_lines_that_begin_like_a_licence(spark, documents):
    """One source file of 100,000 lines takes seconds."""
    text = "\n".join(f"this is line {n}" for n in range(100_000)) + "\nReleased under the\nMIT License."
    began = time.time()
    got = licences.scan(documents([(1, text, None, None)]), licences.known_digests(spark)).collect()
    assert got[0].notices == "MIT" and time.time() - began < 120


def test_running_sums(spark):
    for n in (1, 2, 3, 10, 99, 1000):
        assert spark.range(1).select(licences._running(licences.F.sequence(licences.F.lit(1), licences.F.lit(n)).cast("array<long>")).alias("s")).first().s == [k * (k + 1) // 2 for k in range(1, n + 1)]
