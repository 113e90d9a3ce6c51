import math

import numpy as np
from pyspark.sql import functions as F

from certweave.llm import catalog, language

NAMES = ["de", "en", "es", "fr"]


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/documents.parquet").withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0)
    found = language.identify(docs, NAMES, declared=F.when(~F.col("held"), F.col("lang")), host=F.lit("h")).where("held").select("lang", "language", "language_kept").collect()
    assert len(found) > 250 and sum(r.lang == r.language for r in found) >= 0.97 * len(found) and sum(r.language_kept for r in found) >= 0.97 * len(found)


def test_text_outweighs_a_wrong_declaration(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("lang in ('fr', 'en')")
    wrong = docs.where("lang = 'fr' and length(text) > 400").limit(3).withColumn("lang", F.lit("en")).withColumn("doc_id", -F.col("doc_id") - 1)
    found = language.identify(docs.unionByName(wrong), NAMES, declared=F.col("lang"), host=F.col("source")).where("doc_id < 0").collect()
    assert found and all(r.language == "fr" for r in found)


def test_hosts_decide_where_the_text_does_not(spark):
    rows = [(n, f"le chat et la souris dorment encore numero {chr(97 + n)}", "fr", "a.example.net") for n in range(20)] + [(30 + n, f"the cat and the mouse still sleep number {chr(97 + n)}", "en", "b.example.com") for n in range(20)]
    rows += [(98, "ok", None, "a.example.net"), (99, "ok", None, "b.example.com")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r.language for r in language.identify(docs, ["en", "fr"], declared=F.col("lang"), host=F.col("source")).where("doc_id > 90").collect()}
    assert found == {98: "fr", 99: "en"}


def test_addresses_and_markup(spark):
    rows = [("http://x.de/", "<html lang='FR-ca'>"), ("http://x.com/es/1", "<!doctype html><HTML class=a lang=es>"), ("http://x.com/esx", "<p lang=de>"), (None, None)]
    got = spark.createDataFrame(rows, "u string, h string").select(language.address_suffix(F.col("u"), NAMES), language.markup_language(F.col("h"))).collect()
    assert [tuple(r) for r in got] == [("de", "fr"), ("es", "es"), (None, None), (None, None)]


def test_odd_rows(odd, nothing):
    found = language.identify(odd, NAMES, declared=F.col("lang"), host=F.col("source"))
    rows = found.collect()
    assert len(rows) == 10 and found.columns[-3:] == ["language", "confidence", "language_kept"] and "kept" in found.columns
    assert all(r.language is None and not r.language_kept and r.confidence == 0 for r in rows if not (r.text or "").strip())
    assert language.identify(nothing, NAMES, declared=F.col("lang"), host=F.col("source")).count() == 0


def plain_grams(text):
    data = b" " + bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in (text or "").lower().encode()) + b" "
    codes = [data[i] << 16 | data[i + 1] << 8 | data[i + 2] for i in range(len(data) - 2)]
    return [((c * 2654435761) % (1 << 32)) >> 17 for c in codes if c != 0x202020]


def plain_posterior(rows, names):
    """(language, confidence) of every row (text, declared, host, suffix), with the model counted on all labelled rows."""
    kinds = [*names, "other"]
    grams = [plain_grams(t) for t, *_ in rows]
    counts = np.full((1 << 15, len(kinds)), 0.5)
    for (t, declared, _, _), g in zip(rows, grams):
        if t is not None and declared in names:
            np.add.at(counts[:, names.index(declared)], g, 1)
    logs = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    text = [logs[g].sum(axis=0, dtype=np.float64) / math.sqrt(len(g)) if g else None for g in grams]
    by_host, by_domain, whole = {}, {}, np.zeros(len(kinds))
    domain = lambda h: ".".join(h.split(".")[-2:]) if "." in h else ""
    for (_, _, h, _), e in zip(rows, text):
        found = np.zeros(len(kinds))
        if e is not None:
            found[int(np.argmax(e))] = 1
        h = h or ""
        by_host[h] = by_host.get(h, 0) + found
        by_domain[domain(h)] = by_domain.get(domain(h), 0) + found
        whole = whole + found
    top = (whole + 1) / (whole.sum() + len(kinds))
    smooth = lambda n, above: (n + 20 * above) / (n.sum() + 20)
    out = []
    for (_, declared, h, suffix), e in zip(rows, text):
        if e is None:
            out.append((None, 0.0))
            continue
        log = e + np.log(smooth(by_host[h or ""], smooth(by_domain[domain(h or "")], top)))
        for said, right in ((declared, 0.9), (suffix, 0.8)):
            if said in names:
                log = log + np.log([right if k == said else (1 - right) / len(names) for k in kinds])
        share = 1 / np.exp(log - log.max()).sum()
        out.append((kinds[int(np.argmax(log))], share))
    return out


def held_against_plain(found, rows):
    want = plain_posterior(rows, NAMES)
    assert len(found) == len(want)
    for r, (name, share) in zip(found, want):
        assert abs(r.confidence - share) < 1e-6 and r.language_kept == (name in NAMES and share >= 0.5)
        assert r.language == name or abs(share - 0.5) < 1e-6


def test_posterior_against_plain_python(spark, small, odd):
    for docs in (spark.read.parquet(f"{small}/documents.parquet"), odd):
        found = language.identify(docs, NAMES, declared=F.col("lang"), host=F.col("source")).collect()
        held_against_plain(found, [(r.text, r.lang, r.source, None) for r in found])


def test_posterior_of_pages_against_plain_python(spark, small):
    """Markup language, host and address suffix, as the query on pages has them."""
    pages = spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url", F.regexp_replace("html", "<[^>]*>", " ").alias("text"), language.markup_language(F.col("html")).alias("markup"))
    pages = pages.withColumn("h", catalog.urls.host(F.col("url"))).withColumn("s", language.address_suffix(F.col("url"), NAMES))
    found = language.identify(pages, NAMES, declared=F.col("markup"), host=F.col("h"), suffix=F.col("s")).collect()
    assert any(r.s for r in found)
    held_against_plain(found, [(r.text, r.markup, r.h, r.s) for r in found])
    queried = catalog.op4_language_id_pages(spark, small).collect()
    assert len(queried) == len(found) and {r.page_id for r in queried} == {r.page_id for r in found}


def test_model_counts_every_declared_row(spark, documents):
    """More rows with a language than the 20,000 once drawn: answers as plain Python finds them from all of them."""
    word = lambda n: "".join(chr(97 + n * k % 26) for k in (1, 5, 7, 11))
    docs = documents([(n, f"{word(n)} {word(n // 26)} {chr(97 + n % 7)}", [*NAMES, None, "xx"][n % 6], f"h{n % 5}.example.org") for n in range(36_000)])
    found = language.identify(docs, NAMES, declared=F.col("lang"), host=F.col("source")).collect()
    assert len({r.language for r in found}) > 2
    held_against_plain(found, [(r.text, r.lang, r.source, None) for r in found])
