"""Language identification: several kinds of evidence fused by Bayes' rule.

Text: hashed byte trigrams under one multinomial per language, counted on every row that
declares it, and an even one for "other". The mean log-likelihood counts as often as the square
root of the number of trigrams, as neighbouring trigrams are far from independent. Declared markup language and the
address's suffix are noisy witnesses. Hosts have priors: the share of each language among
the host's own documents, smoothed towards the registered domain, which is smoothed towards
all documents; the counts are one grouped aggregate over all documents.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certweave.functions.nested import settled

from .common import ship, stored

BITS = 15
OTHER = "other"
DECLARED_RIGHT, SUFFIX_RIGHT = 0.9, 0.8
STRENGTH = 20.0  # documents that a smoothing parent counts for
# Bytes that are no letters of a language with an alphabet: controls, digits and ASCII punctuation become spaces.
PLAIN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigrams(text: str | None) -> np.ndarray:
    """Bucket of every byte trigram of the lower-cased text that is not all spaces; empty for texts without letters."""
    data = b" " + (text or "").lower().encode("utf-8", "replace").translate(PLAIN) + b" "
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    code = code[code != 0x202020]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def fit(docs: DataFrame, languages: list[str], *, text: str, declared: str) -> np.ndarray:
    """Log-likelihood of each bucket (rows) under each language and, last, "other".

    Counted on every row that declares one of the languages. A language without rows
    gets the even model.
    """
    labelled = docs.where(F.col(declared).isin(languages) & F.col(text).isNotNull())
    place = {name: k for k, name in enumerate(languages)}

    def count(batches):
        import pyarrow as pa

        sums = np.zeros((len(languages), 1 << BITS), np.int64)
        for batch in batches:
            for whole, name in zip(batch.column(0), batch.column(1).to_pylist()):
                np.add.at(sums[place[name]], trigrams(whole.as_py()), 1)
        k, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(bucket, pa.int32()), pa.array(sums[k, bucket])], ["k", "bucket", "n"])

    rows = labelled.select(F.col(text), F.col(declared)).mapInArrow(count, "k int, bucket int, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.full((1 << BITS, len(languages) + 1), 0.5)
    for r in rows:  # languages times buckets at most
        counts[r.bucket, r.k] += r.n
    return np.log(counts / counts.sum(axis=0)).astype(np.float32)


def text_evidence(text: Column, model: np.ndarray) -> Column:
    """Log evidence per language, "other" last; null for texts without letters."""
    @F.pandas_udf("array<double>")
    def evidence(texts: pd.Series) -> pd.Series:
        out = []
        for whole in texts:
            at = trigrams(whole)
            out.append((model[at].sum(axis=0, dtype=np.float64) / math.sqrt(len(at))).tolist() if len(at) else None)
        return pd.Series(out, dtype=object)

    return evidence(text)


def registered_domain(host: Column) -> Column:
    """The last two labels of a host with dots; all other hosts share the empty one."""
    return F.when(host.contains("."), F.substring_index(host, ".", -2)).otherwise(F.lit(""))


def address_suffix(url: Column, languages: list[str]) -> Column:
    """The language that the host's last label or the path's first part names, if any."""
    label = F.lower(F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*\.([A-Za-z]+)(?::\d+)?(?:[/?#]|$)", 1))
    part = F.lower(F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1))
    return F.when(label.isin(languages), label).when(part.isin(languages), part)


def markup_language(html: Column) -> Column:
    """The lang of the html tag, first part, lower-cased; null without."""
    found = F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    return F.when(found != "", found)


def _witness(said: Column, languages: list[str], right: float) -> list[Column]:
    """Log-likelihood of what a witness said, per language and for "other"; silence and unknown languages say nothing."""
    wrong = (1 - right) / len(languages)
    known = F.coalesce(said.isin(languages), F.lit(False))
    return [F.when(known, F.when(said == name, math.log(right)).otherwise(math.log(wrong))).otherwise(0.0) for name in [*languages, OTHER]]


def host_priors(counted: DataFrame, n: int) -> DataFrame:
    """counted (host, n_0 .. n_k) to (host, prior): log shares smoothed towards the domain and all documents."""
    names = [f"n_{k}" for k in range(n)]
    whole = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first()
    total = sum(whole)
    top = [(w + 1.0) / (total + n) for w in whole]
    smooth = lambda prefix, parent: F.array(*[(F.col(f"{prefix}{c}") + STRENGTH * p) / (sum(F.col(f"{prefix}{x}") for x in names) + STRENGTH) for c, p in zip(names, parent)])
    hosts = counted.withColumn("domain", registered_domain(F.col("host")))
    domains = hosts.groupBy("domain").agg(*[F.sum(c).alias(f"d_{c}") for c in names])
    domains = domains.select("domain", smooth("d_", [F.lit(p) for p in top]).alias("above"))
    out = hosts.join(domains, "domain").select("host", smooth("", [F.col("above")[k] for k in range(n)]).alias("share"))
    return out.select("host", F.transform("share", F.ln).alias("prior"))


def identify(docs: DataFrame, languages: list[str], *, text: str = "text", declared: Column, host: Column, suffix: Column | None = None,
             least: float = 0.5) -> DataFrame:
    """docs, all columns kept, with language, confidence and language_kept.

    ``declared``, ``host`` and ``suffix`` are columns over docs; null says nothing, and rows
    with a null host share one. Texts without a letter, null ones too, have no language
    (null, confidence 0) and are not kept; others are kept if their best language is not
    "other" and has at least ``least`` of the posterior. Ties go to the language named first.
    Equal rows get equal answers; added columns replace those of the same name.
    """
    ship(docs.sparkSession)
    added = ["language", "confidence", "language_kept"]
    n = len(languages) + 1
    silent = F.lit(None).cast("string")
    seen = docs.withColumn("_declared", declared.cast("string")).withColumn("_host", F.coalesce(host.cast("string"), F.lit("")))
    seen = seen.withColumn("_suffix", silent if suffix is None else suffix)
    model = fit(seen.select(F.col(text).alias("text"), "_declared"), languages, text="text", declared="_declared")
    seen = seen.withColumn("_text", text_evidence(F.col(text), model))
    by_text = settled(seen.select("_host", "_text"))
    best = F.array_position("_text", F.array_max("_text"))
    counted = by_text.groupBy(F.col("_host").alias("host")).agg(*[F.count(F.when(best == k + 1, 1)).alias(f"n_{k}") for k in range(n)])
    priors = stored(host_priors(stored(counted, "host-counts"), n), "host-priors").select(F.col("host").alias("_of"), F.col("prior").alias("_prior"))
    told = zip(_witness(F.col("_declared"), languages, DECLARED_RIGHT), _witness(F.col("_suffix"), languages, SUFFIX_RIGHT))
    logs = F.array(*[F.col("_text")[k] + F.col("_prior")[k] + a + b for k, (a, b) in enumerate(told)])
    fused = seen.join(priors, F.col("_host") == F.col("_of")).withColumn("_logs", F.when(F.col("_text").isNotNull(), logs))
    top = F.array_max("_logs")
    fused = fused.withColumn("_best", F.array_position("_logs", top)).withColumn(
        "_share", 1.0 / F.aggregate("_logs", F.lit(0.0), lambda a, x: a + F.exp(x - top)))
    name = F.element_at(F.array(*[F.lit(x) for x in [*languages, OTHER]]), F.col("_best").cast("int"))
    return fused.select(
        *[F.col(c) for c in docs.columns if c not in added], F.when(F.col("_best").isNotNull(), name).alias("language"),
        F.coalesce("_share", F.lit(0.0)).alias("confidence"),
        F.coalesce((F.col("_best") < n) & (F.col("_share") >= least), F.lit(False)).alias("language_kept"))
