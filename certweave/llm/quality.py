"""Quality rules: base counts of a text, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word unigrams and bigrams are counted: one over every trusted
document, one over every document of the corpus. A document's score is the mean over its
grams of log trusted share minus log raw share; it stays if the score reaches a threshold that
comes from the scores of every trusted document, each under a model that its own fold of the
trusted ones was not counted on. Nothing is drawn at random and no label is left out.

Weights are whole millionths, so that a sum does not depend on its order. There are as
many as buckets, for all and without each fold, whatever the corpus; scoring looks them up in an
array, the value of a scalar subquery, and moves no rows. As a literal the array would be spelt out in the
text of every plan, which the driver keeps. Only trusted texts are shuffled, once, to meet their labels: a bitmap
keeps most others back. They are stored for the two uses of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certweave.functions.nested import settled

from .common import SPACES, stored, words

BUCKETS = 1 << 15
FOLDS = 5
BIN = 12
SLOTS = 1 << 26
UNIT = 1_000_000
WINDOW = 5
SYMBOLS = "#*$%&|<>"
HELD = ["_weights_of_words", "_weights_of_pairs"]


def with_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with ``_words`` and their hashes ``_hashes``."""
    return docs.withColumn("_words", words(F.col(text))).withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))


def neighbours(hashes: Column) -> Column:
    """Hash of every pair of neighbours."""
    pairs = F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1)))
    return F.slice(pairs, F.lit(1), F.greatest(F.size(hashes) - 1, F.lit(0)))


def bucket_of(hashed: Column, buckets: int) -> Column:
    return F.pmod(hashed, F.lit(buckets)).cast("int")


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long); a null text counts as empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    h, two = F.col("_hashes"), F.col("_pairs")
    out = with_words(docs, text).withColumn("_pairs", neighbours(h))
    # a window of five words is two pairs and a word
    windows = F.transform(two, lambda x, i: F.xxhash64(x, F.get(two, i + 2), F.get(h, i + 4)))
    out = out.withColumn("_windows", F.slice(windows, F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0)))).withColumn("_lines", lines)
    # places in the order of their window's hash: equal windows lie side by side; sort_array compares in compiled code, array_sort does not
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda x, i: F.struct(x.alias("hash"), i.alias("at"))))
    out = out.withColumn("_placed", F.when(some, placed)).withColumn("_sorted", F.when(some, F.sort_array("_windows")))
    same = F.col("_sorted")
    twice = F.filter("_placed", lambda x, i: (x["hash"] == F.get(same, i + 1)) | (x["hash"] == F.get(same, i - 1)))
    out = out.withColumn("_twice", F.sort_array(F.transform(twice, lambda x: x["at"])))
    t = F.col("_twice")
    covered = F.aggregate(F.transform(t, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(t, i + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    return out.select(
        *docs.columns, "_hashes", "_pairs", F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(whole, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, trusted, fold): every labelled id once; one also called poor is not trusted. Null ids and labels are no labels."""
    ids = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") == 1).alias("trusted"))
    return ids.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(FOLDS)).cast("int"))


def perhaps_labelled(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs without most rows whose doc_id is not among ids: a bitmap of hashed ids, 8 MB at most, tells them. No labelled row is lost."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))
    bins, at = F.bitmap_bucket_number(slot), F.bitmap_bit_position(slot)
    maps = ids.groupBy(bins.alias("_bin")).agg(F.bitmap_construct_agg(at).alias("_bits"))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = docs.where("doc_id is not null").withColumn("_bin", bins).join(F.broadcast(maps), "_bin")
    return found.where(F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1).select(*docs.columns)


def labelled_texts(docs: DataFrame, ids: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text and the other columns of ids) of the documents with these ids; repeated rows stay repeated."""
    # ids grow as documents do: a shuffle at any size
    typed = F.col(doc_id).try_cast(ids.schema["doc_id"].dataType).alias("doc_id")  # a hash depends on the type
    return perhaps_labelled(docs.select(typed, F.col(text).alias("text")), ids).join(ids.hint("merge"), "doc_id")


def gram_rows(docs: DataFrame, buckets: int, *, text: str = "text", fold: str | None = None) -> DataFrame:
    """(bucket, with fold that too): a row for every word and every pair of neighbours."""
    by = [] if fold is None else [F.col(fold).alias("fold")]
    # rows first, then hashes of pairs: what runs on a row is compiled, what runs on an array's elements is not
    hashed = with_words(docs.select(F.col(text).alias("text"), *by))
    after = F.slice("_hashes", F.lit(2), F.size("_hashes"))
    rows = hashed.select(*by, F.explode(F.arrays_zip(F.col("_hashes").alias("one"), after.alias("next"))).alias("at"))
    one, after = F.col("at.one"), F.col("at.next")
    two = F.when(after.isNotNull(), bucket_of(F.xxhash64(one, after), buckets))
    return rows.select(*by, F.explode(F.array(bucket_of(one, buckets), two)).alias("bucket")).where("bucket is not null")


def tally(docs: DataFrame, buckets: int, *, text: str = "text", fold: str | None = None) -> list[list[int]]:
    """How often the grams of all rows fall into each bucket: one list, or one for each fold."""
    rows = gram_rows(docs, buckets, text=text, fold=fold)
    sums = [F.count("*")] if fold is None else [F.count(F.when(F.col("fold") == k, 1)) for k in range(FOLDS)]
    counts = [[0] * buckets for _ in sums]
    for bucket, *found in rows.groupBy("bucket").agg(*sums).collect():  # as many rows as buckets at most
        for k, n in enumerate(found):
            counts[k][bucket] = n
    return counts


def weigh(raw: list[int], good: list[int]) -> list[int]:
    """Weight of each bucket, in millionths: its share in good against its share in raw, each smoothed by one."""
    raw, good = [n + 1 for n in raw], [n + 1 for n in good]
    least = math.log(sum(raw)) - math.log(sum(good))
    return [round(UNIT * (math.log(g) - math.log(r) + least)) for g, r in zip(good, raw)]


def fit(docs: DataFrame, marked: DataFrame, *, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> list[int]:
    """Weights of the trusted documents that are not held out, against all. marked: (doc_id, trusted, held), ids once."""
    good = labelled_texts(docs, marked.where("trusted and not held"), doc_id=doc_id, text=text)
    return weigh(tally(docs, buckets, text=text)[0], tally(good, buckets)[0])


def fit_folds(docs: DataFrame, trusted: DataFrame, *, text: str = "text", buckets: int = BUCKETS) -> tuple[list[int], list[list[int]]]:
    """Weights of all trusted documents against all, and the weights without each fold. trusted: (text, fold)."""
    raw, good = tally(docs, buckets, text=text)[0], tally(trusted, buckets, fold="fold")
    every = [sum(c) for c in zip(*good)]
    return weigh(raw, every), [weigh(raw, [n - own for n, own in zip(every, one)]) for one in good]


def with_weights(docs: DataFrame, weights: list[int]) -> DataFrame:
    """docs with the weights as the columns ``HELD``, for one :func:`score` each.

    The optimizer puts each subquery into the one expression that reads its column; a second one would make it a copied column.
    """
    one_row = docs.sparkSession.createDataFrame(pa.table({"weights": pa.array([weights], pa.list_(pa.int64()))}))
    return docs.withColumns({name: one_row.scalar() for name in HELD})


def _adding(table: Column, at: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
    return lambda total, h: total + F.get(table, at(h))


def score(hashes: Column, weights: list[int], fold: Column | None = None, pairs: Column | None = None, held: bool = False) -> Column:
    """Mean weight of the grams, in millionths (long); null without words. With fold, weights holds one list for each after another.
    pairs: neighbours(hashes) where a column has them. held: the rows are those of with_weights; else few weights are meant, as they are spelt out."""
    tables = [F.col(name) for name in HELD] if held else [F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")] * 2
    buckets = len(weights) if fold is None else len(weights) // FOLDS
    at = (lambda h: bucket_of(h, buckets)) if fold is None else (lambda h: bucket_of(h, buckets) + fold * F.lit(buckets))
    total = F.lit(0).cast("long")
    for hashed, table in zip((hashes, neighbours(hashes) if pairs is None else pairs), tables):
        total = F.aggregate(hashed, total, _adding(table, at))
    return F.when(F.size(hashes) > 0, F.floor(total / (2 * F.size(hashes) - 1)).cast("long"))


def ranked(scores: DataFrame, share: float) -> int | None:
    """The smallest score that at least this share of the rows do not exceed, exactly; null scores do not count.

    Scores are counted in bins, then one by one in the bin of that rank: a score is the mean of weights, which are
    below 45 in size, so there are at most 22,000 bins, and 4,096 scores in one.
    """
    some = scores.where("score is not null")
    at, found = F.shiftright("score", BIN), None
    bins = sorted(map(tuple, some.groupBy(at).count().collect()))
    rank = max(1, math.ceil(share * sum(n for _, n in bins)))
    for b, n in bins:
        if rank <= n:
            found = b
            break
        rank -= n
    if found is None:
        return None
    for value, n in sorted(map(tuple, some.where(at == found).groupBy("score").count().collect())):
        if rank <= n:
            return value
        rank -= n


def apart_scores(trusted: DataFrame, without: list[list[int]]) -> DataFrame:
    """(score) of the trusted documents (text, fold), each under the weights without its fold; null where the base rules fail."""
    # a condition, not a filter: a filter would be pushed below the steps above and repeat them
    weights = [w for one in without for w in one]
    counted = with_weights(base_counts(trusted).withColumn("base_failed", base_failed()), weights)
    apart = score(F.col("_hashes"), weights, F.col("fold"), F.col("_pairs"), held=True)
    return counted.select(F.when(~F.col("base_failed"), apart).alias("score"))


def threshold(trusted: DataFrame, without: list[list[int]], lose: float) -> int:
    """Largest score that all but a share ``lose`` of the trusted documents (text, fold) reach, each under the weights
    without its fold; without any, nothing is rejected."""
    found = ranked(stored(apart_scores(trusted, without), "scores"), lose)
    return -(1 << 62) if found is None else found


def judge(docs: DataFrame, labels: DataFrame, *, lose: float = 0.005, buckets: int = BUCKETS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, all columns kept, with the base counts, base_failed, score (millionths, null without words) and kept.

    labels: (doc_id, quality); quality 1 is trusted. All labels are looked up and all
    documents are counted and judged. Null texts have no words and fail the
    base rules; repeated rows are judged alike; documents whose score equals the threshold
    stay. Columns of docs named like an added one are replaced.
    """
    ids = labelled(labels).where("trusted").drop("trusted")
    trusted = stored(labelled_texts(docs, ids, doc_id=doc_id, text=text).select("text", "fold"), "trusted")
    weights, without = fit_folds(docs, trusted, text=text, buckets=buckets)
    least = threshold(trusted, without, lose)
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    plain = docs.drop(*added)
    out = with_weights(base_counts(plain, text).withColumn("base_failed", base_failed()), weights)
    out = out.withColumn("score", score(F.col("_hashes"), weights, pairs=F.col("_pairs"), held=True))
    out = out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= least, F.lit(False))).select(*plain.columns, *added)
    return settled(out)  # a filter on an added column stays above the steps that made it
