"""URL filter: rules first, then a character language model ratio.

Rules name a host (with all its subdomains) and a path prefix; the longest that fits decides.
The URLs that a rule allows or blocks are the accepted and rejected ones that two character
models learn from. A model predicts a character from up to ``order`` characters before it;
each order is smoothed by the next shorter one in proportion to the kinds of followers its
context has had (Witten-Bell), the shortest by a uniform share. A URL's score is the mean
log ratio over its characters, and the threshold comes from rule-judged URLs that were kept
out of the counts.

Scores are worked out once per distinct (order + 1)-gram and joined back, in whole
millionths, so sums do not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

START, END = "\x02", "\x03"
UNIT = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HELD_OUT = "012"  # URLs whose digest starts with one of these hex digits set the threshold
BIN = UNIT // 1000
MOST_BINS = 20_000  # scores lie within 20 nats of 0


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does. rules: ("allow" or "block", "host/path")."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        of, slash, rest = rule.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, decision).otherwise(verdict)
    return name, verdict


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """A row per character of every URL (and one for its end): the gram that ends there."""
    padded = F.concat(F.lit(START * order), F.col("body"), F.lit(END))
    return urls.withColumn("gram", F.explode(F.transform(F.sequence(F.lit(1), F.length("body") + 1), lambda i: F.substr(padded, i, F.lit(order + 1)))))


def gram_scores(counts: DataFrame, order: int, alphabet: int = 256) -> DataFrame:
    """counts (gram, accepted, rejected), a row per gram with 0 allowed, to (gram, score): log accepted share minus log rejected share."""
    known = None
    for n in range(order + 1):
        tail = counts.groupBy(F.right("gram", F.lit(n + 1)).alias("tail")).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
        tail = tail.withColumn("before", F.substring("tail", 1, n))
        context = tail.groupBy("before").agg(
            F.sum("a").alias("all_a"), F.sum("r").alias("all_r"), F.count(F.when(F.col("a") > 0, 1)).alias("kinds_a"), F.count(F.when(F.col("r") > 0, 1)).alias("kinds_r"))
        both = tail.join(context, "before")
        if known is None:
            both = both.withColumn("less_a", F.lit(1.0 / alphabet)).withColumn("less_r", F.lit(1.0 / alphabet))
        else:
            both = both.withColumn("shorter", F.right("tail", F.lit(n))).join(known, "shorter")
        share = {c: F.when(F.col(f"all_{c}") == 0, F.col(f"less_{c}")).otherwise(
            (F.col(c) + F.col(f"kinds_{c}") * F.col(f"less_{c}")) / (F.col(f"all_{c}") + F.col(f"kinds_{c}"))) for c in "ar"}
        known = both.select(F.col("tail").alias("shorter"), share["a"].alias("less_a"), share["r"].alias("less_r"))
    ratio = F.ln("less_a") - F.ln("less_r")
    return known.select(F.col("shorter").alias("gram"), F.round(ratio * UNIT).cast("long").alias("score"))


def threshold(scored: DataFrame) -> int:
    """The score from which on to allow, best for the mean of both shares judged right; 0 where one kind is missing.

    scored: (score, verdict). The driver gets a histogram of fixed width.
    """
    bin_ = F.greatest(F.lit(-MOST_BINS), F.least(F.lit(MOST_BINS), F.floor(F.col("score") / BIN)))
    rows = scored.groupBy(bin_.alias("bin")).agg(F.count(F.when(F.col("verdict") == "allow", 1)).alias("a"), F.count(F.when(F.col("verdict") == "block", 1)).alias("b")).collect()
    accepted, rejected = sum(r.a for r in rows), sum(r.b for r in rows)
    if not accepted or not rejected:
        return 0
    best, at, kept, blocked, below = 0.0, 0, accepted, 0, None
    for r in sorted(rows, key=lambda r: r.bin):
        right = kept / accepted + blocked / rejected
        if right > best:  # half way between the scores on both sides of the cut
            best, at = right, (r.bin if below is None else (below + r.bin) // 2) * BIN
        below = r.bin
        kept, blocked = kept - r.a, blocked + r.b
    return at


def judge(pages: DataFrame, rules: list[tuple[str, str]], *, url: str = "url", order: int = 4) -> DataFrame:
    """pages, all columns kept, with host, path, rule, score (millionths per character) and verdict.

    A null URL is judged as an empty one: no rule fits, and the model sees its end only.
    Equal URLs are judged alike; a score at the threshold is allowed. Columns of pages named
    like an added one are replaced. Without rows the result has none.
    """
    added = ["host", "path", "rule", "score", "verdict"]
    plain = pages.drop(*[c for c in added if c != url])
    address = F.coalesce(F.col(url), F.lit(""))
    distinct = plain.select(address.alias("address")).distinct()
    h, p = host(F.col("address")), path(F.col("address"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    rest = F.regexp_extract("address", r"(?s)^.*?://[^/?#]*(.*)$", 1)
    # a scheme says nothing here; what has none is read as it is
    body = F.when(F.col("address").contains("://"), F.concat("host", rest)).otherwise(F.col("address"))
    urls = distinct.withColumn("host", h).withColumn("path", p).withColumn("rule", rule).withColumn("ruled", verdict).withColumn("body", body)
    urls = stored(urls.withColumn("id", F.monotonically_increasing_id()).withColumn("held", F.substring(F.md5("address"), 1, 1).isin(*HELD_OUT)), "urls")
    places = _grams(urls.select("id", "body", "ruled", "held"), order)
    learns = lambda v: F.count(F.when((F.col("ruled") == v) & ~F.col("held"), 1))
    counts = stored(places.groupBy("gram").agg(learns("allow").alias("accepted"), learns("block").alias("rejected")), "url-grams")
    scores = stored(gram_scores(counts, order), "url-gram-scores")
    sums = places.select("id", "gram").join(scores, "gram").groupBy("id").agg(F.floor(F.sum("score") / F.count("*")).cast("long").alias("score"))
    scored = stored(urls.join(sums, "id").select("address", "host", "path", "rule", "ruled", "held", "score"), "url-scores")
    least = threshold(scored.where("held").select("score", F.col("ruled").alias("verdict")).where("verdict is not null"))
    decided = scored.select(
        F.col("address").alias("_address"), "host", "path", "rule", "score",
        F.coalesce("ruled", F.when(F.col("score") >= least, "allow").otherwise("block")).alias("verdict"))
    kept = [F.col(c) for c in pages.columns if c not in added or c == url]
    return pages.withColumn("_address", address).select(*kept, F.col("_address").alias("_address")).join(decided, "_address").drop("_address")
