"""Mixing sources to target weights by capped water-filling.

``fill`` finds the targets. Sources whose share of what is left would be more than
``max_epochs`` times their size are clamped there and the excess is shared again by weight,
until nobody is above. The state of that loop is one number, the level (size per unit of
weight), so each round is one aggregate over the table of sources.

``plan`` turns a target into repetitions: so many whole ones, and one more for a seeded part
of the documents. Documents of a source are in the order of a seeded digest; those before a
cut are taken once more. What is then missing (less than the document at the cut has) is
made up by a few documents behind it: twice the largest that fits, then the nearest. The cut is found by narrowing the digest's prefix twice, so no task sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, numbered, stored

FIRST, SECOND = 3, 6  # hex digits of the digest in the two narrowing steps
PICKS = 3


def cycled_weights(sources: DataFrame, weights=(5, 2, 1)) -> DataFrame:
    """Sources in code point order, null last, with the weights repeating over them."""
    ranked = numbered(sources.withColumn("null_last", F.col("source").isNull()), ["null_last", "source"], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    return ranked.withColumn("weight", weight).drop("null_last", "place")


def fill(sources: DataFrame, max_epochs: float = 3.0, budget: float | None = None) -> DataFrame:
    """sources (source, source_size, weight) with ``target``.

    The targets add up to the budget (default: all sizes) or, where that cannot be, to
    ``max_epochs`` times all sizes. Sources of size 0 or without a positive weight get 0.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    weight = F.when(F.col("weight") > 0, F.col("weight")).otherwise(0.0)
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    budget, level, clamped_before = float(total if budget is None else budget), 0.0, -1
    while True:
        above = cap < weight * F.lit(level)
        clamped, taken, free = sources.agg(
            F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, weight)), F.lit(0.0))).first()
        if clamped == clamped_before or free == 0:
            break
        clamped_before, level = clamped, max(level, (budget - taken) / free)
    return sources.withColumn("target", F.least(cap, weight * F.lit(level)))


def digest(seed: int, doc_id: Column, text: Column) -> Column:
    """Order of the documents inside a source. Rows equal in id and text share it and stand together."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), doc_id.cast("string"), text))


def plan(keys: DataFrame, sources: DataFrame) -> DataFrame:
    """sources with ``whole`` repetitions, the ``cut`` before which documents count once more, and the ``picks`` besides.

    keys: (source, key, size), a row per source and key.
    """
    todo = sources.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("whole"))
    todo = stored(todo.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-todo")
    want = todo.where("rest > 0").select("source", "rest")

    def narrowed(rows, unit):
        # the first unit whose running size passes what is wanted
        running = Window.partitionBy("source").orderBy(unit)
        sums = rows.groupBy("source", "rest", unit).agg(F.sum("size").alias("size"))
        sums = sums.withColumn("end", F.sum("size").over(running.rowsBetween(Window.unboundedPreceding, 0)))
        hit = sums.where(F.col("end") > F.col("rest")).groupBy("source").agg(
            F.min(F.struct(F.col(unit), F.col("end"), F.col("size"), F.col("rest"))).alias("hit"))
        return hit.select("source", F.col(f"hit.{unit}").alias(unit),
                          (F.col("hit.rest") - F.col("hit.end") + F.col("hit.size")).alias("rest"))

    keys = keys.withColumn("first", F.substring("key", 1, FIRST)).withColumn("second", F.substring("key", 1, SECOND))

    def inside(found, unit):
        found = stored(found, "mix-cut").withColumnRenamed("source", "of")
        return keys.join(found, keys["source"].eqNullSafe(found["of"]) & (keys[unit] == found[unit])).drop(found[unit]).drop("of")

    found = narrowed(keys.join(want.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of"), "first")
    found = narrowed(inside(found, "first"), "second")
    found = stored(narrowed(inside(found, "second"), "key"), "mix-cut").select(F.col("source").alias("of"), F.col("key").alias("cut"), "rest")
    behind = stored(keys.join(found, F.col("source").eqNullSafe(F.col("of"))).where((F.col("key") >= F.col("cut")) & (F.col("size") > 0))
                    .select("of", "key", "size"), "mix-behind")
    missing, picks = found.select("of", "rest"), []
    for step in range(PICKS):
        gap = F.abs(F.col("size") - F.col("rest")) if step == PICKS - 1 else F.when(F.col("size") <= F.col("rest"), F.col("rest") - F.col("size"))
        left = missing.withColumnRenamed("of", "by")
        near = behind.join(left, F.col("of").eqNullSafe(F.col("by"))).where((gap < F.col("rest")) & gap.isNotNull())
        for got in picks:  # a document is taken once more, not twice
            taken = got.select(F.col("of").alias("by"), F.col("key").alias("gone"))
            near = near.drop("by").join(taken, F.col("of").eqNullSafe(F.col("by")) & (F.col("key") == F.col("gone")), "left_anti").withColumn("by", F.col("of"))
        near = near.groupBy("of", "rest").agg(F.min(F.struct(gap.alias("gap"), F.col("key"), F.col("size"))).alias("near"))
        picks.append(stored(near.select("of", F.col("near.key").alias("key"), (F.col("rest") - F.col("near.size")).alias("rest")), "mix-pick"))
        done = picks[-1].select(F.col("of").alias("by"), F.col("rest").alias("less"))
        missing = missing.join(done, F.col("of").eqNullSafe(F.col("by")), "left").select("of", F.coalesce("less", "rest").alias("rest"))
    out = todo.drop("rest").join(found.drop("rest"), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    every = picks[0]
    for got in picks[1:]:
        every = every.unionByName(got)
    every = every.groupBy(F.col("of").alias("by")).agg(F.collect_set("key").alias("picks"))
    return out.join(every, F.col("source").eqNullSafe(F.col("by")), "left").drop("by")


def mix(docs: DataFrame, weights=(5, 2, 1), max_epochs: float = 3.0, seed: int = 42, budget: float | None = None, *,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, all columns kept, with size, source_size, target and ``times`` (how often the mix has the row).

    weights: numbers repeating over the sources in code point order (null is a source, the
    last one), or a table (source, weight); sources it lacks get nothing. Sizes are words. A
    row without words is in as often as its source's whole repetitions. Rows equal in id and
    text are taken together. Columns of ``docs`` named like an added one are replaced.
    Tables without rows stay so.
    """
    added = ["_size", "_key"]
    sized = docs.withColumn("_size", n_words(F.col(text))).withColumn("_key", digest(seed, F.col(doc_id), F.col(text)))
    keys = stored(sized.groupBy(F.col(source).alias("source"), F.col("_key").alias("key")).agg(F.sum("_size").alias("size")), "mix-keys")
    sources = keys.groupBy("source").agg(F.sum("size").alias("source_size"))
    if isinstance(weights, DataFrame):
        given = weights.select(F.col("source").alias("of"), F.col("weight").cast("double").alias("weight"))
        sources = stored(sources.join(given, F.col("source").eqNullSafe(F.col("of")), "left").drop("of"), "mix-sources")
    else:
        sources = stored(cycled_weights(sources, weights), "mix-sources")
    table = stored(plan(keys, fill(sources, max_epochs, budget)), "mix-plan")
    table = table.select(*[F.col(c).alias(f"_mix_{c}") for c in table.columns])
    once_more = (F.col("_key") < F.col("_mix_cut")) | F.coalesce(F.array_contains(F.col("_mix_picks"), F.col("_key")), F.lit(False))
    times = F.col("_mix_whole") + F.when(F.coalesce(once_more, F.lit(False)), 1).otherwise(0)
    out = sized.join(table, F.col(source).eqNullSafe(F.col("_mix_source")))
    kept = [F.col(c) for c in docs.columns if c not in ("size", "source_size", "target", "times")]
    return out.select(*kept, F.col("_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
                      F.col("_mix_target").alias("target"), times.cast("long").alias("times")).drop(*added)


def repeated(mixed: DataFrame) -> DataFrame:
    """Every row as often as the mix has it."""
    return mixed.where("times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("_copy")
