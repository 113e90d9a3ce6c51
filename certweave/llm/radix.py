"""Exact duplicates by MSD radix partitioning, with texts compared by their bytes and by no digest.

A text's key is its number of bytes followed by its bytes, so texts of different length part at
the first digit and no text ends inside another. A round splits every open group by the
next bytes of its members, ``first`` of them at first and ``wider`` times as many in each
round after. A group of one is closed. A group whose members agree from there to their ends
is closed too, as a group of copies; that is seen from its least and its greatest rest. All others
go into the next round. So a round is two aggregates with partial results on the map
side, where copies are one row per task however many there are, and one join that gives
rows their new group; rows of closed groups leave their text behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, stored

FIRST, WIDER = 64, 8


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def _split(rows: DataFrame, width: int) -> DataFrame:
    """rows (group, doc_id, sha, rest) with the group that the next bytes make, null for a group of one, and what comes after them.

    rows of a closed group keep no rest.
    """
    cut = rows.select("group", F.substring("rest", 1, width).alias("block"), "doc_id", "sha", F.expr(f"substring(rest, {width + 1})").alias("rest"))
    many = cut.groupBy("group", "block").agg(F.count("*").alias("n")).where("n > 1")
    many = stored(many.select("group", "block", F.monotonically_increasing_id().alias("next")), "radix-groups")
    # always by shuffle, so that the need grows in proportion; a group of a third of all rows is split by the adaptive
    # join, as nothing above needs its rows together
    parted = cut.join(many.hint("merge"), ["group", "block"], "left")
    return stored(parted.select(F.col("next").alias("group"), F.monotonically_increasing_id().alias("row"), "doc_id", "sha",
                                F.when(F.col("next").isNotNull(), F.col("rest")).alias("rest")), "radix-rows")


def exact_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", first: int = FIRST, wider: int = WIDER) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row per row of docs.

    Texts are equal when identical after each run of U+0020 and U+0009 to U+000D became one space; null
    counts as empty. keep_id: the smallest doc_id of the equal texts (null ids are last);
    group_size: how many rows have that text; kept: true for one row of each group, that of
    keep_id. Of rows that repeat the id as well, or have no id at all, one stays. text_sha256 is
    worked out for the result only. Other columns are ignored; no rows give no rows.
    """
    whole = normalised(F.col(text)).cast("binary")
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole.alias("rest"))
    rows = plain.select(F.octet_length("rest").cast("long").alias("group"), "doc_id", F.sha2("rest", 256).alias("sha"), "rest")
    done, width = [], first
    while True:
        parted = _split(rows, width)
        done.append(parted.where("group is null").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"))
        open_ = parted.where("group is not null")
        keep = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("keep")
        groups = open_.groupBy("group").agg((F.min("rest") == F.max("rest")).alias("alike"), F.count("*").alias("n"), keep)
        groups = stored(groups.select("group", "alike", "n", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("first")), "radix-checked")
        closed = open_.select("group", "row", "doc_id", "sha").join(groups.where("alike"), "group")
        done.append(closed.select("doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("row") == F.col("first")).alias("kept"), "sha"))
        mixed = groups.where("not alike")
        if mixed.isEmpty():
            break
        rows = open_.join(mixed.select("group"), "group").select("group", "doc_id", "sha", "rest")
        width *= wider
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.withColumnRenamed("sha", "text_sha256")
