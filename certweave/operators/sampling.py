"""Reproducible samples. A hash of seed and key replaces a random generator.

The ``n`` smallest hashes are a uniform sample without replacement that does not
depend on partitioning. They are found by a top-n per task and a merge of the
survivors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from certweave import schema as S
from certweave.functions import nested as N
from certweave.functions import text as X

MAPPING_FIELDS = ["EduLevelName", "ProgrammName", "ProgrammCode", "UGSName", "UGSCode", "TypeName", "IsAccredited"]


def seeded_hash(seed: int, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def sample_n(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """``n`` rows; ``key`` must be unique. Raises when there are fewer rows."""
    have = df.select(key).limit(n).count()
    if have < n:
        raise ValueError(f"asked for {n} rows, there are only {have}")
    return df.orderBy(seeded_hash(seed, F.col(key)), key).limit(n)


def sample_sizes(df: DataFrame, sizes: list[int], key: str, seed_base: int) -> DataFrame:
    """One sample per size, each with its own seed; ``sample_size`` tells them apart."""
    out = None
    for n in sizes:
        part = sample_n(df, n, key, seed_base + n).withColumn("sample_size", F.lit(n))
        out = part if out is None else out.unionByName(part)
    return out


def sample_names(names: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` of the distinct names (column ``name``), or all when there are not more."""
    return names.select("name").distinct().orderBy(seeded_hash(seed, F.col("name")), "name").limit(n)


def _leaf_score(dtype: T.DataType, value: Column) -> Column:
    if isinstance(dtype, T.StructType):
        total = F.lit(0)
        for f in dtype.fields:
            total = total + _leaf_score(f.dataType, value[f.name])
        return total
    if isinstance(dtype, T.ArrayType):
        each = F.transform(value, lambda x: _leaf_score(dtype.elementType, x))
        return F.coalesce(F.aggregate(each, F.lit(0), lambda a, b: a + b), F.lit(0))
    filled = ~X.is_blank(value) if isinstance(dtype, T.StringType) else value.isNotNull()
    return filled.cast("int")


def fill_score(df: DataFrame) -> Column:
    """Number of non-blank leaves of a record; false and 0 count. Bookkeeping columns do not."""
    total = F.lit(0)
    for f in df.schema.fields:
        if f.name not in ("_source_file", "_record_seq"):
            total = total + _leaf_score(f.dataType, F.col(f.name))
    return total


def _level(p: Column) -> Column:
    return X.nonblank(p["EduLevelName"])


def sample_per_level(records: DataFrame, levels: list[str], seed: int, uniform: bool = False) -> DataFrame:
    """One record per level: the best filled one, a hash decides ties; or any one when ``uniform``.

    (level, _record_seq, score) is aggregated with ``min_by``; records themselves
    are not shuffled.
    """
    found = F.array_distinct(F.filter(F.transform(N.all_programs(), _level), lambda x: x.isin(levels)))
    scored = records.select("_record_seq", fill_score(records).alias("score"), found.alias("found"))
    rows = scored.select("_record_seq", "score", F.explode("found").alias("level"))
    tie = seeded_hash(seed, F.concat_ws("|", "level", F.col("_record_seq").cast("string")))
    order = F.struct(F.lit(0) if uniform else -F.col("score"), tie, F.col("_record_seq"))
    return rows.groupBy("level").agg(F.min_by(F.struct("_record_seq", "score"), order).alias("x")).select(
        "level", "x._record_seq", "x.score")


def missing_levels(chosen: DataFrame, levels: list[str]) -> DataFrame:
    """Levels no record was found for; a job fails when this is not empty."""
    wanted = chosen.sparkSession.createDataFrame([(x,) for x in levels], "level string")
    return wanted.join(chosen, "level", "left_anti")


def first_program_of_level(level: Column) -> Column:
    """The record's first programme of a level with the fields of use for a mapping; blanks become null."""
    first = F.try_element_at(F.filter(N.all_programs(), lambda p: F.coalesce(_level(p) == level, F.lit(False))), F.lit(1))
    fields = []
    for f in MAPPING_FIELDS:
        value = first[f] if f in S.BOOL_FIELDS else F.when(~X.is_blank(first[f]), first[f])
        fields.append(value.alias(f))
    slim = F.struct(*fields)
    others = F.lit(False)
    for f in MAPPING_FIELDS[1:]:
        others = others | slim[f].isNotNull()
    return F.when(first.isNotNull(), slim.withField("EduLevelName", F.when(~others, slim["EduLevelName"])))
