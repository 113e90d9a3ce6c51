"""Substring search over certificate nodes by trigram postings.

Every place of a searchable text begins a gram of three characters (shorter at the text's end), so a
query of one or two characters is the beginning of some gram and a longer one holds grams that all have to
occur. A search reads the postings of its rarest grams and then the blocks of nodes they name; each hit
is verified on the node's texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from certweave.operators import graph as G

GRAM = 3
BUCKETS, BLOCKS = 64, 64
RAREST = 3  # grams of a query whose postings are read
SEARCHED = ["EduOrgFullName", "g_display_name"]
WHOLE = ["EduOrgOGRN", "EduOrgINN"]
_WHOLE_MARK = "="  # before a value that is looked up whole


def grams(text: Column) -> Column:
    """Distinct grams of the lower-cased text; none for null. One pass: every character looks at itself and those behind it."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.array_distinct(F.regexp_extract_all(low, F.lit(f"(?s)(?=(.{{1,{GRAM}}}))."), F.lit(1)))


def build(nodes: DataFrame, path: str) -> None:
    """Write the index of certificate nodes (one per uri): ``nodes`` in blocks, ``postings`` and ``grams`` in buckets by gram.

    A common gram is counted with partial results and its postings are written by the tasks that hold its nodes.
    """
    node = F.xxhash64("uri")
    placed = nodes.withColumn("node", node).withColumn("block", F.pmod(F.col("node"), F.lit(BLOCKS)).cast("int"))
    placed.write.partitionBy("block").parquet(f"{path}/nodes")
    stored = nodes.sparkSession.read.schema(placed.schema).parquet(f"{path}/nodes")
    whole = F.array(*[F.concat(F.lit(_WHOLE_MARK), F.col(c)) for c in WHOLE if c in nodes.columns])
    keys = F.array_distinct(F.concat(*[grams(F.col(c)) for c in SEARCHED if c in nodes.columns], F.filter(whole, lambda x: x.isNotNull())))
    found = stored.select("node", F.explode(keys).alias("gram")).withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(BUCKETS)).cast("int"))
    found.sortWithinPartitions("bucket", "gram").write.partitionBy("bucket").parquet(f"{path}/postings")
    counts = nodes.sparkSession.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    counts.write.parquet(f"{path}/grams")


def _candidates(spark: SparkSession, path: str, q: str) -> DataFrame:
    """(node) of the nodes that may hold q; all that do are among them."""
    low = q.lower()
    postings = spark.read.parquet(f"{path}/postings")
    whole = _WHOLE_MARK + q
    if len(low) < GRAM:
        return postings.where((F.col("gram").startswith(low) & (F.length("gram") <= GRAM)) | (F.col("gram") == whole)).select("node").distinct()
    wanted = sorted({low[i:i + GRAM] for i in range(len(low) - GRAM + 1)})
    counts = {r.gram: r.n for r in spark.read.parquet(f"{path}/grams").where(F.col("gram").isin(wanted)).collect()}  # a row per gram of q
    rare = sorted(wanted, key=lambda g: (counts.get(g, 0), g))[:RAREST]
    buckets = spark.range(1).select(F.array(*[F.pmod(F.xxhash64(F.lit(t)), F.lit(BUCKETS)).cast("int") for t in (*rare, whole)])).first()[0]
    read = postings.where(F.col("bucket").isin(buckets) & F.col("gram").isin([*rare, whole]))
    texts = read.where(F.col("gram") != whole).groupBy("node").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(rare)).select("node")
    return texts.unionByName(read.where(F.col("gram") == whole).select("node")).distinct()


def search(spark: SparkSession, path: str, q: str = "", region: str = "", level: str = "", control_organ: str = "", limit: int | None = 20) -> DataFrame:
    """What ``graph.search_certificates`` finds, from the index; all hits where ``limit`` is None.

    Without a text the nodes are filtered as they are; without any condition nothing is found.
    """
    nodes = spark.read.parquet(f"{path}/nodes")
    conditions = G.search_conditions(q, region, level, control_organ)
    if not conditions:
        return nodes.drop("node", "block").where(F.lit(False))
    if q.strip():
        hits = _candidates(spark, path, q.strip()).withColumn("block", F.pmod(F.col("node"), F.lit(BLOCKS)).cast("int"))
        nodes = nodes.join(hits, ["block", "node"], "left_semi")
    for c in conditions:
        nodes = nodes.where(c)
    nodes = nodes.drop("node", "block")
    return nodes if limit is None else nodes.orderBy("uri").limit(limit)
