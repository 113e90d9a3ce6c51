"""Expansion of hubs, imports on top of a store, and search from postings."""

import pytest
from pyspark.sql import functions as F

from certweave.operators import graph as G
from certweave.operators import graph_store as store
from certweave.operators import projection, repair, search_index
from certweave.plans import register_view as V


def plain_expansion(nodes, edges):
    about = {r.uri: (r.kind, r.label) for r in nodes}
    out = [(u, "self", None, None, u, k, la) for u, (k, la) in about.items()]
    for e in edges:
        for own, other, direction, topology in ((e.src, e.dst, "out", G.OUTGOING), (e.dst, e.src, "in", G.INCOMING)):
            if own in about and other in about and e.predicate in topology[about[own][0]]:
                out.append((own, direction, e.predicate, G.EDGE_LABELS[e.predicate], other, *about[other]))
    return sorted(out, key=str)


def test_expansion_of_all_nodes_and_of_some(spark, sf):
    records = V.records(spark, sf).where("_record_seq < 900")
    nodes, edges = G.labelled_nodes(records), G.edges(records)
    want = plain_expansion(nodes.collect(), edges.collect())
    for block in (7, 10**6):
        assert sorted(map(tuple, G.expand_nodes(nodes, edges, block=block).collect()), key=str) == want
    some = nodes.where("kind = 'Region'")
    regions = {r.uri for r in some.collect()}
    assert sorted(map(tuple, G.expand_nodes(nodes, edges, some, block=5).collect()), key=str) == [w for w in want if w[0] in regions]


def test_a_hub_is_dealt_out(spark):
    """A region with a third of all edges: no task joins more than three times the median."""
    n = 12_000
    edges = spark.range(n).select(F.lit("inRegion").alias("predicate"), F.concat(F.lit("c"), F.col("id")).alias("src"),
                                  F.when(F.col("id") % 3 == 0, "r-hub").otherwise(F.concat(F.lit("r"), F.col("id") % 3000)).alias("dst"))
    ends = edges.select(F.col("src").alias("uri"), F.lit("Certificate").alias("kind")).union(edges.select("dst", F.lit("Region"))).distinct()
    nodes = ends.withColumn("label", F.col("uri"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "24"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        hubs = G.hubs(edges, 100)
        assert [tuple(r) for r in hubs.collect()] == [("r-hub", 40)]
        joined = G._salted(edges, "dst", "src", nodes.select("uri", "kind"), hubs)
        sizes = sorted(r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert sum(sizes) == n and sizes[-1] <= 3 * sizes[len(sizes) // 2]
        assert G.expand_nodes(nodes, edges, block=100).count() == 2 * n + nodes.count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def tables(found):
    return {name: sorted((tuple(sorted(r.asDict().items(), key=lambda x: x[0])) for r in t.collect()), key=str) for name, t in found.items()}


def test_imports_come_together(spark, sf, tmp_path):
    records = V.records(spark, sf).where("_record_seq < 600")
    path = str(tmp_path / "store")
    assert store.latest_version(spark, path) is None
    assert store.import_snapshot(spark, path, records.where("_record_seq < 400")) == 1
    assert store.import_snapshot(spark, path, records.where("_record_seq >= 200")) == 2
    once = tables(store.read_store(spark, path))
    assert once == tables(store.snapshot(records))
    assert store.import_snapshot(spark, path, records.where("_record_seq >= 200")) == 3
    assert tables(store.read_store(spark, path)) == once
    assert len(store.read_store(spark, path, 1)["Certificate"].collect()) < len(once["Certificate"])


def test_a_later_import_replaces_only_what_it_has(spark):
    def side(rows, shape):
        nodes = spark.createDataFrame(rows, shape)
        empty = spark.createDataFrame([], "uri string")
        return {n: nodes if n == "Region" else empty for n in store.NODE_TABLES} | {store.EDGES: spark.createDataFrame([("p", "a", "b")], "predicate string, src string, dst string")}

    old = side([("u", "a", "b"), ("v", "c", None)], "uri string, x string, y string")
    new = side([("u", None, "B"), ("w", "d", None)], "uri string, x string, z string")
    got = store.merged(old, new)
    assert sorted(map(tuple, got["Region"].select("uri", "x", "y", "z").collect()), key=str) == [("u", "a", "b", "B"), ("v", "c", None, None), ("w", "d", None, None)]
    assert got[store.EDGES].count() == 1


def test_rows_on_top_of_a_store_are_merged_in_one_step(spark, sf):
    """Rows of a snapshot, repeated ids among them, give what its merged tables give, and one shuffle of them is enough."""
    records = V.records(spark, sf).where("_record_seq < 600")
    stored = store.snapshot(records.where("_record_seq < 400"))
    late = records.where("_record_seq >= 200")
    got, want = store.merged(stored, store.rows(late)), store.merged(stored, store.snapshot(late))
    assert tables(got) == tables(want) == tables(store.snapshot(records))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(got["Certificate"]).count("Aggregate") < plan(want["Certificate"]).count("Aggregate")
    assert plan(got[store.EDGES]).count("Aggregate") < plan(want[store.EDGES]).count("Aggregate")


def test_grams_are_the_places_of_a_text(spark):
    texts = [None, "", "a", "ab", "abc", "Школа № 7", "a\nb\nc", "x😀yz😀", "aaaaaa", "İstanbul", "e\u0301a"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(F.lower("t").alias("t"), search_index.grams(F.col("t")).alias("g"))
    for r in rows.collect():
        t = r.t or ""
        assert sorted(r.g) == sorted({t[i:i + 3] for i in range(len(t))}), t
    for line in rows._jdf.queryExecution().optimizedPlan().toString().split("\n"):
        assert "lambdafunction" not in line


def test_an_unfinished_import_is_no_version(spark, sf, tmp_path):
    path = str(tmp_path / "store")
    records = V.records(spark, sf).where("_record_seq < 50")
    store.import_snapshot(spark, path, records)
    spark.range(3).write.parquet(f"{path}/version=2/Certificate")
    assert store.latest_version(spark, path) == 1 and store.import_snapshot(spark, path, records) == 2
    assert tables(store.read_store(spark, path)) == tables(store.read_store(spark, path, 1))


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    records = V.records(spark, "/root/testdata/sf0.001").where("_record_seq < 700")
    nodes = G.merge_nodes(G.certificate_nodes(projection.with_graph(repair.mark_branches(records))), ["_record_seq"])
    path = str(tmp_path_factory.mktemp("index") / "i")
    search_index.build(nodes, path)
    return spark.createDataFrame(nodes.collect(), nodes.schema), path


def test_search_equals_the_scan(spark, indexed):
    nodes, path = indexed
    texts = [r.EduOrgFullName for r in nodes.where("EduOrgFullName is not null").orderBy("uri").limit(200).collect()]
    queries = [texts[7 * n % len(texts)][n % 5:n % 5 + n] for n in range(1, 21)] + ["ШКОЛА № 1", "nothing like it", "zz", "1026700630615", " ", "=", "=1"]
    for q in queries:
        want = sorted(r.uri for r in G.search_certificates(nodes, q, limit=10**6).collect())
        assert sorted(r.uri for r in search_index.search(spark, path, q, limit=None).collect()) == want, q
    both = dict(q="школа", region="Республика NATION_1")
    assert [r.uri for r in search_index.search(spark, path, **both).collect()] == [r.uri for r in G.search_certificates(nodes, **both).collect()]
    assert search_index.search(spark, path).count() == 0 and search_index.search(spark, path, region="г. NATION_2", limit=5).count() == 5


def test_search_reads_few_postings(spark, indexed):
    _, path = indexed
    plan = search_index._candidates(spark, path, "ломоносова")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
