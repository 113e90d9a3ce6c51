"""Results that must not depend on skew, on partitioning or on the way taken."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from certweave import schema as S
from certweave.operators import audit, backfill, filters, graph, repair
from certweave.operators import graph as G
from certweave.operators import relational as R
from certweave.plans import register_view as V
from certweave.session import scratch_path
from certweave.sources import dims, links, readers, sinks


def test_limit_per_file_with_one_hot_file(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("f"), F.col("id") % 7)).alias("_source_file"), F.col("id").alias("_record_seq"))
    got = {}
    for r in filters.limit_per_file(df.repartition(13), 5).collect():
        got.setdefault(r._source_file, []).append(r._record_seq)
    want = {}
    for n in range(3000):
        want.setdefault("hot" if n % 3 == 0 else f"f{n % 7}", []).append(n)
    assert {k: sorted(v) for k, v in got.items()} == {k: v[:5] for k, v in want.items()}


def test_first_per_group_matches_brute_force(spark):
    df = spark.range(2000).select(F.expr("case when id % 3 = 0 then 'hot' else 'g' || id % 11 end").alias("g"), F.expr("(id * 7919) % 2003").alias("o"))
    rows = df.collect()
    got = sorted((r.g, r.o, r.rank) for r in audit.first_per_group(df, ["g"], ["o"], 4).collect())
    want = sorted((g, o, n + 1) for g in {r.g for r in rows} for n, o in enumerate(sorted(r.o for r in rows if r.g == g)[:4]))
    assert got == want


def test_hot_code_fills_the_same_with_any_partitioning(spark):
    rows = spark.range(1500).selectExpr("'f' as scope", "case when id % 3 = 0 then 'hot' else 'c' || id % 40 end as code",
                                        "case when id % 5 = 0 then null else 'L' || (id % 4) end as level")
    filled = lambda df: sorted((r.code, r.filled_level or "", r.n) for r in backfill.fill_rows(
        df, backfill.majority_level(backfill.level_histogram_by_code(df))).groupBy("code", "filled_level").agg(F.count("*").alias("n")).collect())
    assert filled(rows.repartition(1)) == filled(rows.repartition(9))


def test_merging_nodes_twice_changes_nothing(spark):
    nodes = spark.createDataFrame([("u", 1, "a", None), ("u", 2, None, "b"), ("u", 3, "c", None), ("v", 4, None, None)], "uri string, seq int, p string, q string")
    once = graph.merge_nodes(nodes, ["seq"])
    again = graph.merge_nodes(once.withColumn("seq", F.lit(9)), ["seq"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, again.collect()), key=str) == [("u", "c", "b"), ("v", None, None)]


def test_repeated_id_keeps_the_first_that_loads(spark):
    rows = [("a", 1, ["s", "s"]), ("a", 2, ["s"]), ("a", 3, ["t"]), (None, 4, []), ("b", 5, [None]), ("c", 6, [])]
    record = S.record_type()
    lines = [(i, seq, [{"Id": x} for x in ids]) for i, seq, ids in rows]
    shape = T.StructType([record["Id"], T.StructField("_record_seq", T.IntegerType()), record["Supplements"], record["Decisions"]])
    df = spark.createDataFrame([(i, seq, [tuple(s.get(f.name) for f in record["Supplements"].dataType.elementType.fields) for s in sups], [])
                                for i, seq, sups in lines], shape)
    assert sorted((r.Id, r._record_seq) for r in R.loadable_records(df).collect()) == [("a", 2), ("c", 6)]


def test_loadable_records_on_the_register_view(spark, sf):
    df = V.records(spark, sf).select("Id", "_record_seq", "Supplements", "Decisions")
    kept = R.loadable_records(df).select("Id", "_record_seq").collect()
    assert len({r.Id for r in kept}) == len(kept) and all(r.Id for r in kept)


def test_level_map_file(spark, tmp_path):
    p = tmp_path / "levels.json"
    p.write_text('{"canonical_edu_level_names_fz273":["A","B"],"entries":[{"source_registry_level_name":"x","target_edu_level_name":" A "},'
                 '{"source_registry_level_name":"x","target_edu_level_name":"B"},{"source_registry_level_name":" ","target_edu_level_name":"B"},'
                 '{"source_registry_level_name":"y","target_edu_level_name":null},{"source_registry_level_name":"z","target_edu_level_name":5}]}', encoding="utf-8")
    found = dims.load_levels(spark, str(p))
    assert sorted(map(tuple, found.collect()), key=str) == [("A", "A", "canonical"), ("B", "B", "canonical"), ("x", "A", "rename"), ("y", None, "clear")]
    assert dims.load_levels(spark, str(tmp_path / "absent.json")) is None


def test_override_file(spark, tmp_path):
    p = tmp_path / "o.json"
    p.write_text('{"_note":"n","10 27":"67-1","x":"5","1027":"68"}', encoding="utf-8")
    assert [tuple(r) for r in dims.load_overrides(spark, str(p)).collect()] == [("1027", "68")]
    assert dims.load_overrides(spark, str(tmp_path / "absent.json")).count() == 0


def test_links(spark):
    html = "<a href='/x/data.xml'>1</a> <A class=c HREF=\"sub/b.XML?v=1&amp;w=2\">2</A> <a href=../c.xml>3</a> <a href='/x/data.xml'>4</a> <a href='//h2/d.xml'>5</a> <a href='e.html'>6</a>"
    page = spark.createDataFrame([(1, "http://h/p/q", html)], "page_id int, url string, html string")
    assert [r.link for r in links.extract_links(page).orderBy("pos").collect()] == [
        "http://h/x/data.xml", "http://h/p/q/sub/b.XML?v=1&w=2", "http://h/p/c.xml", "http://h2/d.xml"]
    urls = spark.createDataFrame([("http://h/data-20240101-a.xml",), ("http://h/DATA-20250101-b.xml?x",), ("http://h/data-20250101-c.xml",), ("http://h/z.xml",)], "url string")
    assert links.latest_snapshot(urls).count() == 2
    assert links.latest_snapshot(urls.where("url like '%z.xml'")).count() == 1


def test_line_kinds_and_limits(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('\n{"Id":"1"}\nbroken\n[1]\n{"Id":"2"}\n', encoding="utf-8")
    lines = readers.read_lines(spark, str(tmp_path / "a.jsonl"))
    assert [r.Id for r in readers.parse_records(lines).orderBy("_record_seq").collect()] == ["1", "2"]
    assert readers.limit_lines(lines, 2).count() == 2
    assert [r.value for r in readers.limit_parsed(lines, 2).collect()] == ['{"Id":"1"}', "[1]"]


def test_json_of_any_depth(spark):
    nested = '{"k":' * 12 + '"[{n/a"' + "}" * 12
    lines = spark.createDataFrame([('{"a":{"b":{"c":"-"}},"_x":"-","l":["000",["н/д"]]}',), (f'{{"d":{nested},"e":"-"}}',), ('{"f":' * 9 + '"-"' + "}" * 9,)], "value string")
    full = {(r.cls, r.path): r.total for r in audit.scan_json_placeholders(lines).collect()}
    assert full == {("dash_only", "/a/b/c"): 1, ("only_zeros", "/l/*"): 1, ("empty_marker", "/l/*/*"): 1, ("dash_only", "/e"): 1, ("dash_only", "/f" * 9): 1}


def test_placeholders_thirty_levels_down(spark):
    """The plan is the same for any depth; texts with quotes, brackets and escapes are texts."""
    deep = '{"k":[' * 30 + '"-"' + "]}" * 30
    odd = r'{"a\"b":"-","c":"x\"},[\\","d":["\u002d",{"_h":{"z":"-"},"z":"000"}],"e":"' + "\ue000" + r'q","f\\":"н/д","g":["[","-"]}'
    lines = spark.createDataFrame([(deep,), (odd,), ("[1]",), ("{",), (None,), ('{"l":"' + "x" * 100_000 + '","m":"-"}',), ('{"n":"' + r"\n" * 20_000 + '","o":"—"}',)], "value string")
    full = {(r.cls, r.path): r.total for r in audit.scan_json_placeholders(lines).collect()}
    assert full == {("dash_only", "/k/*" * 30): 1, ("dash_only", '/a"b'): 1, ("dash_only", "/d/*"): 1, ("only_zeros", "/d/*/z"): 1,
                    ("empty_marker", "/f\\"): 1, ("dash_only", "/g/*"): 1, ("dash_only", "/m"): 1, ("dash_only", "/o"): 1}


def test_odd_json_items_cost_themselves_only(spark):
    line = '{"Id":"1","Supplements":["x",{"Id":"s","EducationalPrograms":[null,5,{"Id":"p","ProgrammCode":"380301"}]},null],"Decisions":[7,{"Id":"d"}]}'
    records = readers.parse_records(spark.createDataFrame([(line, 1)], "value string, _record_seq long"))
    assert [(r.supplement_id, r.program_slot, r.program_id) for r in R.programs(records).collect()] == [("s", 2, "p")]
    assert [r.decision_id for r in R.decisions(records).collect()] == ["d"] and R.loadable_records(records).count() == 1
    ends = {r.uri for r in G.labelled_nodes(records).collect()}
    found = G.edges(records).collect()
    assert len(found) == 3 and all(e.src in ends and e.dst in ends for e in found)
    assert G.labelled_nodes(records).where("kind = 'EducationalProgram'").count() == 1


def test_xml_in_the_declared_encoding(spark, tmp_path):
    text = '<?xml version="1.0" encoding="windows-1251"?>\n<OpenData><Certificate><Id>a</Id><StatusName>да e&nbsp;f & g</StatusName></Certificate>' \
        '<!-- <Certificate><Id>gone</Id></Certificate> --><Certificate><Id>b</Id><StatusName><![CDATA[<Certificate> & x]]></StatusName></Certificate></OpenData>'
    (tmp_path / "a.xml").write_bytes(text.encode("cp1251"))
    got = readers.read_xml(spark, str(tmp_path / "a.xml")).orderBy("_record_seq").collect()
    assert [(r.Id, r.StatusName, r._corrupt_record) for r in got] == [("a", "да ef  g", None), ("b", "<Certificate> & x", None)]


def test_xml_files_of_several_encodings_in_one_scan(spark, tmp_path):
    for folder, name, encoding in (("a", "1", "windows-1251"), ("a", "2", "utf-8"), ("b", "1", None), ("b", "2", "KOI8-R")):
        (tmp_path / folder).mkdir(exist_ok=True)
        head = f'<?xml version="1.0" encoding="{encoding}"?>\n' if encoding else ""
        body = "".join(f"<Certificate><Id>{folder}{name}{n}</Id><StatusName>Действует</StatusName></Certificate>" for n in range(3))
        (tmp_path / folder / f"{name}.xml").write_bytes(f"{head}<OpenData>{body}</OpenData>".encode(encoding or "utf-8"))
    want = [(f"{f}{name}{n}", "Действует") for f in "ab" for name in "12" for n in range(3)]
    for path in (str(tmp_path / "*"), [str(tmp_path / "b"), str(tmp_path / "a")], [str(tmp_path / f / f"{n}.xml") for f in "ab" for n in "21"]):
        assert sorted((r.Id, r.StatusName) for r in readers.read_xml(spark, path).collect()) == want


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext, conf = Context, type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(ValueError):
        scratch_path(Session, "x")


def test_all_tables_go_to_the_database_in_order(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    sent = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode=None, properties=None: sent.append((url, table, mode, [f.name for f in self._df.schema.fields], properties)))
    tabs = R.tables(V.records(spark, "/root/testdata/sf0.001"))
    for recreate, mode in ((False, "append"), (True, "overwrite")):
        sent.clear()
        sinks.write_jdbc_tables(tabs, "jdbc:x:y", {"user": "u"}, recreate=recreate)
        assert [(s[0], s[1], s[2], s[4]) for s in sent] == [("jdbc:x:y", name, mode, {"user": "u"}) for name in R.WRITE_ORDER]
        assert all(s[3] == tabs[s[1]].columns for s in sent) and set(R.WRITE_ORDER) == set(tabs)


def test_records_without_a_key_spread_in_the_override_join(spark):
    """Half of the keys null, a third of the rows one key: no partition gets most of the rows, and the fills are right."""
    records = V.records(spark, "/root/testdata/sf0.001").limit(900).withColumn("n", F.row_number().over(W.orderBy("_record_seq")))
    records = records.withColumn("EduOrgOGRN", F.when(F.col("n") % 6 < 3, None).when(F.col("n") % 6 < 5, "1").otherwise(F.col("n").cast("string"))).withColumn("EduOrgINN", F.lit(None).cast("string"))
    empty = F.lit(None)
    records = records.withColumn("ActualEducationOrganization", empty.cast(records.schema["ActualEducationOrganization"].dataType)).withColumn("_derived", empty.cast(records.schema["_derived"].dataType))
    overrides = spark.createDataFrame([("1", "77")], "ogrn string, inn string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        done = repair.override_inn_by_ogrn(records, overrides).select("n", "_derived.EduOrgINN", F.spark_partition_id().alias("part")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(done) == 900 and all((r.EduOrgINN == "77") == (r.n % 6 in (3, 4)) for r in done)
    without = [r.part for r in done if r.n % 6 < 3]
    assert max(without.count(p) for p in set(without)) < 0.5 * len(without)


def test_references_in_link_targets(spark):
    page = [(1, "http://h/", "<a href='/a&#38;b&#x2f;&#1103;&#128512;&#0;&#xD800;&amp;#39;.xml'>")]
    got = links.extract_links(spark.createDataFrame(page, "page_id long, url string, html string")).collect()
    assert [r.link for r in got] == ["http://h/a&b/я\U0001f600&#0;&#xD800;&#39;.xml"]
