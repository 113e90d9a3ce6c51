"""Scans, sinks and look-up tables. Written files go to a fresh path in the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from certweave import schema as S
from certweave.operators import audit, clean, filters, relational, repair
from certweave.plans import register_view as V
from certweave.plans.catalog.audits import ORACLES as _AUDITED
from certweave.plans.catalog.jsonsql import as_is, cleaned, record_json
from certweave.plans.catalog.repairs import seq
from certweave.plans.catalog.sqltext import blank
from certweave.plans.catalog.tables import GOOD, TABLES
from certweave.session import scratch_path
from certweave.sources import dims, links, readers, sinks


def _xml_text(records):
    """Records as XML, one element a line, with all fields of every level; nulls are empty elements, absent cards and lists have none."""
    def escaped(c):
        for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            c = F.replace(c, F.lit(char), F.lit(name))
        return F.coalesce(c, F.lit(""))

    tag = lambda name, inner: F.concat(F.lit(f"<{name}>"), inner, F.lit(f"</{name}>"))
    cells = lambda names, of: [tag(n, escaped(of(n).cast("string"))) for n in names]
    card = lambda c: F.when(c.isNotNull(), tag(S.ORGANIZATION, F.concat(*cells(S.ORGANIZATION_FIELDS, lambda n: c[n])))).otherwise("")
    each = lambda wrapper, items, build: F.when(F.size(items) > 0, tag(wrapper, F.array_join(F.transform(items, lambda x: tag(S.WRAPPERS[wrapper], build(x))), ""))).otherwise("")
    programme = lambda p: F.concat(*cells(S.PROGRAM_FIELDS, lambda n: p[n]))
    sup = lambda s: F.concat(*cells(S.SUPPLEMENT_FIELDS, lambda n: s[n]), card(s[S.ORGANIZATION]), each("EducationalPrograms", s["EducationalPrograms"], programme))
    decision = lambda d: F.concat(*cells(S.DECISION_FIELDS, lambda n: d[n]))
    return records.select(tag(readers.ELEMENT, F.concat(
        *cells(S.CERTIFICATE_FIELDS, F.col), card(F.col(S.ORGANIZATION)), each("Supplements", F.col("Supplements"), sup), each("Decisions", F.col("Decisions"), decision))).alias("value"))


def scan_xml(spark, sf):
    """Whole records through XML: written with every field, read, cleaned; the JSON text of what comes back."""
    path = scratch_path(spark, "xml")
    sinks.packed_text(_xml_text(V.records(spark, sf)).write).text(path)
    raw = readers.read_xml(spark, path)
    stored = scratch_path(spark, "read")
    clean.clean_records(raw).write.option("compression", "zstd").parquet(stored)
    return sinks.json_lines(spark.read.parquet(stored).select(*[f.name for f in S.record_type().fields])).select("value")


def scan_order(spark, sf):
    """Lines written to files in the order of k, and the places that a scan gives them."""
    path = scratch_path(spark, "ordered")
    rows = V.order_rows(spark, sf).select("k", F.expr(f"case when k % 3 = 0 then 'é' || k else {_LINE} end").alias("value"))
    rows.repartitionByRange("k").sortWithinPartitions("k").select("value").write.text(path)
    return readers.read_lines(spark, path).select("value", F.col("_record_seq").alias("position"))


_LINE = ("case k % 7 when 0 then '' when 1 then '  ' when 2 then '{\"Id\":' when 3 then '[1]' when 4 then 'null' "
         "else '{\"Id\":\"c' || k || '\",\"IsFederal\":true,\"RegNumber\":\"' || seg || '\"}' end")


def scan_jsonl(spark, sf):
    path = scratch_path(spark, "jsonl")
    V.order_rows(spark, sf).select(F.expr(_LINE).alias("value")).write.text(path)
    return readers.read_records(spark, path).select("Id", "IsFederal", "RegNumber", F.size("Supplements").alias("supplements"))


def line_kinds(spark, sf):
    lines = V.order_rows(spark, sf).select(F.expr(_LINE).alias("value"))
    return lines.groupBy(readers.line_kind(F.col("value")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def _lines(spark, sf):
    return V.order_rows(spark, sf).select(F.lit("f").alias("_source_file"), F.col("k").alias("_record_seq"), F.expr(_LINE).alias("value"))


def limit_input(spark, sf):
    return readers.limit_lines(_lines(spark, sf), 50).select(seq(), "value")


def limit_parsed(spark, sf):
    return readers.limit_parsed(_lines(spark, sf), 50).select(seq(), "value")


def merge_inputs(spark, sf):
    """Separate outputs, one folder per source file, read back together."""
    path = scratch_path(spark, "separate")
    df = V.records(spark, sf).where(filters.disposition() == filters.WRITTEN)
    sinks.write_records(df, path, merged=False, packed=True)
    back = spark.read.text(path)
    return back.groupBy("_source_file").agg(F.count(F.lit(1)).alias("n"), F.count(F.get_json_object("value", "$.EduOrgINN")).alias("with_inn"))


def load_override_dim(spark, sf):
    """Overrides from JSON documents, one per customer segment."""
    customer = spark.read.parquet(f"{sf}/customer.parquet")
    text = "'{\"_note\":\"1\",\"10277 ' || c_custkey || '\":\"77-' || c_custkey || '\",\"x' || c_custkey || '\":\"1\",\"20277' || c_custkey || '\":\"y\"}'"
    return dims.parse_overrides(customer.select(F.expr(text).alias("value")))


_LEVELS_JSON = ("'{{\"canonical_edu_level_names_fz273\":[\"A\",\"' || c_mktsegment || '\"],\"entries\":[{{\"source_registry_level_name\":\"L' || c_custkey || '\",\"target_edu_level_name\":' || "
                "case c_custkey % 4 when 0 then 'null' when 1 then '\" \"' when 2 then '7' else '\" T' || c_nationkey || ' \"' end || '}},"
                "{{\"source_registry_level_name\":\"L' || c_custkey || '\",\"target_edu_level_name\":\"second\"}},{{\"source_registry_level_name\":\" \",\"target_edu_level_name\":\"x\"}}]}}'").replace("{{", "{").replace("}}", "}")


def load_level_dim(spark, sf):
    customer = spark.read.parquet(f"{sf}/customer.parquet")
    return dims.parse_levels(customer.select(F.expr(_LEVELS_JSON).alias("value")))


def extract_links(spark, sf):
    """Pages whose links to words with a t end as snapshot files do, some with a query behind; only those are links here."""
    html = F.regexp_replace("html", '(<a href="[^"?#]*t)"', '$1.xml"')
    html = F.regexp_replace(html, '(<a href="[^"?#]*a[^"?#]*t\\.xml)"', '$1?v=1&amp;w=2"')
    return links.extract_links(spark.read.parquet(f"{sf}/pages.parquet").withColumn("html", html))


def _names(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return orders.select(F.concat(F.lit("http://host/opendata/"), F.when(F.col("o_orderkey") % 5 == 0, "other-").otherwise("data-"),
                                  F.date_format("o_orderdate", "yyyyMMdd"), F.lit("-structure-"), F.col("o_orderkey"), F.lit(".xml?v=1")).alias("url"))


def latest_snapshot(spark, sf):
    return links.latest_snapshot(_names(spark, sf))


def write_parquet_tables(spark, sf):
    path = scratch_path(spark, "tables")
    sinks.write_parquet_tables(relational.tables(V.records(spark, sf)), path)
    out = None
    for name in relational.WRITE_ORDER:
        part = spark.read.parquet(f"{path}/{name}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def _loadable_tables(spark, sf):
    path = scratch_path(spark, "loadable")
    relational.loadable_records(V.stored_records(spark, sf)).write.parquet(path)
    return relational.tables(spark.read.parquet(path))


def write_jdbc_tables(spark, sf):
    """What a relational sink receives: all columns of all tables of the records that load, with the sink's integer booleans."""
    out = None
    for name, table in _loadable_tables(spark, sf).items():
        cell = lambda f: relational.adapt_scalar(F.col(f.name), f.dataType.simpleString(), "BOOLEAN" if f.dataType.simpleString() == "boolean" else "TEXT", integer_booleans=True)
        cells = [F.concat(F.lit(f"{f.name}="), cell(f).cast("string")) for f in sorted(table.schema.fields, key=lambda f: f.name)]
        part = table.select(F.lit(name).alias("table_name"), F.concat_ws("|", *cells).alias("cells"))
        out = part if out is None else out.unionByName(part)
    return out


def load_records(spark, sf):
    """Records loaded one transaction each into a store that refuses some programmes: what became of every record."""
    class Store:
        def begin(self):
            self.rows = []

        def insert(self, table, row):
            if table == "educational_programs" and row["program_slot"] == 2 and row["program_id"] == "p3":
                raise ValueError("refused")
            self.rows.append((table, row))

        def commit(self):
            self.rows = []

        rollback = close = commit

    return sinks.load_records(_loadable_tables(spark, sf), Store)


def split_by_class(spark, sf):
    path = scratch_path(spark, "classes")
    sinks.write_by_class(audit.classify_certificates(V.records(spark, sf)).select("Id", "_record_seq", "certificate_class"), "certificate_class", path)
    return spark.read.parquet(path).groupBy("certificate_class").agg(F.count(F.lit(1)).alias("n"))


def skip_broken(spark, sf):
    """Readable and unreadable elements of an XML text in which some elements are damaged."""
    path = scratch_path(spark, "broken")
    V.order_rows(spark, sf).select(F.expr(
        "case when k % 10 = 3 then '<Certificate><Id>c' || k || '</Wrong></Certificate>' else '<Certificate><Id>c' || k || '</Id></Certificate>' end").alias("value")).write.text(path)
    rows = readers.read_xml(spark, path)
    return rows.groupBy(F.col("_corrupt_record").isNotNull().alias("broken")).agg(F.count(F.lit(1)).alias("n"))


def omit_empty(spark, sf):
    """Compact JSON of records with branch marks: every member that is left, at any depth."""
    return sinks.json_lines(repair.mark_branches(V.records(spark, sf))).select(seq(), "value")


QUERIES = {f.__name__: f for f in (
    scan_xml, scan_order, scan_jsonl, line_kinds, limit_input, limit_parsed, merge_inputs, load_override_dim, load_level_dim, extract_links,
    latest_snapshot, write_parquet_tables, write_jdbc_tables, load_records, split_by_class, skip_broken, omit_empty)}

_VIEWS = V.oracle_views("cert", "sup", "prog", "dec")
_LOADED = _VIEWS + GOOD + ", certg as (select cert.* from cert join good using (k) where rn = 1)" + TABLES.replace("from cert", "from certg").replace("join cert c", "join certg c")
TABLE_VIEWS = {"certificates": "t1", "supplements": "t2", "decisions": "t3", "educational_programs": "t4", "actual_education_organizations": "t5"}


def _cells(name: str, view: str) -> str:
    """Every cell of a table's view as text, in the order of the column names."""
    keys = {"t1": ["certificate_id"], "t2": ["certificate_id", "supplement_id"], "t3": ["certificate_id", "decision_id"], "t4": ["certificate_id", "supplement_id", "program_slot", "program_id"],
            "t5": ["certificate_id", "ae_scope", "supplement_id", "aeo_id"]}[view]
    fields = {"t1": S.CERTIFICATE_FIELDS, "t2": S.SUPPLEMENT_FIELDS, "t3": S.DECISION_FIELDS, "t4": S.PROGRAM_FIELDS, "t5": S.ORGANIZATION_FIELDS}[view]
    columns = {k: k for k in keys} | {relational.column_name(f): f"cast({relational.column_name(f)} as integer)" if f in S.BOOL_FIELDS else relational.column_name(f) for f in fields if f != "Id"}
    cells = ", ".join(f"'{c}='||cast({columns[c]} as varchar)" for c in sorted(columns))
    return f"select '{name}' as table_name, concat_ws('|', {cells}) as cells from {view}"


ORACLES = {
    "scan_xml": _VIEWS + record_json(cleaned) + " select value from whole",
    "scan_order": V.oracle_views() + f""", lines as (select k, case when k % 3 = 0 then 'é' || k else {_LINE} end as value from base)
        select value, cast(coalesce(sum(strlen(value) + 1) over (order by k rows between unbounded preceding and 1 preceding), 0) as bigint) as position from lines""",
    "scan_jsonl": V.oracle_views() + " select 'c'||k as Id, true as IsFederal, seg as RegNumber, cast(0 as integer) as supplements from base where k % 7 > 4",
    "line_kinds": V.oracle_views() + " select case when k % 7 < 2 then 'blank' when k % 7 = 2 then 'bad_json' when k % 7 < 5 then 'not_object' else 'object' end as kind, count(*) as n from base group by 1",
    "limit_input": V.oracle_views() + f" select k, {_LINE} as value from base where k % 7 > 1 order by k limit 50",
    "limit_parsed": V.oracle_views() + f" select k, {_LINE} as value from base where k % 7 > 2 order by k limit 50",
    "merge_inputs": _VIEWS + f"""select source_file as _source_file, count(*) as n, count(*) filter (where not {blank('EduOrgINN')}) as with_inn from cert
        where not coalesce(StatusName in ('Недействующее', 'Прекращено', 'Лишен аккредитации'), false) and RegionName <> 'образовательные учреждения, находящиеся за пределами Российской Федерации' group by 1""",
    "load_override_dim": "select '10277'||c_custkey as ogrn, '77'||c_custkey as inn from customer",
    "load_level_dim": """select 'L'||c_custkey as level, case when c_custkey % 4 = 2 then 'second' when c_custkey % 4 = 3 then 'T'||c_nationkey end as target,
        case when c_custkey % 4 < 2 then 'clear' else 'rename' end as role from customer union all select 'A', 'A', 'canonical' union all select distinct c_mktsegment, c_mktsegment, 'canonical' from customer""",
    "extract_links": """with pages as (select page_id, url, regexp_replace(regexp_replace(html, '(<a href="[^"?#]*t)"', '\\1.xml"', 'g'), '(<a href="[^"?#]*a[^"?#]*t\\.xml)"', '\\1?v=1&amp;w=2"', 'g') as html from pages),
        g as (select page_id, url, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"', 1)) as u, generate_subscripts(regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"', 1), 1) as n from pages),
        h as (select page_id, url, replace(u, '&amp;', '&') as u, n from g where lower(u) like '%.xml' or lower(u) like '%.xml?%'),
        f as (select page_id, n, case when u like '/%' then regexp_extract(url, '^[a-z]+://[^/?#]*')||trim(u) else trim(u) end as link from h),
        d as (select page_id, link, min(n) as o from f group by all)
        select page_id, cast(row_number() over (partition by page_id order by o) - 1 as integer) as pos, link from d""",
    "latest_snapshot": """with t as (select 'http://host/opendata/'||case when o_orderkey % 5 = 0 then 'other-' else 'data-' end||strftime(o_orderdate, '%Y%m%d')||'-structure-'||o_orderkey||'.xml?v=1' as url,
        case when o_orderkey % 5 > 0 then strftime(o_orderdate, '%Y%m%d') end as snapshot_date from orders) select * from t where snapshot_date = (select max(snapshot_date) from t)""",
    "write_parquet_tables": _VIEWS + f"""select 'certificates' as table_name, count(*) as n from cert union all select 'supplements', count(*) from sup union all select 'decisions', count(*) from dec where not {blank('Id')}
        union all select 'educational_programs', count(*) from prog union all select 'actual_education_organizations', (select count(*) from cert where Id is not null and r_Id is not null)
        + (select count(*) from sup s join cert c using (k) where c.Id is not null and s.Id is not null and s.a_Id is not null)""",
    "write_jdbc_tables": _LOADED + " union all ".join(_cells(name, t) for name, t in TABLE_VIEWS.items()),
    "load_records": _LOADED + """, n as (select certificate_id, sum(n) as n from (""" + " union all ".join(f"select certificate_id, count(*) as n from {t} group by 1" for t in TABLE_VIEWS.values()) + """) group by 1),
        refused as (select distinct certificate_id from t4 where program_slot = 2 and program_id = 'p3')
        select n.certificate_id, cast(case when r.certificate_id is null then n else 0 end as bigint) as rows, case when r.certificate_id is not null then 'educational_programs: refused' end as error
        from n left join refused r using (certificate_id)""",
    "skip_broken": V.oracle_views() + " select k % 10 = 3 as broken, count(*) as n from base group by 1",
    "omit_empty": _VIEWS + """, marked as (select s.*, coalesce(s.IsForBranch, false) or (c.r_Id is not null and s.has_card and s.a_Id is distinct from c.r_Id) as is_branch from sup s join cert c using (k))"""
        + record_json(as_is, branches=True) + " select k, value from whole",
}
ORACLES["split_by_class"] = f"select certificate_class, count(*) as n from ({_AUDITED['classify_certificates']}) t group by 1"
