"""Node and edge tables and the queries on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from certweave import schema as S
from certweave.functions.nested import settled
from certweave.operators import graph as G
from certweave.operators import graph_store as G_store
from certweave.operators import projection, repair, search_index
from certweave.plans import register_view as V
from certweave.plans.catalog.global_pass import ORACLES as PROJECTED
from certweave.plans.catalog.sqltext import blank, nb
from certweave.session import scratch_path


def _records(spark, sf):
    return V.records(spark, sf)


def nodes_certificate(spark, sf):
    return G.certificate_nodes(_records(spark, sf)).withColumnRenamed("_record_seq", "k")


def nodes_supplement(spark, sf):
    return G.supplement_nodes(_records(spark, sf)).withColumnRenamed("_record_seq", "k")


def nodes_program(spark, sf):
    return G.program_nodes(_records(spark, sf)).withColumnRenamed("_record_seq", "k")


def nodes_level(spark, sf):
    return G.level_nodes(_records(spark, sf))


def nodes_region(spark, sf):
    return G.region_nodes(_records(spark, sf))


def nodes_decision(spark, sf):
    return G.decision_nodes(_records(spark, sf)).withColumnRenamed("_record_seq", "k")


def nodes_org(spark, sf):
    return G.merge_nodes(G.organization_nodes(_records(spark, sf)), ["_record_seq", "pos"])


def merge_nodes(spark, sf):
    return G.merge_nodes(G.certificate_nodes(_records(spark, sf)), ["_record_seq"])


def _edges(predicate):
    def run(spark, sf):
        return G.edges(_records(spark, sf), [predicate])
    return run


def edges_counts(spark, sf):
    return G.edges(_records(spark, sf)).groupBy("predicate").agg(F.count(F.lit(1)).alias("n"))


def _certificate_nodes(spark, sf):
    """Certificate nodes with their search fields, record by record."""
    return settled(G.certificate_nodes(projection.with_graph(repair.mark_branches(_records(spark, sf)))))


def _search_nodes(spark, sf):
    """The nodes that are searched: one per uri."""
    return G.merge_nodes(_certificate_nodes(spark, sf), ["_record_seq"])


def graph_filter_fields(spark, sf):
    return _certificate_nodes(spark, sf).select(
        F.col("_record_seq").alias("k"), *[f for f in G.GRAPH_FIELDS if f != "g_edu_levels"], F.array_join("g_edu_levels", "|").alias("g_edu_levels"))


def search_certificates(spark, sf):
    hits = G.search_certificates(_search_nodes(spark, sf), q="школа", region="Республика NATION_1", limit=20)
    return hits.select("uri", "g_display_name")


def facet_region(spark, sf):
    return G.facet_options(_search_nodes(spark, sf), "region", level="Общее образование", control_organ="Минобр Брянской")


def facet_level(spark, sf):
    return G.facet_options(_search_nodes(spark, sf), "level", region="Республика NATION_1")


def facet_control_organ(spark, sf):
    return G.facet_options(_search_nodes(spark, sf), "control_organ", region="г. NATION_2")


def expand_node(spark, sf):
    """Every node with its neighbours, from stored node and edge tables."""
    records = V.stored_records(spark, sf)
    path = scratch_path(spark, "graph")
    G.labelled_nodes(records).write.parquet(f"{path}/nodes")
    G.edges(records).write.parquet(f"{path}/edges")
    return G.expand_nodes(spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges"))


def import_snapshots(spark, sf):
    """Two overlapping parts of the records imported one after the other, and the second once more: the tables of one import of all."""
    records = V.stored_records(spark, sf)
    path = scratch_path(spark, "store")
    early, late = records.where("_record_seq % 30000 < 20000"), records.where("_record_seq % 30000 >= 10000")
    for part in (early, late, late):
        G_store.import_snapshot(spark, path, part)
    tables = G_store.read_store(spark, path)
    out = None
    for name, table in tables.items():
        values = [c for c in table.columns if c not in ("uri", "predicate", "src", "dst")]
        key = F.concat_ws("|", "predicate", "src", "dst") if name == G_store.EDGES else F.col("uri")
        part = table.select(F.lit(name).alias("table_name"), key.alias("key"), F.concat_ws("|", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in sorted(values)]).alias("found"))
        out = part if out is None else out.unionByName(part)
    return out


# texts of 1 to 20 characters, some in the middle of a word, some in no name, one a whole number
SEARCHED = ["ш", "№ ", "«", "шко", "школа", "лицей", "ое бюджетн", "AUTOMOBILE", "university", "ниверситет", "государственный унив", "Customer#00000001", "zzz", "1026700630615", "10267006306", "а", "ц", "МБОУ «Школа № 7», филиал"]


def search_by_postings(spark, sf):
    path = scratch_path(spark, "search")
    search_index.build(_search_nodes(spark, sf), path)
    out = None
    for q in SEARCHED:
        hits = search_index.search(spark, path, q, limit=None).select(F.lit(q).alias("q"), "uri")
        out = hits if out is None else out.unionByName(hits)
    return out


def node_label(spark, sf):
    return G.labelled_nodes(_records(spark, sf))


def node_label_programs(spark, sf):
    return G.labelled_nodes(_records(spark, sf)).where("kind = 'EducationalProgram'")


def edges_without_node(spark, sf):
    """Ends of edges that are no node; there is none."""
    records = V.stored_records(spark, sf)
    ends = G.edges(records).select("predicate", F.explode(F.array("src", "dst")).alias("uri"))
    return ends.join(G.labelled_nodes(records).select("uri"), "uri", "left_anti").groupBy("predicate").agg(F.count(F.lit(1)).alias("n"))


def list_regions(spark, sf):
    return G.region_nodes(_records(spark, sf)).select("name").orderBy("name")


def list_levels(spark, sf):
    return G.level_nodes(_records(spark, sf)).select("name").orderBy("name")


def path_certificates_in_region(spark, sf):
    r = V.stored_records(spark, sf)
    return G.certificates_in_region(G.region_nodes(r), G.edges(r, ["inRegion"]), "Республика NATION_1")


def path_levels_offered(spark, sf):
    r = V.stored_records(spark, sf)
    cards = G.organization_nodes(r).where("INN is not null")
    return G.levels_offered_by(G.level_nodes(r), G.edges(r, ["offersEducationLevel"]), cards)


def path_supplements_by_inn(spark, sf):
    r = V.stored_records(spark, sf)
    cards = G.merge_nodes(G.organization_nodes(r), ["_record_seq", "pos"])
    return G.supplements_by_card_inn(cards, G.edges(r, ["hasActualEducationOrganization"]), F.col("INN").startswith("51"))


QUERIES = {f.__name__: f for f in (
    nodes_certificate, nodes_supplement, nodes_program, nodes_level, nodes_region, nodes_decision, nodes_org, merge_nodes, edges_counts,
    graph_filter_fields, search_certificates, facet_region, facet_level, facet_control_organ, expand_node, import_snapshots, search_by_postings, node_label, node_label_programs,
    edges_without_node, list_regions,
    list_levels, path_certificates_in_region, path_levels_offered, path_supplements_by_inn)}
QUERIES |= {f"edges_{p}": _edges(p) for p in G.PREDICATES}


def _cols(fields, leave=(), prefix="", table="") -> str:
    return ", ".join(f"{table}{prefix}{f} as {f}" for f in fields if f != "Id" and f not in leave)


def _merged(source: str, fields, order: str) -> str:
    return f"select uri, {', '.join(f'arg_max({f}, {order}) filter (where {f} is not null) as {f}' for f in fields)} from {source} group by uri"


_NS = G.NAMESPACE
_CF = [f for f in S.CERTIFICATE_FIELDS if f not in ("Id", "RegionName")]
_SF = [f for f in S.SUPPLEMENT_FIELDS if f != "Id"]
_PF = [f for f in S.PROGRAM_FIELDS if f not in ("Id", "EduLevelName")]
_OF = [f for f in S.ORGANIZATION_FIELDS if f not in ("Id", "RegionName")]
_DF = [f for f in S.DECISION_FIELDS if f != "Id"]
_VIEWS = V.oracle_views("cert", "sup", "prog", "dec") + f""",
cc as (select * from cert where not {blank('Id')}),
ss as (select s.*, c.Id as cid from sup s join cc c using (k) where s.Id is not null),
pp as (select p.*, s.cid, s.Id as sid, '{_NS}EducationalProgram:'||s.cid||':'||s.Id||':'||p.j||':'||coalesce(p.Id, '') as uri, {nb('p.EduLevelName')} as lv
  from prog p join ss s using (k, i)),
dd as (select d.*, c.Id as cid, '{_NS}Decision:'||c.Id||':'||trim(d.Id) as uri from dec d join cc c using (k) where not {blank('d.Id')}),
oo as (select k, i as pos, '{_NS}AEO:'||cid||':supplement:'||a_Id as uri, '{_NS}Supplement:'||cid||':'||Id as owner, a_RegionName as rn,
    {_cols(_OF, prefix='a_')} from ss where a_Id is not null
  union all select k, 99, '{_NS}AEO:'||Id||':certificate:'||r_Id, '{_NS}Certificate:'||Id, r_RegionName, {_cols(_OF, prefix='r_')} from cc where r_Id is not null),
nc as (select k, '{_NS}Certificate:'||Id as uri, {_cols(_CF)} from cc),
ns as (select k, i as pos, '{_NS}Supplement:'||cid||':'||Id as uri, {_cols(_SF)} from ss),
np as (select k, i as pos, uri, {_cols(_PF)} from pp),
nd as (select k, x as pos, uri, {_cols(_DF)} from dd),
lname as (select distinct lv as name from pp where lv is not null),
nl as (select '{_NS}EducationalLevel:'||sha256(name) as uri, name from lname),
rname as (select distinct trim(rn) as name from (select RegionName as rn from cc union all select rn from oo) where {nb('rn')} is not null),
nr as (select '{_NS}Region:'||sha256(name) as uri, name from rname),
ed as (
  select 'hasSupplement' as predicate, '{_NS}Certificate:'||cid as src, '{_NS}Supplement:'||cid||':'||Id as dst from ss
  union select 'hasDecision', '{_NS}Certificate:'||cid, uri from dd
  union select 'hasEducationalProgram', '{_NS}Supplement:'||cid||':'||sid, uri from pp
  union select 'hasEducationLevel', uri, '{_NS}EducationalLevel:'||sha256(lv) from pp where lv is not null
  union select 'offersEducationLevel', '{_NS}AEO:'||s.cid||':supplement:'||s.a_Id, '{_NS}EducationalLevel:'||sha256(lv) from pp p join ss s using (k, i) where lv is not null and s.a_Id is not null
  union select 'offersEducationLevel', '{_NS}AEO:'||c.Id||':certificate:'||c.r_Id, '{_NS}EducationalLevel:'||sha256(lv) from pp p join cc c using (k) where lv is not null and c.r_Id is not null
  union select 'inRegion', '{_NS}Certificate:'||Id, '{_NS}Region:'||sha256(trim(RegionName)) from cc where not {blank('RegionName')}
  union select 'inRegion', uri, '{_NS}Region:'||sha256(trim(rn)) from oo where not {blank('rn')}
  union select 'hasActualEducationOrganization', owner, uri from oo),
mc as ({_merged('nc', _CF, 'k')}), ms as ({_merged('ns', _SF, 'k * 100 + pos')}), mp as ({_merged('np', _PF, 'k * 100 + pos')}),
md as ({_merged('nd', _DF, 'k * 100 + pos')}), mo as ({_merged('oo', _OF, 'k * 100 + pos')}),
labels as (
  select 'Certificate' as kind, uri, coalesce(nullif(EduOrgShortName, ''), nullif(EduOrgFullName, ''), uri) as label from mc
  union all select 'Supplement', uri, coalesce(nullif(Number, ''), uri) from ms
  union all select 'EducationalProgram', uri, coalesce(nullif(trim(coalesce(ProgrammCode, '')||' '||coalesce(ProgrammName, '')), ''), uri) from mp
  union all select 'EducationalLevel', uri, name from nl union all select 'Region', uri, name from nr
  union all select 'ActualEducationOrganization', uri, coalesce(nullif(ShortName, ''), nullif(FullName, ''), uri) from mo
  union all select 'Decision', uri, coalesce(nullif(DecisionTypeName, ''), uri) from md)
"""
_PROJ = PROJECTED["graph_projection"]
_HEAD = PROJECTED["head_projection"]
_SEARCH = f"""with g as ({_PROJ}), h as ({_HEAD}), cc0 as ({V.oracle_views('cert')} select * from cert),
n as (select '{_NS}Certificate:'||c.Id as uri, c.k, c.EduOrgFullName, c.EduOrgOGRN, c.EduOrgINN, g.region as g_region, g.region_short as g_region_short,
 g.control_organ as g_control_organ, g.control_organ_short as g_control_organ_short, g.display_name as g_display_name, g.founder_key as g_founder_key,
 g.founder_label as g_founder_label, nullif(h.levels, '') as g_edu_levels from cc0 c join g using (k) join h using (k) where not {blank('c.Id')})
"""
_FOUND = _SEARCH + ", m as (" + _merged("n", ["EduOrgFullName", "EduOrgOGRN", "EduOrgINN", *G.GRAPH_FIELDS], "k") + ") "
_LABELS = "case predicate " + " ".join(f"when '{k}' then '{v}'" for k, v in G.EDGE_LABELS.items()) + " end"


_RELATIONS = ", ".join(f"('{kind}', '{p}', '{to}')" for to, topology in (("out", G.OUTGOING), ("in", G.INCOMING)) for kind, ps in topology.items() for p in ps)
_ONCE = _VIEWS.replace("\ned as (", "\ned as materialized (").replace("\nlabels as (", "\nlabels as materialized (")


def _stored(name: str, source: str, fields) -> str:
    text = ", ".join(f"'{f}='||cast({f} as varchar)" for f in sorted(fields))
    return f"select '{name}' as table_name, uri as key, concat_ws('|', {text}) as found from {source}"


ORACLES = {
    "nodes_certificate": _VIEWS + "select * from nc",
    "nodes_supplement": _VIEWS + "select * from ns",
    "nodes_program": _VIEWS + "select * from np",
    "nodes_level": _VIEWS + "select * from nl",
    "nodes_region": _VIEWS + "select * from nr",
    "nodes_decision": _VIEWS + "select * from nd",
    "nodes_org": _VIEWS + "select * from mo",
    "merge_nodes": _VIEWS + "select * from mc",
    "edges_counts": _VIEWS + "select predicate, count(*) as n from ed group by 1",
    "graph_filter_fields": _SEARCH + "select k, " + ", ".join(G.GRAPH_FIELDS) + " from n",
    "search_certificates": _FOUND + """select uri, g_display_name from m where (lower(coalesce(EduOrgFullName, '')) like '%школа%'
        or lower(coalesce(g_display_name, '')) like '%школа%' or EduOrgOGRN = 'школа' or EduOrgINN = 'школа') and g_region = 'Республика NATION_1' order by uri limit 20""",
    "facet_region": _FOUND + "select distinct g_region as option from m where list_contains(string_split(g_edu_levels, '|'), 'Общее образование') and g_control_organ_short = 'Минобр Брянской'",
    "facet_level": _FOUND + "select distinct option from (select unnest(string_split(g_edu_levels, '|')) as option from m where g_region = 'Республика NATION_1') where option <> ''",
    "facet_control_organ": _FOUND + "select distinct g_control_organ_short as option from m where g_region = 'г. NATION_2' and g_control_organ_short is not null",
    "expand_node": _ONCE + f""", relations(kind, predicate, direction) as (values {_RELATIONS}),
        a as materialized (select l.uri, r.predicate, r.direction from labels l join relations r using (kind)),
        x as (select a.uri, 'out' as direction, e.predicate, e.dst as neighbor from ed e join a on a.direction = 'out' and a.predicate = e.predicate and a.uri = e.src
          union all select a.uri, 'in', e.predicate, e.src from ed e join a on a.direction = 'in' and a.predicate = e.predicate and a.uri = e.dst)
        select x.uri, direction, predicate, {_LABELS} as edge_label, neighbor, l.kind, l.label from x join labels l on l.uri = x.neighbor
        union all select uri, 'self', null, null, uri, kind, label from labels""",
    "import_snapshots": _VIEWS + " union all ".join([
        _stored("Certificate", "mc", _CF), _stored("Supplement", "ms", _SF), _stored("EducationalProgram", "mp", _PF), _stored("Decision", "md", _DF),
        _stored("ActualEducationOrganization", "mo", _OF), _stored("EducationalLevel", "nl", ["name"]), _stored("Region", "nr", ["name"]),
        "select 'edges', predicate||'|'||src||'|'||dst, '' from ed"]),
    "search_by_postings": _FOUND + f""", wanted as (select unnest([{', '.join(f"'{q}'" for q in SEARCHED)}]) as q)
        select q, uri from wanted join m on contains(lower(coalesce(EduOrgFullName, '')), lower(trim(q))) or contains(lower(coalesce(g_display_name, '')), lower(trim(q))) or EduOrgOGRN = trim(q) or EduOrgINN = trim(q)""",
    "node_label_programs": _VIEWS + "select * from labels where kind = 'EducationalProgram'",
    "edges_without_node": _VIEWS + "select predicate, count(*) as n from (select predicate, src as uri from ed union all select predicate, dst from ed) where uri not in (select uri from labels) group by 1",
    "node_label": _VIEWS + "select * from labels",
    "list_regions": _VIEWS + "select name from nr",
    "list_levels": _VIEWS + "select name from nl",
    "path_certificates_in_region": _VIEWS + f"select distinct '{_NS}Certificate:'||Id as uri from cc where trim(RegionName) = 'Республика NATION_1'",
    "path_levels_offered": _VIEWS + "select e.src as uri, nl.name as level from ed e join nl on nl.uri = e.dst where predicate = 'offersEducationLevel' and e.src in (select uri from oo where INN is not null)",
    "path_supplements_by_inn": _VIEWS + f"select e.src as uri, mo.INN as inn from ed e join mo on mo.uri = e.dst where predicate = 'hasActualEducationOrganization' and e.src like '{_NS}Supplement:%' and mo.INN like '51%'",
}
ORACLES |= {f"edges_{p}": _VIEWS + f"select * from ed where predicate = '{p}'" for p in G.PREDICATES}
