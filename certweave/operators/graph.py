"""Property graph tables (nodes, edges) and the queries on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certweave import schema as S
from certweave.functions import nested as N
from certweave.functions import text as X
from certweave.session import scratch_path

HUB_BLOCK = 50_000  # edges of a hub that are dealt out together
MOST_HUBS = 100_000  # of them are sent to every task, some 10 MB
NAMESPACE = "urn:accred:v1:"

# Node kinds with the relations a viewer follows from / to them, and label texts.
OUTGOING = {
    "Certificate": ["hasSupplement", "hasDecision", "inRegion", "hasActualEducationOrganization"],
    "Supplement": ["hasEducationalProgram", "hasActualEducationOrganization"],
    "EducationalProgram": ["hasEducationLevel"],
    "ActualEducationOrganization": ["inRegion", "offersEducationLevel"],
    "EducationalLevel": [],
    "Region": [],
    "Decision": [],
}
INCOMING = {
    "Certificate": [],
    "Supplement": ["hasSupplement"],
    "EducationalProgram": ["hasEducationalProgram"],
    "EducationalLevel": ["hasEducationLevel", "offersEducationLevel"],
    "Region": ["inRegion"],
    "ActualEducationOrganization": ["hasActualEducationOrganization"],
    "Decision": ["hasDecision"],
}
EDGE_LABELS = {
    "hasSupplement": "приложение",
    "hasDecision": "решение",
    "inRegion": "регион",
    "hasActualEducationOrganization": "ОО",
    "hasEducationalProgram": "программа",
    "hasEducationLevel": "уровень",
    "offersEducationLevel": "предлагает",
}
PREDICATES = list(EDGE_LABELS)
GRAPH_FIELDS = [
    "g_region", "g_region_short", "g_control_organ", "g_control_organ_short", "g_edu_levels",
    "g_display_name", "g_founder_key", "g_founder_label",
]


def _uri(kind: str, *parts: Column) -> Column:
    text = F.lit(NAMESPACE + kind)
    for p in parts:
        text = F.concat(text, F.lit(":"), p)
    return text


def _named_uri(kind: str, name: Column) -> Column:
    """Uri of a node that is its own name: a digest of the stripped text, null for a blank one."""
    return F.concat(F.lit(NAMESPACE + kind + ":"), F.sha2(X.nonblank(name), 256))


def _identified(records: DataFrame) -> DataFrame:
    return records.where(~X.is_blank(F.col("Id"))).withColumn("_cid", X.strip(F.col("Id")))


def _props(obj: Column | None, names: list[str], leave_out: list[str]) -> list[Column]:
    return [(F.col(n) if obj is None else obj[n]).alias(n) for n in names if n not in leave_out and n != "Id"]


def _sup_rows(records: DataFrame, *keep: str) -> DataFrame:
    """Supplements with an id: (cid, seq, pos, s)."""
    return _identified(records).select(
        "_cid", "_record_seq", *keep, F.inline(N.placed(N.supplements())).alias("pos", "s")).where("s.Id is not null")


def graph_fields() -> list[Column]:
    """Search fields of a certificate node, taken from the record's projection."""
    g = F.col("_graph")
    sources = {
        "g_region": g["region"], "g_region_short": g["region_short"],
        "g_control_organ": g["control_organ"], "g_control_organ_short": g["control_organ_short"],
        "g_edu_levels": F.when(F.size(g["edu_levels"]) > 0, g["edu_levels"]),
        "g_display_name": g["org"]["display_name"],
        "g_founder_key": g["org"]["founder_key"], "g_founder_label": g["org"]["founder_label"],
    }
    return [sources[n].alias(n) for n in GRAPH_FIELDS]


def certificate_nodes(records: DataFrame) -> DataFrame:
    extra = graph_fields() if "_graph" in records.columns else []
    return _identified(records).select(
        _uri("Certificate", F.col("_cid")).alias("uri"), "_record_seq", *_props(None, S.CERTIFICATE_FIELDS, ["RegionName"]), *extra)


def supplement_nodes(records: DataFrame) -> DataFrame:
    s = F.col("s")
    return _sup_rows(records).select(
        _uri("Supplement", F.col("_cid"), s["Id"]).alias("uri"), "_record_seq", "pos", *_props(s, S.SUPPLEMENT_FIELDS, []))


def _program_uri(sup_id: Column, slot: Column, p: Column) -> Column:
    return _uri("EducationalProgram", F.col("_cid"), sup_id, slot.cast("string"), F.coalesce(p["Id"], F.lit("")))


def _program_rows(records: DataFrame) -> DataFrame:
    p = F.col("p")
    return _sup_rows(records).select(
        "_cid", "_record_seq", "pos", F.col("s.Id").alias("_sid"), F.inline(N.placed(N.programs_of(F.col("s")))).alias("slot", "p")
    ).withColumn("uri", _program_uri(F.col("_sid"), F.col("slot"), p))


def program_nodes(records: DataFrame) -> DataFrame:
    return _program_rows(records).select("uri", "_record_seq", "pos", *_props(F.col("p"), S.PROGRAM_FIELDS, ["EduLevelName"]))


def _level_of(p: Column) -> Column:
    return X.nonblank(p["EduLevelName"])


def level_nodes(records: DataFrame) -> DataFrame:
    """One node per distinct level name; partial de-duplication makes hot names harmless."""
    return (
        _program_rows(records).select(_level_of(F.col("p")).alias("name")).where("name is not null").distinct()
        .select(_named_uri("EducationalLevel", F.col("name")).alias("uri"), "name")
    )


def _region_names(records: DataFrame) -> DataFrame:
    with_id = lambda c: F.when(c["Id"].isNotNull(), c["RegionName"])
    sups = F.transform(F.filter(N.supplements(), lambda s: s["Id"].isNotNull()), lambda s: with_id(s[N.ROOT]))
    names = F.concat(F.array(F.col("RegionName"), with_id(F.col(N.ROOT))), sups)
    return _identified(records).select(F.explode(F.array_distinct(F.transform(names, X.nonblank))).alias("name")).where("name is not null")


def region_nodes(records: DataFrame) -> DataFrame:
    return _region_names(records).distinct().select(_named_uri("Region", F.col("name")).alias("uri"), "name")


def _decision_rows(records: DataFrame) -> DataFrame:
    rows = _identified(records).select("_cid", "_record_seq", F.inline(N.placed(F.col("Decisions"))).alias("pos", "d"))
    return rows.where(~X.is_blank(F.col("d.Id"))).withColumn(
        "uri", _uri("Decision", F.col("_cid"), X.strip(F.col("d.Id"))))


def decision_nodes(records: DataFrame) -> DataFrame:
    return _decision_rows(records).select("uri", "_record_seq", "pos", *_props(F.col("d"), S.DECISION_FIELDS, []))


def _card_rows(records: DataFrame) -> DataFrame:
    """Every card with an id: (cid, seq, pos, scope, owner uri, card, levels in its context)."""
    level_names = lambda ps: F.array_distinct(F.filter(F.transform(ps, _level_of), lambda x: x.isNotNull()))
    keyed = F.filter(N.supplements(), lambda s: s["Id"].isNotNull())
    # the root card comes last, as it is written last
    cards = F.concat(
        F.transform(keyed, lambda s, i: F.struct(
            i.alias("pos"), F.lit("supplement").alias("scope"), _uri("Supplement", F.col("_cid"), s["Id"]).alias("owner"),
            s[N.ROOT].alias("a"), level_names(N.programs_of(s)).alias("levels"))),
        F.array(F.struct(
            F.size(keyed).alias("pos"), F.lit("certificate").alias("scope"), _uri("Certificate", F.col("_cid")).alias("owner"),
            F.col(N.ROOT).alias("a"), level_names(F.flatten(F.transform(keyed, N.programs_of))).alias("levels"))),
    )
    wanted = F.filter(cards, lambda c: c["a"]["Id"].isNotNull())
    return _identified(records).select("_cid", "_record_seq", F.explode(wanted).alias("x")).select(
        "_record_seq", "x.pos", "x.owner", "x.a", "x.levels",
        _uri("AEO", F.col("_cid"), F.col("x.scope"), F.col("x.a.Id")).alias("uri"))


def organization_nodes(records: DataFrame) -> DataFrame:
    """Cards of supplements with the same card id share a node; merge with :func:`merge_nodes`."""
    return _card_rows(records).select("uri", "_record_seq", "pos", *_props(F.col("a"), S.ORGANIZATION_FIELDS, ["RegionName"]))


def merge_nodes(nodes: DataFrame, order: list[str]) -> DataFrame:
    """One row per uri: of every property the latest non-null value in ``order``.

    ``max_by`` keeps one candidate per property and task, so a uri that is
    repeated very often costs no more than any other.
    """
    props = [c for c in nodes.columns if c not in ("uri", *order)]
    if not props:
        return nodes.select("uri").distinct()
    when = F.struct(*order)
    return nodes.groupBy("uri").agg(*[F.max_by(F.col(p), F.when(F.col(p).isNotNull(), when)).alias(p) for p in props])


def _edge(predicate: str, src: Column, dst: Column) -> Column:
    return F.struct(F.lit(predicate).alias("predicate"), src.alias("src"), dst.alias("dst"))


def _record_edges() -> Column:
    """All edges of a record as one array; targets of blank names are null."""
    cert = _uri("Certificate", F.col("_cid"))
    level_uri = lambda name: _named_uri("EducationalLevel", name)
    distinct_levels = lambda ps: F.array_distinct(F.filter(F.transform(ps, _level_of), lambda x: x.isNotNull()))

    def of_card(owner: Column, scope: str, card: Column, programs: Column) -> Column:
        uri = _uri("AEO", F.col("_cid"), F.lit(scope), card["Id"])
        edges_of = F.concat(
            F.array(_edge("hasActualEducationOrganization", owner, uri), _edge("inRegion", uri, _named_uri("Region", card["RegionName"]))),
            F.transform(distinct_levels(programs), lambda x: _edge("offersEducationLevel", uri, level_uri(x))))
        return F.when(card["Id"].isNotNull(), edges_of).otherwise(F.array().cast(edge_array))

    def of_program(sup_uri: Column, s: Column, p: Column, slot: Column) -> Column:
        uri = _program_uri(s["Id"], slot, p)
        return F.array(_edge("hasEducationalProgram", sup_uri, uri), _edge("hasEducationLevel", uri, level_uri(p["EduLevelName"])))

    def of_supplement(s: Column) -> Column:
        uri = _uri("Supplement", F.col("_cid"), s["Id"])
        programs = N.programs_of(s)
        return F.concat(
            F.array(_edge("hasSupplement", cert, uri)),
            F.flatten(F.transform(N.placed(programs), lambda x: of_program(uri, s, x["item"], x["place"]))),
            of_card(uri, "supplement", s[N.ROOT], programs))

    edge_array = "array<struct<predicate:string,src:string,dst:string>>"
    keyed = F.filter(N.supplements(), lambda s: s["Id"].isNotNull())
    named = F.filter(F.coalesce(F.col("Decisions"), F.array().cast(S.record_type()["Decisions"].dataType)), lambda d: ~X.is_blank(d["Id"]))
    return F.concat(
        F.flatten(F.transform(keyed, of_supplement)),
        F.transform(named, lambda d: _edge("hasDecision", cert, _uri("Decision", F.col("_cid"), X.strip(d["Id"])))),
        of_card(cert, "certificate", F.col(N.ROOT), F.flatten(F.transform(keyed, N.programs_of))),
        F.array(_edge("inRegion", cert, _named_uri("Region", F.col("RegionName")))))


def edges(records: DataFrame, predicates: list[str] | None = None) -> DataFrame:
    """Distinct (predicate, src, dst): one pass over the records, one shuffle of the edges."""
    return edge_rows(records, predicates).distinct()


def edge_rows(records: DataFrame, predicates: list[str] | None = None) -> DataFrame:
    """The edges (predicate, src, dst) record by record; narrow, an edge may come several times."""
    chosen = PREDICATES if predicates is None else predicates
    wanted = F.filter(_record_edges(), lambda e: e["dst"].isNotNull() & e["predicate"].isin(chosen))
    return _identified(records).select(F.explode(wanted).alias("e")).select("e.*")


def label_texts(kind: str, obj: dict[str, Column]) -> list[Column]:
    """The up to three texts a node of a kind can be labelled with, best first."""
    names = {
        "Certificate": ["g_display_name", "EduOrgShortName", "EduOrgFullName"],
        "Supplement": ["Number"],
        "EducationalProgram": ["ProgrammCode", "ProgrammName"],
        "EducationalLevel": ["name"],
        "Region": ["name"],
        "ActualEducationOrganization": ["ShortName", "FullName"],
        "Decision": ["DecisionTypeName"],
    }[kind]
    none = F.lit(None).cast("string")
    found = [obj.get(n, none) for n in names]
    return found + [none] * (3 - len(found))


def node_label(kind: Column, first: Column, second: Column, third: Column, uri: Column) -> Column:
    """Text under a node, from its label texts; falls back to the uri."""
    filled = lambda c: F.nullif(c, F.lit(""))
    code_and_name = X.strip(F.concat_ws(" ", F.coalesce(first, F.lit("")), F.coalesce(second, F.lit(""))))
    label = F.when(kind == "EducationalProgram", filled(code_and_name)).otherwise(F.coalesce(filled(first), filled(second), filled(third)))
    return F.coalesce(label, uri)


def _record_nodes(columns: list[str]) -> Column:
    """All nodes of a record as one array of (kind, uri, t1, t2, t3, pos)."""
    def node(kind: str, uri: Column, obj: dict[str, Column], pos: Column) -> Column:
        texts = label_texts(kind, obj)
        return F.struct(F.lit(kind).alias("kind"), uri.alias("uri"), *[t.alias(f"t{n}") for n, t in enumerate(texts, 1)], pos.cast("int").alias("pos"))

    pick = lambda o, *names: {n: o[n] for n in names}
    cert_texts = {n: (F.col("_graph.org.display_name") if n == "g_display_name" else F.col(n))
                  for n in ("g_display_name", "EduOrgShortName", "EduOrgFullName") if n != "g_display_name" or "_graph" in columns}
    zero = F.lit(0)
    region = lambda c, pos: node("Region", _named_uri("Region", c), {"name": X.nonblank(c)}, pos)

    def of_card(scope: str, card: Column, pos: Column) -> Column:
        own = node("ActualEducationOrganization", F.when(card["Id"].isNotNull(), _uri("AEO", F.col("_cid"), F.lit(scope), card["Id"])),
                   pick(card, "ShortName", "FullName"), pos)
        return F.array(own, region(F.when(card["Id"].isNotNull(), card["RegionName"]), pos))

    def of_supplement(s: Column, pos: Column) -> Column:
        programs = F.flatten(F.transform(N.placed(N.programs_of(s)), lambda x: F.array(
            node("EducationalProgram", _program_uri(s["Id"], x["place"], x["item"]), pick(x["item"], "ProgrammCode", "ProgrammName"), pos),
            node("EducationalLevel", _named_uri("EducationalLevel", x["item"]["EduLevelName"]), {"name": _level_of(x["item"])}, pos))))
        return F.concat(F.array(node("Supplement", _uri("Supplement", F.col("_cid"), s["Id"]), pick(s, "Number"), pos)),
                        programs, of_card("supplement", s[N.ROOT], pos))

    indexed = F.filter(F.transform(N.supplements(), lambda s, pos: F.struct(s.alias("s"), pos.alias("pos"))), lambda x: x["s"]["Id"].isNotNull())
    decisions = F.transform(F.coalesce(F.col("Decisions"), F.array().cast(S.record_type()["Decisions"].dataType)), lambda d, pos: node(
        "Decision", F.when(~X.is_blank(d["Id"]), _uri("Decision", F.col("_cid"), X.strip(d["Id"]))), pick(d, "DecisionTypeName"), pos))
    return F.concat(
        F.array(node("Certificate", _uri("Certificate", F.col("_cid")), cert_texts, zero), region(F.col("RegionName"), zero)),
        F.flatten(F.transform(indexed, lambda x: of_supplement(x["s"], x["pos"]))), decisions,
        of_card("certificate", F.col(N.ROOT), F.size(N.supplements())))


def labelled_nodes(records: DataFrame) -> DataFrame:
    """(kind, uri, label) of every node, merged by uri: one pass over the records, one aggregate."""
    wanted = F.filter(_record_nodes(records.columns), lambda n: n["uri"].isNotNull())
    # settled: a filter on the result must not be pushed below the explode
    rows = N.settled(_identified(records).select("_record_seq", F.explode(wanted).alias("n")).select("_record_seq", "n.*"))
    when = F.struct("_record_seq", "pos")
    latest = [F.max_by(t, F.when(F.col(t).isNotNull(), when)).alias(t) for t in ("t1", "t2", "t3")]
    merged = rows.groupBy("kind", "uri").agg(*latest)
    return merged.select("kind", "uri", node_label(*[F.col(c) for c in ("kind", "t1", "t2", "t3", "uri")]).alias("label"))


def search_conditions(q: str = "", region: str = "", level: str = "", control_organ: str = "", leave_out: str = "") -> list[Column]:
    """The given conditions; text matches inside the names, ids match whole."""
    q, region, level, control_organ = q.strip(), region.strip(), level.strip(), control_organ.strip()
    found = []
    if q:
        inside = lambda c: F.lower(F.coalesce(c, F.lit(""))).contains(q.lower())
        found.append(inside(F.col("EduOrgFullName")) | inside(F.col("g_display_name"))
                     | F.coalesce(F.col("EduOrgOGRN") == q, F.lit(False)) | F.coalesce(F.col("EduOrgINN") == q, F.lit(False)))
    if region and leave_out != "region":
        found.append(F.col("g_region") == region)
    if level and leave_out != "level":
        found.append(F.array_contains("g_edu_levels", level))
    if control_organ and leave_out != "control_organ":
        found.append(F.col("g_control_organ_short") == control_organ)
    return found


def search_certificates(nodes: DataFrame, q: str = "", region: str = "", level: str = "", control_organ: str = "", limit: int = 20) -> DataFrame:
    """The first ``limit`` certificate nodes by uri that meet every condition; none without a condition.

    The limit is part of the search page. It runs as a top-n per task and a small final merge.
    """
    found = search_conditions(q, region, level, control_organ)
    if not found:
        return nodes.where(F.lit(False))
    for c in found:
        nodes = nodes.where(c)
    return nodes.orderBy("uri").limit(limit)


FACETS = {"region": "g_region", "level": "g_edu_levels", "control_organ": "g_control_organ_short"}


def facet_options(nodes: DataFrame, field: str, region: str = "", level: str = "", control_organ: str = "", most: int | None = None) -> DataFrame:
    """Sorted distinct values of one facet under the other facets' filters; all of them, or the first ``most`` a page shows."""
    column = FACETS[field]
    for c in search_conditions("", region, level, control_organ, leave_out=field):
        nodes = nodes.where(c)
    values = nodes.select((F.explode(column) if field == "level" else F.col(column)).alias("option"))
    values = values.where("option is not null and option <> ''").distinct().orderBy("option")
    return values if most is None else values.limit(most)


def hubs(edge_rows: DataFrame, block: int = HUB_BLOCK) -> DataFrame:
    """(uri, blocks) of the nodes that more than ``block`` edges end at; written, as it is read several times. One row per ``block`` edge ends at most."""
    ends = edge_rows.select(F.explode(F.array("src", "dst")).alias("uri")).groupBy("uri").agg(F.count(F.lit(1)).alias("n"))
    found = ends.where(F.col("n") > block).select("uri", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    path = scratch_path(edge_rows.sparkSession, "hubs")
    found.write.parquet(path)
    found = edge_rows.sparkSession.read.schema(found.schema).parquet(path)
    return F.broadcast(found) if found.count() <= MOST_HUBS else found


def _salted(rows: DataFrame, key: str, spread_by: str, side: DataFrame, hub_rows: DataFrame) -> DataFrame:
    """rows joined with ``side`` (uri, ..) on ``key``: a hub's rows are cut into blocks, and its row of the side stands in each of them."""
    blocks = F.coalesce("blocks", F.lit(1))
    cut = rows.join(hub_rows.withColumnRenamed("uri", key), key, "left").withColumn("_block", F.pmod(F.xxhash64(spread_by), blocks).cast("int")).drop("blocks")
    copies = side.join(hub_rows, "uri", "left").withColumn("_block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("blocks")
    return cut.join(copies.withColumnRenamed("uri", key), [key, "_block"]).drop("_block")


def expand_nodes(nodes: DataFrame, edge_rows: DataFrame, wanted: DataFrame | None = None, block: int = HUB_BLOCK) -> DataFrame:
    """The nodes in ``wanted`` (column ``uri``; all without it) and their neighbours: (uri, direction, predicate, edge_label, neighbor, kind, label).

    The node itself has direction ``self`` and no predicate. Only the relations listed for a node's kind are
    followed. nodes and edge_rows are stored tables, read several times. Edges of a hub, such as a region, are dealt
    out in blocks of about ``block`` rows, so no task gets them all.
    """
    nodes = nodes.select("uri", "kind", "label")
    base = nodes if wanted is None else nodes.join(wanted.select("uri").distinct(), "uri", "left_semi")
    hub_rows = hubs(edge_rows, block)
    relations = [(kind, p, "out", "src", "dst") for kind, ps in OUTGOING.items() for p in ps] + [(kind, p, "in", "dst", "src") for kind, ps in INCOMING.items() for p in ps]

    def follow(direction: str, own: str, other: str) -> DataFrame:
        allowed = F.lit(False)
        for kind, predicate, to, *_ in relations:
            if to == direction:
                allowed = allowed | ((F.col("_kind") == kind) & (F.col("predicate") == predicate))
        start = base.select("uri", F.col("kind").alias("_kind"))
        return _salted(edge_rows, own, other, start, hub_rows).where(allowed).select(
            F.col(own).alias("uri"), F.lit(direction).alias("direction"), "predicate", F.col(other).alias("neighbor"))

    steps = follow("out", "src", "dst").unionByName(follow("in", "dst", "src"))
    labels = F.create_map(*[F.lit(x) for kv in EDGE_LABELS.items() for x in kv])
    around = _salted(steps.withColumnRenamed("uri", "_own"), "neighbor", "_own", nodes, hub_rows).select(
        F.col("_own").alias("uri"), "direction", "predicate", F.try_element_at(labels, F.col("predicate")).alias("edge_label"), "neighbor", "kind", "label")
    none = F.lit(None).cast("string")
    own = base.select("uri", F.lit("self").alias("direction"), none.alias("predicate"), none.alias("edge_label"), F.col("uri").alias("neighbor"), "kind", "label")
    return around.unionByName(own)


def certificates_in_region(region_rows: DataFrame, edge_rows: DataFrame, region: str) -> DataFrame:
    """Certificate uris of a region, by its name."""
    target = region_rows.where(F.col("name") == region).select(F.col("uri").alias("dst"))
    hits = edge_rows.where((F.col("predicate") == "inRegion") & F.col("src").startswith(NAMESPACE + "Certificate:"))
    return hits.join(target, "dst", "left_semi").select(F.col("src").alias("uri"))


def levels_offered_by(level_rows: DataFrame, edge_rows: DataFrame, organizations: DataFrame) -> DataFrame:
    """(uri, level) for the given organisation nodes (column ``uri``)."""
    offers = edge_rows.where(F.col("predicate") == "offersEducationLevel")
    return (
        offers.join(organizations.select(F.col("uri").alias("src")).distinct(), "src", "left_semi")
        .join(level_rows.select(F.col("uri").alias("dst"), F.col("name").alias("level")), "dst")
        .select(F.col("src").alias("uri"), "level")
    )


def supplements_by_card_inn(organizations: DataFrame, edge_rows: DataFrame, inn: Column) -> DataFrame:
    """Supplement uris whose card has an INN that satisfies ``inn``."""
    cards = organizations.where(inn).select(F.col("uri").alias("dst"), F.col("INN").alias("inn"))
    has = edge_rows.where((F.col("predicate") == "hasActualEducationOrganization") & F.col("src").startswith(NAMESPACE + "Supplement:"))
    return has.join(cards, "dst").select(F.col("src").alias("uri"), "inn")
