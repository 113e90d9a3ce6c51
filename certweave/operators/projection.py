"""The ``_graph`` struct of a record: head organisation, its programmes, its branches.

All of it is computed inside the row. Grouping within a record sorts the
record's own array and cuts it into runs, so the work stays near-linear in the
size of the record.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certweave.functions import display as D
from certweave.functions import nested as N


def level_list(sup: Column) -> Column:
    """Distinct non-empty effective levels of a supplement in order of appearance."""
    levels = F.transform(N.programs_of(sup), lambda p: F.coalesce(N.effective(p, "EduLevelName"), F.lit("")))
    return F.array_distinct(F.filter(levels, lambda x: x != ""))


def program_entries(sup: Column) -> Column:
    def entry(p: Column) -> Column:
        code = p["ProgrammCode"]
        level = F.coalesce(N.effective(p, "EduLevelName"), F.lit(""))
        short = D.shorten_level(level, code)
        return F.struct(
            code.alias("code"),
            F.when(D.valid_code(p["UGSCode"]), p["UGSCode"]).otherwise(F.concat(F.substring(code, 1, 2), F.lit(".00.00"))).alias("ugs_code"),
            level.alias("edu_level"),
            F.when(short != level, short).alias("edu_level_short"),
        )

    return F.transform(F.filter(N.programs_of(sup), lambda p: D.valid_code(p["ProgrammCode"])), entry)


def runs(items: Column, key: Callable[[Column], Column]) -> Column:
    """Items grouped by ``key``: an array of arrays, groups and members in order of first appearance."""
    tagged = F.array_sort(F.transform(items, lambda x, pos: F.struct(key(x).alias("key"), pos.alias("pos"), x.alias("item"))))

    def cut(t: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda n: (n == 0) | ~t[n]["key"].eqNullSafe(t[F.greatest(n - 1, F.lit(0))]["key"]))
        return N.let(starts, lambda s: F.transform(s, lambda start, n: F.slice(
            t, start + 1, F.coalesce(F.try_element_at(s, n + 2), F.size(t)) - start)))

    groups = N.let(tagged, lambda t: F.when(F.size(t) > 0, cut(t)).otherwise(F.array(t)))
    ordered = F.array_sort(F.transform(F.filter(groups, lambda g: F.size(g) > 0), lambda g: F.struct(
        g[0]["pos"].alias("first"), F.transform(g, lambda x: x["item"]).alias("members"))))
    return F.transform(ordered, lambda g: g["members"])


def distinct_programs(entries: Column) -> Column:
    """First entry per (code, level)."""
    return F.transform(runs(entries, lambda e: F.struct(e["code"], e["edu_level"])), lambda g: g[0])


def _short_levels(levels: Column) -> Column:
    """The short forms, given only when one of them differs."""
    short = F.transform(levels, lambda x: D.shorten_level(x))
    return F.when(~short.eqNullSafe(levels), short)


def _is_branch(s: Column) -> Column:
    return F.coalesce(s["_derived"]["IsBranchSupplement"], F.lit(False))


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def branches(sups: Column) -> Column:
    """Branch supplements grouped by effective OGRN, else card id, else on their own."""
    rows = F.transform(sups, lambda s, pos: F.struct(
        pos.alias("pos"), s.alias("s"), _filled(N.effective(s[N.ROOT], "OGRN")).alias("ogrn"), _filled(s[N.ROOT]["Id"]).alias("id")))
    rows = F.filter(rows, lambda r: _is_branch(r["s"]))
    key = lambda r: F.struct(
        F.coalesce(r["ogrn"], r["id"]).alias("text"),
        F.when(F.coalesce(r["ogrn"], r["id"]).isNull(), r["pos"]).alias("own"),
    )

    def branch(g: Column) -> Column:
        card = g[0]["s"][N.ROOT]
        levels = F.array_distinct(F.flatten(F.transform(g, lambda r: level_list(r["s"]))))
        return F.struct(
            N.effective(card, "OGRN").alias("ogrn"),
            N.effective(card, "INN").alias("inn"),
            D.display_name(card["FullName"], card["ShortName"]).alias("display_name"),
            levels.alias("edu_levels"),
            _short_levels(levels).alias("edu_levels_short"),
            distinct_programs(F.flatten(F.transform(g, lambda r: program_entries(r["s"])))).alias("programs"),
        )

    return F.transform(runs(rows, key), branch)


def with_graph(df: DataFrame) -> DataFrame:
    """Add ``_graph`` to records on which branches are already marked."""
    card = F.col(N.ROOT)
    pick = lambda a, b: F.coalesce(_filled(card[a]), _filled(F.col(b)))
    df = df.withColumn("_head", F.filter(N.supplements(), lambda s: ~_is_branch(s)))
    df = df.withColumns({
        "_head_levels": F.array_distinct(F.flatten(F.transform(F.col("_head"), level_list))),
        "_head_programs": distinct_programs(F.flatten(F.transform(F.col("_head"), program_entries))),
        "_full": pick("FullName", "EduOrgFullName"),
        "_short": pick("ShortName", "EduOrgShortName"),
        "_region_short": D.shorten_region(F.col("RegionName")),
        "_organ_short": D.control_organ_short(F.col("ControlOrgan")),
    })
    df = df.withColumn("_founder", D.founder_key(F.col("IsFederal"), card["FormName"], F.col("RegionName"), F.col("_head_levels")))
    graph = F.struct(
        F.struct(
            _filled(N.effective_root("EduOrgOGRN")).alias("ogrn"),
            _filled(N.effective_root("EduOrgINN")).alias("inn"),
            _filled(D.display_name(F.col("_full"), F.col("_short"))).alias("display_name"),
            F.col("_founder").alias("founder_key"),
            D.founder_label(F.col("_founder")).alias("founder_label"),
        ).alias("org"),
        _filled(F.col("RegionName")).alias("region"),
        F.when(F.col("_region_short") != F.col("RegionName"), F.col("_region_short")).alias("region_short"),
        _filled(F.col("ControlOrgan")).alias("control_organ"),
        F.when(F.col("_organ_short") != F.col("ControlOrgan"), F.col("_organ_short")).alias("control_organ_short"),
        F.col("_head_levels").alias("edu_levels"),
        _short_levels(F.col("_head_levels")).alias("edu_levels_short"),
        F.col("_head_programs").alias("programs"),
        branches(N.supplements()).alias("branches"),
    )
    return df.withColumn("_graph", graph).drop(
        "_head", "_head_levels", "_head_programs", "_full", "_short", "_region_short", "_organ_short", "_founder")
