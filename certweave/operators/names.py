"""Organisation names across records, and dictionaries of suggested names.

Name rules are costly per text and names repeat a lot, so they run on a dictionary of the
distinct names. Rows find theirs by the name's code, a digest of 32 bytes; names themselves are
not joined. A name that is a large part of all rows is one row of the dictionary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certweave.functions import nested as N
from certweave.functions import orgnames as O
from certweave.functions import text as X
from certweave.operators import lookup as L


def name_fields(records: DataFrame) -> DataFrame:
    """(Id, _record_seq, field, name): every non-blank organisation name of a record in reading order."""
    def pair(field: str, value: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), value.alias("name"))

    root = F.col(N.ROOT)
    own = F.array(
        pair("Certificate.EduOrgFullName", F.col("EduOrgFullName")), pair("Certificate.EduOrgShortName", F.col("EduOrgShortName")),
        pair("root_ActualEducationOrganization.FullName", root["FullName"]), pair("root_ActualEducationOrganization.ShortName", root["ShortName"]))
    sups = F.flatten(F.transform(N.supplements(), lambda s: F.array(
        pair("supplement_ActualEducationOrganization.FullName", s[N.ROOT]["FullName"]),
        pair("supplement_ActualEducationOrganization.ShortName", s[N.ROOT]["ShortName"]))))
    named = F.filter(F.concat(own, sups), lambda x: ~X.is_blank(x["name"]))
    return records.select("Id", "_record_seq", F.posexplode(named).alias("pos", "x")).select(
        "Id", "_record_seq", "pos", "x.field", "x.name")


def name_code(name: Column) -> Column:
    """The code of a name in a dictionary: its SHA-256 digest."""
    return F.unhex(F.sha2(name, 256))


def normalized_names(names: DataFrame) -> DataFrame:
    """Distinct names with their display form, fingerprint and whether anything changed."""
    distinct = names.select("name").where("name is not null").distinct()
    # much work per small row: the configured number of tasks. Dealt by another key than the names', or the
    # planner would take the shuffle of distinct() for it, which is coalesced by size.
    distinct = distinct.repartition(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("name"))
    # a filter on the display form stays above it, so the rules run once per name
    shown = N.with_computed(distinct, "display_name", O.normalize_display_name(F.col("name")))
    return shown.withColumns({
        "fingerprint": O.fingerprint_of_display(F.col("display_name")),
        "changed": O.name_changed(F.col("name"), F.col("display_name")),
    })


def normalize_names(fields: DataFrame) -> DataFrame:
    """Rows of :func:`name_fields` with the display form of each name."""
    shown = normalized_names(fields).withColumn("_code", name_code(F.col("name"))).drop("name")
    return fields.withColumn("_code", name_code(F.col("name"))).join(shown, "_code", "left").drop("_code")


def change_counts(fields: DataFrame) -> DataFrame:
    """(field, n): how many values of each field get another text.

    Names are counted per field, and a name's counts (one per field) stand in its row of the
    dictionary, so the rows of the fields are read once and joined with nothing.
    """
    counted = fields.where("name is not null").groupBy("field", "name").agg(F.count(F.lit(1)).alias("n"))
    by_name = counted.groupBy("name").agg(F.collect_list(F.struct("field", "n")).alias("counts"))
    by_name = by_name.repartition(int(fields.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("name"))
    shown = N.with_computed(by_name, "display_name", O.normalize_display_name(F.col("name")))
    rows = shown.where("display_name <> name").select(F.inline("counts"))
    return rows.groupBy("field").agg(F.sum("n").cast("bigint").alias("n"))


def normalize_in_records(records: DataFrame, *, most: int = L.MOST_HELD) -> DataFrame:
    """Records with the six name fields rewritten in place.

    The rules run once per distinct name. The dictionary of those that change is counted: up to ``most`` rows
    it goes to every task and records stay where they are (see ``lookup``); a larger one is joined with
    narrow rows of codes, and records with what was found for them.
    """
    shown = normalized_names(name_fields(records)).where("display_name <> name")
    shown, rows = L.written(shown.select(name_code(F.col("name")).alias("key"), F.col("display_name").alias("value")))
    root = F.col(N.ROOT)
    own = F.array("EduOrgFullName", "EduOrgShortName", root["FullName"], root["ShortName"])
    names = F.concat(own, F.flatten(F.transform(N.supplements(), lambda s: F.array(s[N.ROOT]["FullName"], s[N.ROOT]["ShortName"]))))
    if rows <= most:
        value = lambda name: N.let(name_code(name), lambda k: L.found(k, rows))
        held = L.with_held(records, shown, rows)
        done = held.withColumn("_shown", F.transform(names, lambda name: F.coalesce(value(name), name))).drop(L.HELD)
    else:
        codes = records.select("_record_seq", F.posexplode(F.transform(names, name_code)).alias("at", "key")).where("key is not null")
        found = codes.join(shown, "key").groupBy("_record_seq").agg(F.map_from_entries(F.collect_list(F.struct("at", "value"))).alias("_names"))
        put = lambda name, i: F.coalesce(F.try_element_at(F.col("_names"), i), name)
        done = records.join(found, "_record_seq", "left").withColumn("_shown", F.transform(names, put)).drop("_names")
    at = lambda i: F.get("_shown", i)
    card = lambda a, i: a.withField("FullName", at(i)).withField("ShortName", at(i + 1))
    return done.withColumns({
        "EduOrgFullName": at(F.lit(0)),
        "EduOrgShortName": at(F.lit(1)),
        N.ROOT: card(root, F.lit(2)),
        N.SUPPLEMENTS: F.transform(N.supplements(), lambda s, i: s.withField(N.ROOT, card(s[N.ROOT], i * 2 + 4))),
    }).drop("_shown")


NAME_KINDS = {"all": ["FullName", "ShortName"], "full": ["FullName"], "short": ["ShortName"]}


def collect_unique_names(fields: DataFrame, kind: str = "all", limit: int | None = None) -> DataFrame:
    """Distinct stripped names of a kind: sorted, or the first ``limit`` seen."""
    wanted = F.lit(False)
    for suffix in NAME_KINDS[kind]:
        wanted = wanted | F.col("field").endswith(suffix)
    rows = fields.where(wanted).select(X.nonblank(F.col("name")).alias("name"), "_record_seq", "pos").where("name is not null")
    if limit is None:
        return rows.select("name").distinct().orderBy("name")
    seen = rows.groupBy("name").agg(F.min(F.struct("_record_seq", "pos")).alias("_first"))
    return seen.orderBy("_first").limit(limit).select("name")


# -- dictionaries ------------------------------------------------------------
# entries: raw, original_raw, by_model map<string, struct<suggested_display, reason_short>>, seq

SLOT = "struct<suggested_display:string,reason_short:string>"


def entry_key(raw: Column, ignore_case: bool = True) -> Column:
    return F.nullif(F.lower(raw) if ignore_case else raw, F.lit(""))


def lift_flat_entries(flat: DataFrame, model: str) -> DataFrame:
    """Flat rows (raw, suggested_display, reason_short, seq) as entries of one model."""
    slot = F.struct("suggested_display", F.when(~X.is_blank(F.col("reason_short")), F.col("reason_short")).alias("reason_short"))
    original = F.col("original_raw") if "original_raw" in flat.columns else F.lit(None).cast("string")
    return flat.select("raw", original.alias("original_raw"), F.when(
        F.col("suggested_display").isNotNull(), F.create_map(F.lit(model), slot)).alias("by_model"), "seq")


def merge_dictionary(existing: DataFrame, batch: DataFrame, model: str, ignore_case: bool = True) -> DataFrame:
    """Existing entries with a batch of one model's answers merged in.

    The first existing entry of a key stays; the latest answer fills the model's
    slot; the original text is taken where it was absent. Both sides shrink to one
    row per key before they meet. ``place`` orders the entries: existing ones as they
    were, then new ones in arrival order.
    """
    e = existing.withColumn("key", entry_key(F.col("raw"), ignore_case)).where("key is not null")
    e = e.groupBy("key").agg(F.min_by(F.struct("raw", "original_raw", "by_model"), "seq").alias("e"), F.min("seq").alias("e_seq"))
    reason = F.when(~X.is_blank(F.col("reason_short")), F.col("reason_short"))
    b = batch.withColumn("key", entry_key(F.col("raw"), ignore_case)).where("key is not null")
    b = b.groupBy("key").agg(
        F.min_by("raw", "seq").alias("b_raw"), F.min("seq").alias("b_seq"),
        F.min_by("original_raw", F.when(F.col("original_raw").isNotNull(), F.col("seq"))).alias("b_original"),
        F.max_by(F.struct("suggested_display", reason.alias("reason_short")), "seq").alias("slot"))
    old = F.coalesce(F.col("e.by_model"), F.create_map().cast(f"map<string,{SLOT}>"))
    others = F.map_filter(old, lambda k, _: k != model)
    mine = F.create_map(F.lit(model), F.col("slot"))
    return e.join(b, "key", "full_outer").select(
        "key", F.coalesce("e.raw", "b_raw").alias("raw"), F.coalesce("e.original_raw", "b_original").alias("original_raw"),
        F.when(F.col("slot").isNull(), old).otherwise(F.map_concat(others, mine)).alias("by_model"),
        F.struct(F.col("e_seq").isNull().alias("is_new"), F.coalesce("e_seq", "b_seq").alias("seq")).alias("place"))


def _answer(model: str) -> Column:
    return F.try_element_at(F.col("by_model"), F.lit(model))["suggested_display"]


def names_done(entries: DataFrame, model: str, mask: bool = False) -> DataFrame:
    """Keys that already have an answer of the model; numbers can be masked first."""
    raw = O.mask_numbers(F.col("raw")) if mask else F.col("raw")
    return entries.where(_answer(model).isNotNull() & F.col("raw").isNotNull()).select(F.lower(raw).alias("key")).distinct()


def names_missing(entries: DataFrame, model: str) -> DataFrame:
    return entries.where(~X.is_blank(F.col("raw")) & _answer(model).isNull()).select("raw")


def names_to_ask(names: DataFrame, entries: DataFrame, model: str, mask: bool = False) -> DataFrame:
    """Names without an answer of the model yet."""
    name = O.mask_numbers(F.col("name")) if mask else F.col("name")
    return names.withColumn("key", F.lower(name)).join(names_done(entries, model, mask), "key", "left_anti").drop("key")


def align_batch(sent: DataFrame, answers: DataFrame) -> DataFrame:
    """Answers put to the names sent, by their ``raw`` text, else by position.

    ``sent``: batch, pos, sent, original. ``answers``: batch, pos, raw,
    suggested_display, reason_short; of several at a position the last in text
    order counts. An unusable answer gives no row.
    """
    by_raw = answers.where("raw is not null").groupBy("batch", F.col("raw").alias("sent")).agg(
        F.max_by(F.struct("raw", "suggested_display", "reason_short"), "pos").alias("_by_raw"))
    by_pos = answers.groupBy("batch", "pos").agg(F.max_by(F.struct("raw", "suggested_display", "reason_short"), F.struct("raw", "suggested_display", "reason_short")).alias("_by_pos"))
    joined = sent.join(by_raw, ["batch", "sent"], "left").join(by_pos, ["batch", "pos"], "left")
    item = F.coalesce("_by_raw", "_by_pos")
    return joined.select("batch", "pos", item["raw"].alias("raw"), item["suggested_display"].alias("suggested_display"),
                         item["reason_short"].alias("reason_short"),
                         F.when(F.col("original") != F.col("sent"), F.col("original")).alias("original_raw")) \
        .where("raw is not null and suggested_display is not null")


def keyed_suggestions(entries: DataFrame, model: str | None) -> DataFrame:
    """(key, raw, suggested): the last entry of a key counts; without a model only single-model entries answer."""
    named = entries.where(~X.is_blank(F.col("raw")))
    if model is not None:
        suggested = _answer(model)
    else:
        suggested = F.when(F.size("by_model") == 1, F.map_values("by_model")[0]["suggested_display"])
    return named.groupBy(F.lower("raw").alias("key")).agg(
        F.max_by(F.struct("raw", suggested.alias("suggested")), "seq").alias("x")).select("key", "x.raw", "x.suggested")


def paired(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys of two dictionaries side by side with ``relation``: only_a, only_b, same, different."""
    left = a.select("key", F.col("raw").alias("raw_a"), F.col("suggested").alias("suggested_a"))
    right = b.select("key", F.col("raw").alias("raw_b"), F.col("suggested").alias("suggested_b"))
    return left.join(right, "key", "full_outer").withColumn(
        "relation",
        F.when(F.col("raw_b").isNull(), "only_a").when(F.col("raw_a").isNull(), "only_b")
        .when(F.col("suggested_a") == F.col("suggested_b"), "same").otherwise("different"))


def diff_pairwise(a: DataFrame, b: DataFrame) -> DataFrame:
    r = F.col("relation")
    return paired(a, b).agg(
        F.count_if(r != "only_b").alias("entries_a"), F.count_if(r != "only_a").alias("entries_b"),
        F.count_if(r == "only_a").alias("only_in_a"), F.count_if(r == "only_b").alias("only_in_b"),
        F.count_if(r.isin("same", "different")).alias("common_raw"),
        F.count_if(r == "same").alias("common_same"), F.count_if(r == "different").alias("common_different"))


def diff_samples(a: DataFrame, b: DataFrame, most: int = 40) -> DataFrame:
    """The first ``most`` keys of every relation but ``same``; the report's sample lists."""
    from certweave.operators.audit import first_per_group

    return first_per_group(paired(a, b).where("relation <> 'same'"), ["relation"], ["key"], most)


def triple_samples(a: DataFrame, b: DataFrame, c: DataFrame, most: int = 40) -> DataFrame:
    """The first ``most`` keys on which all three dictionaries differ, and on which the first two agree against the third."""
    from certweave.operators.audit import first_per_group

    side = lambda d, n: d.select("key", F.col("suggested").alias(n))
    t = side(a, "suggested_a").join(side(b, "suggested_b"), "key").join(side(c, "suggested_c"), "key")
    sa, sb, sc = F.col("suggested_a"), F.col("suggested_b"), F.col("suggested_c")
    relation = F.when((sa != sb) & (sa != sc) & (sb != sc), "all_different").when((sa == sb) & (sb != sc), "a_equals_b_not_c")
    return first_per_group(t.withColumn("relation", relation).where("relation is not null"), ["relation"], ["key"], most)


def diff_triple(a: DataFrame, b: DataFrame, c: DataFrame) -> DataFrame:
    """Agreement of three dictionaries on the keys all of them have."""
    side = lambda d, n: d.select("key", F.col("suggested").alias(n))
    t = side(a, "sa").join(side(b, "sb"), "key").join(side(c, "sc"), "key")
    text = F.col("sa").isNotNull() & F.col("sb").isNotNull() & F.col("sc").isNotNull()
    ab, ac, bc = F.col("sa") == F.col("sb"), F.col("sa") == F.col("sc"), F.col("sb") == F.col("sc")
    n = lambda cond: F.count_if(F.coalesce(text & cond, F.lit(False)))
    return t.agg(
        F.count(F.lit(1)).alias("keys_in_all_three"), n(ab & bc).alias("all_same"), n(ab & ~bc).alias("a_equals_b_not_c"),
        n(ac & ~ab).alias("a_equals_c_not_b"), n(bc & ~ab).alias("b_equals_c_not_a"), n(~ab & ~ac & ~bc).alias("all_different"))
