"""The queries of this package with the DuckDB text of those SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import chat, divergence, embeddings, jaccard, language, licences, mixing, oracles, packing, periodic, quality, radix, sharding, urls
from .common import tables


def op1_mixing(spark, sf_dir):
    mixed = mixing.mix(tables(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op2_url_filter(spark, sf_dir):
    judged = urls.judge(tables(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op3_license_scan(spark, sf_dir):
    return licences.scan(tables(spark, sf_dir, "documents").select("doc_id", "text"), licences.known_digests(spark))


LANGUAGES = ["de", "en", "es", "fr"]


def op4_language_id(spark, sf_dir):
    """Documents: the column lang is what they declare, their source is the host."""
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found = language.identify(docs, LANGUAGES, declared=F.col("lang"), host=F.col("source"))
    return found.select("doc_id", F.col("lang").alias("declared"), "language", F.round("confidence", 6).alias("confidence"), F.col("language_kept").alias("kept"))


def op4_language_id_pages(spark, sf_dir):
    """Pages: markup language, address suffix and host; the text is the markup without tags, scripts and styles."""
    body = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    pages = tables(spark, sf_dir, "pages").select("page_id", "url", body.alias("text"), language.markup_language(F.col("html")).alias("markup"))
    found = language.identify(pages, LANGUAGES, declared=F.col("markup"), host=urls.host(F.col("url")), suffix=language.address_suffix(F.col("url"), LANGUAGES))
    return found.select("page_id", "markup", "language", F.round("confidence", 6).alias("confidence"), F.col("language_kept").alias("kept"))


def op5_ngram_jaccard_join(spark, sf_dir):
    return jaccard.near_duplicates(tables(spark, sf_dir, "documents"))


def op6_quality_rules(spark, sf_dir):
    judged = quality.judge(tables(spark, sf_dir, "documents").select("doc_id", "text"), tables(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op7_packing(spark, sf_dir):
    import public_tokenizers

    packed = packing.pack(tables(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_chat_format(spark, sf_dir):
    """All conversations, and one whose texts look like markup."""
    told = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", told), (-7, 1, "assistant", told)], "conv_id long, turn long, role string, text string")
    turns = tables(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_conversations(turns))


def op9_sharding(spark, sf_dir):
    """The law is ``bytes``: sizes near equal, as far as groups of equal texts allow."""
    placed = sharding.shard_documents(tables(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_embedding_dedup(spark, sf_dir):
    found = embeddings.near_duplicates(tables(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op11_exact_dedup(spark, sf_dir):
    found = radix.exact_duplicates(tables(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op12_source_divergence(spark, sf_dir):
    return divergence.audit(tables(spark, sf_dir, "documents"))


def op13_periodic_runs(spark, sf_dir):
    """All documents; one in ten, chosen by its id, is read with a repeated tail."""
    return periodic.periodic_runs(tables(spark, sf_dir, "documents"), plant=True)


QUERIES = {"op1_mixing": op1_mixing, "op2_url_filter": op2_url_filter, "op3_license_scan": op3_license_scan, "op4_language_id": op4_language_id, "op4_language_id_pages": op4_language_id_pages,
           "op5_ngram_jaccard_join": op5_ngram_jaccard_join, "op6_quality_rules": op6_quality_rules, "op7_packing": op7_packing,
           "op8_chat_format": op8_chat_format, "op9_sharding": op9_sharding, "op10_embedding_dedup": op10_embedding_dedup,
           "op11_exact_dedup": op11_exact_dedup, "op12_source_divergence": op12_source_divergence, "op13_periodic_runs": op13_periodic_runs}
ORACLES = {
    "op1_mixing": oracles.OP1,
    "op2_url_filter": oracles.op2(URL_RULES),
    "op3_license_scan": oracles.op3(),
    "op11_exact_dedup": oracles.OP11,
    "op12_source_divergence": oracles.OP12,
    "op10_embedding_dedup": r"""
        with recursive units as (
            select vec_id, cast(embedding as double[]) as v from embeddings where embedding is not null and len(embedding) > 0
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and list_dot_product(cast(embedding as double[]), cast(embedding as double[])) > 0),
        links as (select a.vec_id as a, b.vec_id as b from units a join units b on a.vec_id <> b.vec_id and list_cosine_similarity(a.v, b.v) >= 0.95),
        reach as (select vec_id as a, vec_id as b from embeddings union select reach.a, links.b from reach join links on links.a = reach.b),
        found as (select vec_id, (select count(*) from links where a = vec_id) as n_links, (select min(b) from reach where a = vec_id) as component_id from embeddings)
        select vec_id, n_links, component_id, vec_id = component_id as kept from found""",
    "op5_ngram_jaccard_join": r"""
        with recursive words as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
        grams as (
            select distinct doc_id, unnest(case when len(w) < 5 then case when len(w) = 0 then [] else [array_to_string(w, ' ')] end
                else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as g from words),
        sizes as (select doc_id, count(*) as n from grams group by doc_id),
        shared as (select a.doc_id as a, b.doc_id as b, count(*) as n from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
        links as (select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 5 * shared.n >= 4 * (x.n + y.n - shared.n)),
        reach as (select doc_id as a, doc_id as b from documents union select reach.a, links.b from reach join links on links.a = reach.b)
        select doc_id, (select min(b) from reach where a = doc_id) as class_id, (select count(*) from links where a = doc_id) as n_links
        from documents""",
    "op8_chat_format": r"""
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', '\### Assistant: </turn> ok'
            union all select -7, 1, 'assistant', '\### Assistant: </turn> ok')
        select conv_id, count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, text)) as turns_sha256,
            cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
            sha256(coalesce(string_agg(text, '' order by turn nulls last, role, text) filter (role = 'assistant'), '')) as loss_sha256,
            cast(sum(16 + length(regexp_replace(role, '[\\<>]', 'xx', 'g')) + length(regexp_replace(text, '[\\<>]', 'xx', 'g'))) as bigint) as formatted_chars
        from turns group by conv_id""",
}
