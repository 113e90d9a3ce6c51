"""Scratch text that is packed, and short ways that must give what the long ones give."""

import uuid

import pytest
from pyspark.sql import functions as F

from certweave.functions import text as X
from certweave.plans import register_view as V
from certweave.plans.catalog import damaged, global_pass, sources
from certweave.sources import readers, sinks


def _small(spark, tmp_path, sf):
    """The tables with a few orders."""
    out = tmp_path / "in"
    spark.read.parquet(f"{sf}/orders.parquet").where("o_orderkey < 100").write.parquet(f"{out}/orders.parquet")
    for t in ("customer", "nation"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{out}/{t}.parquet")
    return str(out)


@pytest.mark.parametrize("query", [damaged.convert_with_broken, sources.scan_xml, sources.merge_inputs])
def test_scratch_text_is_packed_in_files_of_bounded_length(spark, sf, tmp_path, monkeypatch, query):
    monkeypatch.setattr(sinks, "PACKED_ROWS", 7)
    small = _small(spark, tmp_path, sf)
    for module in (damaged, sources):
        monkeypatch.setattr(module, "scratch_path", lambda spark, name: f"{tmp_path}/scratch/{name}-{uuid.uuid4().hex}")
    rows = query(spark, small).collect()
    texts = [f for f in (tmp_path / "scratch").rglob("part-*") if "parquet" not in f.name]
    assert rows and texts and all(f.name.endswith(".txt.gz") for f in texts)
    assert len(texts) >= spark.read.parquet(f"{small}/orders.parquet").count() / 7 / 2
    if query is damaged.convert_with_broken:
        assert sum(r.n for r in rows) == spark.read.parquet(f"{small}/orders.parquet").count()


def test_packed_elements_are_those_of_plain_text(spark, sf, tmp_path):
    lines = sources._xml_text(V.records(spark, _small(spark, tmp_path, sf)))
    lines.write.text(str(tmp_path / "plain"))
    sinks.packed_text(lines.write).text(str(tmp_path / "packed"))
    got = [sorted(r.value for r in readers.read_elements(spark, str(tmp_path / p)).collect()) for p in ("plain", "packed")]
    assert got[0] == got[1] and len(got[0]) > 10


def test_a_search_splits_as_the_pattern_does(spark):
    texts = ["<Certificate>a", "x<Certificates><Certificate a='1'>b", "<Certificates>", "", "<Certificate", "<Certificate/><Certificate>c", "é<Certificate\n>d<Certificat>", "<CertificateX><Certificate>e"]
    long = F.regexp_extract_all("t", F.lit(f"(?s){readers.OPENING}.*?(?={readers.OPENING}|$)"), F.lit(0))
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", readers._pieces(F.col("t")).alias("short"), long.alias("long")).collect()
    assert [(r.t, r.short) for r in rows] == [(r.t, r.long) for r in rows]


def test_short_ways_of_the_text_rules(spark):
    texts = [None, "", " ", "a", "a b", "a  b", " a", "a ", "a\n", "a\tb", "a\x00b", "a b", "﻿a", "a​b", "a\x85b", "а　б", "-", "—", "Н/Д", "NULL", "нет данных", "Нет данных!", "123", "123\n", "1 2-3", "١٢",
             "2020-02-29", "2021-02-29", "0000-01-01", "2020-2-9", "2020-02-29Z", "2020-02-29\n", "29.02.2020", "2020-02-29T10:00:00+03:00", "2020-13-01", "😀 x", "😀 x", "\x1c", " "]
    c = F.col("t")
    x = X.drop_space_and_hyphen(c)
    day = X._date_text(c)
    pairs = {"clean": (X.clean_text(c), X._cleaned(c)), "digits": (X.digits_only(c), F.when(x.rlike("^[0-9]+$"), x)),
             "date": (X.parse_date(c), F.coalesce(X._iso_or_null(day), day)), "bad": (X.is_bad_date(c), day.isNotNull() & X._iso_or_null(day).isNull()),
             "blank": (X.is_blank(c), F.coalesce(X.strip(c) == "", F.lit(True)))}
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", *[F.struct(a.alias("short"), b.alias("long")).alias(n) for n, (a, b) in pairs.items()]).collect()
    for n in pairs:
        assert [(r.t, r[n].short) for r in rows] == [(r.t, r[n].long) for r in rows], n


def test_json_text_with_and_without_control_characters(spark):
    texts = ["a", "a\x00b", "\x1c", "\x00 ", "a\x7f", "a\\bc", "\x85", "a\nb", "", None, "é\x0cé"]
    rows = spark.createDataFrame([(n, t, [(t,), ("z",)]) for n, t in enumerate(texts)], "Id int, t string, s array<struct<u: string>>")
    for compact in (True, False):
        rule = (lambda d, c: sinks.omit_empty(d, sinks.json_safe(d, c))) if compact else sinks.json_safe
        whole = F.to_json(F.struct(*[rule(f.dataType, F.col(f.name)).alias(f.name) for f in rows.schema.fields]), {} if compact else {"ignoreNullFields": "false"})
        want = [r[0] for r in rows.orderBy("Id").select(whole).collect()]
        got = [r.value for r in sinks.json_lines(rows.orderBy("Id"), compact=compact).collect()]
        assert got == want


@pytest.mark.parametrize("query", [global_pass.neighbor_backfill_per_file, global_pass.converted_projection])
def test_the_level_pass_reads_converted_records_once_written(spark, sf, tmp_path, query):
    """Neither the majorities nor the result convert the records anew."""
    df = query(spark, _small(spark, tmp_path, sf))
    read = [f for f in df.inputFiles() if "/looked-up-" not in f]
    assert read and all("/written-" in f for f in read)
    assert df.count() > 10
