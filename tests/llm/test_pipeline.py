import re

import corpus_pipeline as pipeline
from certweave.llm import language, mixing, packing, quality

from .test_jaccard import brute
from .test_quality import base


def test_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        kept[name], docs = docs, spark.read.parquet(str(tmp_path / name))
        assert name == "pack_sequences" or docs.columns == columns
    rows = {name: df.select("doc_id", "text", "source").collect() for name, df in kept.items()}
    lettered = {r.doc_id for r in rows["language_id"] if re.search(r"[^\W\d_]", r.text or "")}
    assert {r.doc_id for r in rows["quality_rules"]} <= lettered and len(rows["quality_rules"]) >= 0.97 * len(lettered)
    for r in rows["ngram_jaccard"]:
        n_words, _, _, _, repeated = base(r.text)
        assert n_words >= 10 and 100 * repeated <= 20 * n_words
    assert sorted({c for _, c, _ in brute([(r.doc_id, r.text) for r in rows["ngram_jaccard"]])}) == sorted(r.doc_id for r in rows["mix_sources"])
    words = lambda rs: sum(len(r.text.split()) for r in rs)
    assert abs(words(rows["pack_sequences"]) - words(rows["mix_sources"])) < 0.02 * words(rows["mix_sources"])
    copies = {}
    for r in rows["pack_sequences"]:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 3
    packed = docs.collect()
    starts = {}
    for r in packed:
        starts.setdefault((r.doc_id, r.start), []).append(r)
    assert all(len(v) <= copies[d] for (d, _), v in starts.items()) and {r.doc_id for r in packed} == set(copies)
    assert pipeline.run(spark, small).count() == len(packed)


def test_names():
    assert [f.__module__ for _, f in pipeline.STAGES] == ["corpus_pipeline"] * 5 and all(m for m in (language, mixing, packing, quality))


def test_stages_take_odd_rows_and_none(spark, odd, nothing, small, tmp_path):
    """Nulls in every column, blank and long texts, repeated rows, extra columns with clashing names, no rows."""
    for which, docs in (("odd", odd), ("nothing", nothing)):
        columns = docs.columns
        for name, stage in pipeline.STAGES:
            stage(spark, docs, small).write.parquet(str(tmp_path / which / name))
            docs = spark.read.parquet(str(tmp_path / which / name))
            assert name == "pack_sequences" or docs.columns == columns
        ids = {r.doc_id for r in docs.collect()}
        assert ids <= {4, 7} and (7 in ids) == (which == "odd")


def test_quality_stage_reads_every_label(spark, documents, tmp_path):
    """Trusted documents whose ids a draw by hash from 60,000 labels passes over still make the model."""
    labels = spark.range(60_000).selectExpr("id as doc_id", "pmod(xxhash64(id), 1048576) >= 524288 as late").where("late or doc_id > 500")
    labels.selectExpr("doc_id", "if(late and doc_id <= 500, 1, 0) as quality").write.parquet(str(tmp_path / "labels.parquet"))
    trusted = [r.doc_id for r in labels.where("late and doc_id <= 500").limit(40).collect()]
    good = [(i, " ".join(f"good{(i * (k + 3) + k) % 23}" for k in range(14)), "en", "a") for i in trusted]
    poor = [(70_000 + n, " ".join(f"poor{(n * (k + 3) + k) % 23}" for k in range(14)), "en", "a") for n in range(10)]
    kept = {r.doc_id for r in pipeline.quality_rules(spark, documents(good + poor), str(tmp_path)).collect()}
    passing = {i for i, t, *_ in good if 100 * base(t)[4] <= 20 * base(t)[0]}
    assert len(passing) > 20 and kept == passing


def test_language_stage_counts_every_declared_row(spark, documents):
    """Documents whose texts a draw by hash from 40,000 passes over still make the model of their language."""
    texts = spark.range(80).selectExpr("id", "concat('le chat et la souris dorment ', id) as text").where("pmod(xxhash64(text), 1048576) >= 524288")
    rare = [(50_000 + r.id, r.text, "fr", "a") for r in texts.collect()]
    many = [(n, f"{('gut', 'good', 'bueno', 'bon')[n % 4]} {n}", pipeline.LANGUAGES[n % 4], "b") for n in range(40_000)]
    kept = {r.doc_id for r in pipeline.language_id(spark, documents(many + rare), "").where("doc_id >= 50000").collect()}
    assert len(rare) > 20 and kept == {i for i, *_ in rare}
