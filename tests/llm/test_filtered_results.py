"""A filter on any column that an operator adds ends, and keeps the rows that the whole result has."""

import pytest
from pyspark.sql import functions as F

from certweave.llm import catalog, language, licences, mixing, quality, urls


def results(spark, docs):
    labels = spark.createDataFrame([(7, 1, 0), (5, 0, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    pages = docs.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://a.org/"), F.substring("text", 1, 300)).alias("url"))
    return {
        "quality": lambda: quality.judge(docs, labels),
        "language": lambda: language.identify(docs, ["en", "de"], declared=F.col("lang"), host=F.col("source")),
        "mixing": lambda: mixing.mix(docs.select("doc_id", "text", "source")),
        "urls": lambda: urls.judge(pages, catalog.URL_RULES),
        "licences": lambda: licences.scan(docs, licences.known_digests(spark)),
    }


@pytest.mark.parametrize("name", ["quality", "language", "mixing", "urls", "licences"])
def test_filter_by_each_column(spark, odd, name):
    got = results(spark, odd)[name]()
    rows = got.collect()
    for c in got.columns:
        if c not in ("text", "doc_id", "page_id", "url", "lang"):
            assert got.where(F.col(c).isNotNull()).count() == sum(r[c] is not None for r in rows), c
            value = next((r[c] for r in rows if r[c] is not None), None)
            if value is not None and not isinstance(value, float):
                assert got.where(F.col(c) == F.lit(value)).count() == sum(r[c] == value for r in rows), c
