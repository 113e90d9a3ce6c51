import pytest
from pyspark.sql import functions as F

from certweave.functions import text as X


def apply(spark, rule, values):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v string")
    return [r.x for r in df.select("n", rule(F.col("v")).alias("x")).orderBy("n").collect()]


CASES = [
    (X.clean_text, [" a b c\n d ", "\x07x", "—", "н/д", "NULL", " Нет данных ", "", None, "﻿"],
     ["a b c d", "x", None, None, None, None, None, None, None]),
    (X.cast_bool, ["1", " 0 ", "Да", "ДА", "true", "возможно", None], [True, False, True, True, True, None, None]),
    (X.is_bad_bool, ["1", "возможно", None], [False, True, False]),
    (X.parse_date,
     ["2019-04-15T10:00:00+03:00", "2010-06-18 00:00:00+04", "2010-06-18 00:00:00+0300", "15.04.2019", "15/04/2019", "15-04-2019", "1.2.2019",
      "2019-04-15Z", "2019-04-15T10:00:00.123", "31.02.2020", "вчера", " ", None, "2019-04-15 25:00:00"],
     ["2019-04-15", "2010-06-18", "2010-06-18", "2019-04-15", "2019-04-15", "2019-04-15", "2019-02-01", "2019-04-15", "2019-04-15", "31.02.2020",
      "вчера", None, None, "2019-04-15 25:00:00"]),
    (X.is_bad_date, ["2019-04-15", "вчера"], [False, True]),
    (X.cast_id_number, ["007200000000", "7 200 000 000", "7200-000-000", "12-3X4", " ", "7 200"], ["007200000000", "7200000000", "7200000000", None, None, "7200"]),
    (X.is_bad_id_number, ["1", "12X", "", None], [False, True, False, False]),
    (X.triplet_code, ["031501", "03 15 01", "03-15-01", "12345", "спецкод", "090000", "09.02.07"],
     ["03.15.01", "03.15.01", "03.15.01", "12345", "спецкод", "09.00.00", "09.02.07"]),
    (X.programm_code_key, ["380301", "--", " 38.03.01 ", None], ["38.03.01", None, "38.03.01", None]),
    (lambda c: X.normalize_scalar("Qualification", c), ["0", " Бакалавр "], [None, "Бакалавр"]),
    (lambda c: X.normalize_scalar("ProgrammName", c), ["0"], ["0"]),
    (X.uid_token, [" AbC ", " ", None], ["abc", None, None]),
    (X.classify_placeholder, ["000", "—", "Н/Д", "x", " - "], ["only_zeros", "dash_only", "empty_marker", None, None]),
    (X.null_label, [None, " ", " a "], ["<null>", "<null>", "a"]),
    (X.meta_label_text, [None, " ", " a "], ["<null>", "<empty>", "a"]),
    (X.canonical_qualification, ["Юрист . ", "Юрист..", "Юрист", None], ["Юрист", "Юрист.", "Юрист", None]),
]


@pytest.mark.parametrize("rule, values, expected", CASES)
def test_scalar_rules(spark, rule, values, expected):
    assert apply(spark, rule, values) == expected


def test_number_labels(spark):
    df = spark.sql("select * from values (cast(2.0 as double)), (2.5), (null) as t(v)")
    assert [r[0] for r in df.select(X.meta_label_number(F.col("v"))).collect()] == ["2", "2.5", "<null>"]
