import pytest
from pyspark.sql import functions as F

from certweave.functions import display as D
from certweave.functions import orgnames as O
from certweave.operators import names as M

SHOWN = {
    "ЛИЦЕЙ ИМЕНИ М. В. ЛОМОНОСОВА": '"Лицей имени М.В. Ломоносова"',
    "Муниципальное бюджетное общеобразовательное учреждение «Школа №5»": 'Муниципальное бюджетное общеобразовательное учреждение "Школа № 5"',
    "мбоу СОШ №5 филиал в селе": 'МБОУ "СОШ № 5" Филиал в селе',
    "„„Колледж““ – X": '"Колледж - X"',
    "Частное учреждение ЮЖНЫЙ Федеральный ЦЕНТР": "Частное Учреждение Южный Федеральный Центр",
    '""""x""""': "X",
    # the capital rule runs twice on a bare name, the second time on a mixed text
    "СОШ ГОРОД МОСКВА": '"Сош Город Москва"',
    'ГБПОУ "" колледж': 'ГБПОУ "Колледж"',
    "ФГБОУ ВО «МГУ ИМЕНИ М.В.ЛОМОНОСОВА»": 'ФГБОУ ВО "МГУ имени М.В. Ломоносова"',
    "институт": "Институт",
    "  ": "  ",
}


def test_display_names(spark):
    df = spark.createDataFrame([(k,) for k in SHOWN], "name string")
    got = {r.name: r.d for r in df.select("name", O.normalize_display_name(F.col("name")).alias("d")).collect()}
    assert got == SHOWN


def one(spark, rule, value):
    return spark.createDataFrame([(value,)], "v string").select(rule(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize("rule, value, expected", [
    (O.quotes_to_ascii, "«a» “b” ‘c’", "\"a\" \"b\" 'c'"),
    (O.trim_in_quotes, '" a b " c "d"', '"a b" c "d"'),
    (O.strip_double_quotes, '""Имя""', "Имя"),
    (O.strip_double_quotes, '"""a"""', '"a"'),
    (O.number_sign_spacing, "№5 №  6", "№ 5 № 6"),
    (O.mask_numbers, "СОШ №№ 3 и № 12, год 1999", "СОШ № ⟨N⟩ и № ⟨N⟩, год 1999"),
    (O.initials_spacing, "М. В.Ломоносова", "М.В. Ломоносова"),
    (O.caps_kind, "ЮЖНЫЙ Федеральный", "mixed"),
    (O.caps_kind, "М.В. ЛОМОНОСОВА", "all"),
    (O.caps_kind, "САНКТ-ПЕТЕРБУРГСКИЙ ИНСТИТУТ", "none"),
    (O.title_case, "ИНСТИТУТ XXI ВЕКА ПРИ МГУ", "Институт XXI ВЕКА при МГУ"),
    (O.name_fingerprint, "МБОУ «Школа»", "мбоу школа"),
    (D.shorten_region, "Брянская область", "Брянская"),
    (D.shorten_region, "Ханты-Мансийский автономный округ — Югра", "Ханты-Мансийский"),
    (D.shorten_region, "г. Москва", "Москва"),
    (D.control_organ_short, "Министерство образования и молодёжной политики Республики Татарстан", "Минобр Татарстан"),
    (D.control_organ_short, "Комитет по образованию г. Санкт-Петербурга", "Комитет образования Санкт-Петербурга"),
    (D.control_organ_short, "Федеральная служба по надзору в сфере образования и науки", "Рособрнадзор"),
    (D.shorten_level, "Высшее образование - нечто НОВОЕ", "Нечто новое"),
    (D.shorten_level, "Иное образование", "Иное"),
])
def test_single_rules(spark, rule, value, expected):
    assert one(spark, rule, value) == expected


def test_postgraduate_kind_and_prefix_quirk(spark):
    level, code = F.lit("Высшее образование - подготовка кадров высшей квалификации"), F.lit("38.08.01")
    row = spark.range(1).select(
        D.shorten_level(level, code).alias("kind"),
        # the optional second abbreviation has no word end, so a name that begins with its letters loses them
        D.display_name(F.lit(None).cast("string"), F.lit("МБОУ ДОмовёнок")).alias("quirk")).first()
    assert (row.kind, row.quirk) == ("Ординатура", "мовёнок")


def test_merge_keeps_first_entry_and_latest_answer(spark):
    flat = "raw string, suggested_display string, reason_short string, original_raw string, seq int"
    old = M.lift_flat_entries(spark.createDataFrame([("A", "a1", "r", None, 1), ("a", "a2", None, "o2", 2)], flat), "m1")
    new = spark.createDataFrame([("a", "x", None, "o3", 1), ("a", "y", " ", None, 2), ("B", "b", "why", None, 3)], flat)
    rows = {r.key: r for r in M.merge_dictionary(old, new, "m2").collect()}
    assert rows["a"].raw == "A" and rows["a"].original_raw == "o3"
    assert rows["a"].by_model["m1"].suggested_display == "a1" and rows["a"].by_model["m2"].suggested_display == "y"
    assert rows["a"].by_model["m2"].reason_short is None and rows["b"].by_model["m2"].reason_short == "why"
